"""All queries of the library with the DuckDB SQL that checks them."""

from __future__ import annotations

from .plans import queries, record_queries, release_queries  # noqa: F401  (these register their queries)

QUERIES = queries.QUERIES
ORACLES = queries.ORACLES
FLAGSHIP = "dup_actions"
