"""One digest of many lines, in any order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = 4096  # lines, on average, that one leaf of the tree joins


def tree_digest(rows: DataFrame, key: Column, line: Column, name: str) -> DataFrame:
    """One row, ``name``: SHA-256 over a tree of digests of the lines.

    A leaf joins the sorted lines whose key's SHA-1 has the same first hex digits: two, or as many
    more as keep leaves at about LINES lines. Inner nodes join those that share all digits but the
    last, down to two digits; the root joins these. No task holds more than a leaf or 256 digests.
    """
    lines = rows.select(F.sha1(key).alias("__key"), line.alias("__line"))
    digits, n = 2, lines.count()
    while n > LINES * 16**digits:
        digits += 1
    joined = F.sha2(F.array_join(F.array_sort(F.collect_list("__line")), "\n"), 256)
    nodes = lines.groupBy(F.substring("__key", 1, digits).alias("b")).agg(joined.alias("h"))
    children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: F.concat_ws(":", x["b"], x["h"])), "\n")
    for d in range(digits - 1, 1, -1):
        nodes = nodes.groupBy(F.substring("b", 1, d).alias("up")).agg(F.sha2(children, 256).alias("h")).withColumnRenamed("up", "b")
    return nodes.agg(F.sha2(children, 256).alias(name))
