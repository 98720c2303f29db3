"""Quality rules by host: rule failures counted by domain, rates shrunk with an
empirical beta prior, verdicts joined back to documents."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, refuse_names, whole_row

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 5


@dataclass(frozen=True)
class HostPolicy:
    """Limits of the document rules and of the host rule."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbol_percent: int = 10  # symbols per 100 words
    max_dup_line_percent: int = 30
    min_mean_chars: float = 2.0
    max_mean_chars: float = 20.0
    #: A host goes when the odds of its shrunk rate of failing documents are more than this
    #: many times those of the prior's mean, so that any corpus may have such hosts.
    max_odds_ratio: float = 3.0


def _repeat_words(words: list[bytes]) -> int:
    """Words covered by 5-word windows that occur at least twice."""
    m = len(words) - WINDOW + 1
    if m < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    d = len(ids)
    if d**WINDOW < 2**62:
        key = a[:m].copy()
        for k in range(1, WINDOW):
            key *= d
            key += a[k : m + k]
    else:  # pairs, then fours, then fives, renumbered each time so that keys stay exact
        two = np.unique(a[:-1] * d + a[1:], return_inverse=True)[1]
        four = np.unique(two[:-2] * len(words) + two[2:], return_inverse=True)[1]
        key = four[:m] * d + a[4 : m + 4]
    _, at, n = np.unique(key, return_inverse=True, return_counts=True)
    repeated = (n[at] > 1).astype(np.int64)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:m] += repeated
    edge[WINDOW : m + WINDOW] -= repeated
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The measures of one whole text; a NULL text has none of anything."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        len(lines),
        _repeat_words(words),
    )


def _measure_batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure_text(x) for x in texts], columns=[x.split()[0] for x in MEASURES.split(", ")], dtype="int64")


def measures(text: Column | str) -> Column:
    return F.pandas_udf(_measure_batch, MEASURES)(text)


def base_failed(m: Column, policy: HostPolicy) -> Column:
    return (m["n_words"] < policy.min_words) | (100 * m["n_repeat_words"] > policy.max_repeat_percent * m["n_words"])


def rule_failed(m: Column, policy: HostPolicy) -> Column:
    """True if any document rule fails: the base rules, symbols, doubled lines, word length."""
    mean = m["word_chars"] / F.greatest(m["n_words"], F.lit(1))
    return (
        base_failed(m, policy)
        | (100 * m["n_symbols"] > policy.max_symbol_percent * m["n_words"])
        | (100 * m["n_dup_lines"] > policy.max_dup_line_percent * m["n_lines"])
        | (mean < policy.min_mean_chars)
        | (mean > policy.max_mean_chars)
    )


def document_measures(docs: DataFrame, keep: list[str], policy: HostPolicy, text: str = "text", host: str = "source") -> DataFrame:
    """``keep`` columns, __host and the struct __m of measures, with both rule flags."""
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{host}`").alias("__host"), measures(F.col(f"`{text}`")).alias("__m")).select(
        "*", base_failed(F.col("__m"), policy).alias("__base"), rule_failed(F.col("__m"), policy).alias("__failed")
    )


def host_verdicts(measured: DataFrame, policy: HostPolicy) -> DataFrame:
    """One row per host (a NULL host is a host): counts, shrunk rate, blocked.

    The beta prior is fitted to the counts of all hosts by moments. With one
    host, or hosts that differ no more than chance, the prior pulls every
    host to the common rate; without documents the table is empty. Where all
    documents fail, or none does, no host is blocked.
    """
    hosts = materialize(
        measured.groupBy("__host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("__failed").cast("long")).alias("n_failed")),
        "hosts",
    )
    n, x = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    s = hosts.agg(F.count(F.lit(1)).alias("h"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.sum(x).alias("x"), F.sum(x * x / n).alias("xxn")).first()
    alpha = beta = p = 0.0
    if s["h"]:
        p = s["x"] / s["n"]
        chance = p * (1 - p)
        room = chance * (s["n"] - s["nn"] / s["n"] - (s["h"] - 1))
        rho = (s["xxn"] - s["x"] ** 2 / s["n"] - chance * (s["h"] - 1)) / room if room > 0 else 0.0
        strength = 1 / min(max(rho, 1e-6), 0.999) - 1
        alpha, beta = p * strength, (1 - p) * strength
    rate = (x + alpha) / (n + alpha + beta)
    blocked = rate * (1 - p) > policy.max_odds_ratio * p * (1 - rate)
    return hosts.select("*", rate.alias("host_rate"), blocked.alias("host_blocked"))


def judge_documents(docs: DataFrame, keep: list[str], policy: HostPolicy = HostPolicy()) -> DataFrame:
    """``keep`` columns, measures, base_failed, host_rate and kept, a row per document.

    A document goes if it fails a base rule or its host is blocked. Empty and
    NULL texts have no words and fail; repeated rows are judged one by one.
    ``keep`` may not name results or names that start with two underscores.
    """
    measured = document_measures(docs, keep, policy)
    refuse_names(keep, [*measured.schema["__m"].dataType.names, "base_failed", "host_rate", "kept"])
    measured = materialize(measured, "measures")
    hosts = host_verdicts(measured, policy).select(F.col("__host").alias("__h"), "host_rate", "host_blocked")
    return measured.join(hosts, F.col("__host").eqNullSafe(F.col("__h"))).select(
        *[F.col(f"`{c}`") for c in keep],
        "__m.*",
        F.col("__base").alias("base_failed"),
        "host_rate",
        (~F.col("__base") & ~F.col("host_blocked")).alias("kept"),
    )


def keep_documents(docs: DataFrame, policy: HostPolicy = HostPolicy()) -> DataFrame:
    """The rows of ``docs``, unchanged, that pass their base rules and whose host is not blocked.

    Texts are measured once: rows are written with their host and the outcome of the rules, those
    that fail a base rule without their own columns; the verdicts on hosts read two narrow columns
    of that table. NULL and empty texts fail; a NULL host is a host. Columns may have any names and types.
    """
    rows = docs.select(whole_row(docs).alias("__row"), "text", "source")
    measured = document_measures(rows, ["__row"], policy).drop("__m")
    judged = materialize(measured.select(F.when(~F.col("__base"), F.col("__row")).alias("__row"), "__host", "__base", "__failed"), "judged")
    hosts = host_verdicts(judged, policy).where("host_blocked").select(F.col("__host").alias("__h"))
    passed = judged.where(~F.col("__base")).join(hosts, F.col("__host").eqNullSafe(F.col("__h")), "left_anti")
    return passed.select("__row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, see judge_documents; a NULL source is a host, and NULL texts have no words and fail."""
    return judge_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["doc_id"])


OP2_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
positions AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM words WHERE len(w) >= 5),
windows AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM positions),
doubled AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM doubled) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM words)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
measured AS (
  SELECT r, doc_id, source, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeated USING (r) LEFT JOIN lines USING (r)),
flagged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
      OR word_chars / greatest(n_words, 1) < 2 OR word_chars / greatest(n_words, 1) > 20 AS failed
  FROM measured),
hosts AS (SELECT source AS h, count(*)::DOUBLE AS n, sum(failed::INTEGER)::DOUBLE AS x FROM flagged GROUP BY source),
sums AS (SELECT count(*) AS hs, sum(n) AS n, sum(n * n) AS nn, sum(x) AS x, sum(x * x / n) AS xxn, sum(x) / sum(n) AS p FROM hosts),
room AS (SELECT *, p * (1 - p) * (n - nn / n - (hs - 1)) AS room, xxn - x * x / n - p * (1 - p) * (hs - 1) AS excess FROM sums),
prior AS (SELECT p, 1 / least(greatest(CASE WHEN room > 0 THEN excess / room ELSE 0 END, 1e-6), 0.999) - 1 AS strength FROM room),
rates AS (SELECT h, p, (x + p * strength) / (n + p * strength + (1 - p) * strength) AS host_rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words, base_failed, host_rate,
  NOT base_failed AND host_rate * (1 - p) <= 3 * p * (1 - host_rate) AS kept
FROM flagged JOIN rates ON source IS NOT DISTINCT FROM h
"""
