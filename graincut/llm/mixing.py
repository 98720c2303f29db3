"""Mixing sources to target weights.

Sources weigh 5, 2, 1, repeating in code point order (NULL last), and share a
multiple of all words. A target stops at ``max_epochs`` times its source's
words; the excess goes to the others by weight until none is above. That is a
water level: sources sorted by cap / weight, and a prefix of them is full.

Within a source, rows are sorted by a random-looking key, the MD5 of seed and
row. The key space is cut into 256 equal ranges, so that a source with a third
of all rows is sorted by 256 tasks; range totals give each range's offset and
a window sums words inside the range. A source first gives whole epochs; the
rest is cut at the exact word, inside a document if need be.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_PATTERN, materialize, read_table, running_totals, value_text, whole_row

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
EXPAND_CHUNK = 65_536  # equal rows that one task gives out
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def row_key(seed: str, *columns: Column) -> Column:
    """MD5 of seed and values. Every value has its length before it, so different rows have different texts."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def _as_text(docs: DataFrame, name: str) -> Column:
    """A column's value as text that tells any two values apart."""
    c, kind = F.col(f"`{name}`"), docs.schema[name].dataType
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    return F.when(c.isNotNull(), value_text(c, kind)) if nested else c.cast("string")


def source_targets(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target from a table (source, source_size) with a row per source.

    Ranks and levels are running totals over ranges of sources, so there may be many.
    """
    name = F.col("source").asc_nulls_last()
    ranked = running_totals(sources, [name], {"__rank": F.lit(1)}, "sources")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("__rank") % len(WEIGHTS) + 1).cast("int")).cast("double")
    weighed = ranked.withColumn("__weight", weight).withColumn("__cap", F.col("source_size") * F.lit(float(max_epochs)))
    filled = running_totals(
        weighed.withColumn("__at", F.col("__cap") / F.col("__weight")), [F.col("__at").asc(), name], {"__full_cap": F.col("__cap"), "__full_weight": F.col("__weight")}, "levels"
    )
    whole = filled.agg((F.sum("source_size") * float(share)).alias("room"), F.sum("__weight").alias("weights")).first()
    level = (F.lit(whole["room"]).cast("double") - F.col("__full_cap")) / (F.lit(whole["weights"]).cast("double") - F.col("__full_weight"))
    # The first source, by level, that is not full sets the level for all that follow.
    final = filled.where(F.col("__cap") > level * F.col("__weight")).agg(F.min(F.struct("__at", level.alias("level")))["level"].alias("level")).first()["level"]
    target = F.col("__cap") if final is None else F.least("__cap", F.lit(final) * F.col("__weight"))
    return filled.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = "42", key: Column | None = None) -> DataFrame:
    """doc_id, source, key, size, source_size, target, epochs, taken: a row per document.

    ``docs`` has doc_id, text, source; other columns are not read unless ``key`` does. NULL and
    empty texts have size 0 and nothing taken. Rows of one key are interchangeable: with the
    default key they are equal in these columns, and the order among them cannot be seen in the
    result. An empty table gives an empty plan.
    """
    key = row_key(seed, F.col("source"), F.col("doc_id").cast("string"), F.col("text")) if key is None else key
    sized = materialize(
        docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"), key.alias("key")),
        "sized",
    )
    ranged = sized.withColumn("__range", F.substring("key", 1, 2))
    ranges = materialize(ranged.groupBy("source", "__range").agg(F.sum("size").alias("__words")), "ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("__words").alias("source_size")), share, max_epochs)
    before = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("__offset", F.coalesce(F.sum("__words").over(before), F.lit(0)))
    t = targets.withColumnRenamed("source", "__s")
    offsets = offsets.join(t, F.col("source").eqNullSafe(F.col("__s"))).select(
        F.col("source").alias("__s"), F.col("__range").alias("__r"), "__offset", "source_size", "target"
    )
    inside = Window.partitionBy("source", "__range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("__offset") + F.col("__upto") - F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - epochs * F.col("source_size")
    return (
        ranged.withColumn("__upto", F.sum("size").over(inside))
        .join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__range") == F.col("__r")))
        .select(
            "doc_id",
            "source",
            "key",
            "size",
            "source_size",
            "target",
            epochs.alias("epochs"),
            (epochs * F.col("size") + F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))).cast("long").alias("taken"),
        )
    )


def _first_words(texts: pd.Series, words: pd.Series) -> pd.Series:
    """The whole text up to the end of its n-th word, white space included."""

    def cut(text: str, n: int) -> str:
        data = text.encode("utf-8", "surrogatepass")
        for k, m in enumerate(_WORDS.finditer(data), 1):
            if k == n:
                return data[: m.end()].decode("utf-8", "surrogatepass")
        return text

    return pd.Series([cut(t, n) for t, n in zip(texts, words, strict=True)], dtype=object)


def mix_documents(docs: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = "42") -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each whole copy taken of a
    document and one, cut after its last taken word, for a part. n_chars follows a cut.

    The plan is reduced to a row per source: its whole epochs, and the last key of the epoch
    that is cut. Documents with smaller keys come once more; texts are not shuffled. Rows that
    are equal in all columns share a key; those that hold the cut are one document with a count.
    NULL texts and texts without words hold nothing to take and go; a NULL source is a source.
    Columns may have any names and types.
    """
    key = row_key(seed, *[_as_text(docs, c) for c in docs.columns])
    plan = mix_plan(docs, share, max_epochs, seed, key)
    by_key = plan.groupBy("source", "key").agg(
        F.max("epochs").alias("epochs"), F.sum(F.col("taken") - F.col("epochs") * F.col("size")).alias("rest"), F.max("size").alias("size")
    )
    last = F.max_by(F.struct("key", "rest", "size"), F.when(F.col("rest") > 0, F.col("key")))
    cuts = materialize(by_key.groupBy(F.col("source").alias("__s")).agg(F.max("epochs").alias("__epochs"), last.alias("__cut")), "cuts")
    keyed = docs.select(whole_row(docs).alias("__row"), "text", "source", key.alias("__key")).where(F.col("text").rlike(WORD_PATTERN)).join(cuts, F.col("source").eqNullSafe(F.col("__s")))
    copies = F.col("__epochs") + F.coalesce((F.col("__key") < F.col("__cut.key")).cast("long"), F.lit(0))
    whole = keyed.withColumn("__copies", copies).where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    # A document per source at most, with the number of rows that are equal to it.
    at_cut = materialize(keyed.where(F.col("__key") == F.col("__cut.key")).dropDuplicates(["__key"]).select("__row", "__cut"), "at-cut")
    chunks = F.expr(f"sequence(0L, (__whole - 1) div {EXPAND_CHUNK})")
    inside = F.expr(f"sequence(__chunk * {EXPAND_CHUNK} + 1, least((__chunk + 1) * {EXPAND_CHUNK}, __whole))")
    more = at_cut.withColumn("__whole", F.expr("__cut.rest div __cut.size")).where("__whole > 0").withColumn("__chunk", F.explode(chunks))
    more = more.repartition("__chunk").withColumn("__copy", F.explode(inside))
    part = at_cut.withColumn("__words", F.expr("__cut.rest % __cut.size")).where("__words > 0")
    part = part.withColumn("__text", F.pandas_udf(_first_words, "string")("__row.text", "__words"))
    cut = F.col("__row").withField("text", F.col("__text"))
    if "n_chars" in docs.columns:
        cut = cut.withField("n_chars", F.length("__text").cast(docs.schema["n_chars"].dataType))
    return whole.select("__row").unionAll(more.select("__row")).unionAll(part.select(cut.alias("__row"))).select("__row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; NULL and empty texts have size 0 and nothing taken, repeated rows are mixed one by one."""
    return mix_plan(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat_ws('|', '42', coalesce(strlen(source) || ':' || source, '~'), coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '~'),
      coalesce(strlen(text) || ':' || text, '~'))) AS key
  FROM documents),
sources AS (
  SELECT source AS s, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS room, sum(w) OVER () AS ws,
    coalesce(sum(2.0 * source_size) OVER b, 0) AS full_cap, coalesce(sum(w) OVER b, 0) AS full_w
  FROM sources WINDOW b AS (ORDER BY source_size / w, encode(s) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT min_by((room - full_cap) / (ws - full_w), cap / w) AS final FROM levels WHERE cap > (room - full_cap) / (ws - full_w) * w),
targets AS (SELECT s, source_size, CASE WHEN final IS NULL THEN cap ELSE least(cap, final * w) END::DOUBLE AS target FROM levels, level),
placed AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs,
    sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized JOIN targets ON source IS NOT DISTINCT FROM s)
SELECT doc_id, size, source_size, target,
  (epochs * size + least(greatest(floor(target)::BIGINT - epochs * source_size - start, 0), size))::BIGINT AS taken
FROM placed
"""
