"""Near-duplicates by SimHash, joined by meet-in-the-middle ball hashing.

Two 64-bit fingerprints that differ in 1 to 3 bits meet at a value between
them, at most half the radius, rounded up, from either:

* one bit or three: their parities differ. The even one emits the 64 values one
  bit away. The odd one emits itself and values two bits away - of three bits
  two lie in the same half, so pairs inside a half (2 x 496) are enough.
* two bits: their parities agree, and both emit the 64 values one bit away.

So a shuffle on the emitted values brings all linked fingerprints together; no
bucket of whole groups is ever paired. At a value, every fingerprint one bit
away links to all others there; a star around the least of them holds the
group's links in a row per member. Pairs are verified and deduplicated, and
stars are contracted to components. Copies are counted once: only distinct
fingerprints emit.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, refuse_names, row_text, whole_row

SHINGLE = 3
SEED = 42
RADIUS = 3
BLOCK = 32_768  # shingles whose bits are counted at once


def fingerprint_text(text: str | None) -> int:
    """The signed 64-bit fingerprint of one whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < SHINGLE:
        digests, n = [[digest(b" ".join(words), SEED)]], 1
    else:
        n = len(words) - SHINGLE + 1
        join = b" ".join
        digests = (
            [digest(join(words[k : k + SHINGLE]), SEED) for k in range(a, min(n, a + BLOCK))] for a in range(0, n, BLOCK)
        )
    ones = np.zeros(64, dtype=np.int64)
    for block in digests:
        bits = np.unpackbits(np.frombuffer(b"".join(block), np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def _fingerprint_batch(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_text(x) for x in texts], dtype="int64")


def fingerprint(text: Column | str) -> Column:
    return F.pandas_udf(_fingerprint_batch, "long")(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(values: Iterable[int]) -> Column:
    return F.array(*[F.lit(_signed(v)) for v in values])


def near_pairs(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b), a < b or b < a, that connect all of the distinct values ``fp`` within RADIUS."""
    one = [1 << k for k in range(64)]
    inside = [1 << i | 1 << j for half in (0, 32) for i in range(half, half + 32) for j in range(half, i)]
    emit = lambda masks: F.explode(F.transform(_masks(masks), lambda m: F.col("fp").bitwiseXOR(m)))
    odd = F.bit_count("fp") % 2 == 1
    shell = fingerprints.select("fp", emit(one).alias("met"))
    far = fingerprints.where(odd).select("fp", emit([0, *inside]).alias("met"))
    centers = shell.groupBy("met").agg(F.min("fp").alias("center"))
    pairs = shell.unionAll(far).join(centers, "met").where(F.col("fp") != F.col("center"))
    pairs = pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("center"))) <= RADIUS)
    return pairs.select(F.col("fp").alias("a"), F.col("center").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the least node reachable.

    Alternating stars: each node hands its larger neighbours to its least one,
    then its smaller ones, until nothing changes. Every round is a pair of
    aggregations and joins, written to the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "w")
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(lower, F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(lower.select(F.col("w").alias("u"), F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = now


def near_duplicates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, fp and component_id (least doc_id of the component), a row per row.

    ``docs`` has doc_id and text. NULL and empty texts share fingerprint 0 and
    link like any other. A NULL doc_id counts in no minimum; a component of
    such rows alone has a NULL id. Repeated rows get the same result each. ``keep`` may not name results.
    """
    refuse_names(keep, ["fp", "component_id"])
    kept = [F.col(f"`{c}`") for c in keep]
    marked = materialize(docs.select(*kept, F.col("doc_id").alias("__id"), fingerprint("text").alias("fp")), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("__id").alias("__least")), "distinct")
    # The few narrow files of distinct values are dealt out again, as each value becomes up to 1,057 rows.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roots = components(near_pairs(distinct.select("fp").repartition(tasks, "fp")))
    grouped = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "__least", F.coalesce("root", "fp").alias("__root"))
    ids = grouped.groupBy("__root").agg(F.min("__least").alias("component_id")).withColumnRenamed("__root", "__r")
    classes = grouped.join(ids, F.col("__root") == F.col("__r")).select(F.col("fp").alias("__fp"), "component_id")
    return marked.join(materialize(classes, "classes"), F.col("fp") == F.col("__fp")).select(*kept, "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``: one document of each component, that of the least doc_id.

    Rows that share doc_id and component are cut to one by the order of their
    digests. Of a component without doc_ids the row with the least digest stays.
    NULL and empty texts are one component, of which one row stays. Columns may have any names and types.
    """
    # 128 bits that stand for a whole row; never NULL, so that join and cut share one shuffle.
    keyed = docs.select(whole_row(docs).alias("row"), "doc_id", "text", F.md5(row_text(docs)).alias("row_key"))
    marked = near_duplicates(keyed, ["doc_id", "row_key"])
    pick = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row_key"))).alias("p")
    picked = marked.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone")).agg(pick)
    return keyed.select("row", "row_key").join(picked.select("p.row_key"), "row_key", "left_semi").dropDuplicates(["row_key"]).select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, see near_duplicates; texts without words share fingerprint zero."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
