"""Reproducible shuffle into shards: a Feistel permutation with cycle walking
over global row numbers. DataFrame operations only.

Row numbers come from the order of a hash of the row's identifying columns, so
they depend on the rows alone: not on files, partitions or cluster size. Rows
fall into 4,096 hash ranges; a range's offset is the sum of the ranges before
it, and a window numbers the rows inside a range. Rows that are equal in all
identifying columns are counted first (map-side), so that a third of the table
being one row costs one group, and are expanded again at the end.

The permutation of [0, n) is a generalized Feistel network over a grid a x b
with a = ceil(sqrt(n)), b = ceil(n / a); positions of n and above walk on until
they fall below n. Shard = position mod shards, slot = position div shards:
sizes of shards in rows differ by one at most and slots have no gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table

ROUNDS = 4
#: The grid exceeds n by fewer than sqrt(n) cells, so a walk of this many steps
#: has a chance of at most n ** -31 to be too short; it then raises an error.
MAX_WALK = 64
RANGE_DIGITS = 3  # hex digits of the hash that choose one of 4,096 ranges
EXPAND_CHUNK = 65_536


def _keyed(seed: str, round_no: int, half: Column) -> Column:
    """48 pseudo-random bits of one half of a position."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{round_no}:"), half.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def feistel(position: Column, a: Column, b: Column, seed: str, rounds: int = ROUNDS) -> Column:
    """One pass of the network over the grid a x b: a bijection of [0, a * b)."""
    right = position % b
    left = ((position - right) / b).cast("long")
    for k in range(rounds):
        if k % 2 == 0:
            left = (left + _keyed(seed, k, right)) % a
        else:
            right = (right + _keyed(seed, k, left)) % b
    return left * b + right


def shard_rows(df: DataFrame, key_columns: list[str], n_shards: int, seed: str = "42") -> DataFrame:
    """``key_columns`` of every row with row_number, position, shard and slot (from 0).

    NULLs are values like any other. Rows that are equal in all key columns get
    different positions. An empty table gives an empty table. Other columns of
    ``df`` are not carried, so their names cannot clash; key columns may not
    have the names of results.
    """
    clash = {"row_number", "position", "shard", "slot"} & {c.lower() for c in key_columns}
    if clash or n_shards < 1:
        raise ValueError(f"reserved names {sorted(clash)} or bad shard count {n_shards}")
    keys = [F.col(f"`{c}`") for c in key_columns]
    as_text = [F.coalesce(k.cast("string"), F.lit("~")) for k in keys]
    order = F.md5(F.concat_ws("|", F.lit(seed), *as_text))
    groups = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    groups = groups.withColumn("__order", order).withColumn("__range", F.substring("__order", 1, RANGE_DIGITS))
    ranges = groups.groupBy("__range").agg(F.sum("__n").alias("__in_range"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "__range",
        F.coalesce(F.sum("__in_range").over(before), F.lit(0)).alias("__offset"),
        F.sum("__in_range").over(Window.partitionBy(F.lit(0))).alias("__total"),
    )
    inside = Window.partitionBy("__range").orderBy("__order", *keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # 4,096 ranges at most: the bound that allows the broadcast.
    numbered = (
        groups.withColumn("__upto", F.sum("__n").over(inside))
        .join(F.broadcast(ranges), "__range")
        .withColumn("__first", F.col("__offset") + F.col("__upto") - F.col("__n"))
        .withColumn("__chunk", F.explode(F.expr(f"sequence(0L, (__n - 1) div {EXPAND_CHUNK})")))
        .withColumn("__copy", F.explode(F.expr(f"sequence(__chunk * {EXPAND_CHUNK}, least((__chunk + 1) * {EXPAND_CHUNK}, __n) - 1)")))
        .withColumn("row_number", F.col("__first") + F.col("__copy"))
        .withColumn("__a", F.ceil(F.sqrt(F.col("__total").cast("double"))).cast("long"))
        .withColumn("__b", F.expr("(__total + __a - 1) div __a"))
    )
    total = F.col("__total")
    walked = F.aggregate(
        F.expr(f"sequence(0, {MAX_WALK})"),
        F.struct(F.col("row_number").alias("at"), F.lit(False).alias("moved")),
        lambda s, _: F.when(s["moved"] & (s["at"] < total), s).otherwise(
            F.struct(feistel(s["at"], F.col("__a"), F.col("__b"), seed).alias("at"), F.lit(True).alias("moved"))
        ),
        lambda s: F.when(s["at"] < total, s["at"]).otherwise(F.raise_error(F.lit("cycle walk too long: choose another seed")).cast("long")),
    )
    return numbered.withColumn("position", walked).select(
        *keys,
        "row_number",
        "position",
        (F.col("position") % n_shards).cast("int").alias("shard"),
        F.expr(f"position div {n_shards}").alias("slot"),
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by the law of equal row counts."""
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shard_rows(rows, ["doc_id", "size", "text_crc32"], 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_ROUND_SQL = """(('0x' || substr(md5('42:{k}:' || {half}::VARCHAR), 1, 12))::BIGINT)"""


def _feistel_sql() -> str:
    """Columns l4 and r4 from l0 and r0, as lateral aliases."""
    parts = []
    for k in range(ROUNDS):
        if k % 2 == 0:
            parts += [f"(l{k} + {_ROUND_SQL.format(k=k, half=f'r{k}')}) % a AS l{k + 1}", f"r{k} AS r{k + 1}"]
        else:
            parts += [f"l{k} AS l{k + 1}", f"(r{k} + {_ROUND_SQL.format(k=k, half=f'l{k}')}) % b AS r{k + 1}"]
    return ", ".join(parts)


OP1_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc_table),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '42', coalesce(doc_id::VARCHAR, '~'), size::VARCHAR, text_crc32::VARCHAR)), doc_id, size, text_crc32) - 1 AS n0,
    count(*) OVER () AS n, ceil(sqrt(count(*) OVER ()))::BIGINT AS a
  FROM sized),
grid AS (SELECT *, ((n + a - 1 - (n + a - 1) % a) / a)::BIGINT AS b FROM numbered),
walk AS (
  SELECT doc_id, size, text_crc32, n0, n, a, b, n0 AS pos, 0 AS step FROM grid
  UNION ALL
  SELECT doc_id, size, text_crc32, n0, n, a, b, l4 * b + r4, step + 1
  FROM (SELECT *, ((pos - pos % b) / b)::BIGINT AS l0, pos % b AS r0, {_feistel_sql()} FROM walk WHERE step = 0 OR pos >= n))
SELECT doc_id, size, text_crc32, 'rows' AS law, (pos % 8)::INTEGER AS shard, ((pos - pos % 8) / 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM walk WHERE step > 0 AND pos < n
"""
