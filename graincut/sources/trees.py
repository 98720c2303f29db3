"""Recorded tables with a digest for each range of their keys, and their difference by reading only ranges whose digests differ."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = 8  # tasks that write a leaf, so that a key with many rows is not one task's
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _line(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _TIMES)


def record_tree(table: DataFrame, key: list[str], path: str, leaves: int = 256) -> None:
    """Write ``table`` under ``path``: rows by leaf (a range of hashes of their ``key``), a digest and number
    of rows for each leaf, and what describes them.

    A leaf's digest adds 120 bits of the SHA-256 of its rows, as often as they occur, so order does not
    show, and is summed before the shuffle; it tells accidents apart, not forgeries. Rows of any
    types will do; NULL is a value, also in keys. Column names with two leading underscores are refused.
    """
    if any(c.startswith("__") for c in table.columns) or not key:
        raise ValueError(f"no key, or a column with two leading underscores: {table.columns}")
    spark, line = table.sparkSession, F.sha2(_line(table.columns), 256)
    leaf = F.pmod(F.xxhash64(_line(key)), F.lit(leaves)).cast("int")
    rows = table.withColumns({"__line": line, "__leaf": leaf}).repartition("__leaf", F.pmod(F.xxhash64("__line"), F.lit(PARTS)))
    rows.write.partitionBy("__leaf").parquet(f"{path}/rows")
    schema = T.StructType([*table.schema.fields, T.StructField("__line", T.StringType()), T.StructField("__leaf", T.IntegerType())])
    about = json.dumps({"key": key, "leaves": leaves, "schema": schema.json()})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.parquet(f"{path}/about")
    bits = [F.sum(F.conv(F.substring("__line", at, 15), 16, 10).cast("decimal(20,0)")).alias(name) for at, name in ((1, "high"), (16, "low"))]
    stored = spark.read.schema(schema).parquet(f"{path}/rows")
    stored.groupBy("__leaf").agg(F.count(F.lit(1)).alias("n"), *bits).coalesce(1).write.parquet(f"{path}/digests")


def _about(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.schema("about string").parquet(f"{path}/about").first()["about"])


def differing_leaves(spark: SparkSession, left: str, right: str) -> list[int]:
    """Leaves, in order, whose digests differ or that one side lacks: at most the tables' number of leaves."""
    sides = [spark.read.schema("__leaf int, n long, high decimal(30,0), low decimal(30,0)").parquet(f"{x}/digests") for x in (left, right)]
    own = [d.select("__leaf", F.struct("n", "high", "low").alias(s)) for d, s in zip(sides, "lr", strict=True)]
    return sorted(r["__leaf"] for r in own[0].join(own[1], "__leaf", "full_outer").where(~F.col("l").eqNullSafe(F.col("r"))).select("__leaf").collect())


def tree_difference(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The rows that one recorded table holds more often than the other: side (left or right), n_more and all
    columns. Leaves with equal digests are not read. Both need the same key, number of leaves and schema."""
    about = _about(spark, left)
    if about != _about(spark, right):
        raise ValueError("tables recorded with another key, number of leaves or schema")
    schema = T.StructType.fromJson(json.loads(about["schema"]))
    columns, leaves = [f"`{c}`" for c in schema.names if not c.startswith("__")], differing_leaves(spark, left, right)
    read = lambda path, sign: spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("__leaf").isin(leaves)).withColumn("__sign", F.lit(sign))
    both = read(left, 1).unionByName(read(right, -1))
    more = both.groupBy("__leaf", "__line").agg(F.sum("__sign").alias("__n"), F.first(F.struct(*columns)).alias("__row")).where(F.col("__n") != 0)
    return more.select(F.when(F.col("__n") > 0, "left").otherwise("right").alias("side"), F.abs("__n").alias("n_more"), "__row.*")


def changed_keys(difference: DataFrame, key: list[str]) -> DataFrame:
    """key and change of each key with rows in ``tree_difference``: removed (left only), added or changed."""
    sides = F.array_sort(F.collect_set("side"))
    change = F.when(F.size(sides) == 2, "changed").when(sides[0] == "left", "removed").otherwise("added")
    return difference.groupBy(*key).agg(change.alias("change"))
