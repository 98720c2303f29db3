"""Helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space that separates words: space and tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the
    planner true sizes for its choice of joins.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """``df`` with a column per entry of ``sums``: its total over all rows before, in ``order``.

    Rows are dealt into ranges of the order and written with their range's number; range totals
    (a row per range) give offsets, and each range is sorted in a task of its own.
    """
    ranged = materialize(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), label)
    totals = ranged.groupBy("__range").agg(*[F.sum(c).alias(f"__{name}") for name, c in sums.items()])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__range").alias("__r"), *[F.coalesce(F.sum(f"__{name}").over(earlier), F.lit(0)).alias(f"__{name}") for name in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = {name: F.col(f"__{name}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for name, c in sums.items()}
    return ranged.join(offsets, F.col("__range") == F.col("__r")).select(*df.columns, *[c.alias(name) for name, c in here.items()])


def refuse_names(keep: list[str], results: list[str]) -> None:
    """Raise if a kept column has the name of a result, or one that starts with two underscores, as helpers' do."""
    clash = {c for c in keep if c.startswith("__")} | ({c.lower() for c in keep} & {c.lower() for c in results})
    if clash:
        raise ValueError(f"reserved names: {sorted(clash)}")


def value_text(c: Column, kind: T.DataType) -> Column:
    """A value of any type as text that tells any two values apart; a NULL is ~, and what is not NULL has its length before it.

    Maps are taken in the order of their entries' texts.
    """
    if isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(c, lambda x: value_text(x, kind.elementType)), "|")
    elif isinstance(kind, T.MapType):
        pair = lambda e: F.concat(value_text(e["key"], kind.keyType), F.lit("="), value_text(e["value"], kind.valueType))
        text = F.array_join(F.array_sort(F.transform(F.map_entries(c), pair)), "|")
    elif isinstance(kind, T.StructType):
        text = F.when(c.isNotNull(), F.concat_ws("|", F.lit(""), *[value_text(c.getField(f.name), f.dataType) for f in kind.fields]))
    elif isinstance(kind, T.VariantType):
        text = F.to_json(c)
    else:
        text = F.hex(c) if isinstance(kind, T.BinaryType) else c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def row_text(df: DataFrame) -> Column:
    """All values of a row as one text, see value_text."""
    return F.concat_ws("|", *[value_text(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])


def whole_row(df: DataFrame) -> Column:
    """The row as a struct, so that no helper column can have the name of one of its columns."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def crc32_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id's decimal text; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary"))
