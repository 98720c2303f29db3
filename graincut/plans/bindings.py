"""The driver's tables as annotated records, and the same as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import area_bin, rate_bin
from ..operators.dedup import label_signature
from ..operators.metrics import core_metrics
from ..operators.rules import apply_policy
from ..sources.tables import read_table

FACETS = ["F", "O", "P"]
POLICY_REASON = "extent_max_ge_0.25"


def documents_as_items(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, source, lang, content_hash, signature."""
    labels = read_table(spark, sf, "labels")
    docs = read_table(spark, sf, "documents").select("doc_id", "source", "lang", F.sha1("text").alias("content_hash"))
    return docs.join(labels, "doc_id", "left").select(
        "doc_id", "source", "lang", "content_hash", label_signature(F.col("quality"), F.col("toxic")).alias("signature")
    )


def orders_as_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as items of customers (groups); returned or accepted lines with a high discount
    as annotations. Extents are counted in 1/2000, so that bounds are exact."""
    d = F.rint(F.col("l_discount") * 100).cast("long")
    area = d * F.col("l_quantity").cast("long")
    lines = read_table(spark, sf, "lineitem").where((d >= 8) & F.col("l_returnflag").isin("R", "A"))
    marks = lines.groupBy(F.col("l_orderkey").alias("item_id")).agg(
        F.count(F.lit(1)).alias("n_annotations"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_first"),
        F.count(F.when(F.col("l_returnflag") == "A", 1)).alias("n_second"),
        F.sum(area).alias("area_sum"),
        F.max(area).alias("area_max"),
    )
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    orders = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.col("o_custkey").alias("group_id"),
        F.when(F.col("o_custkey") % 2 == 0, "A").otherwise("B").alias("kind"), F.col("o_orderstatus").alias("facet"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        orders.join(customers, F.col("group_id") == F.col("c_custkey"))
        .join(marks, "item_id", "left")
        .select("item_id", "group_id", "kind", "facet", "segment", F.col("c_nationkey").alias("region_id"), *map(zero, ("n_annotations", "n_first", "n_second", "area_sum", "area_max")))
        .withColumns({"extent_sum": F.col("area_sum") / 2000.0, "extent_max": F.col("area_max") / 2000.0})
    )


def ruled_items(spark: SparkSession, sf: str) -> DataFrame:
    return apply_policy(orders_as_items(spark, sf), "A", F.col("extent_max"), 0.25, POLICY_REASON)


def rated_groups(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Eligible groups of a kind: core metrics, class flags, rate bin, segment."""
    items = ruled_items(spark, sf).where((F.col("kind") == kind) & F.col("eligible"))
    flags = items.groupBy("group_id").agg(F.bool_or(F.col("n_first") > 0).alias("has_first"), F.min("segment").alias("segment"))
    return core_metrics(items, ["group_id"]).join(flags, "group_id").withColumn("rate_bin", rate_bin("positive_ratio"))


def binned_items(spark: SparkSession, sf: str) -> DataFrame:
    return orders_as_items(spark, sf).withColumn("area_bin", area_bin("extent_sum"))


RATE_BIN_SQL = """CASE WHEN positive_ratio <= 1e-12 THEN 'zero' WHEN positive_ratio < 0.01 - 1e-12 THEN 'very_low' WHEN positive_ratio < 0.3 - 1e-12 THEN 'low_mid'
    WHEN positive_ratio < 0.6 - 1e-12 THEN 'mid_high' ELSE 'very_high' END"""

ITEMS_SQL = f"""
WITH marks AS (
  SELECT l_orderkey, count(*) AS n_annotations, count(*) FILTER (l_returnflag = 'R') AS n_first, count(*) FILTER (l_returnflag = 'A') AS n_second,
    sum(round(l_discount * 100)::BIGINT * l_quantity::BIGINT)::BIGINT AS area_sum, max(round(l_discount * 100)::BIGINT * l_quantity::BIGINT) AS area_max
  FROM lineitem WHERE round(l_discount * 100) >= 8 AND l_returnflag IN ('R', 'A') GROUP BY 1),
items AS (
  SELECT o_orderkey AS item_id, o_custkey AS group_id, CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS kind, o_orderstatus AS facet,
    c_mktsegment AS segment, c_nationkey AS region_id, coalesce(n_annotations, 0) AS n_annotations, coalesce(n_first, 0) AS n_first,
    coalesce(n_second, 0) AS n_second, coalesce(area_sum, 0) / 2000.0::DOUBLE AS extent_sum, coalesce(area_max, 0) / 2000.0::DOUBLE AS extent_max
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN marks ON l_orderkey = o_orderkey),
ruled AS (SELECT *, NOT (kind = 'A' AND extent_max >= 0.25) AS eligible, CASE WHEN kind = 'A' AND extent_max >= 0.25 THEN 'extent_max_ge_0.25' END AS policy_reason FROM items),
rated AS (
  SELECT *, {RATE_BIN_SQL} AS rate_bin
  FROM (SELECT kind, group_id, count(*) AS n_items, count(*) FILTER (n_annotations > 0) AS n_positive, sum(n_annotations)::BIGINT AS n_annotations,
      bool_or(n_first > 0) AS has_first, min(segment) AS segment, count(*) FILTER (n_annotations > 0) / count(*) AS positive_ratio
    FROM ruled WHERE eligible GROUP BY ALL))
"""

AREA_BIN_SQL = """CASE WHEN extent_sum = 0 THEN 'zero' WHEN extent_sum < 0.001 THEN 'lt_0.1pct' WHEN extent_sum < 0.01 THEN '0.1_1pct' WHEN extent_sum < 0.05 THEN '1_5pct'
  WHEN extent_sum < 0.1 THEN '5_10pct' WHEN extent_sum < 0.25 THEN '10_25pct' WHEN extent_sum < 0.4 THEN '25_40pct' WHEN extent_sum < 0.5 THEN '40_50pct' ELSE 'ge_50pct' END"""

DUP_SQL = """
WITH items AS (
  SELECT doc_id, source, lang, sha1(text) AS content_hash, coalesce(quality, -1) || ',' || coalesce(toxic, -1) AS signature
  FROM documents LEFT JOIN labels USING (doc_id)),
facts AS (
  SELECT content_hash AS h, count(*) AS n, count(DISTINCT {group}) AS n_groups, count(DISTINCT signature) AS n_signatures, min(doc_id) AS first_id
  FROM items WHERE content_hash IS NOT NULL GROUP BY 1),
numbered AS (SELECT h AS nh, 'dup_' || lpad(row_number() OVER (ORDER BY h)::VARCHAR, 6, '0') AS dup_group FROM facts WHERE n > 1),
resolved AS (
  SELECT doc_id, source, lang, content_hash, coalesce(n, 1) AS n_copies, dup_group,
    CASE WHEN coalesce(n, 1) = 1 THEN 'single' WHEN n_groups > 1 THEN 'cross_group' WHEN n_signatures > 1 THEN 'label_conflict'
      WHEN doc_id = first_id THEN 'representative' ELSE 'duplicate' END AS action
  FROM items LEFT JOIN facts ON content_hash = h LEFT JOIN numbered ON content_hash = nh)
"""
