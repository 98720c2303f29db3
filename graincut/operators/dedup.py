"""Exact duplicates across and within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RANGE_DIGITS = 3  # hex digits of the hash that choose one of 4,096 ranges


def label_signature(*parts: Column) -> Column:
    """Digest of an item's labels for the conflict test; NULLs count as values."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{k}") for k, p in enumerate(parts)]), {"ignoreNullFields": "false"}), 256)


def record_signature(targets: Column, is_normal: Column, extent: Column) -> Column:
    """Digest of a record's labels (see records.targets), its normal flag and the ``extent`` that rules it, NULL if none does.

    Targets count as (class, points) in the order of their JSON texts, so records that list them in another order are equal;
    a repeated target counts as often as it stands, one of unknown class not at all.
    """
    known = F.filter(targets, lambda t: t["class"].isNotNull())
    items = F.array_sort(F.transform(known, lambda t: F.to_json(F.struct(t["class"].alias("class"), t["points"].alias("points")), {"ignoreNullFields": "false"})))
    return label_signature(items, is_normal, extent)


def resolve_duplicates(items: DataFrame, content_hash: str, group: list[str], signature: str, order: list[str]) -> DataFrame:
    """``items`` with action, n_copies and dup_group.

    Items of one content hash: in several groups, all go (cross_group); in one
    group with different labels, all go (label_conflict); else the first by
    ``order`` stays (representative) and the rest go (duplicate). Items without a
    hash stay and are compared with none: single, one copy. dup_group numbers
    hashes with several items in hash order, range by range of their first hex
    digits. Per-hash facts are aggregated map-side and joined back, so a hash
    with a third of all items is no hot task.
    """
    key = F.struct(*group)
    facts = items.where(F.col(content_hash).isNotNull()).groupBy(F.col(content_hash).alias("__h")).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(key).alias("__g0"),
        F.max(key).alias("__g1"),
        F.min(F.struct(signature)).alias("__s0"),  # in a struct, a NULL is a value
        F.max(F.struct(signature)).alias("__s1"),
        F.min(F.struct(*order)).alias("__first"),
    )
    several = facts.where("__n > 1").select(F.col("__h").alias("__k"), F.substring("__h", 1, RANGE_DIGITS).alias("__range"))
    earlier = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = several.groupBy(F.col("__range").alias("__r")).agg(F.count(F.lit(1)).alias("__in")).select(
        "__r", F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__before")
    )
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__k"))
    numbers = several.withColumn("__place", place).join(offsets, F.col("__range") == F.col("__r")).select("__k", (F.col("__before") + F.col("__place")).alias("__no"))
    facts = facts.join(numbers, F.col("__h") == F.col("__k"), "left")
    copies = F.coalesce("__n", F.lit(1))
    action = (
        F.when(copies == 1, "single")
        .when(~F.col("__g0").eqNullSafe(F.col("__g1")), "cross_group")
        .when(~F.col("__s0").eqNullSafe(F.col("__s1")), "label_conflict")
        .when(F.struct(*order).eqNullSafe(F.col("__first")), "representative")
        .otherwise("duplicate")
    )
    return items.join(facts, F.col(content_hash) == F.col("__h"), "left").select(
        *items.columns, copies.alias("n_copies"), action.alias("action"), F.when(F.col("__no").isNotNull(), F.format_string("dup_%06d", "__no")).alias("dup_group")
    )


def review_duplicates(resolved: DataFrame, max_groups: int = 50, max_share: float = 0.01) -> DataFrame:
    """One row: cross-group hashes and items, all items, and whether they ask for a review."""
    cross = F.col("action") == "cross_group"
    counts = resolved.agg(
        F.count_distinct(F.when(cross, F.col("dup_group"))).alias("cross_groups"),
        F.count(F.when(cross, 1)).alias("cross_items"),
        F.count(F.lit(1)).alias("n_items"),
    )
    share = F.coalesce(F.try_divide("cross_items", "n_items"), F.lit(0.0))
    return counts.withColumn("review", (F.col("cross_groups") > max_groups) | (share > max_share))


def valid_items(resolved: DataFrame, included: Column) -> DataFrame:
    """Items that the scan includes and duplicates don't exclude; a NULL verdict of the scan excludes."""
    return resolved.where(F.coalesce(included, F.lit(False)) & F.col("action").isin("single", "representative"))
