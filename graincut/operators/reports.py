"""Roll-up of annotations to items, and the report tables over items and groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rate_bin
from ..sources.tables import settle
from .apportion import same_keys
from .metrics import medians, nearest_rank, share

#: Ratios are summed as decimals, so that sums don't depend on the order of rows.
EXACT = "decimal(28,12)"


def roll_up(annotations: DataFrame, by: list[str], measured: Column) -> DataFrame:
    """One row per item from converted annotations (see rings.convert_annotations).

    Boxes hold only if all annotations of the item have one, rings likewise; an item whose
    rings fail keeps its boxes. ``measured`` marks the annotations that extents are taken of;
    extents stay when boxes go. Counts are those after clearing: a box and a ring for each part of a
    ring; n_more_parts is how many parts there are beyond the first of each annotation.
    """
    item = annotations.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_given"),
        F.bool_and("box_valid").alias("boxes_hold"),
        F.bool_and("ring_valid").alias("rings_hold"),
        F.sum("n_boxes").alias("n_boxes"),
        F.sum("n_rings").alias("n_rings"),
        F.sum(F.greatest(F.col("n_boxes") - 1, F.lit(0))).cast("long").alias("n_more_parts"),
        F.bool_or("min_extent").alias("min_extent"),
        F.coalesce(F.sum(F.when(measured, F.col("area_ratio").cast(EXACT))).cast("double"), F.lit(0.0)).alias("extent_sum"),
        F.coalesce(F.max(F.when(measured, F.col("box_ratio"))), F.lit(0.0)).alias("extent_max"),
    )
    return item.select(
        *by,
        "n_given",
        F.when(F.col("boxes_hold"), F.col("n_boxes")).otherwise(0).cast("long").alias("n_boxes"),
        F.when(F.col("rings_hold"), F.col("n_rings")).otherwise(0).cast("long").alias("n_rings"),
        F.when(F.col("boxes_hold"), F.col("n_more_parts")).otherwise(0).cast("long").alias("n_more_parts"),
        "min_extent",
        "extent_sum",
        "extent_max",
        F.when(~F.col("boxes_hold"), "invalid_target_polygon").alias("box_reason"),
        F.when(~F.col("rings_hold"), "ring_repair_failed").alias("ring_reason"),
    )


def geometry_totals(annotations: DataFrame, item: str) -> DataFrame:
    """One row for reviewers: annotations repaired or clipped, annotations in several parts, parts beyond the
    first, items with a widened box, and whether there is any. Takes the rows of rings.convert_annotations."""
    counts = annotations.agg(
        F.count(F.when(F.array_contains("issues", "polygon_repaired_or_clipped"), 1)).alias("n_repaired"),
        F.count(F.when(F.col("n_boxes") > 1, 1)).alias("n_several_parts"),
        F.coalesce(F.sum(F.when(F.col("n_boxes") > 1, F.col("n_boxes") - 1)), F.lit(0)).cast("long").alias("n_more_parts"),
        F.count_distinct(F.when(F.col("min_extent"), F.col(item))).alias("n_min_extent"),
    )
    return counts.withColumn("review", F.col("n_repaired") + F.col("n_several_parts") + F.col("n_min_extent") > 0)


def group_scan(items: DataFrame, by: list[str], valid: Column, eligible: Column, facets: list[str]) -> DataFrame:
    """Per group: items scanned, valid, eligible, excluded, by facet, and the ratios of the eligible."""
    mine = valid & eligible
    n = lambda c: F.count(F.when(c, 1))
    rows = items.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_scanned"),
        n(valid).alias("n_valid"),
        n(mine).alias("n_eligible"),
        n(valid & ~eligible).alias("n_excluded"),
        *[n(mine & (F.col("facet") == f)).alias(f"n_facet_{f.lower()}") for f in facets],
        share(n(mine & (F.col("n_annotations") > 0)), n(mine)).alias("positive_ratio"),
        share(F.coalesce(F.sum(F.when(mine, F.col("n_annotations"))), F.lit(0)), n(mine)).alias("density"),
    )
    return rows


def preservation(items: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """Per group of the valid ``items``: those discovered, eligible and excluded, whether any is left, and the role and fold
    that ``groups`` (key, role, fold) gives it; preserved: it has one. A NULL eligible is not eligible."""
    ok = F.coalesce(F.col("eligible"), F.lit(False))
    n = lambda c: F.count(F.when(c, 1))
    found = items.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_discovered"), n(ok).alias("n_eligible"), n(~ok).alias("n_excluded"), share(n(~ok), F.count(F.lit(1))).alias("excluded_ratio"),
        share(F.coalesce(F.sum(F.when(ok, F.col("n_annotations"))), F.lit(0)), n(ok)).alias("density"), (n(ok) == 0).alias("emptied"),
    )
    return found.join(groups.select(*key, F.lit(True).alias("preserved"), "role", "fold"), key, "left").withColumn("preserved", F.coalesce("preserved", F.lit(False)))


def selected_groups(items: DataFrame, groups: DataFrame, key: list[str], segment: str, facets: list[str]) -> DataFrame:
    """Per assigned group: role, fold, segment, valid and ``selected`` items, by facet, and the ratios, class flags and, of kind A, the
    rate bin of the selected ones; zeros and false where none is selected."""
    sel = F.coalesce(F.col("selected"), F.lit(False))
    n = lambda c: F.count(F.when(c, 1))
    some = lambda c: F.coalesce(F.bool_or(F.when(sel, F.col(c) > 0)), F.lit(False))
    own = items.groupBy(*key).agg(
        F.min(segment).alias("segment"), F.count(F.lit(1)).alias("n_valid"), n(sel).alias("n_selected"), *[n(sel & (F.col("facet") == f)).alias(f"n_facet_{f.lower()}") for f in facets],
        share(n(sel & (F.col("n_annotations") > 0)), n(sel)).alias("positive_ratio"), share(F.coalesce(F.sum(F.when(sel, F.col("n_annotations"))), F.lit(0)), n(sel)).alias("density"),
        some("n_first").alias("has_first"), some("n_second").alias("has_second"),
    )
    return own.join(groups.select(*key, "role", "fold"), key).withColumn("rate_bin", F.when(F.col("kind") == "A", rate_bin("positive_ratio")))


def rate_bin_report(groups: DataFrame, quotas: DataFrame, bins: tuple[str, ...]) -> DataFrame:
    """By scope (overall, test, each fold) and bin: groups available, wanted, tested, developed.

    ``groups``: group_id, bin, role (test or development), fold; ``quotas``: bin, quota. Overall
    rows pass if as many groups are tested as wanted; the others inform. The grid holds scope
    names and bins only.
    """
    spark = groups.sparkSession
    names = spark.createDataFrame([(b,) for b in bins], "bin string")
    test = F.col("role") == "test"
    counts = groups.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count(F.when(test, 1)).alias("n_test"), F.count(F.when(~test, 1)).alias("n_development")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    every = names.join(counts, "bin", "left").join(quotas.select("bin", F.col("quota").alias("n_wanted")), "bin", "left")
    every = every.select("bin", *map(zero, ("n_candidates", "n_wanted", "n_test", "n_development")))
    none = F.lit(None).cast("long")
    status = F.when(F.col("n_test") == F.col("n_wanted"), "PASS").otherwise("FAIL")
    overall = every.select(F.lit("overall").alias("scope"), "bin", "n_candidates", "n_wanted", "n_test", "n_development", status.alias("status"))
    tested = every.select(F.lit("test").alias("scope"), "bin", "n_candidates", "n_wanted", "n_test", none.alias("n_development"), F.lit("INFO").alias("status"))
    folds = groups.where(~test & F.col("fold").isNotNull())
    grid = folds.select("fold").distinct().join(every.select("bin", "n_candidates"))
    own = folds.groupBy("fold", "bin").agg(F.count(F.lit(1)).alias("n"))
    by_fold = grid.join(own, ["fold", "bin"], "left").select(
        F.concat(F.lit("fold_"), F.col("fold").cast("string")).alias("scope"), "bin", "n_candidates", none.alias("n_wanted"), none.alias("n_test"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_development"), F.lit("INFO").alias("status"),
    )
    return overall.unionByName(by_fold).unionByName(tested)


def box_shapes(boxes: DataFrame, by: list[str]) -> DataFrame:
    """Per dataset: boxes, medians of width and height, nearest-rank percentiles of the aspect w / h (0 for flat boxes).
    Boxes of one width and height are counted first: they are written, divided, rounded and ranked once, with their number."""
    aspect = F.when(F.col("h") > 0, F.round(F.col("w") / F.col("h"), 12)).otherwise(0.0)
    counted = boxes.groupBy(*by, "w", "h").agg(F.count(F.lit(1)).alias("__times"))
    shaped = settle(counted.select(*by, "w", "h", aspect.alias("aspect"), "__times"), "boxes")
    middle = medians(shaped, by, {"w": "median_w", "h": "median_h", "aspect": "median_aspect"}, "__times")
    ranks = nearest_rank(shaped, by, "aspect", {"aspect_p05": 0.05, "aspect_p95": 0.95}, "__times")
    # Boxes have sides, so both tables have a row for every dataset.
    other = ranks.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("n").alias("n_boxes"), "aspect_p05", "aspect_p95")
    return middle.join(other, same_keys(by, [f"__{c}" for c in by])).select(*by, "n_boxes", "median_w", "median_h", "median_aspect", "aspect_p05", "aspect_p95")


def totals(tables: dict[str, tuple[DataFrame, Column]], by: str) -> DataFrame:
    """(metric, by, value) of each named table: one aggregate over its rows by kind."""
    parts = [df.groupBy(by).agg(value.cast("long").alias("value")).select(F.lit(name).alias("metric"), by, "value") for name, (df, value) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def missing_classes(items: DataFrame, split: str, classes: dict[str, str]) -> DataFrame:
    """(split, class) of classes (name -> count column) that a split has no annotation of; splits without items don't show."""
    sums = items.groupBy(split).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"__{k}") for k, c in enumerate(classes.values())])
    found = F.explode(F.array(*[F.struct(F.lit(name).alias("class"), F.col(f"__{k}").alias("n")) for k, name in enumerate(classes)]))
    return sums.select(split, found.alias("c")).where("c.n = 0").select(split, "c.class")


def inclusion(items: DataFrame, groups: DataFrame, key: list[str], policy_reason: str) -> DataFrame:
    """``items`` with role, included and reason from groups (key, role, NULL: not picked): the
    policy's reason first, then group_not_picked, then sampling_cap for items not ``sampled``.
    Items of groups that are not listed count as not picked."""
    joined = items.join(groups.select(*key, "role"), key, "left")
    reason = F.when(~F.col("eligible"), F.col(policy_reason)).when(F.col("role").isNull(), "group_not_picked").when(~F.coalesce("sampled", F.lit(False)), "sampling_cap")
    return joined.withColumn("reason", reason).withColumn("included", F.col("reason").isNull())
