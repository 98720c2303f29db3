"""Leakage, balance, density and quality audits over split assignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digests import tree_digest
from .metrics import core_metrics, share

#: Ratios this close to a limit are at it.
EDGE = 1e-12


def leakage(items: DataFrame, split: str, keys: list[str]) -> DataFrame:
    """For every pair of splits and every key: distinct shared values and PASS or FAIL.

    Distinct (split, key) rows are paired by key; the grid of pairs is of split
    names only, and gives zeros.
    """
    names = items.select(split).where(F.col(split).isNotNull()).distinct()
    left, right = names.select(F.col(split).alias("left_split")), names.select(F.col(split).alias("right_split"))
    grid = left.join(right, F.col("left_split") < F.col("right_split"))
    parts = []
    for key in keys:
        own = items.where(F.col(key).isNotNull() & F.col(split).isNotNull()).select(F.col(split).alias("s"), F.col(key).alias("k")).distinct()
        shared = own.select(F.col("s").alias("l"), "k").join(own.select(F.col("s").alias("r"), "k"), "k").where("l < r").groupBy("l", "r").agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            grid.join(shared, (F.col("left_split") == F.col("l")) & (F.col("right_split") == F.col("r")), "left").select(
                F.lit(key).alias("key"), "left_split", "right_split", F.coalesce("n", F.lit(0)).cast("long").alias("n_shared")
            )
        )
    return reduce(DataFrame.unionByName, parts).withColumn("verdict", F.when(F.col("n_shared") > 0, "FAIL").otherwise("PASS"))


def values_in_several(items: DataFrame, value: str, role: str) -> DataFrame:
    """Values that occur under more than one role."""
    return items.groupBy(value).agg(F.count_distinct(role).alias("n_roles")).where("n_roles > 1")


def class_balance(items: DataFrame, dataset: str, classes: dict[str, str]) -> DataFrame:
    """Annotations and items by dataset and class (name -> count column), zeros and ALL included."""
    n_classes = F.explode(F.array(*[F.struct(F.lit(n).alias("class"), F.col(c).alias("n")) for n, c in classes.items()]))
    long = items.select(dataset, n_classes.alias("c")).select(dataset, "c.*")
    sums = [F.sum("n").cast("long").alias("n_annotations"), F.count(F.when(F.col("n") > 0, 1)).alias("n_items")]
    each = long.groupBy(dataset, "class").agg(*sums)
    return each.unionByName(long.groupBy("class").agg(*sums).withColumn(dataset, F.lit("ALL")))


def compare_tasks(items: DataFrame, by: list[str], first: str, second: str) -> DataFrame:
    """Items and positives of two label tasks side by side, their loss and ratio gap; a limit that is just met passes."""
    out = items.groupBy(*by).agg(
        F.count(F.when(F.col(first).isNotNull(), 1)).alias("n_first"),
        F.count(F.when(F.col(second).isNotNull(), 1)).alias("n_second"),
        F.count(F.when(F.col(first) > 0, 1)).alias("pos_first"),
        F.count(F.when(F.col(second) > 0, 1)).alias("pos_second"),
    )
    gap = F.abs(share(F.col("pos_first"), F.col("n_first")) - share(F.col("pos_second"), F.col("n_second")))
    loss = share(F.col("n_first") - F.col("n_second"), F.col("n_first"))
    return out.withColumns({"loss": loss, "ratio_gap": gap}).withColumn("verdict", F.when((loss > 0.07 + EDGE) | (gap > 0.03 + EDGE), "FAIL").otherwise("PASS"))


def facet_gaps(items: DataFrame, role: str, facet: str, sides: tuple[str, str]) -> DataFrame:
    """By facet: share of each side's items, positive rates, and their gaps, with max and sum."""
    own = items.where(F.col(role).isin(*sides)).groupBy(facet).agg(
        *[F.count(F.when(F.col(role) == s, 1)).alias(f"n_{s}") for s in sides],
        *[F.count(F.when((F.col(role) == s) & (F.col("n_annotations") > 0), 1)).alias(f"pos_{s}") for s in sides],
    )
    rate = {f"rate_{s}": share(F.col(f"pos_{s}"), F.col(f"n_{s}")) for s in sides}
    every = Window.partitionBy(F.lit(0))
    gap = F.abs(F.col(f"rate_{sides[0]}") - F.col(f"rate_{sides[1]}"))
    return own.withColumns(rate).withColumn("gap", gap).withColumns({"max_gap": F.max("gap").over(every), "sum_gap": F.sum("gap").over(every)})


def distribution(items: DataFrame, split: str, dims: list[str]) -> DataFrame:
    """Counts by split and dims with the share inside the split."""
    counts = items.groupBy(split, *dims).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(split)))


def fold_shares(items: DataFrame, fold: str, group: str, folds: int, tolerance: float = 0.05) -> DataFrame:
    """Groups and items by fold, item share against 1 / folds, review flag."""
    own = items.where(F.col(fold).isNotNull()).groupBy(fold).agg(F.count_distinct(group).alias("n_groups"), F.count(F.lit(1)).alias("n_items"))
    part = F.col("n_items") / F.sum("n_items").over(Window.partitionBy(F.lit(0)))
    return own.withColumn("share", part).withColumn("deviation", F.col("share") - F.lit(1.0 / folds)).withColumn("review", F.abs("deviation") >= tolerance - EDGE)


def density_guard(items: DataFrame, split: str, limit: float = 0.20) -> DataFrame:
    """Annotations per item of each split against its kind's, PASS or FAIL."""
    target = core_metrics(items, ["kind"]).select("kind", F.col("density").alias("target"))
    own = core_metrics(items, ["kind", split]).join(target, "kind")
    deviation = F.coalesce(F.try_divide(F.col("density") - F.col("target"), F.col("target")), F.lit(0.0))
    return own.select("kind", split, "n_items", "density", "target", deviation.alias("deviation")).withColumn(
        "verdict", F.when(F.abs("deviation") > limit + EDGE, "FAIL").otherwise("PASS")
    )


def fold_deviations(items: DataFrame, role: str, fold: str) -> DataFrame:
    """By fold: items, density and its deviation from that of all development items, positive rate and its gap, gap of the share of items from an equal one."""
    developed = items.where(F.col(role) == "development")
    whole = core_metrics(developed, []).select(F.col("n_items").alias("n"), F.col("density").alias("d"), F.col("positive_ratio").alias("p"))
    folds = developed.agg(F.count_distinct(fold).alias("k"))
    own = core_metrics(developed.withColumn("split", F.concat(F.lit("fold_"), F.col(fold).cast("string"))), ["split"])
    deviation = F.coalesce(F.try_divide(F.col("density"), F.col("d")) - 1, F.lit(0.0))
    return own.join(whole.join(folds)).select(  # a row each
        "split", "n_items", "density", deviation.alias("deviation"), "positive_ratio", (F.col("positive_ratio") - F.col("p")).alias("rate_gap"),
        (share(F.col("n_items"), F.col("n")) - F.try_divide(F.lit(1.0), F.col("k"))).alias("share_gap"),
    )


def deviation_summary(items: DataFrame, role: str, fold: str, limit: float = 0.20) -> DataFrame:
    """One row: largest deviations of the folds, PASS or FAIL by that of density, and density and rate of test items by those of development items; NULL for an empty side."""
    worst = fold_deviations(items, role, fold).agg(
        F.max(F.abs("deviation")).alias("worst_deviation"), F.max(F.abs("rate_gap")).alias("rate_spread"), F.max(F.abs("share_gap")).alias("share_spread")
    )
    side = lambda r, x: core_metrics(items.where(F.col(role) == r), []).select(F.col("density").alias(f"d_{x}"), F.col("positive_ratio").alias(f"p_{x}"))
    both = worst.join(side("test", "t")).join(side("development", "d"))  # a row each
    verdict = F.when(F.col("worst_deviation") > limit + EDGE, "FAIL").otherwise("PASS")
    return both.select(
        "worst_deviation", verdict.alias("verdict"), "rate_spread", "share_spread", F.try_divide("d_t", "d_d").alias("test_density_ratio"), F.try_divide("p_t", "p_d").alias("test_rate_ratio")
    )


def findings(table: DataFrame, code: str, when: Column, subject: Column, observed: Column, threshold: str) -> DataFrame:
    """Rows (code, subject, observed, threshold) where ``when`` holds."""
    return table.where(when).select(
        F.lit(code).alias("code"), subject.cast("string").alias("subject"), observed.cast("double").alias("observed"), F.lit(threshold).alias("threshold")
    )


def sorted_findings(*tables: DataFrame) -> DataFrame:
    """Findings of all ``tables``, each once, in the order of code, subject, observed and threshold."""
    return reduce(DataFrame.unionByName, tables).distinct().orderBy("code", "subject", "observed", "threshold")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of only one side, with side; empty if both hold the same rows as often."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def mapping_diff(left: DataFrame, right: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys whose value differs, or that one side lacks; NULLs are values."""
    l, r = left.select(*key, F.col(value).alias("recorded"), F.lit(True).alias("__l")), right.select(*key, F.col(value).alias("recomputed"), F.lit(True).alias("__r"))
    both = l.join(r, key, "full_outer")
    change = F.when(F.col("__l").isNull(), "added").when(F.col("__r").isNull(), "removed").when(~F.col("recorded").eqNullSafe(F.col("recomputed")), "changed")
    return both.withColumn("change", change).where("change is not null").select(*key, "recorded", "recomputed", "change")


def value_set_hash(values: DataFrame, value: str) -> DataFrame:
    """One row, set_hash: a digest of the distinct values, a line each (see tree_digest)."""
    own = values.where(F.col(value).isNotNull()).select(F.col(value).cast("string").alias("v")).distinct()
    return tree_digest(own, F.col("v"), F.col("v"), "set_hash")


def bin_concentration(items: DataFrame, fold: str, bin_: str, limit: float = 0.40) -> DataFrame:
    """By bin: its items, the largest number of them in one fold, that share, and whether it asks for a review."""
    counts = items.where(F.col(fold).isNotNull()).groupBy(bin_, fold).agg(F.count(F.lit(1)).alias("n"))
    out = counts.groupBy(bin_).agg(F.sum("n").alias("n_items"), F.max("n").alias("n_largest"))
    return out.withColumn("share", share(F.col("n_largest"), F.col("n_items"))).withColumn("review", F.col("share") >= limit - EDGE)


def representativeness(raw: DataFrame, picked: DataFrame, segment: str = "segment") -> DataFrame:
    """One row: gaps between all groups and the picked ones, and FAIL if one is over its limit.

    Groups have n_items, n_positive, has_first and a segment. Limits: 0.03 of the positive rate, 0.02
    of the share of groups with the first class, 0.02 of each segment's share, and 0.30 of normal items.
    """
    sums = lambda g, x: g.agg(
        share(F.sum("n_positive"), F.sum("n_items")).alias(f"rate_{x}"), F.avg(F.col("has_first").cast("int")).alias(f"first_{x}")
    )
    sized = lambda g, x: g.groupBy(F.col(segment).alias("s")).agg(F.count(F.lit(1)).alias(x))
    n_raw, n_picked = raw.count(), picked.count()
    apart = F.abs(F.coalesce("a", F.lit(0)) / max(n_raw, 1) - F.coalesce("b", F.lit(0)) / max(n_picked, 1))
    segments = sized(raw, "a").join(sized(picked, "b"), "s", "full_outer").agg(F.max(apart).alias("segment_gap"))
    both = sums(raw, "a").join(sums(picked, "b")).join(segments)  # one row each
    rate, first = F.col("rate_b") - F.col("rate_a"), F.col("first_b") - F.col("first_a")
    over = (F.abs(rate) > 0.03 + EDGE) | (F.abs(first) > 0.02 + EDGE) | (F.col("segment_gap") > 0.02 + EDGE) | (1 - F.col("rate_b") < 0.30 - EDGE)
    return both.select(
        F.round(rate, 9).alias("rate_gap"), F.round(first, 9).alias("first_gap"), F.round("segment_gap", 9).alias("segment_gap"), F.when(over, "FAIL").otherwise("PASS").alias("verdict")
    )


def split_reviews(items: DataFrame, group: str, split: str, test: str, segment: str, least_test: int = 100, most_excluded: float = 0.20) -> DataFrame:
    """(code, subject, observed) for reviewers: groups with mixed segments, test groups with fewer than
    ``least_test`` eligible items, and test groups that lost ``most_excluded`` of their items or more.

    ``items``: all scanned items with eligible; NULL segments don't mix, a NULL split is no test.
    """
    own = items.groupBy(group).agg(
        F.count_distinct(segment).alias("segments"), F.bool_or(F.coalesce(F.col(split) == test, F.lit(False))).alias("tested"),
        F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("eligible"), 1)).alias("kept"),
    )
    lost = share(F.col("raw") - F.col("kept"), F.col("raw"))
    row = lambda code, when, seen: F.when(when, F.struct(F.lit(code).alias("code"), F.col(group).cast("string").alias("subject"), seen.cast("double").alias("observed")))
    rows = F.array_compact(F.array(
        row("mixed_segments", F.col("segments") > 1, F.col("segments")),
        row("small_test_group", F.col("tested") & (F.col("kept") < least_test), F.col("kept")),
        row("test_exclusion", F.col("tested") & (lost >= most_excluded), lost),
    ))
    return own.select(F.inline(rows))
