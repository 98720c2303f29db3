"""Measures of item sets and groups. Items have kind, group_id, facet, segment,
n_annotations, n_first, n_second (annotations of the two classes)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import settle


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def core_metrics(items: DataFrame, by: list[str]) -> DataFrame:
    """Items, positive items, annotations and their ratios by ``by``; with no key and no items, zeros."""
    return with_ratios(
        items.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n_items"),
            F.count(F.when(F.col("n_annotations") > 0, 1)).alias("n_positive"),
            F.coalesce(F.sum("n_annotations"), F.lit(0)).cast("long").alias("n_annotations"),
        )
    )


def with_ratios(counts: DataFrame) -> DataFrame:
    n, positive = F.col("n_items"), F.col("n_positive")
    return counts.withColumns(
        {"positive_ratio": share(positive, n), "density": share(F.col("n_annotations"), n), "normal_ratio": share(n - positive, n)}
    )


def pooled_ratio(counts: DataFrame, by: list[str]) -> DataFrame:
    """Ratio of sums over groups, not mean of ratios."""
    total = counts.groupBy(*by).agg(F.sum("n_items").alias("n_items"), F.sum("n_positive").alias("n_positive"))
    return total.withColumn("pooled_ratio", share(F.col("n_positive"), F.col("n_items")))


def group_stats(items: DataFrame, facets: list[str]) -> DataFrame:
    """Core metrics by (kind, group_id), class flags and counts by facet."""
    stats = items.groupBy("kind", "group_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count(F.when(F.col("n_annotations") > 0, 1)).alias("n_positive"),
        F.sum("n_annotations").cast("long").alias("n_annotations"),
        F.bool_or(F.col("n_first") > 0).alias("has_first"),
        F.bool_or(F.col("n_second") > 0).alias("has_second"),
        *[F.count(F.when(F.col("facet") == f, 1)).alias(f"n_facet_{f.lower()}") for f in facets],
    )
    return with_ratios(stats)


def with_group_ratio(items: DataFrame, groups: DataFrame, key: list[str], ratio: str, name: str) -> DataFrame:
    """``items`` with their group's ``ratio`` as ``name``; NULL where the group is not listed."""
    return items.join(groups.select(*key, F.col(ratio).alias(name)), key, "left")


def majority(items: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value by ``by``; ties by lower case, then raw text. NULLs don't vote."""
    votes = items.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct(F.col(value).alias("v"), F.col("n")), F.struct(-F.col("n"), F.lower(value), F.col(value)))
    return votes.groupBy(*by).agg(best.alias("b")).select(*by, F.col("b.v").alias(value), F.col("b.n").alias("votes"))


def feature_counts(items: DataFrame, group: str, facet: str, bin_: str) -> DataFrame:
    """Counts by group, by group and facet, by group and bin, by all three, as (group, feature, n)."""
    g, f, b = F.col(group), F.col(facet), F.col(bin_)
    level = F.grouping_id(g, f, b)
    sets = items.groupingSets([[g], [g, f], [g, b], [g, f, b]], g, f, b).agg(F.count(F.lit(1)).alias("n"), level.alias("level"))
    feature = (
        F.when(F.col("level") == 3, F.lit("items"))
        .when(F.col("level") == 1, F.concat(F.lit("facet:"), f))
        .when(F.col("level") == 2, F.concat(F.lit("area:"), b))
        .otherwise(F.concat(F.lit("joint:"), f, F.lit("|"), b))
    )
    return sets.select(g, feature.alias("feature"), "n")


def macro_rates(groups: DataFrame, by: list[str]) -> DataFrame:
    """Mean, median, least and largest group rate, share of zero groups, and the pooled rate."""
    groups = settle(groups, "rates")
    rate = F.col("positive_ratio")
    rates = groups.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg(rate).alias("mean_rate"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        share(F.count(F.when(F.col("n_positive") == 0, 1)), F.count(F.lit(1))).alias("zero_share"),
        share(F.sum("n_positive"), F.sum("n_items")).alias("micro_rate"),
    )
    middle = medians(groups, by, {"positive_ratio": "median_rate"})
    return rates.join(middle.select(*[F.col(c).alias(f"__{c}") for c in by], "median_rate"), _same(by), "left").select(
        *by, "n_groups", "mean_rate", "median_rate", "min_rate", "max_rate", "zero_share", "micro_rate"
    )


def _same(by: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by], F.lit(True))


def values_at_ranks(values: DataFrame, by: list[str], value: str, ranks: Callable[[Column], dict[str, Column]], times: str | None = None) -> DataFrame:
    """``by``, n and a column for each of ``ranks``: the value at that rank from 0, given the number of values that are not NULL.
    ``times`` is a column that says how many values a row stands for, else it is one.

    Distinct values with their counts are dealt to tasks by ranges of ``by`` and value, however many a group has.
    Range totals, a row per group and range, give every range the rank that it starts at; a range
    whose ranks hold a wanted one is the only one that a window looks into. So no task
    sorts a group, and none holds its values in memory. NULL keys are keys.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(*by, value).agg((F.sum(times) if times else F.count(F.lit(1))).alias("__n"))
    ranged = settle(counts.repartitionByRange(*by, value).withColumn("__range", F.spark_partition_id()), "value-ranges")
    keys = [F.col(c).alias(f"__{c}") for c in by]
    per_range = ranged.groupBy("__range", *keys).agg(F.sum("__n").alias("__in"))
    group = Window.partitionBy(*[f"__{c}" for c in by]) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_range.select("*", F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__before"), F.sum("__in").over(group).alias("n"))
    wanted = ranks(F.col("n"))
    holds = reduce(lambda x, y: x | y, [(r >= F.col("__before")) & (r < F.col("__before") + F.col("__in")) for r in wanted.values()])
    held = placed.where(holds).withColumnRenamed("__range", "__r")
    near = ranged.join(held, (F.col("__range") == F.col("__r")) & _same(by))
    upto = Window.partitionBy("__range", *by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = near.withColumn("__upto", F.col("__before") + F.sum("__n").over(upto))
    hit = lambda r: F.max(F.when((r < F.col("__upto")) & (r >= F.col("__upto") - F.col("__n")), F.col(value)))
    return here.groupBy(*by).agg(F.max("n").alias("n"), *[hit(r).alias(name) for name, r in wanted.items()])


def nearest_rank(values: DataFrame, by: list[str], value: str, fractions: dict[str, float], times: str | None = None) -> DataFrame:
    """Percentiles at the 0-based rank round((n - 1) * f), halves to even, see values_at_ranks."""
    return values_at_ranks(values, by, value, lambda n: {name: F.rint((n - 1) * F.lit(f)).cast("long") for name, f in fractions.items()}, times)


def medians(values: DataFrame, by: list[str], names: dict[str, str], times: str | None = None) -> DataFrame:
    """``by`` and the median of each column of ``names`` under its name; of an even number the mean of the two middle values."""
    out = None
    for value, name in names.items():
        pair = values_at_ranks(values, by, value, lambda n: {"__low": F.floor((n - 1) / 2).cast("long"), "__high": F.floor(n / 2).cast("long")}, times)
        own = pair.select(*by, ((F.col("__low") + F.col("__high")) / 2).alias(name))
        if out is None:
            out = own
        else:
            out = out.join(own.select(*[F.col(c).alias(f"__{c}") for c in by], name), _same(by), "full_outer")
            out = out.select(*[F.coalesce(c, f"__{c}").alias(c) for c in by], *[n for n in names.values() if n in out.columns])
    return out
