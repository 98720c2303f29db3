"""Items of both kinds to one assignment (kind, group_id, role, fold), and its replay.

Kind A: all groups, a test set by quota of rate bins, folds of equal numbers of groups. Kind B: a
representative choice of groups by stratum, split in train, val and test. Items have kind, group_id,
item_id, facet, area_bin, segment, n_annotations, n_first and eligible.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import rate_bin
from ..sources.tables import settle
from . import apportion, assign, audit, metrics


@dataclass(frozen=True)
class Structure:
    """Numbers of groups that an assignment has to have."""

    a_groups: int
    a_test: int
    folds: int
    b_picked: int
    b_val: int
    b_test: int
    b_cap: int = 300  # items sampled of a group that is not a test group

    def check(self, a_groups: int, b_groups: int) -> None:
        """Raises if the groups found don't give this structure; none is dropped to make it fit."""
        if a_groups != self.a_groups or (self.a_groups - self.a_test) % self.folds or self.a_test > self.a_groups:
            raise ValueError(f"{a_groups} groups of kind A do not give {self}")
        if b_groups < self.b_picked or self.b_val + self.b_test > self.b_picked:
            raise ValueError(f"{b_groups} groups of kind B do not give {self}")


def quotas_by_bin(groups: DataFrame, seats: int, key: str = "bin") -> DataFrame:
    """key and quota: ``seats`` over the bins by their numbers of groups."""
    counts = groups.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("cap", F.col("n"))
    return apportion.largest_remainder(counts, seats, key, "n", "cap").select(key, "quota")


def rated_features(items: DataFrame, facets: list[str], bins: list[str]) -> DataFrame:
    """group_id, f and rate bin of every discovered group; groups without eligible items have zeros."""
    features = assign.group_features(items.where("eligible"), facets, bins)
    length = assign.HEAD + len(facets) + len(bins) + len(facets) * len(bins)
    empty = F.array_repeat(F.lit(0).cast("long"), length)
    every = items.select("group_id").distinct().join(features, "group_id", "left").withColumn("f", F.coalesce("f", empty))
    return every.withColumn("bin", rate_bin(metrics.share(F.col("f")[1], F.col("f")[0])))


def assign_a(items: DataFrame, facets: list[str], bins: list[str], structure: Structure, seed: int, locked: DataFrame | None = None) -> DataFrame:
    """group_id, role (test or development), fold of kind A. ``locked``: the test groups (group_id)
    of an earlier assignment; raises if they don't fit the quotas of today."""
    groups = settle(rated_features(items, facets, bins), "rated-groups")  # read by every step of the search
    quotas = quotas_by_bin(groups, structure.a_test)
    if locked is None:
        test = assign.choose_test(groups, {r["bin"]: r["quota"] for r in quotas.collect()}, len(facets), seed)
    else:
        faults = assign.check_locked_test(groups, locked, quotas).collect()
        if faults:
            raise ValueError(f"locked test groups: {[tuple(r) for r in faults]}")
        test = [r["group_id"] for r in locked.distinct().collect()]
    development = groups.where(~F.col("group_id").isin(test))
    folds = assign.choose_folds(development, structure.folds, len(facets), seed)
    named = development.join(folds, "group_id").select("group_id", "f", F.col("fold").cast("string").alias("split"))
    refined = assign.refine_density(named).select("group_id", F.lit("development").alias("role"), F.col("split").cast("int").alias("fold"))
    return refined.unionByName(groups.where(F.col("group_id").isin(test)).select("group_id", F.lit("test").alias("role"), F.lit(None).cast("int").alias("fold")))


def with_strata(groups: DataFrame) -> DataFrame:
    """``groups`` with stratum: segment, has_first and the fifth by positive rate, ties by id."""
    binned = apportion.quantile_bins(groups, [], [F.col("positive_ratio"), F.col("group_id").cast("string")], 5)
    parts = [F.col("segment"), F.col("has_first").cast("string"), F.col("bin").cast("string")]
    return binned.withColumn("stratum", F.to_json(F.array(*parts), {"ignoreNullFields": "false"})).drop("bin")


def assign_b(items: DataFrame, structure: Structure, seed: int, locked: DataFrame | None = None, gate: bool = True) -> DataFrame:
    """group_id, role (train, val, test), fold (NULL) of the chosen groups of kind B.

    A group's items are sampled by role; test groups keep all. Raises with ``gate`` if the choice
    does not represent all groups, or if val or test have no group of the first class; and always
    if ``locked`` test groups are not among the chosen ones.
    """
    own = items.where("eligible").withColumn("__positive", F.col("n_annotations") > 0)
    scope = lambda x: F.concat_ws(":", F.lit("B"), F.col("group_id").cast("string"), F.lit(x))
    sample = lambda x: apportion.stratified_sample(own, ["group_id"], "item_id", F.col("__positive"), structure.b_cap, seed, scope(x))
    facts = own.groupBy("group_id").agg(F.bool_or(F.col("n_first") > 0).alias("has_first")).join(metrics.majority(own, ["group_id"], "segment").drop("votes"), "group_id", "left")
    # Each step reads the groups before it several times; unsettled, plans would multiply with every step.
    groups = settle(with_strata(metrics.core_metrics(sample("selection"), ["group_id"]).join(facts, "group_id")), "strata")
    picked = apportion.nearest_to_mean(groups, quotas_by_bin(groups, structure.b_picked, "stratum"), ["stratum"], "positive_ratio", "group_id", seed, "pick")
    picked = settle(picked, "picked")
    if gate and audit.representativeness(groups, picked).first()["verdict"] != "PASS":
        raise ValueError("the chosen groups of kind B do not represent all")
    again = settle(with_strata(picked.drop("stratum")), "picked-strata")
    if locked is None:
        seats = quotas_by_bin(again, structure.b_test, "stratum").withColumnRenamed("quota", "quota_test")
        tested = apportion.seeded_split(again, seats, ["stratum"], "group_id", seed, ["test"], "rest")
    else:
        fixed = again.join(locked.select("group_id").distinct(), "group_id", "left_semi").withColumn("role", F.lit("test"))
        if fixed.count() != structure.b_test or locked.distinct().count() != structure.b_test:
            raise ValueError(f"locked test groups must be {structure.b_test} of the chosen ones")
        tested = fixed.unionByName(again.join(locked.select("group_id"), "group_id", "left_anti").withColumn("role", F.lit("rest")))
    tested = settle(tested, "tested")
    rest = tested.where("role = 'rest'").drop("role")
    seats = quotas_by_bin(rest, structure.b_val, "stratum").withColumnRenamed("quota", "quota_val")
    roles = settle(tested.where("role = 'test'").unionByName(apportion.seeded_split(rest, seats, ["stratum"], "group_id", seed, ["val"], "train")), "roles")
    if gate and apportion.require_class_in_roles(roles, "role", ["val", "test"], "has_first").count():
        raise ValueError("val or test has no group of the first class")
    head = F.array(F.col("n_items"), F.col("n_positive"), F.col("n_annotations"))
    counts = lambda df, x: metrics.core_metrics(df, ["group_id"]).select("group_id", head.alias(x))
    by_role = counts(own, "test").join(counts(sample("train"), "train"), "group_id").join(counts(sample("val"), "val"), "group_id")
    f = F.create_map(*[x for name in ("train", "val", "test") for x in (F.lit(name), F.col(name))])
    placed = roles.join(by_role, "group_id").select("group_id", "stratum", F.col("role").alias("split"), f.alias("f"))
    refined = assign.refine_density(placed, stratum="stratum", locked=("test",), moving_target=True)
    return refined.select("group_id", F.col("split").alias("role"), F.lit(None).cast("int").alias("fold"))


def assign_dataset(
    items: DataFrame, facets: list[str], bins: list[str], structure: Structure, seed: int = 42,
    locked: dict[str, DataFrame] | None = None, gate: bool = True,
) -> DataFrame:
    """kind, group_id, role, fold of all assigned groups; groups of kind B that were not chosen have no row.

    ``locked``: test groups (group_id) by kind. Groups with NULL kind or id take no part.
    """
    own = ["kind", "group_id", "item_id", "facet", "area_bin", "segment", "n_annotations", "n_first", "eligible"]
    known = settle(items.where(F.col("group_id").isNotNull()).select(*own), "items")
    a, b = (known.where(F.col("kind") == k) for k in "AB")
    structure.check(a.select("group_id").distinct().count(), b.where("eligible").select("group_id").distinct().count())
    locked = locked or {}
    parts = {"A": assign_a(a, facets, bins, structure, seed, locked.get("A")), "B": assign_b(b, structure, seed, locked.get("B"), gate)}
    return parts["A"].select(F.lit("A").alias("kind"), "*").unionByName(parts["B"].select(F.lit("B").alias("kind"), "*"))


def replay(recorded: DataFrame, recomputed: DataFrame) -> DataFrame:
    """(kind, group_id, recorded, recomputed, change) of groups whose role or fold differs, or that one side lacks."""
    split = F.concat_ws("_", "role", F.col("fold").cast("string")).alias("split")
    side = lambda df: df.select("kind", "group_id", split)
    return audit.mapping_diff(side(recorded), side(recomputed), ["kind", "group_id"], "split")
