"""Assignment of whole groups to a test set and folds under quota and balance.

Everything works on one row per group with ``f``, an array of counts: items,
positives, annotations, then one per facet, one per area bin, and one per facet
and area bin, facet by facet. Items are read once, to build it. Each round of a search is a Spark job over candidates
or candidate pairs that returns its single best row; the state between rounds
is a few sums.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import order_key
from ..sources.tables import settle
from .swaps import HEAD, ROUND, best_swap

# Weights of the test objective (largest and summed facet gap, positive rate, density, area bin)
# and of the fold score (items, positive rate, density, facet, area bin, facet and area bin).
TEST_WEIGHTS = (3.0, 1.0, 6.0, 6.0, 20.0)
FOLD_WEIGHTS = (12.0, 8.0, 4.0, 3.0, 1.0, 2.0)
#: Groups that a task of the fold search reads, all its restarts together.
FOLD_ROWS = 200_000


def group_features(items: DataFrame, facets: list[str], bins: list[str]) -> DataFrame:
    """group_id and f from items with group_id, facet, area_bin, n_annotations. A facet
    that is not listed is an error."""
    odd = F.count(F.when(F.col("facet").isNull() | ~F.col("facet").isin(*facets), 1))
    counts = [
        F.count(F.lit(1)),
        F.count(F.when(F.col("n_annotations") > 0, 1)),
        F.coalesce(F.sum("n_annotations"), F.lit(0)).cast("long"),
        *[F.count(F.when(F.col("facet") == x, 1)) for x in facets],
        *[F.count(F.when(F.col("area_bin") == x, 1)) for x in bins],
        *[F.count(F.when((F.col("facet") == x) & (F.col("area_bin") == y), 1)) for x in facets for y in bins],
    ]
    f = F.when(odd > 0, F.raise_error(F.lit("item with an unknown facet")).cast("array<bigint>")).otherwise(F.array(*counts))
    return items.groupBy("group_id").agg(f.alias("f"))


def _n_bins(length: int, n_facets: int) -> int:
    """Area bins of count arrays of this length: HEAD + facets + bins + facets x bins."""
    return (length - HEAD - n_facets) // (1 + n_facets)


def _array(values: Iterable[int]) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def _plus(a: Column, b: Column, sign: int = 1) -> Column:
    return F.zip_with(a, b, lambda x, y: x + sign * y)


def _relative(a: Column, b: Column, if_zero: Column) -> Column:
    return F.when(b > 0, F.abs(a / b - 1)).otherwise(if_zero)


def test_objective(t: Column, d: Column, n_facets: int, n_bins: int) -> Column:
    """Weighted gaps between test counts t and development counts d; both are count arrays.

    3 x largest and 1 x summed facet share gap, 6 x relative gap of the positive
    rate, 6 x of the annotation density, 20 x largest area bin share gap.
    """

    def rate(a: Column, k: int) -> Column:
        return F.when(a[0] > 0, a[k] / a[0]).otherwise(0.0)

    def gaps(a: int, n: int) -> Column:
        part = lambda x: F.transform(F.slice(x, a + 1, n), lambda v: F.when(x[0] > 0, v / x[0]).otherwise(0.0))
        return F.zip_with(part(t), part(d), lambda x, y: F.abs(x - y))

    facet, area = gaps(HEAD, n_facets), gaps(HEAD + n_facets, n_bins)
    total = F.aggregate(facet, F.lit(0.0), lambda s, x: s + x)
    density = _relative(rate(t, 2), rate(d, 2), F.when(rate(t, 2) > 0, 1.0).otherwise(0.0))
    positive = _relative(rate(t, 1), rate(d, 1), rate(t, 1))
    a, b, c, d, e = TEST_WEIGHTS
    return F.round(a * F.array_max(facet) + b * total + c * positive + d * density + e * F.array_max(area), ROUND)


def choose_test(groups: DataFrame, quotas: dict[str, int], n_facets: int, seed: int) -> list[int]:
    """Ids of the test groups: ``quotas`` per bin, built greedily, then improved by swaps
    inside bins until none helps. ``groups``: group_id, bin, f. Raises if a bin is short."""
    total = [r[0] for r in groups.select(F.posexplode("f")).groupBy("pos").agg(F.sum("col")).orderBy("pos").select("sum(col)").collect()]
    sizes = {r["bin"]: r["count"] for r in groups.groupBy("bin").count().collect()}
    if any(sizes.get(b, 0) < q for b, q in quotas.items()):
        raise ValueError(f"a bin has fewer groups than its quota: {quotas} of {sizes}")
    chosen: dict[int, str] = {}
    state = [0] * len(total)

    def best(candidates: DataFrame, change: Column, out: list[str], ties: list[Column]):
        t = _plus(_array(state), change)
        scored = candidates.withColumn("t", t).withColumn("o", test_objective(F.col("t"), _plus(_array(total), F.col("t"), -1), n_facets, _n_bins(len(total), n_facets)))
        return scored.agg(F.min_by(F.struct(*out, "t", "o"), F.struct("o", *ties)).alias("b")).first()["b"]

    while len(chosen) < sum(quotas.values()):
        open_bins = [b for b, q in quotas.items() if sum(x == b for x in chosen.values()) < q]
        left = groups.where(F.col("bin").isin(open_bins) & ~F.col("group_id").isin(list(chosen)))
        row = best(left, F.col("f"), ["group_id", "bin"], [order_key(seed, "test", F.col("group_id")), F.col("group_id")])
        chosen[row["group_id"]], state, value = row["bin"], row["t"], row["o"]
    while chosen:
        inside = F.col("group_id").isin(list(chosen))
        give = groups.where(inside).select("bin", F.col("group_id").alias("out_id"), F.col("f").alias("out_f"))
        pairs = groups.where(~inside).join(give, "bin")
        row = best(pairs, _plus(F.col("f"), F.col("out_f"), -1), ["group_id", "out_id", "bin"], [order_key(seed, "test_swap", F.concat_ws(":", "out_id", "group_id")), F.col("out_id"), F.col("group_id")])
        if row is None or row["o"] >= value:
            break
        del chosen[row["out_id"]]
        chosen[row["group_id"]], state, value = row["bin"], row["t"], row["o"]
    return sorted(chosen)


def check_locked_test(groups: DataFrame, locked: DataFrame, quotas: DataFrame) -> DataFrame:
    """Violations of a fixed test set (group_id): missing groups and bins off their quota
    (bin, quota); empty if it holds."""
    missing = locked.join(groups, "group_id", "left_anti").select(F.lit("missing_group").alias("code"), F.col("group_id").cast("string").alias("subject"))
    own = groups.join(locked, "group_id", "left_semi").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    off = quotas.join(own, "bin", "full_outer").where(F.coalesce("n", F.lit(0)) != F.coalesce("quota", F.lit(0)))
    return missing.unionByName(off.select(F.lit("quota").alias("code"), F.col("bin").alias("subject")))


class _Folds:
    """Folds filled by groups as they come: the state is a fold's sums, its number of groups and its score."""

    def __init__(self, total: list[int], n_groups: int, folds: int, n_facets: int) -> None:
        self.total = np.array(total, dtype=float)
        self.target = self.total / folds
        self.room = n_groups // folds
        n_bins = _n_bins(len(total), n_facets)
        self.weight = np.repeat(FOLD_WEIGHTS[3:], [n_facets, n_bins, n_facets * n_bins])
        self.sums, self.sizes = np.zeros((folds, len(total))), np.zeros(folds, int)
        self.scores = self.score(self.sums)

    def score(self, s: np.ndarray) -> np.ndarray:
        target, n = self.target, np.maximum(s[:, 0], 1)
        value = FOLD_WEIGHTS[0] * ((s[:, 0] - target[0]) / max(target[0], 1)) ** 2
        for k in (1, 2):
            rate = self.total[k] / max(self.total[0], 1)
            value = value + FOLD_WEIGHTS[k] * ((s[:, k] / n - rate) / max(rate, 0.01)) ** 2
        return value + (self.weight * ((s[:, HEAD:] - target[HEAD:]) / np.maximum(target[HEAD:], 1)) ** 2).sum(axis=-1)

    def place(self, f: np.ndarray) -> int:
        """The open fold that f raises least; ties to fewer groups, then to the first fold."""
        after = self.score(self.sums + f)
        gain = np.round(after - self.scores, ROUND)
        best = min((j for j in range(len(gain)) if self.sizes[j] < self.room), key=lambda j: (gain[j], self.sizes[j], j))
        self.sums[best] += f
        self.sizes[best] += 1
        self.scores[best] = after[best]
        return best


def _restart_scores(*shape):
    """Score of each restart from its groups in order; restarts come one after another."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        restart, state = None, None
        done = lambda: pd.DataFrame({"restart": [restart], "score": [float(np.round(state.scores.sum(), ROUND))]})
        for batch in batches:
            for k, f in zip(batch["restart"], np.array(batch["f"].tolist(), dtype=float), strict=True):
                if k != restart:
                    if state is not None:
                        yield done()
                    restart, state = k, _Folds(*shape)
                state.place(f)
        if state is not None:
            yield done()

    return run


def _fold_of_groups(*shape):
    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        state = _Folds(*shape)
        for batch in batches:
            yield pd.DataFrame({"group_id": batch["group_id"], "fold": [state.place(f) for f in np.array(batch["f"].tolist(), dtype=float)]})

    return run


def choose_folds(groups: DataFrame, folds: int, n_facets: int, seed: int, restarts: int = 500) -> DataFrame:
    """group_id and fold: equal numbers of groups per fold, the best of many greedy restarts. Raises
    if groups don't divide by folds; without groups there are no rows.

    Each restart is a stream of all groups, largest first, ties in its own seeded order. Spark deals the
    streams to tasks by restart and sorts them, spilling where needed; a task holds the sums of the
    folds alone, so any number of groups and any type of id will do. The best restart then runs once
    more to name the folds: one sorted stream, as each group's fold depends on all before it.
    """
    groups = settle(groups.select("group_id", "f"), "fold-groups")
    total = [r["s"] for r in groups.select(F.posexplode("f")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()]
    n = groups.count()
    if n % folds:
        raise ValueError(f"{n} groups do not divide into {folds} folds")
    result = T.StructType([groups.schema["group_id"], T.StructField("fold", T.IntegerType())])
    if not n:
        return groups.sparkSession.createDataFrame([], result)
    shape = (total, n, folds, n_facets)
    in_order = lambda df: df.sortWithinPartitions(
        "restart", F.desc(F.col("f")[0]), order_key(seed, F.concat(F.lit("restart:"), F.col("restart").cast("string")), "group_id"), "group_id"
    ).select("restart", "group_id", "f")
    tasks = min(restarts, max(16, n * restarts // FOLD_ROWS))
    streams = groups.select("group_id", "f", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart")).repartition(tasks, "restart")
    best = in_order(streams).mapInPandas(_restart_scores(*shape), "restart long, score double").agg(F.min_by("restart", F.struct("score", "restart"))).first()[0]
    one = in_order(groups.withColumn("restart", F.lit(best)).repartition(1))
    return settle(one.mapInPandas(_fold_of_groups(*shape), result), "folds")


def refine_density(
    groups: DataFrame, rounds: int = 12, goal: float = 0.15, guard: float = 0.01, stratum: str | None = None,
    locked: tuple[str, ...] = (), moving_target: bool = False,
) -> DataFrame:
    """Swap groups between splits while that lowers the worst relative deviation of a
    split's annotation density, until ``goal``. ``groups``: group_id, split, f.

    The target is the density of all splits that are not ``locked``: as it is at the start, or with
    ``moving_target`` as each swap makes it. Locked splits give and take no groups, but count for
    the spread of positive rates, which a swap may widen by ``guard`` at most. With ``stratum``, only
    groups of one stratum are swapped. ``f`` may be a map from split to counts, where a group's
    items depend on its split; a map that lacks a split keeps its group from swaps that need it.
    Candidates are pairs of classes of groups with equal counts (in every split, with maps), one in
    the worst split and one in another (of all splits, with a moving target); ``best_swap`` finds
    the best without forming all. Ties go to the first ids as text.
    """
    mapped = isinstance(groups.schema["f"].dataType, T.MapType)
    moved: dict[int, str] = {}
    fixed = None
    groups = settle(groups, "splits")  # every round reads it
    names = [r["split"] for r in groups.select("split").distinct().orderBy("split").collect()]
    # Maps can't be grouped by: their counts stand in a row, split by split.
    unknown = F.array(*[F.lit(None).cast("long")] * HEAD)
    counts = [F.coalesce(F.slice(F.try_element_at("f", F.lit(name)), 1, HEAD), unknown) for name in names]
    head = F.concat(*counts) if mapped and names else F.slice("f", 1, HEAD)
    same = ["split", (F.col(stratum) if stratum else F.lit(0)).alias("stratum"), head.alias("f")]

    def placed() -> DataFrame:
        if not moved:
            return groups
        to = F.create_map(*[F.lit(x) for kv in moved.items() for x in kv])
        return groups.withColumn("split", F.coalesce(F.try_element_at(to, F.col("group_id")), F.col("split")))

    for _ in range(rounds):
        # Groups of one split with equal counts (and stratum) swap alike: the one whose id comes first stands for them.
        first = F.min_by("group_id", F.col("group_id").cast("string")).alias("id")
        classes = settle(placed().groupBy(*same).agg(first, F.count(F.lit(1)).alias("m")), "classes")
        at = F.array_position(F.array(*[F.lit(x) for x in names]), F.col("split")).cast("int") - 1 if mapped else F.lit(0)
        own = [F.sum(F.col("m") * F.get("f", at * HEAD + k)).alias(c) for k, c in enumerate("npa")]
        rows = classes.groupBy("split").agg(*own, F.count(F.lit(1)).alias("classes")).orderBy("split").collect()
        sums = {r["split"]: r for r in rows}
        free = [name for name in sums if name not in locked]
        n, a = (sum(sums[name][c] for name in free) for c in "na")
        if not a or len(free) < 2:
            break
        fixed = a / n if fixed is None or moving_target else fixed
        part = lambda x, y: x / y if y else 0.0
        off = {name: abs(part(sums[name]["a"], sums[name]["n"]) / fixed - 1) for name in free}
        worst = max(off.values())
        overall = sum(r["p"] for r in sums.values()) / sum(r["n"] for r in sums.values())
        spread = max(abs(part(r["p"], r["n"]) - overall) for r in sums.values())
        if worst <= goal + 1e-12:
            break
        # With a fixed target, a swap between other splits leaves the worst one as it is.
        sides = [(x, y) for x in free for y in free if x < y and (moving_target or max(off, key=off.get) in (x, y))]
        row = best_swap(
            classes.where(F.col("split").isin(free)), sides, sums, free, None if moving_target else fixed, mapped,
            worst - 1e-12, spread + guard + 1e-12, sum(r["classes"] for r in rows if r["split"] in free),
        )
        if row is None:
            break
        moved |= {row["l_id"]: row["r_split"], row["r_id"]: row["l_split"]}
    return placed()
