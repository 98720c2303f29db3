"""Assignment against plain loops over 12 groups, structure, locked test groups, and replay."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from graincut.operators import assign, dataset, swaps
from graincut.sources.tables import settle

from .test_queries import greedy_folds

FACETS, BINS = 3, 4


def twelve_groups(seed):
    rng = random.Random(seed)
    for g in range(12):
        draws = [(rng.randrange(FACETS), rng.randrange(BINS)) for _ in range(rng.randint(20, 60))]
        positives = rng.randint(1, len(draws) // 2)
        single = [*[sum(x[0] == j for x in draws) for j in range(FACETS)], *[sum(x[1] == j for x in draws) for j in range(BINS)]]
        yield g, ("low", "high")[g % 2], [len(draws), positives, positives * rng.randint(1, 4), *single, *[draws.count((i, j)) for i in range(FACETS) for j in range(BINS)]]


def objective(t, d):
    rate = lambda a, k: a[k] / a[0] if a[0] else 0.0
    relative = lambda k, none: abs(rate(t, k) / rate(d, k) - 1) if rate(d, k) > 0 else none
    gaps = [abs(rate(t, k) - rate(d, k)) for k in range(3, 3 + FACETS + BINS)]
    density = relative(2, 1.0 if rate(t, 2) > 0 else 0.0)
    return round(3 * max(gaps[:FACETS]) + sum(gaps[:FACETS]) + 6 * relative(1, rate(t, 1)) + 6 * density + 20 * max(gaps[FACETS:]), 12)


def chosen_by_hand(groups, quotas, seed):
    add = lambda ids: [sum(x) for x in zip(*[groups[g][1] for g in ids], strict=True)] if ids else [0] * 22
    value = lambda ids: objective(add(ids), add([g for g in groups if g not in ids]))
    key = lambda scope, x: hashlib.sha1(f"{seed}|{scope}|{x}".encode()).hexdigest()
    test = []
    while len(test) < sum(quotas.values()):
        open_bins = [b for b, n in quotas.items() if sum(groups[g][0] == b for g in test) < n]
        test.append(min((g for g in groups if g not in test and groups[g][0] in open_bins), key=lambda g: (value([*test, g]), key("test", g), g)))
    while True:
        swaps = [(o, i) for o in test for i in groups if i not in test and groups[i][0] == groups[o][0]]
        after = lambda s: value([g for g in test if g != s[0]] + [s[1]])
        best = min(swaps, key=lambda s: (after(s), key("test_swap", f"{s[0]}:{s[1]}"), s))
        if after(best) >= value(test):
            return sorted(test)
        test = [g for g in test if g != best[0]] + [best[1]]


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_choice_and_swaps(spark, seed):
    rows = list(twelve_groups(seed))
    found = assign.choose_test(spark.createDataFrame(rows, "group_id long, bin string, f array<bigint>").cache(), {"low": 2, "high": 1}, FACETS, seed)
    assert found == chosen_by_hand({g: (b, f) for g, b, f in rows}, {"low": 2, "high": 1}, seed)


def deviations(placed, free, target, moving):
    sums = {s: [sum(f[k] for x, f in placed.values() if x == s) for k in range(3)] for s in sorted({x for x, _ in placed.values()})}
    target = sum(sums[s][2] for s in free) / sum(sums[s][0] for s in free) if moving else target
    overall = sum(v[1] for v in sums.values()) / sum(v[0] for v in sums.values())
    return round(max(abs(sums[s][2] / sums[s][0] / target - 1) for s in free), 12), max(abs(v[1] / v[0] - overall) for v in sums.values())


def refined_by_hand(groups, locked, moving, rounds=12, goal=0.15):
    """groups: id -> (split, {split: counts}, stratum)."""
    split = {g: s for g, (s, _, _) in groups.items()}
    place = lambda at: {g: (at[g], groups[g][1][at[g]]) for g in groups}
    free = [s for s in sorted(set(split.values())) if s not in locked]
    start = place(split)
    target = sum(f[2] for x, f in start.values() if x in free) / sum(f[0] for x, f in start.values() if x in free)
    for _ in range(rounds):
        worst, spread = deviations(place(split), free, target, moving)
        if worst <= goal + 1e-12:
            break
        options = []
        for x, y in combinations(sorted(groups), 2):
            for left, right in ((x, y), (y, x)):
                if split[left] < split[right] and {split[left], split[right]} <= set(free) and groups[left][2] == groups[right][2]:
                    after, gap = deviations(place(split | {left: split[right], right: split[left]}), free, target, moving)
                    if gap <= spread + 0.01 + 1e-12 and after < worst - 1e-12:
                        options.append((after, left, right))
        if not options:
            break
        _, left, right = min(options)
        split[left], split[right] = split[right], split[left]
    return split


@pytest.mark.parametrize(("locked", "moving", "seed"), [((), False, 3), (("c",), False, 4), (("c",), True, 5), ((), True, 6)])
def test_density_swaps_by_hand(spark, locked, moving, seed):
    rng = random.Random(seed)
    counts = lambda: [n := rng.randint(50, 90), rng.randint(10, 14), n * rng.randint(1, 9)]
    groups = {g: ("abc"[g % 3], {s: counts() for s in "abc"}, g % 2) for g in range(12)}
    if not moving:
        groups = {g: (s, dict.fromkeys("abc", f[s]), k) for g, (s, f, k) in groups.items()}
    rows = [(g, s, f if moving else f[s], k) for g, (s, f, k) in groups.items()]
    df = spark.createDataFrame(rows, f"group_id long, split string, f {'map<string,array<bigint>>' if moving else 'array<bigint>'}, k long").cache()
    found = {r.group_id: r.split for r in assign.refine_density(df, stratum="k", locked=locked, moving_target=moving).collect()}
    assert found == refined_by_hand(groups, locked, moving) and all(found[g] == s for g, (s, _, _) in groups.items() if s in locked)


def items_of_both_kinds():
    rng = random.Random(9)
    for g in range(12):
        for k in range(20):
            n = int(rng.random() < 0.1 + 0.06 * g) * rng.randint(1, 3)
            yield g * 100 + k, g, "A", "xyz"[k % 3], "zero" if not n else "1_5pct", "s", n, n, g != 11
    for g in range(20):
        for k in range(10):
            n = int(rng.random() < 0.4)
            yield 10_000 + g * 100 + k, g, "B", None, None, "uv"[g % 2], n, n, True


def test_one_assignment_of_both_kinds(spark):
    schema = "item_id long, group_id long, kind string, facet string, area_bin string, segment string, n_annotations long, n_first long, eligible boolean"
    items = spark.createDataFrame(list(items_of_both_kinds()), schema).cache()
    make = lambda n=12, **more: dataset.assign_dataset(items, list("xyz"), ["zero", "1_5pct"], dataset.Structure(n, 2, 5, 10, 2, 2, 6), gate=False, **more).cache()
    found = make()
    rows = [tuple(r) for r in found.collect()]
    sizes = {}
    for kind, _, role, fold in rows:
        sizes[kind, role, fold] = sizes.get((kind, role, fold), 0) + 1
    assert sizes == {("A", "test", None): 2, **{("A", "development", k): 2 for k in range(5)}, ("B", "test", None): 2, ("B", "val", None): 2, ("B", "train", None): 6}
    assert {g for kind, g, _, _ in rows if kind == "A"} == set(range(12))  # group 11 lost all items and stays
    with pytest.raises(ValueError):
        make(13)
    own = found.where("kind = 'A'")
    a = lambda locked: dataset.assign_a(items.where("kind = 'A'"), list("xyz"), ["zero", "1_5pct"], dataset.Structure(12, 2, 5, 10, 2, 2, 6), 42, locked)
    assert dataset.replay(own, a(own.where("role = 'test'").select("group_id")).withColumn("kind", F.lit("A"))).count() == 0
    with pytest.raises(ValueError):
        a(spark.createDataFrame([(0,), (77,)], "group_id long"))
    changed = found.withColumn("fold", F.when(F.col("fold") == 3, 4).otherwise(F.col("fold"))).where("group_id <> 5 or kind <> 'A'")
    diff = {(r.kind, r.group_id, r.change) for r in dataset.replay(changed, found).collect()}
    assert diff == {(k, g, "added" if g == 5 else "changed") for k, g, _, fold in rows if k == "A" and (fold == 3 or g == 5)}


def test_swaps_follow_distinct_counts_not_groups(spark):
    """60,000 groups of a few hundred distinct counts: pairs of groups would be a billion."""
    k = F.col("id")
    f = F.array((50 + k % 10).cast("long"), (20 + k % 3).cast("long"), F.when(k % 2 == 0, 90 + k % 7).otherwise(20 + k % 5).cast("long"))
    groups = spark.range(60_000).select(k.alias("group_id"), F.concat(F.lit("s"), (k % 2).cast("string")).alias("split"), f.alias("f"))
    after = assign.refine_density(groups, rounds=2)
    assert after.count() == 60_000 and {r["count"] for r in after.groupBy("split").count().collect()} == {30_000}
    moved = after.join(groups.withColumnRenamed("split", "was"), "group_id").where("split <> was").count()
    assert moved == 4


@pytest.mark.parametrize(("locked", "moving", "seed"), [((), False, 3), (("c",), True, 5)])
def test_swaps_by_boxes_of_counts_are_those_of_all_pairs(spark, monkeypatch, locked, moving, seed):
    """The case above with cells of several levels, more groups and ids as text."""
    plans = []
    monkeypatch.setattr(swaps, "CELLS", 8)
    monkeypatch.setattr(swaps, "settle", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df, label))
    rng = random.Random(seed)
    counts = lambda: [n := rng.randint(50, 400), rng.randint(10, 24), n * rng.randint(1, 9) // 2]
    groups = {str(g): ("abc"[g % 3], {s: counts() for s in "abc"}, g % 2) for g in range(48)}
    if not moving:
        groups = {g: (s, dict.fromkeys("abc", f[s]), k) for g, (s, f, k) in groups.items()}
    rows = [(g, s, f if moving else f[s], k) for g, (s, f, k) in groups.items()]
    df = spark.createDataFrame(rows, f"group_id string, split string, f {'map<string,array<bigint>>' if moving else 'array<bigint>'}, k long")
    found = {r.group_id: r.split for r in assign.refine_density(df, 3, goal=0.0, stratum="k", locked=locked, moving_target=moving).collect()}
    assert found == refined_by_hand(groups, locked, moving, 3, 0.0)
    assert len(plans) > 4 and not any("NestedLoop" in p or "Cartesian" in p for p in plans)


def test_swaps_of_many_distinct_counts(spark):
    """8,000 groups of distinct counts: 16 million pairs. The first swap against a search over sorted arrays."""
    k = F.col("id")
    n, p = (50 + k % 997).cast("long"), (20 + k % 3).cast("long")
    a = F.when(k % 2 == 0, n * 2 + k % 1009).otherwise(n + k % 1013).cast("long")
    groups = spark.range(8_000).select(k.alias("group_id"), F.concat(F.lit("s"), (k % 2).cast("string")).alias("split"), F.array(n, p, a).alias("f")).cache()
    after = assign.refine_density(groups, rounds=1, goal=0.0)
    found = sorted(r["group_id"] for r in after.join(groups.withColumnRenamed("split", "was"), "group_id").where("split <> was").collect())
    f = np.array([r.f for r in groups.orderBy("group_id").collect()], dtype=float)
    left, right = f[::2], f[1::2]
    sums, target = (left.sum(0), right.sum(0)), f[:, 2].sum() / f[:, 0].sum()
    best = (9.0,)
    for i, x in enumerate(left):
        move = right - x
        s, t = sums[0] + move, sums[1] - move
        o = np.round(np.maximum(abs(s[:, 2] / s[:, 0] / target - 1), abs(t[:, 2] / t[:, 0] / target - 1)), 12)
        best = min(best, *((o[j], str(2 * i), str(2 * j + 1)) for j in np.flatnonzero(o == o.min())))
    assert found == sorted(map(int, best[1:]))


def test_folds_of_a_large_group_table_by_hand(spark):
    """110,000 groups with text ids in one restart, against the plain loop."""
    k = F.col("id")
    f = F.array(*[x.cast("long") for x in (40 + k % 30, 5 + k % 4, 9 + k % 5, 10 + k % 9, 30 + k % 21, 20 + k % 11, 20 + k % 19, *[F.lit(1)] * 4)])
    groups = spark.range(110_000).select(F.concat(F.lit("g"), k.cast("string")).alias("group_id"), f.alias("f"))
    found = assign.choose_folds(groups, 5, 2, 1, restarts=1)
    assert found.schema["group_id"].dataType.simpleString() == "string"
    rows = {r.group_id: list(r.f) for r in groups.collect()}
    assert {r.group_id: r.fold for r in found.collect()} == greedy_folds(rows, 5, 2, 1, 1)[2]


def test_folds_follow_ids_as_text_and_order_of_rows_does_not_matter(spark):
    rows = [(str(g), f) for g, _, f in twelve_groups(8)]
    make = lambda x: {r.group_id: r.fold for r in assign.choose_folds(spark.createDataFrame(x, "group_id string, f array<bigint>"), 4, FACETS, 5, 30).collect()}
    found = make(rows)
    assert found == make(rows[::-1]) and sorted(found.values()) == sorted([*range(4)] * 3)
    assert assign.choose_folds(spark.createDataFrame([], "group_id string, f array<bigint>"), 4, FACETS, 5).collect() == []
    with pytest.raises(ValueError):
        make(rows[:-1])
