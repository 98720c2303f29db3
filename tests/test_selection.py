"""Apportionment and ranks without sorting a whole group in one task, against plain loops."""

import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from graincut.operators import apportion, metrics


def greedy(weights, caps, seats):
    raw = {k: w * seats / sum(weights.values()) for k, w in weights.items()}
    quota = {k: min(int(raw[k]), caps[k]) for k in weights}
    while sum(quota.values()) < seats:
        k = min((k for k in weights if quota[k] < caps[k]), key=lambda k: (-(raw[k] - quota[k]), -weights[k], k))
        quota[k] += 1
    return quota


@pytest.mark.parametrize("few", [0, 3])
def test_quotas_equal_the_loop_with_ties_and_tight_caps(spark, monkeypatch, few):
    monkeypatch.setattr(apportion, "RANKED_SEATS", few)
    rng = random.Random(few)
    for n, top in ((6, 3), (60, 1)):
        weights = {f"k{j:03d}": rng.randint(1, top) for j in range(n)}
        caps = {k: rng.choice((0, 1, 2, 50)) for k in weights}
        for seats in {1, n // 2, sum(caps.values()) * 3 // 4}:
            df = spark.createDataFrame([(k, w, caps[k]) for k, w in weights.items()], "k string, w long, cap long")
            assert {r.k: r.quota for r in apportion.largest_remainder(df, seats, "k", "w", "cap").collect()} == greedy(weights, caps, seats)


def test_many_keys_stay_a_row_each(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.lit(1).alias("w"), F.lit(3000).alias("cap"))
    began = time.time()
    out = apportion.largest_remainder(df, 2999, "k", "w", "cap").collect()
    assert sum(r.quota for r in out) == 2999 and [r.k for r in out if r.quota == 0] == [2999] and time.time() - began < 30
    with pytest.raises(ValueError, match="capacity"):
        apportion.largest_remainder(df.withColumn("cap", F.lit(0)), 1, "k", "w", "cap")
    assert apportion.largest_remainder(df.limit(0), 0, "k", "w", "cap").collect() == []


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranks_and_medians_equal_sorted_lists(spark):
    rng = random.Random(2)
    rows = [(g, rng.choice((None, float(rng.randrange(50)), rng.random()))) for g in ("a", "b", None) for _ in range(rng.randrange(150, 400))] + [("lone", 1.5), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    groups = {g: sorted(v for k, v in rows if k == g and v is not None) for g in {g for g, _ in rows}}
    got = {r.g: r for r in metrics.nearest_rank(df, ["g"], "v", {"p05": 0.05, "p50": 0.5, "p95": 0.95}).collect()}
    assert {g: (r.n, r.p05, r.p50, r.p95) for g, r in got.items()} == {g: (len(v), *[v[round((len(v) - 1) * f)] for f in (0.05, 0.5, 0.95)]) for g, v in groups.items() if v}
    middle = metrics.medians(df.withColumn("u", -F.col("v")), ["g"], {"v": "m", "u": "k"})
    assert {r.g: (r.m, r.k) for r in middle.collect()} == {g: (statistics.median(v), -statistics.median(v)) for g, v in groups.items() if v}
    assert metrics.nearest_rank(df.limit(0), ["g"], "v", {"p": 0.5}).collect() == [] and metrics.medians(df, [], {"v": "m"}).first().m == statistics.median(sorted(v for _, v in rows if v is not None))
    # Windows are over ranges, or over a row for each range; nothing aggregates a whole group's values.
    text = plan(metrics.nearest_rank(df, ["g"], "v", {"p": 0.5}))
    assert "percentile" not in text.lower() and "median" not in text.lower() and "hashpartitioning(__range" in text
