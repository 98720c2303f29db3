"""Every query of the library, by its DuckDB SQL, and on other partitionings."""

import hashlib
import random

import duckdb
import pytest

from graincut import catalog
from graincut.plans import queries as q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def settled(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in catalog.ORACLES if not n.startswith(("test_assignment", "fold_invariants", "dataset_invariants", "replay_diff"))])
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(catalog.ORACLES[name])
    assert columns == sorted(want.columns)
    assert settled(df.select(*columns).collect()) == settled(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_assignment_keeps_quotas_and_whole_groups(spark, duck):
    """Both kinds in one assignment, and its replay, are held by test_assignment.py."""
    for name in ("test_assignment_invariants", "fold_invariants"):
        df = catalog.QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        assert settled(df.select(*columns).collect()) == settled(duck.sql(catalog.ORACLES[name]).select(*columns).fetchall())


def greedy_folds(rows, folds, n_facets, seed, restarts):
    """(score, restart, {group: fold}) of the best restart, one group and fold at a time."""
    total = [sum(x) for x in zip(*rows.values(), strict=True)]

    def score(s):
        n = max(s[0], 1)
        parts = [12 * ((s[0] - total[0] / folds) / max(total[0] / folds, 1)) ** 2]
        for k, weight in ((1, 8), (2, 4)):
            rate = total[k] / max(total[0], 1)
            parts.append(weight * ((s[k] / n - rate) / max(rate, 0.01)) ** 2)
        n_bins = (len(s) - 3 - n_facets) // (1 + n_facets)
        for k in range(3, len(s)):
            parts.append((3 if k < 3 + n_facets else 1 if k < 3 + n_facets + n_bins else 2) * ((s[k] - total[k] / folds) / max(total[k] / folds, 1)) ** 2)
        return sum(parts)

    found = []
    for restart in range(restarts):
        key = {g: hashlib.sha1(f"{seed}|restart:{restart}|{g}".encode()).hexdigest() for g in rows}
        sums, members = [[0] * len(total) for _ in range(folds)], [[] for _ in range(folds)]
        for g in sorted(rows, key=lambda g: (-rows[g][0], key[g], g)):
            added = [[x + y for x, y in zip(s, rows[g], strict=True)] for s in sums]
            open_folds = [j for j in range(folds) if len(members[j]) * folds < len(rows)]
            best = min(open_folds, key=lambda j: (round(score(added[j]) - score(sums[j]), 12), len(members[j]), j))
            sums[best] = added[best]
            members[best].append(g)
        found.append((round(sum(map(score, sums)), 12), restart, {g: j for j in range(folds) for g in members[j]}))
    return min(found, key=lambda x: x[:2])


def group_rows(seed):
    """25 groups of one size, so that their order is the restart's: group_id, bin, f."""
    rng = random.Random(seed)
    for g in range(25):
        n = 60
        facets, bins = len(q.b.FACETS), len(q.text.AREA_BINS)
        draws = [(rng.randrange(facets), rng.randrange(bins)) for _ in range(n)]
        count = lambda test: sum(map(test, draws))
        positives = rng.randint(n // 10, n // 2)
        single = [*[count(lambda x: x[0] == j) for j in range(facets)], *[count(lambda x: x[1] == j) for j in range(bins)]]  # noqa: B023
        joint = [count(lambda x: x == (i, j)) for i in range(facets) for j in range(bins)]  # noqa: B023
        yield g, "mid_high", [n, positives, positives * rng.randint(1, 4), *single, *joint]


@pytest.mark.parametrize(("fixture", "late"), [(1, False), (2, True)])
def test_folds_are_the_best_of_500_restarts(spark, monkeypatch, fixture, late):
    """In the second set of groups the best restart is one that a search of 100 does not reach."""
    calls, choose = [], q.assign.choose_folds

    def spy(groups, folds, n_facets, seed, **more):
        chosen = choose(groups, folds, n_facets, seed, **more)
        calls.append((groups, folds, n_facets, seed, chosen))
        return chosen

    small = spark.createDataFrame(list(group_rows(fixture)), "group_id long, bin string, f array<bigint>")
    monkeypatch.setattr(q.assign, "choose_folds", spy)
    monkeypatch.setattr(q, "_region_groups", lambda *_: small)
    monkeypatch.setattr(q, "_test_ids", lambda _: list(range(20, 25)))
    q._assigned(spark, SF)
    [(groups, folds, n_facets, seed, chosen)] = calls
    rows = {r["group_id"]: list(r["f"]) for r in groups.collect()}
    score, restart, want = greedy_folds(rows, folds, n_facets, seed, 500)
    assert not late or (restart >= 100 and score < greedy_folds(rows, folds, n_facets, seed, 100)[0])
    assert {r["group_id"]: r["fold"] for r in chosen.collect()} == want


@pytest.mark.parametrize("name", ["dup_actions", "stratified_sample", "fingerprint", "stratum_topk"])
def test_partition_count_does_not_matter(spark, name):
    found = []
    for n in ("1", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(settled(catalog.QUERIES[name](spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
