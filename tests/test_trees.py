"""Difference of recorded tables by digests of leaves."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from graincut.sources import trees
from graincut.sources.tables import shared_path

SCHEMA = "k string, at timestamp, m map<string,int>, side_note string"


def recorded(spark, rows, leaves=16):
    path = shared_path(spark, "tree")
    trees.record_tree(spark.createDataFrame(rows, SCHEMA), ["k"], path, leaves)
    return path


def test_only_differing_leaves_are_read(spark):
    t = datetime.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = [(f"k{n}", t, {"a": n}, None) for n in range(200)] + [(None, None, None, ""), ("k7", t, {"a": 7}, None)]
    later = [*rows[:3], ("k3", t + datetime.timedelta(microseconds=1), {"a": 3}, None), *rows[5:-1], ("new", t, {}, None)]
    left, right = recorded(spark, rows), recorded(spark, later[::-1])
    leaves = trees.differing_leaves(spark, left, right)
    assert 0 < len(leaves) <= 4
    found = trees.tree_difference(spark, left, right)
    equal = [f for x in (left, right) for f in Path(x.removeprefix("file://")).glob("rows/__leaf=*/*.parquet") if int(f.parent.name.split("=")[1]) not in leaves]
    assert len(equal) > 12
    for f in equal:  # a read of these would fail
        f.write_bytes(b"none")
    assert {(r.side, r.n_more, r.k) for r in found.collect()} == {("left", 1, "k3"), ("right", 1, "k3"), ("left", 1, "k4"), ("left", 1, "k7"), ("right", 1, "new")}
    # one of two equal rows went: its key is there on one side of the difference
    assert {tuple(r) for r in trees.changed_keys(found, ["k"]).collect()} == {("k3", "changed"), ("k4", "removed"), ("k7", "removed"), ("new", "added")}


def test_equal_empty_and_unlike_tables(spark):
    rows = [("a", None, None, None), (None, None, None, None)]
    one, two, empty = recorded(spark, rows), recorded(spark, rows[::-1]), recorded(spark, [])
    assert trees.tree_difference(spark, one, two).collect() == [] and trees.tree_difference(spark, empty, empty).collect() == []
    assert {(r.side, r.k) for r in trees.tree_difference(spark, empty, one).collect()} == {("right", "a"), ("right", None)}
    with pytest.raises(ValueError):
        trees.tree_difference(spark, one, recorded(spark, rows, 8))
    with pytest.raises(ValueError):
        trees.record_tree(spark.range(1).withColumn("__x", F.lit(1)), ["id"], shared_path(spark, "tree"))
