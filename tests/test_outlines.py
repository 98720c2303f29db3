"""Repair and clipping of rings against winding numbers on a grid, and the edges of the audit gates."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from graincut.functions import outlines, rings
from graincut.operators import audit, reports


def ring(*v):
    return [(float(x), float(y)) for x, y in zip(v[::2], v[1::2], strict=True)]


def winding(points, x, y):
    w = 0
    for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
        side = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        w += (ay <= y < by and side > 0) - (by <= y < ay and side < 0)
    return w


@pytest.mark.parametrize(
    ("points", "area", "parts"),
    [
        (ring(2, 2, 8, 8, 8, 2, 2, 8), 9, 1),  # lobes of equal area: the clockwise one
        (ring(0, 0, 9, 9, 9, 3, 0, 3), 18, 1),  # the larger lobe
        (ring(1, 1, 5, 1, 5, 5, 3, 1, 1, 5), 8, 2),  # touches itself
        (ring(1, -5, 9, -5, 9, 5, 7, 5, 7, -1, 6, -1, 6, 5, 4, 5, 4, -1, 3, -1, 3, 5, 1, 5), 30, 3),  # a comb
        (ring(-5, -5, 15, -5, 15, 15, -5, 15), 100, 1),  # around the frame
        (ring(-5, -5, 15, -5, 15, 15, 14, 15, 14, -4, -5, -4), 0, 0),  # around it, outside
        (ring(1, 1, 5, 1, 5, 5, 5, 9, 5, 5, 1, 5), 16, 1),  # a spike
        (ring(0, 0, 9, 0, 9, 9, 0, 9, 0, 0.5, 3, 3, 3, 6, 6, 6, 6, 3, 3, 3, 0, 0.5), 72, 1),  # a hole on a line
        (ring(1, 1, 3, 1, 3, 2, 6, 2, 6, 1, 8, 1, 8, 3, 6, 3, 6, 2, 3, 2, 3, 3, 1, 3), 8, 2),  # two squares on a line
        (ring(1, 1, 5, 5, 9, 9), 0, 0),
    ],
)
def test_known_outlines(points, area, parts):
    for turned in (points, points[3:] + points[:3]):
        changed, found, borders = outlines.parts_in_frame(turned, 10.0, 10.0)
        assert (round(found, 9), len(borders), changed) == (area, parts, parts > 0)
        assert all(outlines.is_simple(b) and outlines.normal_ring(b) == b for b in borders)


def test_unchanged_outlines_keep_their_points():
    points = ring(5, 1, 9, 9, 5, 5, 1, 9)
    assert outlines.parts_in_frame(points, 10.0, 10.0) == (False, 16.0, [points])


@pytest.mark.parametrize("grid", [False, True])
def test_area_is_that_of_the_winding_rule(grid):
    for seed in range(60):
        rng = random.Random(seed)
        draw = (lambda: float(rng.randint(-2, 6))) if grid else (lambda: rng.uniform(-2, 6))  # noqa: B023
        points = []
        for _ in range(rng.randint(4, 10)):
            p = (draw(), draw())
            if not points or points[-1] != p:
                points.append(p)
        if len(set(points)) < 3 or points[0] == points[-1]:
            continue
        _, area, parts = outlines.parts_in_frame(points, 4.0, 4.0)
        sign, n = (1 if outlines.signed_area(points) > 0 else -1), 60
        hits = sum(winding(points, (i + 0.5003) * 4 / n, (j + 0.4997) * 4 / n) * sign >= 1 for i in range(n) for j in range(n))
        assert abs(hits * (4 / n) ** 2 - area) < 0.6, points
        assert all(outlines.is_simple(p) for p in parts)


def test_long_outlines_take_no_pairs_of_sides():
    points = [(50 + (30 + k % 3) * math.cos(k * math.tau / 1000), 50 + (30 + k % 3) * math.sin(k * math.tau / 1000)) for k in range(1000)]
    began = time.process_time()
    assert outlines.parts_in_frame(points, 100.0, 100.0)[0] is False
    assert outlines.parts_in_frame(points, 60.0, 100.0)[0] is True
    assert time.process_time() - began < 1


def test_conversion_counts_parts(spark):
    rows = [(1, [1.0, 1.0, 5.0, 1.0, 5.0, 5.0, 3.0, 1.0, 1.0, 5.0]), (1, [2.0, 2.0, 3.0, 2.0, 3.0, 3.0]), (2, [1.0, 1.0, 5.0, 5.0, 9.0, 9.0]), (3, None), (3, [float("nan")] * 6)]
    df = rings.convert_annotations(spark.createDataFrame(rows, "item int, flat array<double>"), "flat", F.lit(10), F.lit(10))
    rolled = {r.item: r for r in reports.roll_up(df, ["item"], F.lit(True)).collect()}
    assert [(rolled[k].n_given, rolled[k].n_boxes, rolled[k].n_rings, rolled[k].n_more_parts) for k in (1, 2, 3)] == [(2, 3, 3, 1), (1, 1, 0, 0), (2, 0, 0, 0)]
    assert tuple(reports.geometry_totals(df, "item").first()) == (1, 1, 1, 0, True)
    assert rings.convert_annotations(spark.createDataFrame(rows[:1], "item int, flat array<double>"), "flat", F.lit(0), F.lit(10)).first().issues == ["invalid_frame"]


def test_gates_pass_what_just_meets_a_limit(spark):
    shares = spark.createDataFrame([(f, g) for f, n in ((0, 25), (1, 20), (2, 20), (3, 20), (4, 15)) for g in range(n)], "fold int, g int")
    assert {r.fold for r in audit.fold_shares(shares, "fold", "g", 5).where("review").collect()} == {0, 4}
    # 100 items of both tasks, of which 40 and 43 are positive.
    tasks = spark.createDataFrame([("k", int(k < 40), int(k < 43)) for k in range(100)], "k string, f int, s int")
    assert audit.compare_tasks(tasks, ["k"], "f", "s").first().verdict == "PASS"
    # 3.6 a split against 3.0 of its kind.
    dense = spark.createDataFrame([("A", "x", 18)] * 1 + [("A", "x", 0)] * 4 + [("A", "y", 12)] + [("A", "y", 0)] * 4, "kind string, split string, n_annotations int")
    assert {r.verdict for r in audit.density_guard(dense, "split").collect()} == {"PASS"}


def test_findings_are_sorted_and_held_once(spark):
    one = audit.findings(spark.range(3), "b", F.col("id") > 0, F.col("id"), F.col("id"), "t")
    two = audit.findings(spark.range(1), "a", F.lit(True), F.col("id"), F.col("id"), "t")
    assert [(r.code, r.subject) for r in audit.sorted_findings(one, two, one).collect()] == [("a", "0"), ("b", "1"), ("b", "2")]
