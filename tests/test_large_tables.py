"""Queries on keys and shapes that only larger tables have."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graincut.functions import outlines, rings
from graincut.operators import publish, reports
from graincut.plans import record_queries, release_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wide_parts(spark, tmp_path_factory):
    """Parts with keys of seven digits, of which pairs share the first six."""
    folder = str(tmp_path_factory.mktemp("wide"))
    spark.read.parquet(f"{SF}/part.parquet").withColumn("p_partkey", F.col("p_partkey") + 1_200_000).write.parquet(f"{folder}/part.parquet")
    return folder


def test_rule_chain_reads_all_digits_of_a_key(spark, wide_parts):
    faults = {r.p_partkey for r in record_queries.record_rule_chain(spark, wide_parts).where("reason = 'group_id_mismatch'").collect()}
    assert faults == {k for k in range(1_200_000, 1_200_200) if k // 5 % 12 == 1 and k % 5 in (0, 1, 3)}


def test_class_variants_reads_all_digits_of_a_key(spark, wide_parts):
    found = {r.p_partkey for r in release_queries.class_variants(spark, wide_parts).collect()}
    assert found == {k for k in range(1_200_000, 1_200_200) if k // 5 % 12 == 7 and k % 5 in (0, 1, 3)}


def test_payloads_are_dealt_to_all_tasks(spark):
    tasks = record_queries._records(spark, SF).where("payload is not null").select(F.spark_partition_id().alias("k"), "is_normal").distinct()
    assert tasks.select("k").distinct().count() == 8


def test_many_rings_are_repaired_at_once():
    """A batch of bowties, rings that touch themselves and rings that the frame cuts in two takes seconds, not a walk each."""
    kinds = [[0, 0, 6, 6, 6, 2, 0, 2], [0, 0, 4, 0, 4, 4, 2, 0, 0, 4], [12, 1, 12, 7, 8, 7, 8, 5, 11, 5, 11, 3, 8, 3, 8, 1]]
    flats = [[float(v) for v in kinds[k % 3]] for k in range(12_000)]
    began = time.process_time()
    found = outlines.rings_in_frames(np.array([v for flat in flats for v in flat]).reshape(-1, 2), np.array([len(f) // 2 for f in flats]), np.full(12_000, 10.0), np.full(12_000, 10.0))
    assert time.process_time() - began < 4
    changed, area, _, sizes, of = found
    assert changed.all() and area[:3].tolist() == [8.0, 8.0, 8.0] and np.bincount(of)[:3].tolist() == [1, 2, 2] and sizes[:5].tolist() == [3, 3, 3, 4, 4]


POINTS = {
    "[]": [], "[1,2,3]": rings.ODD_LENGTH, "[[1,2],[3,4]]": [1, 2, 3, 4], "[[1,2],[3]]": rings.NOT_NUMERIC, "[[1,2],[3,4,5]]": rings.NOT_NUMERIC, "[[1,null],[2,3]]": rings.NOT_NUMERIC,
    "[1,null]": rings.NOT_NUMERIC, "[null]": rings.ODD_LENGTH, "[[1,2],null]": rings.NOT_NUMERIC, "[[1,2],3]": rings.NOT_NUMERIC, '{"x":1}': rings.NO_STRUCTURE, "null": rings.NO_STRUCTURE,
    "[1,true]": rings.NOT_NUMERIC, '[[1,"2"],[3,4]]': rings.NOT_NUMERIC, "[1.5,2e3,-7,4]": [1.5, 2000, -7, 4], "[[]]": rings.ODD_LENGTH, "[[1.5,2],[3e1,4]]": [1.5, 2, 30, 4], None: rings.NO_STRUCTURE,
}


def test_points_are_read_by_the_type_of_their_list(spark):
    df = spark.createDataFrame([(v,) for v in POINTS], "v string").select("v", rings.parse_points(F.try_parse_json("v")).alias("p"))
    assert {r.v: r.p.issue or r.p.flat for r in df.collect()} == POINTS


def times_parsed(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parseJson(")


def test_payloads_are_parsed_once_a_row(spark):
    """A payload's text and the text of its points, each in one place of the plan at most."""
    assert times_parsed(record_queries.payload_rollup(spark, SF)) == 2
    assert times_parsed(record_queries.record_anomalies(spark, SF)) == 1
    assert times_parsed(release_queries.label_conflicts(spark, SF)) <= 1


def test_three_points_are_told_from_two():
    rows = np.random.default_rng(3).integers(0, 2, (400, 2)).astype(float)
    sizes = np.tile([0, 1, 2, 3, 4], 40)
    ends = np.cumsum(sizes)
    assert outlines.three_points(rows, sizes).tolist() == [len({*map(tuple, rows[e - n : e])}) >= 3 for n, e in zip(sizes, ends, strict=True)]


@pytest.mark.parametrize("query", [record_queries.planted_totals, record_queries.planted_rollup, record_queries.conversion_issues, record_queries.label_lines, release_queries.geometry_totals])
def test_measures_that_no_step_reads_are_not_computed(spark, query):
    """The share of a rounded box is an expensive column, and only the largest extents are taken of it."""
    assert "array_max(" not in query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_a_view_holds_no_set_of_all_keys(spark):
    """Labels and images may have a key several times; no step gathers their keys first."""
    items, labels, images = (spark.createDataFrame([(k,) for k in x], "id int") for x in ((1, 2, 3), (1, 1, 2, 2), (1, 1)))
    view, missing = publish.training_view(items, labels, images, "id")
    assert [r.id for r in view.collect()] == [1] and [r.id for r in missing.collect()] == [2]
    assert not any("Aggregate" in x._jdf.queryExecution().optimizedPlan().toString() for x in (view, missing))


def test_equal_outlines_of_a_batch_are_repaired_once(monkeypatch):
    """Copies take what the first one comes to, in its own order; another frame makes another ring."""
    kinds = [[0, 0, 6, 6, 6, 2, 0, 2], [0, 0, 4, 0, 4, 4, 2, 0, 0, 4], [12, 1, 12, 7, 8, 7, 8, 5, 11, 5, 11, 3, 8, 3, 8, 1], [0, 0, 4, 0, 2, 0], [1, 1, 2, 1, 2, 2]]
    rings_of = [np.array(kinds[k % 5], float).reshape(-1, 2) for k in range(2000)]
    widths, seen, faces = np.where(np.arange(2000) < 1000, 10.0, 9.0), [], outlines.Faces
    monkeypatch.setattr(outlines, "Faces", lambda a, *more: seen.append(len(a)) or faces(a, *more))
    changed, area, points, sizes, of = outlines.rings_in_frames(np.concatenate(rings_of), np.array([len(r) for r in rings_of]), widths, np.full(2000, 10.0))
    assert sum(seen) <= 2 * (4 + 5 + 8 + 4 + 3)
    ends = np.cumsum(sizes)
    for k in (0, 1, 2, 3, 4, 1002, 1995, 1996, 1997, 1998, 1999):
        one = outlines.parts_in_frame([(x, y) for x, y in rings_of[k].tolist()], widths[k], 10.0)
        assert one == (changed[k], area[k], [[(x, y) for x, y in points[ends[i] - sizes[i] : ends[i]].tolist()] for i in np.flatnonzero(of == k)])


@pytest.mark.parametrize(
    ("query", "measures"),
    [(record_queries.planted_totals, ()), (record_queries.conversion_issues, ()), (release_queries.geometry_totals, ()), (record_queries.record_rollup, ("box_ratio",)), (record_queries.box_shapes, ("boxes",)), (record_queries.label_lines, ("boxes",))],
)
def test_batches_give_back_only_shapes_that_are_read(spark, monkeypatch, query, measures):
    asked, cut = [], rings.cut_to_frame
    monkeypatch.setattr(rings, "cut_to_frame", lambda flat, width, height, m: asked.append(m) or cut(flat, width, height, m))
    query(spark, SF)
    assert asked == [measures]


def test_boxes_of_batches_are_those_of_columns(spark):
    """Also of flat sides, outside the frame, and at halves of the last digit."""
    r = np.random.default_rng(5)
    some = np.sort(r.uniform(-2, 12, (3000, 2, 2)), axis=1).reshape(-1, 4)
    ties = np.sort((r.integers(0, 10**8, (3000, 2, 2)) + 0.5) / 1e7, axis=1).reshape(-1, 4)
    rows = np.concatenate([some, ties, np.sort(r.integers(0, 4, (300, 2, 2)) * 2.5, axis=1).reshape(-1, 4)])
    b = F.struct("x1", "y1", "x2", "y2")
    df = spark.createDataFrame(rows.tolist(), "x1 double, y1 double, x2 double, y2 double").select(rings.box(b, F.lit(10.0), F.lit(10.0)).alias("b"), rings.rounded_box_ratio(b, F.lit(10.0), F.lit(10.0)).alias("ratio"))
    found, frames = df.select("b.*", "ratio").collect(), np.full((len(rows), 2), 10.0)
    assert [tuple(x) for x in found] == [(*box, ratio) for box, ratio in zip(outlines.boxes(rows, frames).tolist(), outlines.rounded_box_ratios(rows, frames).tolist(), strict=True)]


def test_texts_are_made_of_kept_items_only(spark):
    """Label lines are no part of the aggregate that tells which items keep their boxes."""
    plan = record_queries.label_lines(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "format_number(" in plan and not any("format_number(" in x for x in plan.splitlines() if "Aggregate [" in x)


def test_equal_boxes_are_ranked_once_with_their_number(spark, monkeypatch):
    """The table that is written has a row for each width and height; the ranks are those of all boxes."""
    drawn = [(k % 3 == 0 and "R" or None, 0.1 * (k % 7 + 1), 0.2 * (k % 4)) for k in range(3000)]
    sizes, settle = [], reports.settle
    monkeypatch.setattr(reports, "settle", lambda df, label: sizes.append((kept := settle(df, label)).count()) or kept)
    found = {r.c: r for r in reports.box_shapes(spark.createDataFrame(drawn, "c string, w double, h double"), ["c"]).collect()}
    assert sizes == [len(set(drawn))]
    for c in ("R", None):
        w, h, aspect = (sorted(x) for x in zip(*[(w, h, round(w / h, 12) if h else 0.0) for k, w, h in drawn if k == c], strict=True))
        middle = [(x[(len(x) - 1) // 2] + x[len(x) // 2]) / 2 for x in (w, h, aspect)]
        r = found[c]
        assert [r.median_w, r.median_h, r.median_aspect] == pytest.approx(middle, abs=1e-12) and r.n_boxes == len(w)
        assert [r.aspect_p05, r.aspect_p95] == pytest.approx([aspect[round((len(w) - 1) * f)] for f in (0.05, 0.95)], abs=1e-12)


class Watched(np.ndarray):
    """An array that notes when rows of two axes are picked by an array, which copies them item by item."""

    picked: list[int] = []  # noqa: RUF012

    def __getitem__(self, key):
        if self.ndim == 2 and isinstance(key, np.ndarray):
            Watched.picked.append(len(self))
        return super().__getitem__(key)


def test_rows_of_points_are_taken_whole():
    """Rectangles, some flat, some cut by the frame: no step indexes arrays of points."""
    corners, sides = (np.random.default_rng(11).integers(0, n, (4000, 2)).astype(float) for n in (60, 30))
    xy = np.stack([corners + sides * k for k in ([0, 0], [1, 0], [1, 1], [0, 1])], axis=1).reshape(-1, 2).view(Watched)
    frame = np.full(4000, 50.0)
    Watched.picked.clear()
    points, n = outlines.cleaned(xy, np.full(4000, 4))
    few = ~outlines.three_points(points, n)
    points, n = points.take(np.flatnonzero(np.repeat(~few, n)), axis=0), np.where(few, 0, n)
    changed, area, parts, sizes, of = outlines.rings_in_frames(points, n, frame, frame)
    bounds, has = outlines.bounds_in_frames(points, n, frame, frame, parts, sizes, of)
    assert not Watched.picked
    left = np.clip(50 - corners, 0, sides) * (sides.min(axis=1, keepdims=True) > 0)
    assert area.tolist() == left.prod(axis=1).tolist() and changed.tolist() == ((left != sides).any(axis=1) & (left.min(axis=1) > 0)).tolist()
    assert bounds[np.repeat(area > 0, has)].tolist() == np.hstack([corners, corners + left])[area > 0].tolist()


def test_bounds_of_parts_are_not_worked_out_where_no_shape_is_read(spark, monkeypatch):
    """Their number is that of the parts; only outlines without parts are looked at."""
    works, seen, spans = [], [], outlines._spans
    monkeypatch.setattr(rings.F, "arrow_udf", lambda work, kind: works.append(work) or (lambda *c: F.lit(None).cast("struct<issue:string>")))
    monkeypatch.setattr(outlines, "_spans", lambda xy, sizes: seen.append(len(sizes)) or spans(xy, sizes))
    rings.cut_to_frame(F.lit(None), F.lit(0), F.lit(0), ())
    flats = pa.array([[1.0, 1.0, 5.0, 1.0, 5.0, 5.0], [1.0, 1.0, 5.0, 5.0, 9.0, 9.0], [40.0, 40.0, 60.0, 40.0, 60.0, 60.0, 40.0, 60.0], None])
    found = works[0](flats, pa.array([50.0] * 4), pa.array([50.0] * 4)).to_pylist()
    assert sum(seen) == 1 and [(r["n_parts"], r["n_bounds"], r["min_extent"]) for r in found] == [(1, 1, False), (0, 1, False), (1, 1, False), (0, 0, False)]
