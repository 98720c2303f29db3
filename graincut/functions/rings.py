"""Polygon rings as array expressions. A ring is array<struct<x: double, y: double>>."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import outlines
from .text import let

# Codes of faulty points.
NO_STRUCTURE, ODD_LENGTH, NOT_NUMERIC = "invalid_points_structure", "odd_flat_points_length", "non_numeric_coordinate"
NOT_FINITE, TOO_FEW = "non_finite_coordinate", "fewer_than_3_unique_points"
# Fixed value: code of a changed outline.
REPAIRED = "polygon_repaired_or_clipped"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def ring_of_flat(flat: Column) -> Column:
    """Points of a flat list x, y, x, y, ...; NULL for an odd length."""
    pairs = F.transform(F.sequence(F.lit(0), (F.size(flat) / 2 - 1).cast("int")), lambda k: point(F.get(flat, (2 * k).cast("int")), F.get(flat, (2 * k + 1).cast("int"))))
    return F.when(F.size(flat) == 0, F.array().cast("array<struct<x:double,y:double>>")).when(F.size(flat) % 2 == 0, pairs)


def cleaned(ring: Column) -> Column:
    """Without consecutive repeats and without a closing point."""
    kept = F.filter(ring, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(ring, i - 1)))
    closed = (F.size(kept) > 1) & F.try_element_at(kept, F.lit(1)).eqNullSafe(F.try_element_at(kept, F.lit(-1)))
    return F.when(closed, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)


def parse_points(points: Column) -> Column:
    """struct(flat, issue) of the points of an annotation, a VARIANT: a list of pairs or a flat list.

    flat: x, y, x, y, ... as doubles. issue: code of the first fault of the structure, else NULL; a
    list that is not all pairs counts as flat. Booleans, texts and nulls are no numbers.
    """
    members = lambda v: F.try_variant_get(v, "$", "array<variant>")
    is_list = lambda v: F.coalesce(F.schema_of_variant(v).startswith("ARRAY"), F.lit(False))
    number = "(BIGINT|DOUBLE|FLOAT|DECIMAL)"

    def known(flat: Column, issue: Column) -> Column:
        return F.struct(F.when(issue.isNull(), flat).alias("flat"), issue.alias("issue"))

    def of_numbers(flat: Column) -> Column:
        """Of a list that holds only numbers and nulls."""
        return known(flat, F.when(F.size(flat) % 2 == 1, ODD_LENGTH).when(F.exists(flat, lambda v: v.isNull()), NOT_NUMERIC))

    def of_members(values: Column) -> Column:
        numeric = F.forall(values, lambda v: F.coalesce(F.schema_of_variant(v).rlike(f"^{number}"), F.lit(False)))
        flat = F.transform(values, lambda v: F.try_variant_get(v, "$", "double"))
        return known(flat, F.when(F.size(values) % 2 == 1, ODD_LENGTH).when(~numeric, NOT_NUMERIC))

    def of_any(every: Column) -> Column:
        pairs = (F.size(every) > 0) & F.forall(every, lambda m: is_list(m) & (F.coalesce(F.size(members(m)), F.lit(0)) == 2))
        return let(F.when(pairs, F.flatten(F.transform(every, members))).otherwise(every), of_members)

    def of_pairs(lists: Column, v: Column) -> Column:
        two = F.forall(lists, lambda m: F.coalesce(F.size(m) == 2, F.lit(False)))
        return F.when(two, let(F.flatten(lists), of_numbers)).otherwise(let(members(v), of_any))

    def of_kind(v: Column, kind: Column) -> Column:
        """One reading of the whole list, if its type says that it holds nothing but numbers, or lists of numbers."""
        return (
            F.when(~F.coalesce(kind.startswith("ARRAY"), F.lit(False)), known(F.lit(None).cast("array<double>"), F.lit(NO_STRUCTURE)))
            .when(kind.rlike(f"^ARRAY<{number}"), let(F.try_variant_get(v, "$", "array<double>"), of_numbers))
            .when(kind.rlike(f"^ARRAY<ARRAY<{number}"), let(F.try_variant_get(v, "$", "array<array<double>>"), lambda lists: of_pairs(lists, v)))
            .otherwise(let(members(v), of_any))
        )

    return let(points, lambda v: let(F.schema_of_variant(v), lambda kind: of_kind(v, kind)))


def point_issue(flat: Column) -> Column:
    """Code of the first fault of a flat list: missing, odd length, not finite, too few points."""
    finite = F.forall(flat, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        F.when(flat.isNull(), NO_STRUCTURE)
        .when(F.size(flat) % 2 == 1, ODD_LENGTH)
        .when(~finite, NOT_FINITE)
        .when(F.size(F.array_distinct(cleaned(ring_of_flat(flat)))) < 3, TOO_FEW)
    )


def _next(ring: Column, i: Column) -> Column:
    return F.get(ring, ((i + 1) % F.size(ring)).cast("int"))


def area(ring: Column) -> Column:
    """Shoelace area; 0 for fewer than three points."""
    cross = F.transform(ring, lambda p, i: p["x"] * _next(ring, i)["y"] - _next(ring, i)["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2


def clip_half(ring: Column, axis: str, bound: Column, above: bool) -> Column:
    """The part of a ring on one side of x or y = bound."""
    other = "y" if axis == "x" else "x"
    inside = (lambda p: p[axis] >= bound) if above else (lambda p: p[axis] <= bound)

    def crossing(p: Column, q: Column) -> Column:
        at = p[other] + (bound - p[axis]) / (q[axis] - p[axis]) * (q[other] - p[other])
        return point(bound, at) if axis == "x" else point(at, bound)

    def step(side: Column) -> Column:
        p, q = side["p"], side["q"]
        none = F.array().cast("array<struct<x:double,y:double>>")
        cut = F.array(crossing(p, q))
        return F.when(inside(p), F.when(inside(q), F.array(p)).otherwise(F.concat(F.array(p), cut))).otherwise(F.when(inside(q), cut).otherwise(none))

    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(0))), F.slice(ring, 1, 1))
    sides = F.zip_with(ring, turned, lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    return F.when(F.forall(ring, inside), ring).otherwise(F.flatten(F.transform(sides, step)))


def clip_to_frame(df, ring: str, width: Column, height: Column, out: str):
    """``df`` with ``out``: the ring cut to [0, width] x [0, height]. A ring that lies inside
    keeps its vertices. Each half-plane is a projection of its own, so that plans stay small."""
    inside = F.forall(F.col(ring), lambda p: p["x"].between(0, width) & p["y"].between(0, height))
    df = df.withColumn(out, F.col(ring))
    for axis, bound, above in (("x", F.lit(0.0), True), ("x", width, False), ("y", F.lit(0.0), True), ("y", height, False)):
        df = df.withColumn(out, clip_half(F.col(out), axis, bound.cast("double"), above))
    return df.withColumn(out, F.when(inside, F.col(ring)).otherwise(F.col(out)))


def bounds(ring: Column) -> Column:
    """struct(x1, y1, x2, y2), NULL for an empty ring."""
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.when(F.size(ring) > 0, F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")))


def box(b: Column, width: Column, height: Column) -> Column:
    """struct(cx, cy, w, h) of bounds, as shares of the frame; a flat side is widened by half
    a unit each way, inside the frame."""
    low = lambda a, z: F.when(b[z] > b[a], b[a]).otherwise(F.greatest(F.lit(0.0), b[a] - 0.5))
    high = lambda a, z, d: F.when(b[z] > b[a], b[z]).otherwise(F.least(d.cast("double"), b[z] + 0.5))
    x1, x2, y1, y2 = low("x1", "x2"), high("x1", "x2", width), low("y1", "y2"), high("y1", "y2", height)
    return F.struct(
        ((x1 + x2) / 2 / width).alias("cx"), ((y1 + y2) / 2 / height).alias("cy"), ((x2 - x1) / width).alias("w"), ((y2 - y1) / height).alias("h")
    )


def rounded_box_ratio(b: Column, width: Column, height: Column, digits: int = 8) -> Column:
    """Share of the frame of a ring with bounds ``b``, vertices rounded as shares first (rounding keeps their order)."""
    cut = lambda v, d: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v / d)), digits)
    return (cut(b["x2"], width) - cut(b["x1"], width)) * (cut(b["y2"], height) - cut(b["y1"], height))


def canonical_ring(ring: Column) -> Column:
    """From the least vertex, in the lesser of both directions: equal for equal outlines."""

    def from_least(r: Column) -> Column:
        k = F.array_position(r, F.array_min(r)).cast("int")
        return F.concat(F.slice(r, k, F.size(r)), F.slice(r, 1, k - 1))

    return F.when(F.size(ring) > 0, F.least(from_least(ring), from_least(F.reverse(ring))))


RING = "array<struct<x:double,y:double>>"


CUT = "issue string, changed boolean, area double, n_parts int, n_bounds int, min_extent boolean"
MEASURES = {"bounds": "array<struct<x1:double,y1:double,x2:double,y2:double>>", "boxes": "array<struct<cx:double,cy:double,w:double,h:double>>", "box_ratio": "double", "parts": f"array<{RING}>"}
ISSUES = [NO_STRUCTURE, ODD_LENGTH, NOT_FINITE, TOO_FEW]


def cut_to_frame(flat: Column, width: Column, height: Column, measures: tuple[str, ...] = ("bounds", "parts")) -> Column:
    """struct(issue, changed, area, n_parts, n_bounds, min_extent, and of bounds, boxes, box_ratio and parts those in ``measures``) of
    a flat list of points: repaired where its ring crosses or touches itself, cut to [0, width] x [0, height].

    issue is that of point_issue; the ring is that of cleaned. parts are the outer rings of what is left, none if there is an issue or
    if no area is left. A simple ring inside the frame is its own only part, as given; all others are in canonical form and in the order
    of bounds, area and vertices. area is that of all parts, without holes. bounds are the parts', or if there are none the bounds of what
    the frame holds of the outline, if any; min_extent: these are flat. boxes are box of the bounds, box_ratio the largest
    rounded_box_ratio of the parts', 0 without parts. The rules are those of the module outlines.
    """

    def work(flats: pa.Array, widths: pa.Array, heights: pa.Array) -> pa.Array:
        given = pc.is_valid(flats).to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(flats), 0).to_numpy()
        values = flats.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        w, h = (pc.fill_null(x, 0.0).to_numpy() for x in (widths, heights))
        ring = np.repeat(np.arange(len(sizes)), sizes)
        odd, finite = sizes % 2 == 1, ~outlines.some(~np.isfinite(values), ring, len(sizes))
        read = ~odd & finite
        xy, n = outlines.cleaned((values if read.all() else values[read[ring]]).reshape(-1, 2), np.where(read, sizes, 0) // 2)
        few = ~outlines.three_points(xy, n)
        issue = np.select([~given, odd, ~finite, few], range(len(ISSUES)), -1)
        xy, n = xy.take(np.flatnonzero(np.repeat(~few, n)), axis=0), np.where(few, 0, n)
        changed, area, points, size, of = outlines.rings_in_frames(xy, n, w, h, normal="parts" in measures)
        bounds, has = outlines.bounds_in_frames(xy, n, w, h, points, size, of, bool({"bounds", "boxes", "box_ratio"} & {*measures}))
        held = np.bincount(of, minlength=len(n))
        flat = np.zeros(len(n), bool)
        line = (held == 0) & (has > 0)
        low, high = np.split(bounds[(np.cumsum(has) - has)[line]], 2, axis=1)
        flat[line] = (low >= high).any(axis=1)
        frames = np.repeat(np.column_stack([w, h]), has, axis=0)
        ends = lambda k: pa.array(np.concatenate([[0], np.cumsum(k)]), pa.int32())
        fields = lambda v, names: pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x)) for x in v.T], names)
        code = pa.array(ISSUES).take(pa.array(issue, pa.int32(), mask=issue < 0))
        columns = {"issue": code, "changed": pa.array(changed), "area": pa.array(area), "n_parts": pa.array(held, pa.int32()), "n_bounds": pa.array(has, pa.int32()), "min_extent": pa.array(flat)}
        if "bounds" in measures:
            columns["bounds"] = pa.ListArray.from_arrays(ends(has), fields(bounds, ["x1", "y1", "x2", "y2"]))
        if "boxes" in measures:
            columns["boxes"] = pa.ListArray.from_arrays(ends(has), fields(outlines.boxes(bounds, frames), ["cx", "cy", "w", "h"]))
        if "box_ratio" in measures:
            ratios, largest = outlines.rounded_box_ratios(bounds, frames), np.zeros(len(n))
            np.maximum.at(largest, np.repeat(np.arange(len(n)), has), np.where(np.repeat(held > 0, has), ratios, 0.0))
            columns["box_ratio"] = pa.array(largest)
        if "parts" in measures:
            columns["parts"] = pa.ListArray.from_arrays(ends(held), pa.ListArray.from_arrays(ends(size), fields(points, ["x", "y"])))
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    work.__annotations__ = dict.fromkeys(("flats", "widths", "heights", "return"), pa.Array)
    return F.arrow_udf(work, ", ".join([CUT, *[f"{name} {kind}" for name, kind in MEASURES.items() if name in measures]]))(flat, width.cast("double"), height.cast("double"))


def parts_in_frame(ring: Column, width: Column, height: Column) -> Column:
    """cut_to_frame of a cleaned ring."""
    return cut_to_frame(F.flatten(F.transform(ring, lambda p: F.array(p["x"], p["y"]))), width, height)


def once(df, **columns: Column):
    """``df`` with columns that are computed once a row: a generator of one row each is a border
    that the optimizer doesn't copy expressions across, where chained projections would grow."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def convert_annotations(df, flat: str, width: Column, height: Column, issue: str | None = None, measures: tuple[str, ...] = ("boxes", "box_ratio", "parts")):
    """``df``, a row per annotation, with ring, parts, boxes, n_boxes, n_rings, box_ratio, area_ratio, box_valid,
    ring_valid, min_extent and issues, from the flat points of column ``flat``.

    ``issue`` is a column of codes found before, as by parse_points; such rows are not converted. parts are
    the rings to write, boxes one for each, see parts_in_frame; box_ratio is the largest box's. A ring with
    nothing left may still have part of its outline in the frame: its only box is that outline's, flat
    sides widened, and it has no ring. Shapes are most of what a batch works out and gives back: of boxes, box_ratio
    and parts (with ring) only those in ``measures`` are there.
    """
    known = F.col(issue) if issue else F.lit(None).cast("string")
    framed = (width > 0) & (height > 0)
    df = df.withColumn("__cut", cut_to_frame(F.when(known.isNull() & framed, F.col(flat)), width, height, measures))
    ringed, valid = F.col("__cut.n_parts") > 0, F.col("__cut.n_bounds") > 0
    df = df.withColumn("__issue", F.when(~framed, "invalid_frame").otherwise(F.coalesce(known, F.col("__cut.issue"))))
    usable = F.col("__issue").isNull()
    # A row with an issue has no parts and is not changed, and one that is changed has parts: these are all cases.
    empty, no_box = F.lit("empty_or_zero_area_after_clip"), F.lit("invalid_detection_bbox")
    issues = (
        F.when(~usable, F.array("__issue")).when(F.col("__cut.changed"), F.array(F.lit(REPAIRED)))
        .when(ringed, F.array().cast("array<string>")).when(valid, F.array(empty)).otherwise(F.array(no_box, empty))
    )
    # Plain columns of what the batches give, so that those that no step reads are not computed.
    more = {name: F.col(f"__cut.{name}") for name in measures}
    if "parts" in measures:
        more["ring"] = F.when(usable, cleaned(ring_of_flat(F.col(flat))))
    more |= {
        "n_boxes": F.col("__cut.n_bounds"), "box_valid": valid, "n_rings": F.col("__cut.n_parts"), "ring_valid": ringed, "min_extent": F.col("__cut.min_extent"),
        "area_ratio": F.when(usable, F.col("__cut.area") / (width.cast("double") * height)).otherwise(0.0), "issues": issues,
    }
    return df.withColumns(more).drop("__issue", "__cut")


def ring_issues(flat: Column, cut: Column, width: Column, height: Column) -> Column:
    """Codes of one annotation: frame, points, repair or clipping, empty result. ``cut``: its parts_in_frame."""
    code = point_issue(flat)
    flagged = [
        F.when((width <= 0) | (height <= 0), "invalid_frame"),
        code,
        F.when(code.isNull() & cut["changed"], REPAIRED),
        F.when(code.isNull() & (F.size(cut["parts"]) == 0), "empty_or_zero_area_after_clip"),
    ]
    return F.array_compact(F.array(*flagged))
