"""Queries on whole records: payload rules, ring conversion and roll-up, inclusion, report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records, rings, text
from ..operators import apportion, dataset, publish, reports, rules
from ..sources.tables import items_of_manifest, parse_json, read_table, settle
from . import bindings as b
from . import queries as q
from .queries import query

FRAME = 50.0


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Payloads and rings are heavy for their bytes: rows are dealt to a given number of tasks, by the key that they are rolled up by."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


# Records: file names of parts with payloads that break each rule in turn.
def _records(spark, sf) -> DataFrame:
    s, fault = F.col("p_partkey").cast("string"), F.expr("(p_partkey div 5) % 12")
    names = dealt(q._names(spark, sf, whole=True), "p_partkey")
    parsed = rings.once(names, fault=fault, parsed=text.parse_item_name("name"), stem=F.regexp_replace("name", r"\.[^.]*$", ""))
    porous = F.when(F.col("parsed.kind") == "A", "Porosity").otherwise("damage")
    one = lambda name: F.concat(F.lit('{"name":"'), name, F.lit('","points":[[1,1],[9,1],[9,9]]}'))
    marks = (
        F.when(fault == 7, one(F.lit("mystery")))
        .when(fault.isin(8, 9), one(F.lit("outline")))
        .when(fault == 11, F.concat(one(porous), F.lit(",7,"), one(porous)))
        .otherwise(one(porous))
    )
    normal = F.when(fault == 8, '"true"').when(fault.isin(9, 10), "true").otherwise("false")
    body = F.concat(
        F.lit('{"data_info":{"battery_ids":["'), F.when(fault == 1, "0").otherwise(s), F.lit('"],"data_type":"'),
        F.when((F.col("parsed.kind") == "A") != (fault == 2), " CT ").otherwise("Rgb"), F.lit('"'),
        F.when(fault == 5, "").when(fault == 6, ',"roi":[0,20]').otherwise(',"roi":[20,20]'),
        F.lit('},"image_info":{"file_name":"'), F.when(fault == 3, "other").otherwise(F.col("stem")), F.lit('.png","width":'),
        F.when(fault == 4, "true").otherwise("40"), F.lit(',"height":30,"is_normal":'), normal, F.lit('},"defects":['), marks, F.lit("]}"),
    )
    payload = parse_json(F.when(fault == 0, F.lit("{broken")).otherwise(body))
    df = rings.once(parsed, payload=payload, width=F.lit(40), height=F.lit(30))
    df = rings.once(df, json_group_id=rules.json_group_id(F.col("payload"), "$.data_info.battery_ids", "$.data_info.battery_id"), **records.record_fields(F.col("payload")))
    return rings.once(df, targets=records.targets(records.without_repeats(F.col("defects")), F.col("parsed.kind")))


_RECORD_SQL = """WITH r AS (SELECT p_partkey, (p_partkey // 5) % 12 AS fault, CASE p_partkey % 5 WHEN 0 THEN 'A' WHEN 3 THEN 'A' WHEN 1 THEN 'B' END AS kind FROM part)"""


@query(_RECORD_SQL + """ SELECT p_partkey, CASE WHEN kind IS NULL THEN 'filename_parse_error' WHEN fault = 0 THEN 'json_parse_error' WHEN fault = 1 THEN 'group_id_mismatch' WHEN fault = 2 THEN 'kind_mismatch'
  WHEN fault = 3 THEN 'file_name_mismatch' WHEN fault = 4 THEN 'image_size_mismatch' WHEN fault = 5 AND kind = 'A' THEN 'missing_roi' WHEN fault = 6 AND kind = 'A' THEN 'invalid_roi' WHEN fault = 7 THEN 'undefined_class'
  WHEN fault = 8 THEN 'no_target_and_not_explicit_normal' END AS reason FROM r""")
def record_rule_chain(spark, sf):
    return _records(spark, sf).select("p_partkey", rules.first_failure(records.record_rules()).alias("reason"))


@query(_RECORD_SQL + """ SELECT issue, count(*) AS n FROM (
  SELECT 'duplicate_annotation' AS issue FROM r WHERE fault = 11 UNION ALL SELECT 'is_normal_type' FROM r WHERE fault = 8 UNION ALL SELECT 'normal_with_target' FROM r WHERE fault = 10) GROUP BY 1""")
def record_anomalies(spark, sf):
    usable = _records(spark, sf).where("payload is not null")
    return rules.issue_rows(usable, ["p_partkey"], rules.all_failures(records.record_anomalies())).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


def _lines(spark, sf) -> DataFrame:
    """Lines, dealt by order before anything wide is made of them."""
    return dealt(read_table(spark, sf, "lineitem").drop("l_suppkey", "l_extendedprice", "l_linestatus", "l_shipdate"), "l_orderkey")


# Rectangles of lineitem as flat rings in a frame, a row per annotation.
def _converted(spark, sf, *measures: str) -> DataFrame:
    x, y = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double") * 10
    w, h = F.rint(F.col("l_discount") * 100) * 3, F.rint(F.col("l_tax") * 100) * 3
    flat = F.array(x, y, x + w, y, x + w, y + h, x, y + h)
    return rings.convert_annotations(_lines(spark, sf).select("l_orderkey", "l_returnflag", flat.alias("flat")), "flat", F.lit(FRAME), F.lit(FRAME), measures=measures)


_CONVERT_SQL = """WITH p AS (SELECT l_orderkey, l_returnflag, l_partkey % 13 AS fault, l_quantity AS x1, l_linenumber * 10 AS y1, l_quantity + round(l_discount * 100) * 3 AS x2, l_linenumber * 10 + round(l_tax * 100) * 3 AS y2 FROM lineitem),
c AS (SELECT l_orderkey, l_returnflag, fault, x2 > x1 AND y2 > y1 AS ok, x1, y1, x2, y2, least(x2, 50) AS cx, least(y2, 50) AS cy FROM p),
v AS (SELECT *, ok AND x1 <= 50 AND y1 <= 50 AS box_valid, ok AND x1 < 50 AND y1 < 50 AS ring_valid FROM c),
a AS (SELECT *, box_valid AND NOT ring_valid AS min_extent, CASE WHEN ring_valid THEN (cx - x1) * (cy - y1) / 2500.0 ELSE 0 END::DOUBLE AS ratio,
  CASE WHEN cx > x1 THEN x1 ELSE x1 - 0.5 END AS bx, CASE WHEN cy > y1 THEN y1 ELSE y1 - 0.5 END AS by_ FROM v)"""


@query(_CONVERT_SQL + """, i AS (SELECT l_orderkey AS item_id, count(*) AS n_given, bool_and(box_valid) AS bh, bool_and(ring_valid) AS rh, bool_or(min_extent) AS min_extent,
  round(coalesce(sum(ratio) FILTER (l_returnflag = 'R'), 0), 6) AS extent_sum, round(coalesce(max(ratio) FILTER (l_returnflag = 'R'), 0), 6) AS extent_max FROM a GROUP BY 1)
SELECT item_id, n_given, CASE WHEN bh THEN n_given ELSE 0 END AS n_boxes, CASE WHEN rh THEN n_given ELSE 0 END AS n_rings, min_extent, extent_sum, extent_max,
  CASE WHEN NOT bh THEN 'invalid_target_polygon' END AS box_reason, CASE WHEN NOT rh THEN 'ring_repair_failed' END AS ring_reason FROM i""")
def record_rollup(spark, sf):
    converted = _converted(spark, sf, "box_ratio").withColumnRenamed("l_orderkey", "item_id")
    return reports.roll_up(converted, ["item_id"], F.col("l_returnflag") == "R").drop("n_more_parts").withColumns({c: F.round(c, 6) for c in ("extent_sum", "extent_max")})


@query(_CONVERT_SQL + """ SELECT issue, count(*) AS n FROM (
  SELECT unnest(CASE WHEN NOT ok THEN ['fewer_than_3_unique_points'] WHEN ring_valid THEN CASE WHEN x2 > 50 OR y2 > 50 THEN ['polygon_repaired_or_clipped'] ELSE [] END
    WHEN box_valid THEN ['empty_or_zero_area_after_clip'] ELSE ['invalid_detection_bbox', 'empty_or_zero_area_after_clip'] END) AS issue FROM a) GROUP BY 1""")
def conversion_issues(spark, sf):
    return _converted(spark, sf).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


def _planted(spark, sf, *measures: str) -> DataFrame:
    """Rings of six kinds, by order, converted: unequal bowtie, bowtie whose areas cancel, ring that touches itself, U that the
    frame cuts in two, line, square."""
    s, x, y = F.col("l_linenumber") + 1.0, F.col("l_quantity").cast("double") % 20, (F.col("l_partkey") % 20).cast("double")
    f = F.lit(FRAME)
    flat = lambda *v: F.array(*[a + x if k % 2 == 0 else a + y for k, a in enumerate(v)])
    zero = F.lit(0.0)
    kind = F.col("l_orderkey") % 6
    ring = (
        F.when(kind == 0, flat(zero, zero, 3 * s, 3 * s, 3 * s, s, zero, s))
        .when(kind == 1, flat(zero, zero, 2 * s, 2 * s, 2 * s, zero, zero, 2 * s))
        .when(kind == 2, flat(zero, zero, 2 * s, zero, 2 * s, 2 * s, s, zero, zero, 2 * s))
        .when(kind == 3, F.array(f + 2, y, f + 2, y + 3 * s, f - s, y + 3 * s, f - s, y + 2 * s, f + 1, y + 2 * s, f + 1, y + s, f - s, y + s, f - s, y))
        .when(kind == 4, flat(zero, zero, 2 * s, zero, s, zero))
        .otherwise(flat(zero, zero, s, zero, s, s, zero, s))
    )
    return rings.convert_annotations(_lines(spark, sf).select("l_orderkey", "l_linenumber", ring.alias("flat")), "flat", f, f, measures=measures)


_PLANTED_SQL = """WITH p AS (SELECT l_orderkey, l_linenumber, l_orderkey % 6 AS k, l_linenumber + 1 AS s, l_quantity::BIGINT % 20 AS x, l_partkey % 20 AS y FROM lineitem)"""


@query(_PLANTED_SQL + """ SELECT l_orderkey, l_linenumber, CASE WHEN k IN (2, 3) THEN 2 ELSE 1 END::INTEGER AS n_boxes, CASE k WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END::INTEGER AS n_rings,
  CASE k WHEN 0 THEN 2 * s * s WHEN 1 THEN s * s WHEN 2 THEN 2 * s * s WHEN 3 THEN 2 * s * s WHEN 4 THEN 0 ELSE s * s END::DOUBLE AS area, k = 4 AS min_extent,
  CASE k WHEN 0 THEN [x + s, y + s, 3 * s + x, y + s, 3 * s + x, 3 * s + y] WHEN 1 THEN [x + s, y + s, 2 * s + x, y, 2 * s + x, 2 * s + y] WHEN 2 THEN [x, y, x, y + 2 * s, x + s, y]
    WHEN 3 THEN [50 - s, y, 50 - s, y + s, 50, y + s, 50, y] WHEN 5 THEN [x, y, x + s, y, x + s, y + s, x, y + s] END::VARCHAR AS first_ring,
  CASE k WHEN 0 THEN [2 * x + 4 * s, 2 * y + 4 * s, 4 * s, 4 * s] WHEN 1 THEN [2 * x + 3 * s, 2 * y + 2 * s, 2 * s, 4 * s] WHEN 2 THEN [2 * x + 3 * s, 2 * y + 2 * s, 2 * s, 4 * s] WHEN 3 THEN [100 - s, 2 * y + 5 * s, 2 * s, 2 * s]
    WHEN 4 THEN [2 * x + 2 * s, greatest(4 * y, 1) // 2, 4 * s, CASE WHEN y = 0 THEN 1 ELSE 2 END] ELSE [2 * x + s, 2 * y + s, 2 * s, 2 * s] END::VARCHAR AS last_box,
  CASE WHEN k < 4 THEN 'polygon_repaired_or_clipped' WHEN k = 4 THEN 'empty_or_zero_area_after_clip' ELSE '' END AS issues FROM p""")
def planted_rings(spark, sf):
    """Parts, areas, codes, vertices of the first part in their order, and the last box in halves of a unit."""
    text = lambda a: F.concat(F.lit("["), F.array_join(a, ", "), F.lit("]"))
    points = F.flatten(F.transform(F.get("parts", F.lit(0)), lambda p: F.array(F.rint(p["x"]).cast("long"), F.rint(p["y"]).cast("long"))))
    last = F.element_at("boxes", -1)
    box = F.array(*[F.floor(last[c] * FRAME * 2 + 1e-6).cast("long") for c in ("cx", "cy", "w", "h")])
    return _planted(spark, sf, "boxes", "parts").select(
        "l_orderkey", "l_linenumber", "n_boxes", "n_rings", F.round(F.col("area_ratio") * FRAME * FRAME, 6).alias("area"), "min_extent", text(points).alias("first_ring"), text(box).alias("last_box"),
        F.array_join("issues", ",").alias("issues"),
    )


@query(_PLANTED_SQL + """, t AS (SELECT count(*) FILTER (k < 4) AS n_repaired, count(*) FILTER (k IN (2, 3)) AS n_several_parts, count(*) FILTER (k IN (2, 3)) AS n_more_parts, count(DISTINCT l_orderkey) FILTER (k = 4) AS n_min_extent FROM p)
SELECT *, n_repaired + n_several_parts + n_min_extent > 0 AS review FROM t""")
def planted_totals(spark, sf):
    return reports.geometry_totals(_planted(spark, sf), "l_orderkey")


@query(_PLANTED_SQL + """ SELECT l_orderkey AS item_id, count(*) AS n_given, sum(CASE WHEN k IN (2, 3) THEN 2 ELSE 1 END)::BIGINT AS n_boxes, CASE WHEN any_value(k) = 4 THEN 0 ELSE sum(CASE WHEN k IN (2, 3) THEN 2 ELSE 1 END) END::BIGINT AS n_rings,
  sum(CASE WHEN k IN (2, 3) THEN 1 ELSE 0 END)::BIGINT AS n_more_parts, CASE WHEN any_value(k) = 4 THEN 'ring_repair_failed' END AS ring_reason FROM p GROUP BY 1""")
def planted_rollup(spark, sf):
    rolled = reports.roll_up(_planted(spark, sf, "box_ratio").withColumnRenamed("l_orderkey", "item_id"), ["item_id"], F.lit(True))
    return rolled.select("item_id", "n_given", "n_boxes", "n_rings", "n_more_parts", "ring_reason")


def _payload_rectangles(spark, sf, *measures: str) -> DataFrame:
    """The rectangles as annotations in JSON payloads, as pairs or flat by order, some with faults, converted."""
    x, y = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double") * 10
    w, h = F.rint(F.col("l_discount") * 100) * 3, F.rint(F.col("l_tax") * 100) * 3
    flat = F.array(x, y, x + w, y, x + w, y + h, x, y + h)
    pairs = F.array(*[F.array(*p) for p in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])
    fault = F.col("l_partkey") % 13
    points = (
        F.when(fault == 0, F.lit('[[1,"2"],[3,4],[5,6]]')).when(fault == 1, F.lit("[1,2,3,4,5,6,7]")).when(fault == 2, F.lit('{"x":1}')).when(fault == 3, F.lit("[1,2,true,4,5,6]"))
        .when(F.col("l_orderkey") % 2 == 0, F.to_json(pairs)).otherwise(F.to_json(flat))
    )
    body = F.concat(F.lit('{"defects":[7,{"name":"damage","points":'), points, F.lit("}]}"))
    lines = _lines(spark, sf).select("l_orderkey", "l_returnflag", body.alias("body"))
    found = lines.select("l_orderkey", "l_returnflag", F.explode(records.defects(parse_json("body"))).alias("d"))
    parsed = found.select("l_orderkey", "l_returnflag", F.inline(F.array(rings.parse_points(F.try_parse_json("d.points")))))
    return rings.convert_annotations(parsed, "flat", F.lit(FRAME), F.lit(FRAME), "issue", measures=measures)


_PAYLOAD_SQL = _CONVERT_SQL + """, w AS (SELECT l_orderkey, l_returnflag, fault, ok, x2, y2, fault > 3 AND box_valid AS box_valid, fault > 3 AND ring_valid AS ring_valid, CASE WHEN fault > 3 THEN ratio ELSE 0 END AS ratio FROM a)"""


@query(_PAYLOAD_SQL + """ SELECT l_orderkey AS item_id, count(*) AS n_given, CASE WHEN bool_and(box_valid) THEN count(*) ELSE 0 END AS n_boxes, CASE WHEN bool_and(ring_valid) THEN count(*) ELSE 0 END AS n_rings,
  round(coalesce(sum(ratio) FILTER (l_returnflag = 'R'), 0), 6) AS extent_sum FROM w GROUP BY 1""")
def payload_rollup(spark, sf):
    converted = _payload_rectangles(spark, sf, "box_ratio").withColumnRenamed("l_orderkey", "item_id")
    rolled = reports.roll_up(converted, ["item_id"], F.col("l_returnflag") == "R")
    return rolled.select("item_id", "n_given", "n_boxes", "n_rings", F.round("extent_sum", 6).alias("extent_sum"))


@query(_PAYLOAD_SQL + """ SELECT issue, count(*) AS n FROM (
  SELECT unnest(CASE WHEN fault IN (0, 3) THEN ['non_numeric_coordinate'] WHEN fault = 1 THEN ['odd_flat_points_length'] WHEN fault = 2 THEN ['invalid_points_structure'] WHEN NOT ok THEN ['fewer_than_3_unique_points']
    WHEN ring_valid THEN CASE WHEN x2 > 50 OR y2 > 50 THEN ['polygon_repaired_or_clipped'] ELSE [] END
    WHEN box_valid THEN ['empty_or_zero_area_after_clip'] ELSE ['invalid_detection_bbox', 'empty_or_zero_area_after_clip'] END) AS issue FROM w) GROUP BY 1""")
def payload_issues(spark, sf):
    return _payload_rectangles(spark, sf).select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query(_CONVERT_SQL + """, s AS (SELECT l_returnflag, (cx - bx) / 50 AS w, (cy - by_) / 50 AS h, round(((cx - bx) / 50) / ((cy - by_) / 50), 12) AS aspect FROM a WHERE box_valid)
SELECT l_returnflag, count(*) AS n_boxes, round(median(w), 9) AS median_w, round(median(h), 9) AS median_h, round(median(aspect), 6) AS median_aspect,
  round(list_sort(list(round(aspect, 6)))[round_even((count(*) - 1) * 0.05, 0)::BIGINT + 1], 6) AS aspect_p05, round(list_sort(list(round(aspect, 6)))[round_even((count(*) - 1) * 0.95, 0)::BIGINT + 1], 6) AS aspect_p95 FROM s GROUP BY 1""")
def box_shapes(spark, sf):
    boxes = _converted(spark, sf, "boxes").select("l_returnflag", F.inline("boxes"))
    shapes = reports.box_shapes(boxes, ["l_returnflag"])
    return shapes.select("l_returnflag", "n_boxes", *[F.round(c, d).alias(c) for c, d in (("median_w", 9), ("median_h", 9), ("median_aspect", 6), ("aspect_p05", 6), ("aspect_p95", 6))])


@query(_CONVERT_SQL + """, l AS (SELECT l_orderkey AS item_id, count(*) AS n, bool_and(box_valid) AS ok FROM a GROUP BY 1), k AS (SELECT *, item_id % 9 AS f FROM l WHERE ok)
SELECT item_id, CASE WHEN f = 3 THEN 0 ELSE n END AS n_lines, CASE f WHEN 0 THEN 'field_count' WHEN 1 THEN 'class_id' WHEN 2 THEN 'coordinate' WHEN 3 THEN 'defect_empty' WHEN 4 THEN 'normal_not_empty' ELSE '' END AS faults FROM k""")
def label_lines(spark, sf):
    """Label lines of the items whose boxes all hold, some broken after writing, checked as written."""
    class_id = records.class_id(F.when(F.col("l_returnflag") == "R", "Damaged").otherwise("Pollution"), F.lit("B"))
    items = _converted(spark, sf, "boxes").groupBy(F.col("l_orderkey").alias("item_id")).agg(F.collect_list(F.struct(class_id.alias("id"), "boxes")).alias("drawn"), F.bool_and("box_valid").alias("ok"))
    # Texts cost more than numbers, and items whose boxes don't all hold have none.
    lines = F.array_sort(F.flatten(F.transform("drawn", lambda d: F.transform(d["boxes"], lambda drawn: publish.box_text(d["id"], drawn)))))
    items = rings.once(items.where("ok").select("item_id", "drawn"), lines=lines)
    fault = F.col("item_id") % 9
    broken = F.transform("lines", lambda x: F.when(fault == 0, F.concat(x, F.lit(" 0.5"))).when(fault == 1, F.concat(F.lit("7"), F.substring(x, 2, 1000))).when(fault == 2, F.concat(F.substring(x, 1, 2), F.lit("1.5"), F.substring(x, 13, 1000))).otherwise(x))
    written = items.select("item_id", F.when(fault == 3, F.array().cast("array<string>")).otherwise(broken).alias("lines"))
    return written.select("item_id", F.size("lines").cast("long").alias("n_lines"), F.array_join(publish.label_faults(F.col("lines"), fault == 4, 2, 5), ",").alias("faults"))


@query(b.ITEMS_SQL + """SELECT kind, group_id, count(*) AS n_scanned, count(*) FILTER (v) AS n_valid, count(*) FILTER (v AND eligible) AS n_eligible, count(*) FILTER (v AND NOT eligible) AS n_excluded,
  count(*) FILTER (v AND eligible AND facet = 'F') AS n_facet_f, count(*) FILTER (v AND eligible AND facet = 'O') AS n_facet_o, count(*) FILTER (v AND eligible AND facet = 'P') AS n_facet_p,
  coalesce(count(*) FILTER (v AND eligible AND n_annotations > 0) / nullif(count(*) FILTER (v AND eligible), 0), 0) AS positive_ratio,
  coalesce(sum(n_annotations) FILTER (v AND eligible) / nullif(count(*) FILTER (v AND eligible), 0), 0) AS density FROM (SELECT *, extent_sum < 0.5 AS v FROM ruled) GROUP BY 1, 2""")
def group_scan(spark, sf):
    return reports.group_scan(b.ruled_items(spark, sf), ["kind", "group_id"], F.col("extent_sum") < 0.5, F.col("eligible"), b.FACETS)


@query(b.ITEMS_SQL + """SELECT 'scanned' AS metric, kind, count(*) AS value FROM ruled GROUP BY kind UNION ALL SELECT 'groups', kind, count(DISTINCT group_id) FROM ruled GROUP BY kind
UNION ALL SELECT 'excluded_by_policy', kind, count(*) FILTER (NOT eligible) FROM ruled GROUP BY kind UNION ALL SELECT 'annotations', kind, sum(n_annotations)::BIGINT FROM ruled GROUP BY kind""")
def scan_totals(spark, sf):
    items = b.ruled_items(spark, sf)
    return reports.totals(
        {
            "scanned": (items, F.count(F.lit(1))),
            "groups": (items, F.count_distinct("group_id")),
            "excluded_by_policy": (items, F.count(F.when(~F.col("eligible"), 1))),
            "annotations": (items, F.sum("n_annotations")),
        },
        "kind",
    )


@query(b.ITEMS_SQL + """, s AS (SELECT kind, group_id % 5 AS k, sum(n_first) AS f, sum(n_second) FILTER (group_id % 5 > 0) AS g FROM items GROUP BY 1, 2), t AS (SELECT kind || '_' || k AS split, f, coalesce(g, 0) AS g FROM s)
SELECT split, 'first' AS class FROM t WHERE f = 0 UNION ALL SELECT split, 'second' FROM t WHERE g = 0""")
def missing_classes(spark, sf):
    fold = F.col("group_id") % 5
    items = b.orders_as_items(spark, sf).select(F.concat_ws("_", "kind", fold.cast("string")).alias("split"), "n_first", F.when(fold > 0, F.col("n_second")).alias("n_second"))
    return reports.missing_classes(items, "split", {"first": "n_first", "second": "n_second"})


# Groups of kind B: picked by stratum, split in roles, sampled by role.
SEATS = 8


def _roles(spark, sf) -> DataFrame:
    """Picked groups with role: by largest remainder SEATS for test, then SEATS of the rest for val."""
    picked = settle(q._picked(spark, sf), "picked")
    quotas = q._quotas(picked, SEATS).withColumnRenamed("quota", "quota_test")
    test = settle(apportion.seeded_split(picked, quotas, ["stratum"], "group_id", 42, ["test"], "rest"), "tested")
    rest = test.where("role = 'rest'").drop("role")
    again = q._quotas(rest, SEATS).withColumnRenamed("quota", "quota_val")
    others = apportion.seeded_split(rest, again, ["stratum"], "group_id", 42, ["val"], "train")
    return test.where("role = 'test'").unionByName(others)


_ROLES_SQL = (
    q._PICK_SQL
    + ", c1 AS (SELECT stratum, count(*) AS n FROM picked GROUP BY 1)"
    + q.quota_sql("c1", "stratum", SEATS, "1")
    + """, tested AS (SELECT p.*, row_number() OVER (PARTITION BY stratum ORDER BY sha1('42|split|' || group_id), group_id) <= quotas1.quota AS test FROM picked p JOIN quotas1 ON stratum = key),
c2 AS (SELECT stratum, count(*) AS n FROM tested WHERE NOT test GROUP BY 1)"""
    + q.quota_sql("c2", "stratum", SEATS, "2")
    + """, roles AS (SELECT group_id, stratum, has_first, 'test' AS role FROM tested WHERE test UNION ALL
  SELECT group_id, stratum, has_first, CASE WHEN row_number() OVER (PARTITION BY stratum ORDER BY sha1('42|split|' || group_id), group_id) <= quotas2.quota THEN 'val' ELSE 'train' END FROM tested JOIN quotas2 ON stratum = key WHERE NOT test)"""
)


@query(_ROLES_SQL + " SELECT group_id, stratum, role FROM roles")
def role_split(spark, sf):
    return _roles(spark, sf).select("group_id", "stratum", "role")


@query(_ROLES_SQL + " SELECT role FROM (VALUES ('test'), ('val')) t(role) WHERE role NOT IN (SELECT role FROM roles WHERE has_first)")
def roles_without_class(spark, sf):
    return apportion.require_class_in_roles(_roles(spark, sf), "role", ["test", "val"], "has_first")


def _included(spark, sf) -> DataFrame:
    items = b.ruled_items(spark, sf).where("kind = 'B'")
    roles = _roles(spark, sf).select("group_id", "role")
    own = items.where("eligible").join(roles, "group_id")
    scope = F.concat(F.lit("B:"), F.col("group_id").cast("string"))
    sampled = apportion.sample_by_role(own, ["group_id"], "item_id", F.col("n_annotations") > 0, 6, 42, scope, "role").select("item_id", F.lit(True).alias("sampled"))
    return reports.inclusion(items.join(sampled, "item_id", "left"), roles, ["group_id"], "policy_reason")


_INCLUDED_SQL = _ROLES_SQL + """, own AS (SELECT r.*, o.role, n_annotations > 0 AS pos FROM ruled r JOIN roles o USING (group_id) WHERE kind = 'B' AND eligible),
sized AS (SELECT *, count(*) OVER g AS n, count(*) FILTER (pos) OVER g AS np FROM own WINDOW g AS (PARTITION BY group_id)),
placed AS (SELECT *, least(6, n) AS want, greatest(least(round_even(least(6, n) * np / n, 0)::BIGINT, np), least(6, n) - (n - np)) AS wp,
  row_number() OVER (PARTITION BY group_id, pos ORDER BY sha1('42|B:' || group_id || ':' || role || CASE WHEN pos THEN ':p' ELSE ':n' END || '|' || item_id), item_id) AS r FROM sized),
included AS (
  SELECT i.item_id, i.group_id, o.role, CASE WHEN NOT eligible THEN policy_reason WHEN o.role IS NULL THEN 'group_not_picked'
    WHEN i.item_id NOT IN (SELECT item_id FROM placed WHERE role = 'test' OR r <= CASE WHEN pos THEN wp ELSE want - wp END) THEN 'sampling_cap' END AS reason
  FROM ruled i LEFT JOIN roles o USING (group_id) WHERE kind = 'B')"""


@query(_INCLUDED_SQL + " SELECT item_id, group_id, role, reason, reason IS NULL AS included FROM included")
def item_inclusion(spark, sf):
    return _included(spark, sf).select("item_id", "group_id", "role", "reason", "included")


@query(_INCLUDED_SQL + " SELECT role, segment, count(DISTINCT i.group_id) AS n_groups, count(*) AS n_items FROM included i JOIN ruled USING (item_id) WHERE reason IS NULL GROUP BY 1, 2")
def segments_by_role(spark, sf):
    return _included(spark, sf).where("included").groupBy("role", "segment").agg(F.count_distinct("group_id").alias("n_groups"), F.count(F.lit(1)).alias("n_items"))


@query(q._REGION_SQL + q.quota_sql("f", "rate_bin", q._N_TEST) + """, g AS (SELECT key AS bin, n, quota FROM quotas), k AS (SELECT unnest(['zero', 'very_low', 'low_mid', 'mid_high', 'very_high']) AS bin)
SELECT 'overall' AS scope, k.bin, coalesce(n, 0) AS n_candidates, coalesce(quota, 0) AS n_wanted, coalesce(quota, 0) AS n_test, coalesce(n - quota, 0) AS n_development, 'PASS' AS status FROM k LEFT JOIN g USING (bin)
UNION ALL SELECT 'test', k.bin, coalesce(n, 0), coalesce(quota, 0), coalesce(quota, 0), NULL, 'INFO' FROM k LEFT JOIN g USING (bin)
UNION ALL SELECT 'all_folds', k.bin, coalesce(n, 0), NULL, NULL, coalesce(n - quota, 0), 'INFO' FROM k LEFT JOIN g USING (bin)""")
def rate_bin_report(spark, sf):
    """The report with its fold rows summed, as the choice of folds has no SQL."""
    report = reports.rate_bin_report(q._assigned(spark, sf), q._test_quotas(q._region_groups(spark, sf)), text.RATE_BINS)
    scope = F.when(F.col("scope").startswith("fold_"), "all_folds").otherwise(F.col("scope"))
    return report.groupBy(scope.alias("scope"), "bin", "n_candidates", "status").agg(*[F.sum(c).alias(c) for c in ("n_wanted", "n_test", "n_development")])


# Both kinds: regions as groups of kind A, customers as groups of kind B.
_STRUCTURE = dataset.Structure(a_groups=25, a_test=5, folds=5, b_picked=40, b_val=5, b_test=5, b_cap=8)
_ITEM_SCHEMA = "item_id long, group_id long, kind string, facet string, area_bin string, segment string, n_annotations long, n_first long, eligible boolean"


def _dataset_items(spark, sf) -> DataFrame:
    items = b.ruled_items(spark, sf).withColumn("area_bin", text.area_bin("extent_sum"))
    regions = items.withColumns({"kind": F.lit("A"), "group_id": F.col("region_id").cast("long")})
    return regions.unionByName(items.where("kind = 'B'")).select(*[c.split()[0] for c in _ITEM_SCHEMA.split(", ")])


def _assign(items: DataFrame) -> DataFrame:
    return dataset.assign_dataset(items, b.FACETS, list(text.AREA_BINS), _STRUCTURE, gate=False)


@query("""SELECT 'A' AS kind, 'test' AS role, NULL::INTEGER AS fold, 5::BIGINT AS n_groups, 5::BIGINT AS n_distinct UNION ALL SELECT 'A', 'development', k::INTEGER, 4, 4 FROM range(5) t(k)
UNION ALL SELECT 'B', 'test', NULL, 5, 5 UNION ALL SELECT 'B', 'val', NULL, 5, 5 UNION ALL SELECT 'B', 'train', NULL, 30, 30""")
def dataset_invariants(spark, sf):
    """Numbers of groups by kind, role and fold of one assignment of both kinds."""
    return _assign(_dataset_items(spark, sf)).groupBy("kind", "role", "fold").agg(F.count(F.lit(1)).alias("n_groups"), F.count_distinct("group_id").alias("n_distinct"))


@query("""SELECT 'A' AS kind, c_nationkey::BIGINT AS group_id, CASE WHEN c_nationkey % 11 = 0 THEN 'added' ELSE 'changed' END AS change
FROM (SELECT DISTINCT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey) WHERE c_nationkey % 7 = 0 OR c_nationkey % 11 = 0""")
def replay_diff(spark, sf):
    """A recorded assignment, changed for some groups and without others, against one recomputed from the manifest's text."""
    items = _dataset_items(spark, sf)
    assigned = settle(_assign(items), "assigned")
    role = F.when(F.col("group_id") % 7 == 0, F.concat(F.lit("was_"), "role")).otherwise(F.col("role"))
    recorded = assigned.where("kind = 'B' or group_id % 11 <> 0").withColumn("role", F.when(F.col("kind") == "A", role).otherwise(F.col("role")))
    manifest = items.select(*[F.col(c).cast("string").alias(c) for c in items.columns])
    return dataset.replay(recorded, _assign(items_of_manifest(manifest, _ITEM_SCHEMA))).select("kind", "group_id", "change")
