"""Operators on literal rows with known results."""

import hashlib
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from graincut.functions import digests, records, rings, text
from graincut.operators import apportion, approve, assign, dedup, publish, reports, rules
from graincut.sources import tables


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def test_keys_and_ids(spark):
    lit = F.lit
    r = one(spark, text.order_key(42, "scope", lit("item")), text.item_id(lit("A"), lit("stem"), lit("a\\b")), text.strip_zeros(lit("000")), text.strip_zeros(lit("x1")), text.class_token(lit(" A_b--C ")))
    assert r[0] == hashlib.sha1(b"42|scope|item").hexdigest()
    assert r[1] == "A__stem__" + hashlib.sha1(b"a/b").hexdigest()[:8]
    assert (r[2], r[3], r[4]) == ("0", None, "a b c")
    assert one(spark, text.canonical_class(lit("Damage"), lit("B")), text.canonical_class(lit("damage"), lit("A")))[:] == ("Damaged", None)
    ids = spark.createDataFrame([("10",), ("9",), ("b",), ("A",), ("009",)], "id string")
    assert [x.id for x in ids.orderBy(text.natural_key("id")).collect()] == ["009", "9", "10", "A", "b"]


def test_bin_edges(spark):
    areas = {0.0: "zero", 0.0009: "lt_0.1pct", 0.001: "0.1_1pct", 0.25: "25_40pct", 0.5: "ge_50pct", 3.0: "ge_50pct"}
    rates = {0.0: "zero", 0.005: "very_low", 0.01: "low_mid", 0.3: "mid_high", 0.6: "very_high", 1.0: "very_high"}
    for f, table in ((text.area_bin, areas), (text.rate_bin, rates)):
        assert {k: one(spark, f(F.lit(k)))[0] for k in table} == table
    for bad in (-0.1, float("nan")):
        with pytest.raises(Exception):
            one(spark, text.area_bin(F.lit(bad)))


def test_fixed_decimals(spark):
    assert one(spark, text.fixed8_unit(F.lit(1.5)), text.fixed8_unit(F.lit(1 / 3)), text.fixed8(F.lit(1234.5)))[:] == ("1.00000000", "0.33333333", "1234.50000000")


def test_largest_remainder_equals_the_greedy_loop(spark):
    import random

    rng = random.Random(5)
    for _ in range(6):
        weights = {f"k{j}": rng.randint(0, 9) + 1 for j in range(rng.randint(1, 6))}
        caps = {k: rng.randint(0, 8) for k in weights}
        seats = rng.randint(0, sum(caps.values()))
        raw = {k: w * seats / sum(weights.values()) for k, w in weights.items()}
        quota = {k: min(int(raw[k]), caps[k]) for k in weights}
        while sum(quota.values()) < seats:
            k = min((k for k in weights if quota[k] < caps[k]), key=lambda k: (-(raw[k] - quota[k]), -weights[k], k))
            quota[k] += 1
        df = spark.createDataFrame([(k, w, caps[k]) for k, w in weights.items()], "k string, w long, cap long")
        assert {r.k: r.quota for r in apportion.largest_remainder(df, seats, "k", "w", "cap").collect()} == quota
    with pytest.raises(Exception):
        apportion.largest_remainder(spark.createDataFrame([("a", 1, 1)], "k string, w long, cap long"), 2, "k", "w", "cap").collect()


def test_quantile_bins_over_many_ranges(spark):
    """Ranks as in one sort, with tied values, a hot and a NULL key, and ranges that are not merged."""
    rows = [(k, None if k % 10 == 0 else "hot" if k % 3 else "cold", (k * 7919) % 13 / 13) for k in range(400)]
    df = spark.createDataFrame(rows, "group_id long, segment string, rate double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for by in ([], ["segment"]):
            found = {r.group_id: r.bin for r in apportion.quantile_bins(df, by, [F.col("rate"), F.col("group_id")], 5).collect()}
            want = {}
            for key in {r[1] if by else 0 for r in rows}:
                own = sorted((r for r in rows if not by or r[1] == key), key=lambda r: (r[2], r[0]))
                want |= {r[0]: min(4, k * 5 // len(own)) for k, r in enumerate(own)}
            assert found == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert apportion.quantile_bins(df.limit(0), [], [F.col("rate")], 5).collect() == []


def test_rings(spark):
    flat = F.array(*[F.lit(float(x)) for x in (-10, -10, 60, -10, 60, 60, -10, 60, -10, -10)])
    df = spark.range(1).select(rings.cleaned(rings.ring_of_flat(flat)).alias("ring"))
    clipped = rings.clip_to_frame(df, "ring", F.lit(50.0), F.lit(50.0), "cut")
    r = clipped.select(rings.area(F.col("cut")), rings.bounds(F.col("cut"))["x2"], F.size("ring")).first()
    assert r[:] == (2500.0, 50.0, 4)
    bow = rings.ring_of_flat(F.array(*[F.lit(float(x)) for x in (0, 0, 2, 2, 2, 0, 0, 2)]))
    square = lambda *xs: rings.canonical_ring(rings.ring_of_flat(F.array(*[F.lit(float(x)) for x in xs])))
    r = one(spark, rings.parts_in_frame(bow, F.lit(9), F.lit(9))["changed"], square(0, 0, 0, 1, 1, 1) == square(1, 1, 0, 1, 0, 0), rings.point_issue(F.array(F.lit(1.0))), rings.point_issue(F.array(*[F.lit(1.0)] * 6)))
    assert r[:] == (True, True, "odd_flat_points_length", "fewer_than_3_unique_points")


def test_json_group_ids(spark):
    cases = {'{"g":"007"}': "7", '{"g":["12"]}': "12", '{"g":true}': None, '{"g":3}': "3", '{"g":["1","2"]}': None, '{"h":4}': "4", "[1]": None, '﻿{"g":1}': "1"}
    for raw, want in cases.items():
        assert one(spark, rules.json_group_id(tables.parse_json(F.lit(raw)), "$.g", "$.h"))[0] == want, raw


def test_density_swaps_lower_the_worst_deviation(spark):
    rows = [(k, f"s{k % 2}", [100, 30, 90 if k % 2 else 20]) for k in range(8)]
    groups = spark.createDataFrame(rows, "group_id long, split string, f array<long>")
    after = assign.refine_density(groups).groupBy("split").agg(F.count("*").alias("n"), (F.sum(F.col("f")[2]) / F.sum(F.col("f")[0])).alias("d")).collect()
    assert [r.n for r in after] == [4, 4] and max(abs(r.d / 0.55 - 1) for r in after) <= 0.15


def test_labels_and_views(spark):
    box = F.struct(F.lit(0.5).alias("cx"), F.lit(0.5).alias("cy"), F.lit(2.0).alias("w"), F.lit(0.25).alias("h"))
    line = publish.box_text(F.lit(1), box)
    r = one(spark, line, publish.label_issues(F.array(line), 2, 5), publish.label_issues(F.array(F.lit("9 0.5 x 0.1")), 2, 5))
    assert r[0] == "1 0.50000000 0.50000000 1.00000000 0.25000000" and r[1] == [] and r[2] == ["field_count", "class_id", "coordinate"]
    ids = lambda *xs: spark.createDataFrame([(x,) for x in xs], "id long")
    view, missing = publish.training_view(ids(1, 2, 3), ids(1, 2), ids(1), "id")
    assert [x.id for x in view.collect()] == [1] and [x.id for x in missing.collect()] == [2]
    assert publish.memberships(spark.range(5).withColumn("fold", F.col("id").cast("int")), "fold", 5).where("role = 'val'").count() == 5


def test_approval_detects_tampering(spark, tmp_path):
    report = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    make = lambda df, seed: approve.approval_record(spark, {"seed": seed}, {"ids": (df, "id")}, {"report": df})
    good = make(report, "1")
    approve.write_approval(good, str(tmp_path / "approval"))
    with pytest.raises(Exception):
        approve.write_approval(good, str(tmp_path / "approval"))
    assert approve.approval_faults(good, make(report.orderBy(F.desc("id")), "1")).count() == 0
    changed = approve.approval_faults(good, make(report.withColumn("v", F.lit("x")), "2")).collect()
    assert {(r.part, r.name) for r in changed} == {("policy", "seed"), ("reports", "report")}
    findings = spark.createDataFrame([("f1", "c", 1.0, "t"), ("f2", "c", 2.0, "t")], "finding_id string, code string, observed double, threshold string")
    exceptions = spark.createDataFrame([("f1", "c", 1.0, "t", "approved", "me", "now", " "), ("f3", "c", 1.0, "t", "approved", "me", "now", "ok")], findings.schema.simpleString()[7:-1].replace(":", " ") + ", status string, approver string, approved_at string, reason string")
    assert {tuple(r) for r in approve.exception_faults(findings, exceptions).collect()} == {("f1", "audit_field_missing"), ("f2", "missing"), ("f3", "unknown")}


def _png(path, pixels, width, grey):
    raw = b"".join(b"\0" + bytes(pixels[k : k + width * (1 if grey else 3)]) for k in range(0, len(pixels), width * (1 if grey else 3)))
    chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
    height = len(pixels) // (width * (1 if grey else 3))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0 if grey else 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_file_sources(spark, tmp_path):
    _png(tmp_path / "a.png", [10] * 6, 3, True)
    _png(tmp_path / "b.PNG", [10] * 18, 3, False)
    (tmp_path / "c.png").write_bytes(b"no image")
    (tmp_path / "a.json").write_text("﻿" + json.dumps({"width": 3}), encoding="utf-8")
    (tmp_path / "b.json").write_text("[1]")
    (tmp_path / "d.txt").write_text("x")
    listed = {(r.relative, r.role) for r in tables.list_files(spark, str(tmp_path)).collect()}
    assert listed == {("a.png", "image"), ("b.PNG", "image"), ("c.png", "image"), ("a.json", "json"), ("b.json", "json")}
    images = {r.path[-5:]: r for r in tables.image_metadata(spark, str(tmp_path)).where("path like '%png' or path like '%PNG'").collect()}
    assert images["a.png"].width == 3 and images["a.png"].height == 2 and images["c.png"].corrupt
    assert images["a.png"].content_hash == images["b.PNG"].content_hash
    payloads = {r.path[-6:]: r.ok for r in tables.read_annotations(spark, str(tmp_path)).selectExpr("path", "payload is not null ok").collect()}
    assert payloads == {"a.json": True, "b.json": False}


def test_record_columns_and_inclusion(spark):
    lit = F.lit
    r = one(spark, records.class_id(lit("Pollution"), lit("B")), records.class_id(lit("Pollution"), lit("A")), records.split_label(lit("A"), lit("development"), lit(3)), records.split_label(lit("A"), lit("test"), lit(None)), records.stratum_text(lit(True).cast("int"), lit(None)))
    assert r[:] == (1, None, "A_fold_3", "A_test", '["1",null]')
    items = spark.createDataFrame([(1, 1, True, None, True), (2, 1, False, "policy", None), (3, 1, True, None, None), (4, 2, True, None, True)], "item long, group_id long, eligible boolean, why string, sampled boolean")
    out = reports.inclusion(items, spark.createDataFrame([(1, "train")], "group_id long, role string"), ["group_id"], "why")
    assert {(x.item, x.reason) for x in out.collect()} == {(1, None), (2, "policy"), (3, "sampling_cap"), (4, "group_not_picked")}


def test_converted_annotations(spark):
    rows = [("in", [1, 1, 9, 1, 9, 9]), ("cut", [5, 5, 15, 5, 15, 15, 5, 15]), ("edge", [10, 2, 14, 2, 14, 6, 10, 6]), ("out", [20, 20, 30, 20, 30, 30]), ("odd", [1, 2, 3]), ("none", None)]
    df = spark.createDataFrame([(k, None if v is None else [float(x) for x in v]) for k, v in rows], "id string, flat array<double>")
    got = {r.id: r for r in rings.convert_annotations(df, "flat", F.lit(10), F.lit(10)).collect()}
    assert {k: (r.box_valid, r.ring_valid, r.min_extent) for k, r in got.items()} == {
        "in": (True, True, False), "cut": (True, True, False), "edge": (True, False, True), "out": (False, False, False), "odd": (False, False, False), "none": (False, False, False),
    }
    assert {k: r.issues for k, r in got.items()} == {
        "in": [], "cut": ["polygon_repaired_or_clipped"], "edge": ["empty_or_zero_area_after_clip"], "out": ["invalid_detection_bbox", "empty_or_zero_area_after_clip"],
        "odd": ["odd_flat_points_length"], "none": ["invalid_points_structure"],
    }
    assert got["cut"].area_ratio == 0.25 and got["cut"].box_ratio == 0.25 and abs(got["edge"].boxes[0].w - 0.05) < 1e-12


def test_items_without_a_hash_stay(spark):
    rows = [(1, None, "g", "s"), (2, None, "h", "s"), (3, "aa", "g", "s"), (4, "aa", "g", "s"), (5, "ab", "g", None), (6, "ab", "g", "s"), (7, "ba", "g", "s"), (8, "ba", None, "s"), (9, "c", "g", "s")]
    items = spark.createDataFrame(rows, "id long, h string, g string, s string")
    found = {r.id: (r.action, r.n_copies, r.dup_group) for r in dedup.resolve_duplicates(items, "h", ["g"], "s", ["id"]).collect()}
    assert found == {
        1: ("single", 1, None), 2: ("single", 1, None), 9: ("single", 1, None), 3: ("representative", 2, "dup_000001"), 4: ("duplicate", 2, "dup_000001"),
        5: ("label_conflict", 2, "dup_000002"), 6: ("label_conflict", 2, "dup_000002"), 7: ("cross_group", 2, "dup_000003"), 8: ("cross_group", 2, "dup_000003"),
    }


def test_points_of_both_forms(spark):
    cases = {
        "[[1,1],[9,1],[9,9.5]]": None, "[1,1,9,1,9,9.5]": None, "[]": "fewer_than_3_unique_points", "[1,2,3]": "odd_flat_points_length", '{"x":1}': "invalid_points_structure", '"1,2"': "invalid_points_structure",
        "[[1,2],[3,true],[5,6]]": "non_numeric_coordinate", '[1,"2",3,4,5,6]': "non_numeric_coordinate", "[1,null,3,4,5,6]": "non_numeric_coordinate", "[[1,2],[3,4],[5,6,7]]": "odd_flat_points_length",
        "[[1,2],[3,4],[5]]": "odd_flat_points_length", "[[1,1],[9,1],[1,1],[9,1]]": "fewer_than_3_unique_points", "[[1,1],[9,1],[9,9],[1,1],5]": "odd_flat_points_length",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "raw string").select("raw", F.inline(F.array(rings.parse_points(F.try_parse_json("raw")))))
    got = {r.raw: (r.issues, r.ring_valid) for r in rings.convert_annotations(df, "flat", F.lit(10), F.lit(10), "issue").collect()}
    for raw, code in (cases | {None: "invalid_points_structure"}).items():
        assert got[raw][0][:1] == ([code] if code else []) and got[raw][1] == (code is None), raw
    far = spark.createDataFrame([([1.0, float("inf"), 2.0, 3.0, 4.0, 5.0],)], "flat array<double>")
    assert rings.convert_annotations(far, "flat", F.lit(10), F.lit(10)).first().issues == ["non_finite_coordinate"]


def test_digest_of_a_deeper_tree(spark, monkeypatch):
    lines = spark.range(900).select(F.col("id").cast("string").alias("k"))
    flat = digests.tree_digest(lines, F.col("k"), F.col("k"), "d").first()[0]
    monkeypatch.setattr(digests, "LINES", 0.1)
    deep = digests.tree_digest(lines, F.col("k"), F.col("k"), "d").first()[0]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    key = lambda k: hashlib.sha1(str(k).encode()).hexdigest()

    def by_hand(digits):
        nodes = {}
        for k in range(900):
            nodes.setdefault(key(k)[:digits], []).append(str(k))
        level = {b: sha("\n".join(sorted(x))) for b, x in nodes.items()}
        for d in [*range(digits - 1, 1, -1), 0]:
            up = {}
            for b in sorted(level):
                up.setdefault(b[:d], []).append(f"{b}:{level[b]}")
            level = {b: sha("\n".join(x)) for b, x in up.items()}
        return level[""]

    assert flat == by_hand(2) and deep == by_hand(4)
    assert digests.tree_digest(lines.orderBy(F.desc("k")).repartition(7), F.col("k"), F.col("k"), "d").first()[0] == deep


def test_pairs_list_the_first_paths_of_a_hot_key(spark):
    left = spark.createDataFrame([("k", f"p{n:03d}") for n in range(50)] + [("j", "x")], "s string, path string")
    found = {r.s: r for r in rules.pair_files(left, spark.createDataFrame([("j", "y")], "s string, path string"), ["s"], "path").collect()}
    assert found["k"].n_left == 50 and found["k"].left_paths.split("|") == [f"p{n:03d}" for n in range(10)] and found["k"].status == "left_only" and found["j"].status == "paired"


def test_samples_of_a_hot_group(spark):
    rows = [(k, "hot", k % 3 == 0) for k in range(300)] + [(1000, None, True), (1001, None, None)]
    items = spark.createDataFrame(rows, "item long, g string, pos boolean")
    found = apportion.stratified_sample(items, ["g"], "item", F.col("pos"), 10, 42, F.coalesce("g", F.lit("-"))).collect()
    key = lambda k, side: hashlib.sha1(f"42|hot:{side}|{k}".encode()).hexdigest()
    want = {*sorted((k for k in range(300) if k % 3 == 0), key=lambda k: key(k, "p"))[:3], *sorted((k for k in range(300) if k % 3), key=lambda k: key(k, "n"))[:7]}
    assert {r.item for r in found if r.g == "hot"} == want and {r.item for r in found if r.g is None} == {1000, 1001}


def test_sinks_and_checks_of_what_was_written(spark, tmp_path):
    ring = F.array(*[rings.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.5), (1.0, 2.0), (0.25, 0.0))])
    assert one(spark, publish.ring_text(F.lit(2), ring))[0] == "2 0.00000000 0.50000000 1.00000000 1.00000000 0.25000000 0.00000000"
    df = spark.createDataFrame([(2, "b", 1.5), (1, "a", None)], "id int, k string, v double")
    publish.write_report(df, str(tmp_path / "report"), ["id"])
    assert [tuple(r) for r in tables.read_report(spark, str(tmp_path / "report"), "id int, k string, v double").collect()] == [(1, "a", None), (2, "b", 1.5)]
    publish.write_partitioned(df, str(tmp_path / "table"), ["k"])
    assert {p.name for p in (tmp_path / "table").iterdir() if p.is_dir()} == {"k=a", "k=b"}
    for again in (lambda: publish.write_report(df, str(tmp_path / "report"), ["id"]), lambda: publish.write_partitioned(df, str(tmp_path / "table"), ["k"])):
        with pytest.raises(Exception):
            again()
    sides = [spark.createDataFrame(x, "id int, sha string") for x in ([(1, "x"), (2, "y"), (3, None)], [(1, "x"), (2, "z"), (3, None)])]
    assert [tuple(r) for r in publish.copies_differ(*sides, "id", "sha").collect()] == [(2, "y", "z")]
    lines = F.array(F.lit("0 0.5 0.5 0.1 0.1"))
    none = F.array().cast("array<string>")
    r = one(spark, publish.label_faults(lines, F.lit(True), 2, 5), publish.label_faults(none, F.lit(False), 2, 5), publish.label_faults(none, F.lit(True), 2, 5), publish.label_faults(F.lit(None).cast("array<string>"), F.lit(False), 2, 5))
    assert r[:] == (["normal_not_empty"], ["defect_empty"], [], ["defect_empty"])


def test_structural_checks(spark):
    items = spark.createDataFrame([(1, True, True), (2, False, False), (3, False, True), (4, False, False)], "id int, eligible boolean, selected boolean")
    faults = approve.structural_faults(items, spark.createDataFrame([(2,), (3,), (9,)], "id int"), "id").collect()
    assert {tuple(r) for r in faults} == {("not_in_exclusions", "4"), ("not_excluded", "9"), ("selected_but_excluded", "3")}
    scan = spark.createDataFrame([(1, 5, 3, 2), (2, 5, 3, 1)], "group_id int, n_valid long, n_eligible long, n_excluded long")
    dist = lambda *n: spark.createDataFrame([(x,) for x in n], "n long")
    found = approve.count_faults(scan, items.where("selected"), {"good": dist(1, 1), "bad": dist(1, 2)}).collect()
    assert {tuple(r) for r in found} == {("valid_count", "2", 5, 4), ("distribution_total", "bad", 2, 3)}


def test_rows_of_a_training_view(spark):
    rows = [(1, "A", "development", 0, True), (2, "A", "development", 1, True), (3, "A", "test", None, True), (4, "A", "development", 1, False), (5, "B", "train", None, True), (6, "B", None, None, True)]
    items = spark.createDataFrame(rows, "id int, kind string, role string, fold int, included_box boolean")
    view = lambda *a, **k: {(r.id, r.role) for r in publish.view_rows(items, *a, **k).collect()}
    assert view("A", "box", 1) == {(1, "train"), (2, "val")} and view("A", "box", 0, include_test=True) == {(1, "val"), (2, "train"), (3, "test")} and view("B", "box") == {(5, "train")}


def test_manifest_keeps_every_item(spark):
    items = spark.createDataFrame(
        [
            (1, "r/1.x/a.PNG", "B", 7, None, "s", 2, 1, True, None, True, True, False, None, "ring_repair_failed", 0.1, 0.1),
            (2, "r/2", "B", 7, "F", "s", 0, 0, True, None, None, True, True, None, None, 0.0, 0.0),
            (3, "r/3.png", "A", 8, None, "s", 1, 1, False, "policy", True, True, None, None, "bad", 0.3, 0.3),
            (4, None, None, None, None, None, None, None, None, None, True, None, None, "unread", "unread", None, None),
        ],
        "item_id int, path string, kind string, group_id int, facet string, segment string, n_annotations int, n_first int, eligible boolean, policy_reason string, sampled boolean, included_box boolean, included_ring boolean, reason_box string, reason_ring string, extent_sum double, extent_max double",
    )
    groups = spark.createDataFrame([("B", 7, "test", None), ("A", 8, "development", 3)], "kind string, group_id int, role string, fold int")
    rows = {r.item_id: r for r in publish.manifest(items, groups, {"first": "n_first"}).collect()}
    pick = lambda k, *c: tuple(rows[k][x] for x in c)
    names = ("role", "fold", "selected", "included_box", "included_ring", "reason_box", "reason_ring", "group_rate", "output_name", "destination", "stratum", "has_first")
    assert len(rows) == 4
    assert pick(1, *names) == ("test", None, True, True, False, None, "ring_repair_failed", 0.5, "1.png", "B/test", None, True)
    assert pick(2, *names) == ("test", None, False, False, False, "sampling_cap", "sampling_cap", 0.5, "2", None, None, False)
    assert pick(3, *names) == ("development", 3, False, False, False, "policy", "policy", 0.0, "3.jpg", None, "|25_40pct", True)
    assert pick(4, *names) == (None, None, False, False, False, "unread", "unread", 0.0, "4", None, None, False)


def test_orders_of_reports(spark):
    ids = spark.createDataFrame([("A", "10"), ("A", "9"), ("A", "x"), (None, "1")], "kind string, group_id string")
    assert [r[1] for r in ids.orderBy(*publish.report_order("groups", ids.columns)).collect()] == ["1", "9", "10", "x"]
    bins = spark.createDataFrame([("test", "zero"), ("fold_1", "zero"), ("overall", "very_high"), ("overall", "very_low")], "scope string, bin string")
    assert [tuple(r) for r in bins.orderBy(*publish.report_order("rate_bins", bins.columns)).collect()] == [("overall", "very_low"), ("overall", "very_high"), ("fold_1", "zero"), ("test", "zero")]
    pairs = spark.createDataFrame([(1, "b/c", "z"), (3, "a\\d", "y"), (2, "a/d", "x")], "n int, path string, reason string")
    assert [r[0] for r in pairs.orderBy(*publish.report_order("pairs", pairs.columns)).collect()] == [2, 3, 1]
    assert [r[0] for r in pairs.orderBy(*publish.report_order("other", pairs.columns)).collect()] == [1, 2, 3]
