"""Files and reports: digests of bytes, ordered reports in parts, signatures over the targets of a record."""

import glob

from pyspark.sql import functions as F

from graincut.functions import records
from graincut.operators import apportion, audit, dedup, publish
from graincut.sources import tables


def test_digests_tell_a_changed_copy(spark, tmp_path):
    for side in ("source", "sink"):
        (tmp_path / side / "a").mkdir(parents=True)
        for name, data in (("a/x.json", b"{}"), ("a/y.json", b"[1]" if side == "source" else b"[2]"), ("z.bin", bytes(range(256)))):
            (tmp_path / side / name).write_bytes(data)
    (tmp_path / "source" / "only").write_bytes(b"1")
    source, sink = (tables.file_digests(spark, f"{tmp_path}/{side}") for side in ("source", "sink"))
    assert {r.relative for r in publish.copies_differ(source, sink, "relative", "sha256").collect()} == {"a/y.json", "only"}


def test_report_parts_hold_the_order(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish.write_report(rows, str(tmp_path / "report"), ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted(glob.glob(str(tmp_path / "report" / "part-*")))
    lines = [line for p in parts for line in open(p).read().split("\n")[1:] if line]
    assert len(parts) > 1 and [int(line.split(",")[0]) for line in lines] == list(range(5000))
    placed = apportion.numbered(rows, [F.col("k").desc()], "place").collect()
    assert all(r.place == 5000 - r.k for r in placed) and len(placed) == 5000


def test_signatures_ignore_the_order_of_targets(spark):
    a, b, c = ('{"name":"%s","points":%s}' % x for x in (("damage", "[[1,2],[3,4],[5,6]]"), ("pollution", "[1,2,3,4,5,6]"), ("damage", "[[1,2],[3,4],[5,7]]")))
    texts = {"ab": f"[{a},{b}]", "ba": f"[{b},{a}]", "cb": f"[{c},{b}]", "aab": f"[{a},{a},{b}]", "none": "[]", "odd": f'[{a},{b},{{"name":"outline"}},7]'}
    df = spark.createDataFrame([(k, '{"defects":%s}' % v) for k, v in texts.items()], "k string, body string").withColumn("v", tables.parse_json("body"))
    signed = df.select("k", dedup.record_signature(records.targets(records.defects(F.col("v")), F.lit("B")), F.lit(False), F.lit(None).cast("string")).alias("s"))
    got = {r.k: r.s for r in signed.collect()}
    assert got["ab"] == got["ba"] == got["odd"] and len(set(got.values())) == 4


def test_deviations_of_empty_sides(spark):
    items = spark.createDataFrame([("development", 0, 2), ("development", 1, 0)], "role string, fold int, n_annotations int")
    assert {r.split: r.deviation for r in audit.fold_deviations(items, "role", "fold").collect()} == {"fold_0": 1.0, "fold_1": -1.0}
    row = audit.deviation_summary(items, "role", "fold").first()
    assert (row.verdict, row.worst_deviation, row.test_density_ratio) == ("FAIL", 1.0, 0.0)
    assert audit.deviation_summary(items.limit(0), "role", "fold").first().worst_deviation is None
