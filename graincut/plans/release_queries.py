"""Queries on what is released: full manifest, views, reviews, structural checks, exceptions and approval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import records, rings
from ..operators import apportion, approve, audit, dedup, publish, reports, rules
from ..sources.tables import parse_json, read_table, settle, shared_path
from ..sources.trees import changed_keys, record_tree, tree_difference
from . import bindings as b
from . import queries as q
from . import record_queries as r
from .queries import query


@query(r._RECORD_SQL + " SELECT p_partkey, 'mystery' AS raw_class FROM r WHERE kind IS NOT NULL AND fault = 7")
def class_variants(spark, sf):
    undefined = rules.first_failure(records.record_rules()) == "undefined_class"
    names = F.when(undefined, records.unknown_classes(F.col("targets")))  # a filter on the reason would repeat the whole chain
    return r._records(spark, sf).select("p_partkey", F.explode(names).alias("raw_class"))


@query(b.DUP_SQL.format(group="lang") + "SELECT source, count(*) AS n_valid FROM resolved WHERE action IN ('single', 'representative') AND lang = 'en' GROUP BY 1")
def valid_documents(spark, sf):
    return dedup.valid_items(q._resolved(spark, sf, "lang"), F.col("lang") == "en").groupBy("source").agg(F.count(F.lit(1)).alias("n_valid"))


@query(r._CONVERT_SQL + """ SELECT *, n_repaired + n_several_parts + n_min_extent > 0 AS review FROM (
  SELECT count(*) FILTER (ring_valid AND (x2 > 50 OR y2 > 50)) AS n_repaired, 0::BIGINT AS n_several_parts, 0::BIGINT AS n_more_parts, count(DISTINCT l_orderkey) FILTER (min_extent) AS n_min_extent FROM a)""")
def geometry_totals(spark, sf):
    return reports.geometry_totals(r._converted(spark, sf), "l_orderkey")


# Scanned items and assigned groups of a release; a sixth of the groups is not picked.
def _scanned(spark, sf) -> DataFrame:
    i = F.col("item_id")
    box, ring = i % 11 != 0, (i % 11 != 0) & (i % 7 != 0)
    return b.ruled_items(spark, sf).withColumns({
        "path": F.concat(F.lit("raw/"), i.cast("string"), F.when(i % 3 == 0, ".PNG").otherwise(".Jpg")),
        "included_box": box, "included_ring": ring, "sampled": i % 4 != 0,
        "reason_box": F.when(~box, "duplicate"), "reason_ring": F.when(~box, "duplicate").when(~ring, "ring_repair_failed"),
    })


def _groups(items: DataFrame) -> DataFrame:
    g = F.col("group_id")
    role = F.when(g % 5 == 0, "test").otherwise(F.when(F.col("kind") == "A", "development").otherwise("train"))
    fold = F.when((F.col("kind") == "A") & (g % 5 != 0), (g % 5).cast("int"))
    return items.where("group_id % 6 <> 1").select("kind", "group_id", role.alias("role"), fold.alias("fold")).distinct()


def _manifest(spark, sf) -> DataFrame:
    items = _scanned(spark, sf)
    return publish.manifest(items, _groups(items), {"first": "n_first", "second": "n_second"})


_RELEASE_SQL = b.ITEMS_SQL + f""", scanned AS (
  SELECT *, item_id % 11 <> 0 AS box, item_id % 11 <> 0 AND item_id % 7 <> 0 AS ring, CASE WHEN group_id % 6 = 1 THEN NULL WHEN group_id % 5 = 0 THEN 'test' WHEN kind = 'A' THEN 'development' ELSE 'train' END AS role FROM ruled),
rates AS (SELECT kind, group_id, count(*) FILTER (n_annotations > 0) / count(*) AS rate FROM scanned WHERE eligible AND box GROUP BY 1, 2),
chosen AS (SELECT *, eligible AND item_id % 4 <> 0 AND role IS NOT NULL AS selected, CASE WHEN role IS NULL THEN 'group_not_picked' ELSE 'sampling_cap' END AS why, {b.AREA_BIN_SQL} AS bin FROM scanned),
released AS (SELECT item_id, c.kind, c.group_id, facet, segment, n_annotations, eligible, policy_reason, role, CASE WHEN role = 'development' THEN (c.group_id % 5)::INTEGER END AS fold, selected,
  box AND selected AS included_box, ring AND selected AS included_ring,
  CASE WHEN NOT eligible THEN policy_reason WHEN box AND NOT selected THEN why WHEN NOT box THEN 'duplicate' END AS reason_box,
  CASE WHEN NOT eligible THEN policy_reason WHEN ring AND NOT selected THEN why WHEN NOT box THEN 'duplicate' WHEN NOT ring THEN 'ring_repair_failed' END AS reason_ring,
  coalesce(rate, 0) AS group_rate, n_first > 0 AS has_first, n_second > 0 AS has_second, CASE WHEN c.kind = 'A' THEN extent_sum END AS extent_sum, CASE WHEN c.kind = 'A' THEN extent_max END AS extent_max,
  CASE WHEN c.kind = 'A' THEN bin END AS area_bin, CASE WHEN c.kind = 'A' THEN facet || '|' || bin END AS stratum,
  item_id || CASE WHEN c.kind = 'A' OR item_id % 3 <> 0 THEN '.jpg' ELSE '.png' END AS output_name,
  CASE WHEN selected THEN c.kind || CASE WHEN role = 'test' THEN '/test' ELSE '/trainval' END END AS destination
  FROM chosen c LEFT JOIN rates r ON r.kind = c.kind AND r.group_id = c.group_id)"""
_MANIFEST_COLUMNS = """item_id, kind, group_id, facet, segment, n_annotations, eligible, policy_reason, role, fold, selected, included_box, included_ring, reason_box, reason_ring,
 group_rate, has_first, has_second, extent_sum, extent_max, area_bin, stratum, output_name, destination"""


@query(_RELEASE_SQL + f" SELECT {_MANIFEST_COLUMNS} FROM released")
def release_manifest(spark, sf):
    return _manifest(spark, sf).select(*[c.strip() for c in _MANIFEST_COLUMNS.split(",")])


@query(_RELEASE_SQL + """ SELECT item_id, CASE WHEN role = 'test' THEN 'test' WHEN fold = 2 THEN 'val' ELSE 'train' END AS role, item_id % 17 = 0 AS image_missing
FROM released WHERE kind = 'A' AND included_ring AND item_id % 13 <> 0""")
def task_view(spark, sf):
    """Rows of a view of kind A's rings with fold 2 for validation, and those whose image is missing."""
    rows = publish.view_rows(_manifest(spark, sf), "A", "ring", fold=2, include_test=True).select("item_id", "role")
    orders = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("item_id"))
    view, missing = publish.training_view(rows, orders.where("item_id % 13 <> 0"), orders.where("item_id % 17 <> 0"), "item_id")
    return view.withColumn("image_missing", F.lit(False)).unionByName(missing.withColumn("image_missing", F.lit(True)))


@query(_RELEASE_SQL + """, o AS (SELECT item_id, eligible, selected OR item_id % 50 = 0 AS selected, CASE WHEN eligible THEN item_id % 101 = 0 ELSE item_id % 3 <> 0 END AS listed FROM released)
SELECT 'not_in_exclusions' AS code, item_id::VARCHAR AS subject FROM o WHERE NOT eligible AND NOT listed UNION ALL SELECT 'not_excluded', item_id::VARCHAR FROM o WHERE eligible AND listed
UNION ALL SELECT 'selected_but_excluded', item_id::VARCHAR FROM o WHERE selected AND NOT eligible""")
def structural_faults(spark, sf):
    """The manifest with some excluded items selected, against an exclusion table with rows lacking and added."""
    items = _manifest(spark, sf).select("item_id", "eligible", (F.col("selected") | (F.col("item_id") % 50 == 0)).alias("selected"))
    listed = items.where(F.when(F.col("eligible"), F.col("item_id") % 101 == 0).otherwise(F.col("item_id") % 3 != 0)).select("item_id")
    return approve.structural_faults(items, listed, "item_id")


@query(_RELEASE_SQL + """, s AS (SELECT group_id, count(*) FILTER (box) AS v, count(*) FILTER (box AND eligible) AS e, count(*) FILTER (box AND NOT eligible) + (group_id % 9 = 0)::BIGINT AS x FROM scanned WHERE kind = 'A' GROUP BY 1),
n AS (SELECT count(*) AS whole, count(*) FILTER (facet <> 'P') AS part FROM released WHERE kind = 'A' AND included_box)
SELECT 'valid_count' AS code, group_id::VARCHAR AS subject, v AS expected, e + x AS found FROM s WHERE v <> e + x UNION ALL SELECT 'distribution_total', 'without_p', whole, part FROM n WHERE whole <> part""")
def count_faults(spark, sf):
    """Counts of kind A by group, off by one in some, and two distributions, one of which leaves a facet out."""
    a = F.col("kind") == "A"
    scan = reports.group_scan(_scanned(spark, sf).where(a), ["group_id"], F.col("included_box"), F.col("eligible"), b.FACETS)
    scan = scan.withColumn("n_excluded", F.col("n_excluded") + (F.col("group_id") % 9 == 0).cast("long"))
    chosen = _manifest(spark, sf).where(a & F.col("included_box"))
    whole, part = (audit.distribution(df, "role", ["facet", "area_bin"]) for df in (chosen, chosen.where("facet <> 'P'")))
    return approve.count_faults(scan, chosen, {"whole": whole, "without_p": part})


@query(b.ITEMS_SQL + """, f AS (SELECT group_id FROM rated WHERE n_items < 12)
SELECT 'f' || group_id AS finding_id, CASE group_id % 7 WHEN 0 THEN 'missing' WHEN 1 THEN 'changed' WHEN 2 THEN 'not_approved' WHEN 3 THEN 'not_approved' ELSE 'audit_field_missing' END AS fault FROM f WHERE group_id % 7 <= 4
UNION ALL SELECT 'x' || group_id, 'unknown' FROM f WHERE group_id % 7 = 5""")
def exception_faults(spark, sf):
    """Findings on small groups against exceptions of which most have a fault."""
    groups = b.ruled_items(spark, sf).where("eligible").groupBy("group_id").agg(F.count(F.lit(1)).alias("n_items"))
    id_, m = F.concat(F.lit("f"), F.col("group_id").cast("string")).alias("finding_id"), F.col("group_id") % 7
    found = groups.where("n_items < 12").select("group_id", id_, F.lit("small_group").alias("code"), F.col("n_items").cast("double").alias("observed"), F.lit("n_items < 12").alias("threshold"))
    fields = {"status": F.when(m == 2, "pending").when(m != 3, "approved"), "approver": F.when(m == 4, " ").otherwise("someone"), "approved_at": F.lit("2024-01-01"), "reason": F.lit("known")}
    given = found.where(m != 0).withColumn("observed", F.when(m == 1, F.col("observed") + 1).otherwise(F.col("observed"))).withColumns(fields)
    unknown = given.where(m == 5).withColumn("finding_id", F.concat(F.lit("x"), F.col("group_id").cast("string")))
    return approve.exception_faults(found.drop("group_id"), given.unionByName(unknown).drop("group_id"))


@query("SELECT * FROM (VALUES ('policy', 'seed'), ('sets', 'test_groups'), ('reports', 'mapping'), ('reports', 'added')) t(part, name)")
def approval_faults(spark, sf):
    """An approval of the manifest's groups, sets and findings against one of today, where some roles, the seed and a report changed."""
    items = _scanned(spark, sf)
    groups, ids = _groups(items), items.select("item_id")
    findings = audit.findings(items, "large_extent", F.col("extent_sum") >= 0.4, F.col("item_id"), F.col("extent_sum"), "extent_sum >= 0.40")
    changed = groups.withColumn("role", F.when((F.col("role") == "test") & (F.col("group_id") % 10 == 0), "train").otherwise(F.col("role")))
    record = lambda seed, g, **more: approve.approval_record(
        spark, {"seed": seed, "reason": b.POLICY_REASON}, {"items": (ids, "item_id"), "test_groups": (g.where("role = 'test'"), "group_id")}, {"mapping": g, "findings": findings, **more}
    )
    return approve.approval_faults(record("42", groups), record("43", changed, added=groups)).select("part", "name")


@query(b.ITEMS_SQL + """, g AS (SELECT kind, region_id AS group_id, count(*) AS n_items FROM items GROUP BY 1, 2)
SELECT *, row_number() OVER (ORDER BY kind, group_id) AS position FROM g""")
def report_positions(spark, sf):
    """Places of a report's rows; the report has a row per kind and region."""
    report = b.orders_as_items(spark, sf).groupBy("kind", F.col("region_id").alias("group_id")).agg(F.count(F.lit(1)).alias("n_items"))
    return apportion.numbered(report, publish.report_order("groups", report.columns), "position")


# Every order as two records of one picture: the second lists its targets the other way round, has another point for
# one order in five, and belongs to another group for one in seven.
@query("""WITH o AS (SELECT DISTINCT l_orderkey AS o FROM lineitem), c AS (SELECT o, unnest([0, 1]) AS copy FROM o)
SELECT o * 2 + copy AS record_id, 2::BIGINT AS n_copies, CASE WHEN o % 7 = 0 THEN 'cross_group' WHEN o % 5 = 0 THEN 'label_conflict' WHEN copy = 0 THEN 'representative' ELSE 'duplicate' END AS action FROM c""")
def label_conflicts(spark, sf):
    """Duplicates by picture, with signatures over the targets of JSON payloads."""
    mark = lambda shift: F.concat(F.lit('{"name":"damage","points":[['), F.col("l_quantity").cast("int").cast("string"), F.lit(",1],["), F.col("l_linenumber").cast("string"), F.lit(",9],[30,"), F.lit(str(shift)), F.lit("]]}"))
    each = F.struct("l_linenumber", "l_partkey", mark(20).alias("same"), mark(21).alias("moved"))
    lines = r.dealt(read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_orderkey").groupBy(F.col("l_orderkey").alias("o")).agg(F.array_sort(F.collect_list(each)).alias("x"))
    copies = lines.select("o", "x", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    second = F.reverse(F.transform("x", lambda t: F.when((F.col("o") % 5 == 0) & (t == F.get("x", F.lit(0))), t["moved"]).otherwise(t["same"])))
    marks = F.when(F.col("copy") == 0, F.transform("x", lambda t: t["same"])).otherwise(second)
    body = F.concat(F.lit('{"image_info":{"is_normal":false},"defects":['), F.array_join(marks, ","), F.lit("]}"))
    parsed = rings.once(copies.select("o", "copy", body.alias("body")), v=parse_json("body"))
    found = parsed.select((F.col("o") * 2 + F.col("copy")).alias("record_id"), F.col("o").cast("string").alias("picture"), F.when((F.col("copy") == 1) & (F.col("o") % 7 == 0), "x").otherwise("g").alias("g"), records.defects(F.col("v")).alias("d"), F.try_variant_get("v", "$.image_info.is_normal", "boolean").alias("normal"))
    signed = found.select("record_id", F.sha1("picture").alias("picture"), "g", dedup.record_signature(records.targets(F.col("d"), F.lit("B")), F.col("normal"), F.lit(None).cast("string")).alias("signature"))
    signed = settle(signed, "signed")  # the steps below read it twice
    return dedup.resolve_duplicates(signed, "picture", ["g"], "signature", ["record_id"]).select("record_id", "n_copies", "action")


def _role_groups(spark, sf) -> DataFrame:
    """Some groups of kind A, with role and fold."""
    groups = b.orders_as_items(spark, sf).where("kind = 'A' and group_id % 3 <> 0").select("kind", "group_id").distinct()
    tested = F.col("group_id") % 5 == 0
    return groups.select("kind", "group_id", F.when(tested, "test").otherwise("development").alias("role"), F.when(~tested, F.col("group_id") % 4).cast("int").alias("fold"))


_ROLE_SQL = """, picked AS (SELECT DISTINCT kind, group_id, CASE WHEN group_id % 5 = 0 THEN 'test' ELSE 'development' END AS role, CASE WHEN group_id % 5 <> 0 THEN group_id % 4 END::INTEGER AS fold FROM items WHERE kind = 'A' AND group_id % 3 <> 0)"""


@query(b.ITEMS_SQL + _ROLE_SQL + """, g AS (SELECT group_id, count(*) AS n_discovered, count(*) FILTER (eligible) AS n_eligible, count(*) FILTER (NOT eligible) AS n_excluded, count(*) FILTER (NOT eligible) / count(*) AS excluded_ratio,
  coalesce(sum(n_annotations) FILTER (eligible) / nullif(count(*) FILTER (eligible), 0), 0) AS density, count(*) FILTER (eligible) = 0 AS emptied FROM ruled WHERE kind = 'A' GROUP BY 1)
SELECT g.*, role IS NOT NULL AS preserved, role, fold FROM g LEFT JOIN picked USING (group_id)""")
def preservation_audit(spark, sf):
    return reports.preservation(b.ruled_items(spark, sf).where("kind = 'A'"), _role_groups(spark, sf), ["group_id"])


@query(b.ITEMS_SQL + _ROLE_SQL + f""", chosen AS (SELECT *, eligible AND item_id % 3 <> 1 AS sel FROM ruled),
g AS (SELECT kind, group_id, role, fold, min(segment) AS segment, count(*) AS n_valid, count(*) FILTER (sel) AS n_selected, count(*) FILTER (sel AND facet = 'F') AS n_facet_f, count(*) FILTER (sel AND facet = 'O') AS n_facet_o,
  count(*) FILTER (sel AND facet = 'P') AS n_facet_p, coalesce(count(*) FILTER (sel AND n_annotations > 0) / nullif(count(*) FILTER (sel), 0), 0) AS positive_ratio,
  coalesce(sum(n_annotations) FILTER (sel) / nullif(count(*) FILTER (sel), 0), 0) AS density, coalesce(bool_or(n_first > 0) FILTER (sel), false) AS has_first, coalesce(bool_or(n_second > 0) FILTER (sel), false) AS has_second
  FROM chosen JOIN picked USING (kind, group_id) GROUP BY ALL)
SELECT *, CASE WHEN kind = 'A' THEN {b.RATE_BIN_SQL} END AS rate_bin FROM g""")
def selected_groups(spark, sf):
    items = b.ruled_items(spark, sf).withColumn("selected", F.col("eligible") & (F.col("item_id") % 3 != 1))
    return reports.selected_groups(items, _role_groups(spark, sf), ["kind", "group_id"], "segment", b.FACETS)


_DEVIATION_SQL = b.ITEMS_SQL + _ROLE_SQL + """, i AS (SELECT coalesce('fold_' || fold, role) AS split, role, n_annotations FROM ruled JOIN picked USING (kind, group_id) WHERE eligible),
d AS (SELECT count(*) AS n, sum(n_annotations) / count(*) AS density, count(*) FILTER (n_annotations > 0) / count(*) AS rate, count(DISTINCT split) AS k FROM i WHERE role = 'development'),
s AS (SELECT split, role, count(*) AS n_items, sum(n_annotations) / count(*) AS density, count(*) FILTER (n_annotations > 0) / count(*) AS positive_ratio FROM i GROUP BY 1, 2)"""


@query(_DEVIATION_SQL + """ SELECT split, n_items, s.density, s.density / d.density - 1 AS deviation, positive_ratio, positive_ratio - rate AS rate_gap, n_items / n - 1.0 / k AS share_gap FROM s, d WHERE role = 'development'""")
def replay_deviations(spark, sf):
    items = b.ruled_items(spark, sf).where("eligible").join(_role_groups(spark, sf), ["kind", "group_id"])
    return audit.fold_deviations(items, "role", "fold")


@query(_DEVIATION_SQL + """, w AS (SELECT max(abs(s.density / d.density - 1)) AS worst_deviation, max(abs(positive_ratio - rate)) AS rate_spread, max(abs(n_items / n - 1.0 / k)) AS share_spread FROM s, d WHERE role = 'development')
SELECT worst_deviation, CASE WHEN worst_deviation > 0.2 + 1e-12 THEN 'FAIL' ELSE 'PASS' END AS verdict, rate_spread, share_spread, t.density / d.density AS test_density_ratio, t.positive_ratio / d.rate AS test_rate_ratio FROM w, d, s t WHERE t.role = 'test'""")
def replay_summary(spark, sf):
    items = b.ruled_items(spark, sf).where("eligible").join(_role_groups(spark, sf), ["kind", "group_id"])
    return audit.deviation_summary(items, "role", "fold")


@query("""SELECT doc_id, CASE WHEN doc_id % 1000 = 7 THEN 'changed' ELSE 'removed' END AS change FROM documents WHERE doc_id % 1000 IN (7, 13)
UNION ALL SELECT doc_id + 1000000000, 'added' FROM documents WHERE doc_id % 1000 = 21""")
def recorded_changes(spark, sf):
    """Documents as recorded against those of today, with changed, removed and new ones, by digests of leaves."""
    docs, k = read_table(spark, sf, "documents"), F.col("doc_id") % 1000
    text = F.when(k == 7, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text"))
    new = docs.where(k == 21).withColumn("doc_id", F.col("doc_id") + 1_000_000_000)
    paths = [shared_path(spark, "recorded"), shared_path(spark, "today")]
    for table, path in zip((docs, docs.where(k != 13).withColumn("text", text).unionByName(new)), paths, strict=True):
        record_tree(table, ["doc_id"], path)
    return changed_keys(tree_difference(spark, *paths), ["doc_id"])
