"""One query per operator or family of operators, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records, rings, text
from ..operators import apportion, assign, audit, dedup, metrics, rules
from ..sources.tables import files_fingerprint, parse_json, raw_group_counts, read_table, settle
from . import bindings as b

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _resolved(spark: SparkSession, sf: str, group: str) -> DataFrame:
    return dedup.resolve_duplicates(b.documents_as_items(spark, sf), "content_hash", [group], "signature", ["doc_id"])


@query(b.DUP_SQL.format(group="source") + "SELECT doc_id, source, content_hash, n_copies, action, dup_group FROM resolved")
def dup_actions(spark, sf):
    return _resolved(spark, sf, "source").select("doc_id", "source", "content_hash", "n_copies", "action", "dup_group")


@query(b.DUP_SQL.format(group="lang") + "SELECT dup_group, content_hash, lang, doc_id, action FROM resolved WHERE n_copies > 1")
def dup_groups(spark, sf):
    return _resolved(spark, sf, "lang").where("n_copies > 1").select("dup_group", "content_hash", "lang", "doc_id", "action")


@query(b.DUP_SQL.format(group="lang") + "SELECT source, action, count(*) AS n_items FROM resolved GROUP BY ALL")
def discard_counts(spark, sf):
    return _resolved(spark, sf, "lang").groupBy("source", "action").agg(F.count(F.lit(1)).alias("n_items"))


@query(b.DUP_SQL.format(group="source") + """
SELECT *, cross_groups > 50 OR cross_items / n_items > 0.01 AS review FROM (
  SELECT count(DISTINCT dup_group) FILTER (action = 'cross_group') AS cross_groups, count(*) FILTER (action = 'cross_group') AS cross_items, count(*) AS n_items FROM resolved)""")
def dup_review(spark, sf):
    return dedup.review_duplicates(_resolved(spark, sf, "source"))


_METRICS = """count(*) AS n_items, count(*) FILTER (n_annotations > 0) AS n_positive, sum(n_annotations)::BIGINT AS n_annotations,
  count(*) FILTER (n_annotations > 0) / count(*) AS positive_ratio, sum(n_annotations) / count(*) AS density, count(*) FILTER (n_annotations = 0) / count(*) AS normal_ratio"""


@query(b.ITEMS_SQL + f"""SELECT kind, group_id, {_METRICS}, bool_or(n_first > 0) AS has_first, bool_or(n_second > 0) AS has_second,
  count(*) FILTER (facet = 'F') AS n_facet_f, count(*) FILTER (facet = 'O') AS n_facet_o, count(*) FILTER (facet = 'P') AS n_facet_p FROM items GROUP BY 1, 2""")
def item_metrics_by_group(spark, sf):
    return metrics.group_stats(b.orders_as_items(spark, sf), b.FACETS)


@query(b.ITEMS_SQL + f"SELECT {_METRICS} FROM items")
def metrics_overall(spark, sf):
    return metrics.core_metrics(b.orders_as_items(spark, sf), [])


@query(b.ITEMS_SQL + "SELECT kind, sum(n_items)::BIGINT AS n_items, sum(n_positive)::BIGINT AS n_positive, sum(n_positive) / sum(n_items) AS pooled_ratio FROM rated GROUP BY 1")
def pooled_rates(spark, sf):
    items = b.ruled_items(spark, sf).where("eligible")
    return metrics.pooled_ratio(metrics.core_metrics(items, ["kind", "group_id"]), ["kind"])


@query(b.ITEMS_SQL + "SELECT kind, group_id, count(*) AS n_files FROM items GROUP BY 1, 2")
def raw_counts(spark, sf):
    return raw_group_counts(b.orders_as_items(spark, sf))


@query(b.ITEMS_SQL + """SELECT region_id, segment, votes FROM (
  SELECT region_id, segment, count(*) AS votes, row_number() OVER (PARTITION BY region_id ORDER BY count(*) DESC, lower(segment), segment) AS k FROM items GROUP BY 1, 2) WHERE k = 1""")
def majority_segment(spark, sf):
    return metrics.majority(b.orders_as_items(spark, sf), ["region_id"], "segment")


@query(b.ITEMS_SQL + f""", binned AS (SELECT *, {b.AREA_BIN_SQL} AS area_bin FROM items)
SELECT group_id, CASE WHEN g = 3 THEN 'items' WHEN g = 1 THEN 'facet:' || facet WHEN g = 2 THEN 'area:' || area_bin ELSE 'joint:' || facet || '|' || area_bin END AS feature, n
FROM (SELECT group_id, facet, area_bin, grouping(group_id, facet, area_bin) AS g, count(*) AS n FROM binned
  GROUP BY GROUPING SETS ((group_id), (group_id, facet), (group_id, area_bin), (group_id, facet, area_bin)))""")
def feature_counts(spark, sf):
    return metrics.feature_counts(b.binned_items(spark, sf), "group_id", "facet", "area_bin")


@query(b.ITEMS_SQL + """SELECT kind, count(*) AS n_groups, avg(positive_ratio) AS mean_rate, median(positive_ratio) AS median_rate, min(positive_ratio) AS min_rate,
  max(positive_ratio) AS max_rate, count(*) FILTER (n_positive = 0) / count(*) AS zero_share, sum(n_positive) / sum(n_items) AS micro_rate FROM rated GROUP BY 1""")
def macro_micro_rates(spark, sf):
    return metrics.macro_rates(metrics.core_metrics(b.ruled_items(spark, sf).where("eligible"), ["kind", "group_id"]), ["kind"])


@query("""SELECT l_returnflag, count(*) AS n,
  list_sort(list(l_extendedprice))[round_even((count(*) - 1) * 0.05, 0)::BIGINT + 1] AS p05, list_sort(list(l_extendedprice))[round_even((count(*) - 1) * 0.5, 0)::BIGINT + 1] AS p50,
  list_sort(list(l_extendedprice))[round_even((count(*) - 1) * 0.95, 0)::BIGINT + 1] AS p95 FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY 1""")
def nearest_rank_percentiles(spark, sf):
    return metrics.nearest_rank(read_table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p05": 0.05, "p50": 0.5, "p95": 0.95})


@query(b.ITEMS_SQL + f"SELECT kind, {b.AREA_BIN_SQL} AS area_bin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY kind) AS share FROM items GROUP BY 1, 2")
def area_bins(spark, sf):
    return audit.distribution(b.binned_items(spark, sf), "kind", ["area_bin"])


@query(b.ITEMS_SQL + "SELECT rate_bin, count(*) AS n_groups FROM rated WHERE kind = 'A' GROUP BY 1")
def rate_bins(spark, sf):
    return b.rated_groups(spark, sf, "A").groupBy("rate_bin").agg(F.count(F.lit(1)).alias("n_groups"))



_BINS_SQL = """, ordered AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY positive_ratio, group_id::VARCHAR) - 1 AS i, count(*) OVER (PARTITION BY segment) AS n FROM rated WHERE kind = 'B'),
binned AS (SELECT *, least(4, floor(i * 5 / n))::INTEGER AS bin FROM ordered)"""


def _quintiled(spark, sf):
    return apportion.quantile_bins(b.rated_groups(spark, sf, "B"), ["segment"], [F.col("positive_ratio"), F.col("group_id").cast("string")], 5)


@query(b.ITEMS_SQL + _BINS_SQL + " SELECT group_id, segment, positive_ratio, bin FROM binned")
def quantile_bins(spark, sf):
    return _quintiled(spark, sf).select("group_id", "segment", "positive_ratio", "bin")


def quota_sql(source: str, key: str, seats: int | str, tag: str = "") -> str:
    """Largest remainder over counts of ``source`` (key, n), as one statement's CTEs, ending in quotas; ``tag`` ends their names."""
    return f""", shares{tag} AS (SELECT {key} AS key, n, n * {seats}::DOUBLE / sum(n) OVER () AS raw, least(floor(n * {seats}::DOUBLE / sum(n) OVER ()), n)::BIGINT AS fl FROM {source}),
seats{tag} AS (SELECT key, n, raw, unnest(range(fl + 1, n + 1)) AS seat FROM shares{tag}),
won{tag} AS (SELECT key, count(*) AS w FROM (
  SELECT key, row_number() OVER (ORDER BY raw - (seat - 1) DESC, n DESC, key) AS k FROM seats{tag}) WHERE k <= {seats} - (SELECT sum(fl) FROM shares{tag}) GROUP BY 1),
quotas{tag} AS (SELECT key, n, (fl + coalesce(w, 0))::BIGINT AS quota FROM shares{tag} LEFT JOIN won{tag} USING (key))"""


@query(b.ITEMS_SQL + ", counts AS (SELECT rate_bin, count(*) AS n FROM rated WHERE kind = 'A' GROUP BY 1)" + quota_sql("counts", "rate_bin", 47) + " SELECT key AS rate_bin, n, quota FROM quotas")
def largest_remainder_quota(spark, sf):
    counts = b.rated_groups(spark, sf, "A").groupBy("rate_bin").agg(F.count(F.lit(1)).alias("n"))
    return apportion.largest_remainder(counts.withColumn("cap", F.col("n")), 47, "rate_bin", "n", "cap")


@query(b.ITEMS_SQL + """, counted AS (SELECT *, n_annotations > 0 AS pos, count(*) OVER g AS n, count(*) FILTER (n_annotations > 0) OVER g AS np FROM items WINDOW g AS (PARTITION BY group_id)),
wanted AS (SELECT *, least(6, n) AS want, greatest(least(round_even(least(6, n) * np / n, 0)::BIGINT, np), least(6, n) - (n - np)) AS wp,
  row_number() OVER (PARTITION BY group_id, pos ORDER BY sha1('42|item:' || group_id || CASE WHEN pos THEN ':p' ELSE ':n' END || '|' || item_id), item_id) AS r FROM counted)
SELECT item_id, group_id, pos AS positive FROM wanted WHERE r <= CASE WHEN pos THEN wp ELSE want - wp END""")
def stratified_sample(spark, sf):
    items = b.orders_as_items(spark, sf).withColumn("positive", F.col("n_annotations") > 0)
    scope = F.concat(F.lit("item:"), F.col("group_id").cast("string"))
    return apportion.stratified_sample(items, ["group_id"], "item_id", F.col("positive"), 6, 42, scope).select("item_id", "group_id", "positive")


_STRATA = b.ITEMS_SQL + _BINS_SQL + ", strata AS (SELECT *, segment || '|' || has_first::VARCHAR || '|' || bin AS stratum FROM binned), sizes AS (SELECT stratum, count(*) AS n FROM strata GROUP BY 1)"
_PICK = 40


def _strata(spark, sf):
    return _quintiled(spark, sf).withColumn("stratum", F.concat_ws("|", "segment", F.col("has_first").cast("string"), F.col("bin").cast("string")))


def _quotas(groups: DataFrame, seats: int) -> DataFrame:
    counts = groups.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
    return apportion.largest_remainder(counts.withColumn("cap", F.col("n")), seats, "stratum", "n", "cap").select("stratum", "quota")


def _picked(spark, sf):
    groups = _strata(spark, sf)
    return apportion.nearest_to_mean(groups, _quotas(groups, _PICK), ["stratum"], "positive_ratio", "group_id", 42, "pick")


_PICK_SQL = _STRATA + quota_sql("sizes", "stratum", _PICK) + """, near AS (SELECT s.*, quota, round(abs(positive_ratio - avg(positive_ratio) OVER (PARTITION BY stratum)), 12) AS apart FROM strata s JOIN quotas ON stratum = key),
picked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY apart, sha1('42|pick|' || group_id), group_id) AS r FROM near) WHERE r <= quota)"""


@query(_PICK_SQL + " SELECT group_id, stratum, positive_ratio FROM picked")
def stratum_topk(spark, sf):
    return _picked(spark, sf).select("group_id", "stratum", "positive_ratio")


@query(_STRATA + """, q AS (SELECT stratum, (n / 10)::DOUBLE AS t, floor(n / 10)::BIGINT AS qt FROM sizes),
placed AS (SELECT s.group_id, s.stratum, qt, row_number() OVER (PARTITION BY stratum ORDER BY sha1('42|split|' || group_id), group_id) AS r FROM strata s JOIN q USING (stratum))
SELECT group_id, stratum, CASE WHEN r <= qt THEN 'test' WHEN r <= 2 * qt THEN 'val' ELSE 'train' END AS role FROM placed""")
def strata_split(spark, sf):
    groups = _strata(spark, sf)
    tenth = F.floor(F.count(F.lit(1)) / 10).cast("long")
    quotas = groups.groupBy("stratum").agg(tenth.alias("quota_test"), tenth.alias("quota_val"))
    return apportion.seeded_split(groups, quotas, ["stratum"], "group_id", 42, ["test", "val"], "train").select("group_id", "stratum", "role")


@query(_PICK_SQL + """, sides AS (
  SELECT 'all' AS side, group_id, n_items, n_positive, has_first FROM strata UNION ALL SELECT 'picked', group_id, n_items, n_positive, has_first FROM picked),
m AS (SELECT side, sum(n_positive) / sum(n_items) AS rate, avg(has_first::INTEGER) AS first_share FROM sides GROUP BY 1),
seg AS (SELECT max(abs(coalesce(x, 0) - coalesce(y, 0))) AS gap FROM (SELECT segment, count(*) / (SELECT count(*) FROM strata) AS x FROM strata GROUP BY 1) FULL JOIN
  (SELECT segment, count(*) / (SELECT count(*) FROM picked) AS y FROM picked GROUP BY 1) USING (segment))
SELECT round(p.rate - a.rate, 9) AS rate_gap, round(p.first_share - a.first_share, 9) AS first_gap, round(gap, 9) AS segment_gap,
  CASE WHEN abs(p.rate - a.rate) > 0.03 + 1e-12 OR abs(p.first_share - a.first_share) > 0.02 + 1e-12 OR gap > 0.02 + 1e-12 OR 1 - p.rate < 0.3 - 1e-12 THEN 'FAIL' ELSE 'PASS' END AS verdict
FROM m a, m p, seg WHERE a.side = 'all' AND p.side = 'picked'""")
def representativeness_gate(spark, sf):
    return audit.representativeness(_strata(spark, sf), _picked(spark, sf))


@query(b.ITEMS_SQL + f"""SELECT area_bin, sum(n)::BIGINT AS n_items, max(n) AS n_largest, max(n) / sum(n) AS share, max(n) / sum(n) >= 0.4 - 1e-12 AS review FROM (
  SELECT {b.AREA_BIN_SQL} AS area_bin, group_id % 5 AS fold, count(*) AS n FROM items GROUP BY 1, 2) GROUP BY 1""")
def bin_concentration(spark, sf):
    return audit.bin_concentration(b.binned_items(spark, sf).withColumn("fold", F.col("group_id") % 5), "fold", "area_bin")


@query(b.ITEMS_SQL + "SELECT item_id, i.kind, i.group_id, r.positive_ratio AS group_rate FROM items i LEFT JOIN rated r ON r.kind = i.kind AND r.group_id = i.group_id AND r.n_items >= 5")
def item_group_ratio(spark, sf):
    items = b.ruled_items(spark, sf)
    rates = metrics.core_metrics(items.where("eligible"), ["kind", "group_id"]).where("n_items >= 5")
    return metrics.with_group_ratio(items, rates, ["kind", "group_id"], "positive_ratio", "group_rate").select("item_id", "kind", "group_id", "group_rate")


@query(b.ITEMS_SQL + """, g AS (SELECT region_id, count(DISTINCT segment) AS s, count(*) AS raw, count(*) FILTER (eligible) AS kept FROM ruled GROUP BY 1),
lost AS (SELECT *, (raw - kept) / raw AS lost FROM g)
SELECT 'mixed_segments' AS code, region_id::VARCHAR AS subject, s::DOUBLE AS observed FROM lost WHERE s > 1
UNION ALL SELECT 'small_test_group', region_id::VARCHAR, kept::DOUBLE FROM lost WHERE region_id % 5 = 0 AND kept < 650
UNION ALL SELECT 'test_exclusion', region_id::VARCHAR, lost FROM lost WHERE region_id % 5 = 0 AND lost >= 0.001""")
def split_reviews(spark, sf):
    items = b.ruled_items(spark, sf).withColumn("role", F.when(F.col("region_id") % 5 == 0, "test"))
    return audit.split_reviews(items, "region_id", "role", "test", "segment", least_test=650, most_excluded=0.001)


_NAMES_SQL = """WITH names AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'CT_cell_pouch_' || lpad(p_partkey::VARCHAR, 6, '0') || '_' || substr('xyz', (p_partkey % 3 + 1)::INTEGER, 1) || '_0001.jpg'
  WHEN 1 THEN 'RGB_cell_prismatic_b_' || p_partkey || '_12.png' WHEN 2 THEN 'RGB_module_x_' || p_partkey || '_1.jpg' WHEN 3 THEN 'ct_CELL_pouch_a_' || p_partkey || '_X_7.png' ELSE 'CT_cell_' || p_partkey || '.jpg' END AS name FROM part),"""


def _names(spark, sf, whole=False):
    """File names of parts; ``whole`` keeps all digits of keys above 999,999, of which names of six digits hold the first six."""
    k, s = F.col("p_partkey"), F.col("p_partkey").cast("string")
    digits = F.lpad(s, F.greatest(F.length(s), F.lit(6)) if whole else 6, "0")
    axis = F.element_at(F.array(*map(F.lit, "xyz")), (k % 3 + 1).cast("int"))
    name = (
        F.when(k % 5 == 0, F.concat(F.lit("CT_cell_pouch_"), digits, F.lit("_"), axis, F.lit("_0001.jpg")))
        .when(k % 5 == 1, F.concat(F.lit("RGB_cell_prismatic_b_"), s, F.lit("_12.png")))
        .when(k % 5 == 2, F.concat(F.lit("RGB_module_x_"), s, F.lit("_1.jpg")))
        .when(k % 5 == 3, F.concat(F.lit("ct_CELL_pouch_a_"), s, F.lit("_X_7.png")))
        .otherwise(F.concat(F.lit("CT_cell_"), s, F.lit(".jpg")))
    )
    return read_table(spark, sf, "part").select("p_partkey", name.alias("name"))


@query(_NAMES_SQL + r""" parts AS (SELECT *, regexp_extract(regexp_replace(name, '\.[^.]*$', ''), '(?i)^ct_cell_(.+)_([0-9]+)_([xyz])_([^_]+)$', ['form', 'id', 'facet', 'frame']) AS a,
  regexp_extract(regexp_replace(name, '\.[^.]*$', ''), '(?i)^rgb_cell_(.+)_([0-9]+)_([^_]+)$', ['form', 'id', 'frame']) AS b FROM names)
SELECT p_partkey, CASE WHEN a.id <> '' THEN 'A' WHEN b.id <> '' THEN 'B' END AS kind, CASE WHEN a.id <> '' THEN coalesce(nullif(ltrim(a.id, '0'), ''), '0') WHEN b.id <> '' THEN coalesce(nullif(ltrim(b.id, '0'), ''), '0') END AS group_id,
  CASE WHEN a.id <> '' THEN lower(a.facet) END AS facet, CASE WHEN a.id <> '' THEN a.frame WHEN b.id <> '' THEN b.frame END AS frame,
  'K__' || regexp_replace(name, '\.[^.]*$', '') || '__' || substr(sha1('raw/' || name), 1, 8) AS item_id FROM parts""")
def name_grammar(spark, sf):
    parsed = _names(spark, sf).withColumn("p", text.parse_item_name("name"))
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    return parsed.select(
        "p_partkey", *[F.col(f"p.{c}").alias(c) for c in ("kind", "group_id", "facet", "frame")],
        text.item_id(F.lit("K"), stem, F.concat(F.lit("raw\\"), F.col("name"))).alias("item_id"),
    )


_TYPES = {"economy anodized steel": "steel", "standard polished brass": "brass", "promo burnished copper": "copper"}


@query("""SELECT p_partkey, lower(trim(regexp_replace(translate(p_type, '_-', '  '), '\\s+', ' ', 'g'))) AS token, CASE lower(p_type) WHEN 'economy anodized steel' THEN 'steel' WHEN 'standard polished brass' THEN 'brass'
  WHEN 'promo burnished copper' THEN 'copper' END AS class, CASE lower(p_brand) WHEN 'brand#11' THEN 'first' ELSE coalesce(nullif(trim(p_brand), ''), 'BLANK') END AS segment FROM part""")
def class_alias(spark, sf):
    return read_table(spark, sf, "part").select(
        "p_partkey", text.class_token("p_type").alias("token"), text.canonical("p_type", _TYPES).alias("class"), text.segment_alias("p_brand", {"brand#11": "first"}).alias("segment")
    )


def _payloads(spark, sf):
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    body = lambda uid, w: F.concat(F.lit('{"user":'), uid, F.lit(',"width":'), w, F.lit(',"props":'), F.col("props"), F.lit("}"))
    raw = (
        F.when(e % 11 == 0, F.lit("{broken"))
        .when(e % 11 == 1, F.lit("[1]"))
        .when(e % 11 == 2, body(F.lit('"x7"'), F.lit("10")))
        .when(e % 11 == 3, body(F.concat(F.lit('["0'), u, F.lit('"]')), F.lit("true")))
        .when(e % 11 == 4, body(F.lit("true"), F.lit("10")))
        .otherwise(body(u, F.lit("10")))
    )
    return read_table(spark, sf, "events").select("event_id", "user_id", parse_json(raw).alias("v"))


def _json_rules():
    return [
        ("json_parse_error", F.col("v").isNull()),
        ("group_id_mismatch", ~F.coalesce(F.col("gid") == F.col("user_id").cast("string"), F.lit(False))),
        ("size_missing", F.col("width").isNull()),
        ("props_missing", F.try_variant_get("v", "$.props.k", "int").isNull()),
    ]


def _checked(spark, sf):
    return _payloads(spark, sf).withColumns({"gid": rules.json_group_id(F.col("v"), "$.user"), "width": rules.strict_int(F.col("v"), "$.width")})


_JSON_SQL = """WITH c AS (SELECT event_id, event_id % 11 AS m, json_extract(props, '$.k') IS NULL AS nok FROM events),
f AS (SELECT event_id, CASE WHEN m <= 1 THEN ['json_parse_error', 'group_id_mismatch', 'size_missing', 'props_missing'] ELSE
  list_filter([CASE WHEN m IN (2, 4) THEN 'group_id_mismatch' END, CASE WHEN m = 3 THEN 'size_missing' END, CASE WHEN nok THEN 'props_missing' END], lambda x: x IS NOT NULL) END AS issues FROM c)"""


@query(_JSON_SQL + " SELECT event_id, issues[1] AS reason FROM f")
def json_rule_chain(spark, sf):
    return _checked(spark, sf).select("event_id", rules.first_failure(_json_rules()).alias("reason"))


@query(_JSON_SQL + " SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM f) GROUP BY 1")
def json_issues(spark, sf):
    return rules.issue_rows(_checked(spark, sf), ["event_id"], rules.all_failures(_json_rules())).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH l AS (SELECT unnest(CASE WHEN p_partkey % 7 = 0 THEN ['Training/A/' || p_partkey || '.png', 'Training/B/' || p_partkey || '.jpg'] ELSE ['Training/A/' || p_partkey || '.png'] END) AS path, p_partkey::VARCHAR AS stem FROM part WHERE p_partkey % 5 <> 0),
r AS (SELECT 'Training/L/' || p_partkey || '.json' AS path, p_partkey::VARCHAR AS stem FROM part WHERE p_partkey % 3 <> 0),
ls AS (SELECT stem, count(*) AS n, string_agg(path, '|' ORDER BY path) AS p FROM l GROUP BY 1), rs AS (SELECT stem, count(*) AS n, string_agg(path, '|' ORDER BY path) AS p FROM r GROUP BY 1)
SELECT 'training' AS split, coalesce(ls.stem, rs.stem) AS stem, coalesce(ls.n, 0) AS n_left, coalesce(rs.n, 0) AS n_right, ls.p AS left_paths, rs.p AS right_paths,
  CASE WHEN ls.n = 1 AND rs.n = 1 THEN 'paired' WHEN rs.n IS NULL THEN 'left_only' WHEN ls.n IS NULL THEN 'right_only' ELSE 'ambiguous' END AS status FROM ls FULL JOIN rs ON ls.stem = rs.stem""")
def pair_full_outer(spark, sf):
    part = read_table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("s"), F.col("p_partkey").alias("k"))
    one, two = F.concat(F.lit("Training/A/"), "s", F.lit(".png")), F.concat(F.lit("Training/B/"), "s", F.lit(".jpg"))
    left = part.where("k % 5 <> 0").select(F.explode(F.when(F.col("k") % 7 == 0, F.array(one, two)).otherwise(F.array(one))).alias("path"))
    right = part.where("k % 3 <> 0").select(F.concat(F.lit("Training/L/"), "s", F.lit(".json")).alias("path"))
    keyed = lambda d: d.withColumn("m", text.match_key(F.concat(F.lit("raw/"), "path"), "raw")).select("path", "m.*")
    return rules.pair_files(keyed(left), keyed(right), ["split", "stem"], "path")


@query(b.ITEMS_SQL + "SELECT item_id, kind, eligible, policy_reason FROM ruled")
def policy_eligibility(spark, sf):
    return b.ruled_items(spark, sf).select("item_id", "kind", "eligible", "policy_reason")


@query(b.ITEMS_SQL + """, own AS (SELECT kind, group_id, count(*) AS n_items, count(*) FILTER (n_annotations > 0) AS n_positive FROM ruled WHERE eligible AND n_annotations > 0 GROUP BY ALL)
SELECT i.kind, i.group_id, coalesce(n_items, 0) AS n_items, coalesce(n_positive, 0) AS n_positive, n_items IS NULL AS emptied FROM (SELECT DISTINCT kind, group_id FROM items) i LEFT JOIN own o ON o.kind = i.kind AND o.group_id = i.group_id""")
def group_preservation(spark, sf):
    items = b.ruled_items(spark, sf)
    stats = metrics.core_metrics(items.where("eligible and n_annotations > 0"), ["kind", "group_id"]).select("kind", "group_id", "n_items", "n_positive")
    return rules.preserve_groups(items.select("kind", "group_id").distinct(), stats, ["n_items", "n_positive"])


@query("""WITH i AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS s, source, sha1(text) AS content_hash FROM documents),
k AS (SELECT DISTINCT 'source' AS key, s, source AS v FROM i UNION ALL SELECT DISTINCT 'content_hash', s, content_hash FROM i),
g AS (SELECT * FROM (VALUES ('test', 'train'), ('test', 'val'), ('train', 'val')) t(left_split, right_split), (VALUES ('source'), ('content_hash')) u(key)),
n AS (SELECT l.key, l.s AS a, r.s AS b, count(*) AS n FROM k l JOIN k r ON l.key = r.key AND l.v = r.v AND l.s < r.s GROUP BY 1, 2, 3)
SELECT g.key, left_split, right_split, coalesce(n, 0)::BIGINT AS n_shared, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM g LEFT JOIN n ON n.key = g.key AND a = left_split AND b = right_split""")
def leakage_pairs(spark, sf):
    docs = read_table(spark, sf, "documents")
    role = F.when(F.col("doc_id") % 4 == 0, "test").when(F.col("doc_id") % 4 == 1, "val").otherwise("train")
    return audit.leakage(docs.select(role.alias("split"), "source", F.sha1("text").alias("content_hash")), "split", ["source", "content_hash"])


@query("SELECT l_suppkey, count(DISTINCT l_returnflag) AS n_roles FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def ids_in_several_roles(spark, sf):
    return audit.values_in_several(read_table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag")


@query(b.ITEMS_SQL + """, long AS (SELECT kind, 'first' AS class, n_first AS n FROM items UNION ALL SELECT kind, 'second', n_second FROM items)
SELECT kind, class, sum(n)::BIGINT AS n_annotations, count(*) FILTER (n > 0) AS n_items FROM long GROUP BY 1, 2
UNION ALL SELECT 'ALL', class, sum(n)::BIGINT, count(*) FILTER (n > 0) FROM long GROUP BY 2""")
def class_balance(spark, sf):
    return audit.class_balance(b.orders_as_items(spark, sf), "kind", {"first": "n_first", "second": "n_second"})


@query(b.ITEMS_SQL + """, t AS (SELECT kind, n_annotations AS f, CASE WHEN extent_sum <= 0.4 THEN n_first END AS s FROM items),
m AS (SELECT kind, count(f) AS n_first, count(s) AS n_second, count(*) FILTER (f > 0) AS pos_first, count(*) FILTER (s > 0) AS pos_second FROM t GROUP BY 1),
g AS (SELECT *, (n_first - n_second) / n_first AS loss, abs(pos_first / n_first - pos_second / n_second) AS ratio_gap FROM m)
SELECT *, CASE WHEN loss > 0.07 + 1e-12 OR ratio_gap > 0.03 + 1e-12 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM g""")
def task_comparison(spark, sf):
    items = b.orders_as_items(spark, sf).select("kind", F.col("n_annotations").alias("f"), F.when(F.col("extent_sum") <= 0.4, F.col("n_first")).alias("s"))
    return audit.compare_tasks(items, ["kind"], "f", "s")


@query(b.ITEMS_SQL + """, m AS (SELECT facet, count(*) FILTER (kind = 'A') AS "n_A", count(*) FILTER (kind = 'B') AS "n_B", count(*) FILTER (kind = 'A' AND n_annotations > 0) AS "pos_A", count(*) FILTER (kind = 'B' AND n_annotations > 0) AS "pos_B" FROM items GROUP BY 1),
r AS (SELECT *, "pos_A" / "n_A" AS "rate_A", "pos_B" / "n_B" AS "rate_B", abs("pos_A" / "n_A" - "pos_B" / "n_B") AS gap FROM m)
SELECT *, max(gap) OVER () AS max_gap, sum(gap) OVER () AS sum_gap FROM r""")
def facet_gaps(spark, sf):
    return audit.facet_gaps(b.orders_as_items(spark, sf), "kind", "facet", ("A", "B"))


@query(b.ITEMS_SQL + f"SELECT kind, facet, {b.AREA_BIN_SQL} AS area_bin, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY kind) AS share FROM items GROUP BY 1, 2, 3")
def axis_bin_distribution(spark, sf):
    return audit.distribution(b.binned_items(spark, sf), "kind", ["facet", "area_bin"])


@query(b.ITEMS_SQL + """SELECT *, share - 0.2 AS deviation, abs(share - 0.2) >= 0.05 - 1e-12 AS review FROM (
  SELECT group_id % 5 AS fold, count(DISTINCT group_id) AS n_groups, count(*) AS n_items, count(*) / sum(count(*)) OVER () AS share FROM items GROUP BY 1)""")
def fold_shares(spark, sf):
    return audit.fold_shares(b.orders_as_items(spark, sf).withColumn("fold", F.col("group_id") % 5), "fold", "group_id", 5)


@query(b.ITEMS_SQL + """, s AS (SELECT kind, segment, count(*) AS n_items, sum(n_annotations) / count(*) AS density FROM items GROUP BY 1, 2), k AS (SELECT kind, sum(n_annotations) / count(*) AS target FROM items GROUP BY 1)
SELECT kind, segment, n_items, density, target, (density - target) / target AS deviation, CASE WHEN abs((density - target) / target) > 0.2 + 1e-12 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM s JOIN k USING (kind)""")
def density_guard(spark, sf):
    return audit.density_guard(b.orders_as_items(spark, sf), "segment")


@query(b.ITEMS_SQL + """SELECT 'small_group' AS code, group_id::VARCHAR AS subject, n_items::DOUBLE AS observed, 'n_items < 5' AS threshold FROM rated WHERE n_items < 5
UNION ALL SELECT 'missing_class', group_id::VARCHAR, 0.0, 'n_first > 0' FROM rated WHERE NOT has_first
UNION ALL SELECT 'large_extent', item_id::VARCHAR, extent_sum, 'extent_sum >= 0.40' FROM ruled WHERE extent_sum >= 0.4""")
def gate_findings(spark, sf):
    items = b.ruled_items(spark, sf)
    groups = items.where("eligible").groupBy("group_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("n_first").alias("n_first"))
    small = audit.findings(groups, "small_group", F.col("n_items") < 5, F.col("group_id"), F.col("n_items"), "n_items < 5")
    missing = audit.findings(groups, "missing_class", F.col("n_first") == 0, F.col("group_id"), F.lit(0.0), "n_first > 0")
    large = audit.findings(items, "large_extent", F.col("extent_sum") >= 0.4, F.col("item_id"), F.col("extent_sum"), "extent_sum >= 0.40")
    return audit.sorted_findings(small, missing, large, small)


@query(b.ITEMS_SQL + """SELECT fold, CASE WHEN group_id % 5 = fold THEN 'val' ELSE 'train' END AS role, count(*) AS n_items, count(DISTINCT group_id) AS n_groups FROM items, range(5) t(fold) WHERE kind = 'A' GROUP BY 1, 2""")
def fold_membership(spark, sf):
    items = b.orders_as_items(spark, sf).where("kind = 'A'").withColumn("own", F.col("group_id") % 5)
    folds = items.withColumn("fold", F.explode(F.array(*[F.lit(k).cast("long") for k in range(5)])))
    role = F.when(F.col("own") == F.col("fold"), "val").otherwise("train")
    return folds.groupBy("fold", role.alias("role")).agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("group_id").alias("n_groups"))


@query(b.ITEMS_SQL + """SELECT i.item_id, CASE WHEN group_id % 5 = 0 THEN 'val' ELSE 'train' END AS role FROM items i WHERE kind = 'B' AND item_id IN (SELECT l_orderkey FROM marks)""")
def training_view(spark, sf):
    items = b.orders_as_items(spark, sf)
    labelled = items.where("n_annotations > 0").select("item_id")
    role = F.when(F.col("group_id") % 5 == 0, "val").otherwise("train")
    return items.where("kind = 'B'").join(labelled, "item_id", "left_semi").select("item_id", role.alias("role"))


@query(b.ITEMS_SQL + f"""SELECT item_id, kind, group_id, facet, segment, n_annotations, extent_sum, extent_max, eligible, CASE WHEN NOT eligible THEN policy_reason WHEN n_annotations = 0 AND group_id % 3 = 0 THEN 'group_cap' END AS reason,
  kind || '/' || CASE WHEN group_id % 5 = 0 THEN 'val' ELSE 'train' END AS destination FROM ruled""")
def manifest(spark, sf):
    items = b.ruled_items(spark, sf)
    reason = rules.first_failure([(b.POLICY_REASON, ~F.col("eligible")), ("group_cap", (F.col("n_annotations") == 0) & (F.col("group_id") % 3 == 0))])
    place = F.concat_ws("/", "kind", F.when(F.col("group_id") % 5 == 0, "val").otherwise("train"))
    return items.select(
        "item_id", "kind", "group_id", "facet", "segment", "n_annotations", "extent_sum", "extent_max", "eligible", reason.alias("reason"), place.alias("destination")
    )


_TWO_LEVEL = """WITH lines AS (SELECT DISTINCT substr(sha1(v), 1, 2) AS b, {line} AS l FROM {source}),
h AS (SELECT b, sha256(string_agg(l, chr(10) ORDER BY l)) AS h FROM lines GROUP BY 1) SELECT sha256(string_agg(b || ':' || h, chr(10) ORDER BY b)) AS {name} FROM h"""


@query(_TWO_LEVEL.format(line="v || chr(9) || n_chars || chr(9) || sha256(text)", source="(SELECT doc_id::VARCHAR AS v, n_chars, text FROM documents)", name="fingerprint"))
def fingerprint(spark, sf):
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("relative"), F.col("n_chars").alias("length"), F.sha2("text", 256).alias("sha256"))
    return files_fingerprint(docs)


@query(_TWO_LEVEL.format(line="v", source="(SELECT source || '/' || lang AS v FROM documents)", name="set_hash"))
def set_hash(spark, sf):
    return audit.value_set_hash(read_table(spark, sf, "documents").select(F.concat_ws("/", "source", "lang").alias("v")), "v")


@query(b.ITEMS_SQL + """SELECT group_id, sha256('{"code":"small_group","observed":' || n_items || ',"threshold":5}') AS finding_id FROM rated WHERE n_items < 5""")
def finding_ids(spark, sf):
    groups = b.ruled_items(spark, sf).where("eligible").groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    return groups.where("n < 5").select("group_id", text.finding_id(F.lit("small_group"), F.col("n"), F.lit(5)).alias("finding_id"))


@query("""WITH l AS (SELECT c_custkey AS id, c_mktsegment AS v FROM customer WHERE c_custkey % 10 <> 0), r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 11 <> 0)
SELECT coalesce(l.id, r.id) AS id, l.v AS recorded, r.v AS recomputed, CASE WHEN l.id IS NULL THEN 'added' WHEN r.id IS NULL THEN 'removed' ELSE 'changed' END AS change FROM l FULL JOIN r ON l.id = r.id
WHERE l.id IS NULL OR r.id IS NULL OR l.v IS DISTINCT FROM r.v""")
def mapping_diff(spark, sf):
    c = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("v"))
    return audit.mapping_diff(c.where("id % 10 <> 0"), c.where("id % 11 <> 0").withColumn("v", F.when(F.col("id") % 7 != 0, F.col("v"))), ["id"], "v")


@query("""SELECT o_orderkey, o_orderstatus, 'left' AS side FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_orderkey, o_orderstatus, 'right' FROM orders WHERE o_orderkey % 3 = 2""")
def set_equality(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return audit.set_difference(orders.where("o_orderkey % 3 <> 2"), orders.where("o_orderkey % 3 <> 0"))


def _region_groups(spark, sf) -> DataFrame:
    """Regions (nations of the customers) as groups of all eligible items, with rate bin and counts."""
    items = b.ruled_items(spark, sf).where("eligible").withColumn("area_bin", text.area_bin("extent_sum")).withColumn("group_id", F.col("region_id").cast("long"))
    features = assign.group_features(items, b.FACETS, list(text.AREA_BINS))
    return settle(features.withColumn("bin", text.rate_bin(F.col("f")[1] / F.col("f")[0])), "region-groups")


def _test_quotas(groups: DataFrame) -> DataFrame:
    """bin and quota of the test groups: FOLDS, and as many more as leave a multiple of FOLDS."""
    counts = groups.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).withColumn("cap", F.col("n"))
    return apportion.largest_remainder(counts, FOLDS + groups.count() % FOLDS, "bin", "n", "cap").select("bin", "quota")


def _test_ids(groups: DataFrame) -> list[int]:
    return assign.choose_test(groups, {r["bin"]: r["quota"] for r in _test_quotas(groups).collect()}, len(b.FACETS), 42)


@query()
def test_assignment(spark, sf):
    groups = _region_groups(spark, sf)
    return groups.select("group_id", "bin", F.when(F.col("group_id").isin(_test_ids(groups)), "test").otherwise("development").alias("role"))


FOLDS = 5
_REGION_SQL = b.ITEMS_SQL + f""", rates AS (SELECT region_id, count(*) FILTER (n_annotations > 0) / count(*) AS positive_ratio FROM ruled WHERE eligible GROUP BY 1),
f AS (SELECT {b.RATE_BIN_SQL} AS rate_bin, count(*) AS n FROM rates GROUP BY 1)"""
_N_TEST = f"(SELECT {FOLDS} + sum(n)::BIGINT % {FOLDS} FROM f)"


@query(_REGION_SQL + quota_sql("f", "rate_bin", _N_TEST) + " SELECT key AS bin, n AS n_groups, quota AS n_test FROM quotas")
def test_assignment_invariants(spark, sf):
    return test_assignment(spark, sf).groupBy("bin").agg(F.count(F.lit(1)).alias("n_groups"), F.count(F.when(F.col("role") == "test", 1)).alias("n_test"))


def _assigned(spark, sf) -> DataFrame:
    """group_id, bin, f, role, fold of all regions."""
    groups = _region_groups(spark, sf)
    ids = _test_ids(groups)
    development = groups.where(~F.col("group_id").isin(ids))
    folds = assign.choose_folds(development, FOLDS, len(b.FACETS), 42)
    named = development.join(folds, "group_id").select("group_id", "bin", "f", F.col("fold").cast("string").alias("split"))
    refined = assign.refine_density(named).select("group_id", "bin", "f", F.lit("development").alias("role"), F.col("split").cast("int").alias("fold"))
    return refined.unionByName(groups.where(F.col("group_id").isin(ids)).select("group_id", "bin", "f", F.lit("test").alias("role"), F.lit(None).cast("int").alias("fold")))


@query()
def fold_assignment(spark, sf):
    label = records.split_label(F.lit("A"), F.col("role"), F.col("fold"))
    return _assigned(spark, sf).select("group_id", label.alias("split"), F.col("f")[0].alias("n_items"), F.col("f")[2].alias("n_annotations"))


@query(_REGION_SQL + f""" SELECT 'A_fold_' || k AS split, (SELECT sum(n) - {_N_TEST} FROM f)::BIGINT // {FOLDS} AS n_groups, (SELECT sum(n) - {_N_TEST} FROM f)::BIGINT // {FOLDS} AS n_distinct FROM range({FOLDS}) t(k)
UNION ALL SELECT 'A_test', {_N_TEST}, {_N_TEST}""")
def fold_invariants(spark, sf):
    return fold_assignment(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_groups"), F.count_distinct("group_id").alias("n_distinct"))


def _rectangles(spark, sf) -> DataFrame:
    x, y = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double") * 10
    w, h = F.rint(F.col("l_discount") * 100) * 3, F.rint(F.col("l_tax") * 100) * 3
    ring = F.array(rings.point(x, y), rings.point(x + w, y), rings.point(x + w, y + h), rings.point(x, y + h))
    frame = F.lit(50.0)
    lines = read_table(spark, sf, "lineitem").select("l_linenumber", "l_quantity", ring.alias("ring"))
    return rings.clip_to_frame(lines, "ring", frame, frame, "clipped")


@query("""SELECT l_linenumber, count(*) AS n, round(sum(greatest(0, least(l_quantity + round(l_discount * 100) * 3, 50) - l_quantity) * greatest(0, least(l_linenumber * 10 + round(l_tax * 100) * 3, 50) - l_linenumber * 10)), 3)::DOUBLE AS area
FROM lineitem GROUP BY 1""")
def ring_clip_area(spark, sf):
    clipped = _rectangles(spark, sf).withColumn("a", rings.area(F.col("clipped")))
    return clipped.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("a"), 3).alias("area"))


def _star_rings(spark, sf) -> DataFrame:
    """Vectors as rings that cross themselves and their frame, with their parts."""
    frame = F.lit(100.0)
    flat = F.transform("embedding", lambda v: v.cast("double") * 150 + 50)
    docs = read_table(spark, sf, "embeddings").select("vec_id", flat.alias("flat")).withColumn("ring", rings.cleaned(rings.ring_of_flat(F.col("flat"))))
    cut = docs.withColumn("cut", rings.parts_in_frame(F.col("ring"), frame, frame))
    return cut.withColumn("left", F.flatten("cut.parts"))


@query()
def ring_boxes(spark, sf):
    """Bounds of all parts of a ring, and a digest of its outline before."""
    frame = F.lit(100.0)
    bounds = rings.bounds(F.col("left"))
    box, ratio = rings.box(bounds, frame, frame), rings.rounded_box_ratio(bounds, frame, frame)
    digest = F.sha1(F.to_json(rings.canonical_ring(F.col("ring"))))
    return _star_rings(spark, sf).select("vec_id", box.alias("b"), ratio.alias("box_ratio"), digest.alias("outline")).select("vec_id", "b.*", "box_ratio", "outline")


@query()
def ring_issues(spark, sf):
    frame = F.lit(100.0)
    codes = rings.ring_issues(F.col("flat"), F.col("cut"), frame, frame)
    return _star_rings(spark, sf).select(F.explode(codes).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT count(*) AS n, count(*) AS n_boxes_in_frame, count(*) AS n_ratios_of_boxes, count(DISTINCT embedding) AS n_outlines FROM embeddings""")
def ring_invariants(spark, sf):
    """Boxes lie in the frame, rounded ratios are those of the boxes, and equal outlines are equal rings."""
    b_ = ring_boxes(spark, sf)
    inside = (F.col("cx") - F.col("w") / 2 >= -1e-9) & (F.col("cx") + F.col("w") / 2 <= 1 + 1e-9) & (F.col("cy") - F.col("h") / 2 >= -1e-9) & (F.col("cy") + F.col("h") / 2 <= 1 + 1e-9)
    return b_.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(inside, 1)).alias("n_boxes_in_frame"),
        F.count(F.when(F.abs(F.col("box_ratio") - F.col("w") * F.col("h")) < 1e-6, 1)).alias("n_ratios_of_boxes"), F.count_distinct("outline").alias("n_outlines"),
    )
