"""Scalar functions on names, tokens, ids and numbers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and their aliases by kind, outlines (never a class).
CLASS_ALIASES = {
    ("A", "porosity"): "Porosity",
    ("B", "damaged"): "Damaged",
    ("B", "damage"): "Damaged",
    ("B", "pollution"): "Pollution",
    ("B", "contamination"): "Pollution",
}
IGNORED_CLASSES = ("outline",)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)``, the value computed once: generators and lambdas compute an expression anew wherever it stands."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_item_name(name: Column | str) -> Column:
    """struct(kind, group_id, facet, form, frame) of a file name, NULL if it does not parse.

    A: ``CT_cell_<form...>_<digits>_<x|y|z>_<frame>``, B: ``RGB_cell_<form...>_<digits>_<frame>``,
    letters of either case; names with ``_module_`` never parse.
    """
    stem = F.regexp_replace(_col(name), r"\.[^.]*$", "")
    facetted = r"(?i)^ct_cell_(.+)_([0-9]+)_([xyz])_([^_]+)$"
    plain = r"(?i)^rgb_cell_(.+)_([0-9]+)_([^_]+)$"

    def part(pattern: str, k: int) -> Column:
        return F.regexp_extract(stem, pattern, k)

    none = F.lit(None).cast("string")
    a = F.struct(
        F.lit("A").alias("kind"), strip_zeros(part(facetted, 2)).alias("group_id"), F.lower(part(facetted, 3)).alias("facet"),
        F.lower(part(facetted, 1)).alias("form"), part(facetted, 4).alias("frame"),
    )
    b = F.struct(
        F.lit("B").alias("kind"), strip_zeros(part(plain, 2)).alias("group_id"), none.alias("facet"),
        F.lower(part(plain, 1)).alias("form"), part(plain, 3).alias("frame"),
    )
    allowed = ~F.lower(stem).contains("_module_")
    return F.when(allowed & stem.rlike(facetted), a).when(allowed & stem.rlike(plain), b)


def strip_zeros(value: Column | str) -> Column:
    """Digits without leading zeros; NULL for anything but ASCII digits."""
    v = _col(value)
    return F.when(v.rlike("^[0-9]+$"), F.regexp_replace(v, "^0+(?=.)", ""))


def natural_key(value: Column | str) -> Column:
    """Sort key: ids of digits first, by value; others after, case-insensitively."""
    v = _col(value)
    digits = v.rlike("^[0-9]+$")
    number = F.when(digits, F.length(F.regexp_replace(v, "^0+(?=.)", "")))
    return F.struct(
        F.when(digits, 0).otherwise(1).alias("other"),
        number.alias("magnitude"),
        F.when(digits, F.regexp_replace(v, "^0+(?=.)", "")).alias("digits"),
        F.lower(v).alias("folded"),
        v.alias("raw"),
    )


def order_key(seed: str | int, scope: Column | str, item: Column | str) -> Column:
    """Seeded pseudo-random key, the same on any cluster: SHA-1 of seed|scope|item."""
    scope = F.lit(scope) if isinstance(scope, str) else scope
    return F.sha1(F.concat_ws("|", F.lit(str(seed)), scope.cast("string"), _col(item).cast("string")))


def item_id(kind: Column | str, stem: Column | str, path: Column | str) -> Column:
    """KIND__stem__ and 8 hex digits of the path's SHA-1, back slashes as slashes."""
    digest = F.substring(F.sha1(F.translate(_col(path), "\\", "/")), 1, 8)
    return F.concat_ws("__", _col(kind), _col(stem), digest)


def class_token(value: Column | str) -> Column:
    """Lower case, with underscores, hyphens and runs of space as one space."""
    return F.lower(F.trim(F.regexp_replace(F.translate(_col(value), "_-", "  "), r"\s+", " ")))


def alias_map(aliases: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])


def canonical(value: Column | str, aliases: dict[str, str]) -> Column:
    """The alias's target by normalized token, else NULL."""
    return F.try_element_at(alias_map(aliases), class_token(value))


def canonical_class(raw: Column | str, kind: Column | str) -> Column:
    """Class by kind and token; NULL if unknown."""
    table = {f"{k}|{token}": name for (k, token), name in CLASS_ALIASES.items()}
    return F.try_element_at(alias_map(table), F.concat_ws("|", _col(kind), class_token(raw)))


def segment_alias(raw: Column | str, aliases: dict[str, str], blank: str = "BLANK") -> Column:
    """The alias's target, else the trimmed value itself, else ``blank``."""
    return F.coalesce(canonical(raw, aliases), F.nullif(F.trim(_col(raw)), F.lit("")), F.lit(blank))


def fixed8(value: Column | str) -> Column:
    """Text with 8 decimals, without grouping."""
    return F.translate(F.format_number(_col(value), 8), ",", "")


def fixed8_unit(value: Column | str) -> Column:
    """Text with 8 decimals, clamped to [0, 1]."""
    return fixed8(F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(value))))


def match_key(path: Column | str, marker: str) -> Column:
    """struct(split, stem): the first part named training or validation after ``marker``,
    and the file's stem, both in lower case; NULL without the marker or a split."""
    parts = F.split(F.lower(_col(path)), "/")
    after = F.slice(parts, F.array_position(parts, F.lit(marker.lower())).cast("int") + 1, F.size(parts))
    split = F.try_element_at(F.filter(after, lambda p: p.isin("training", "validation")), F.lit(1))
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    found = F.array_contains(parts, marker.lower()) & split.isNotNull()
    return F.when(found, F.struct(split.alias("split"), stem.alias("stem")))


def finding_id(code: Column | str, observed: Column | str, threshold: Column | str) -> Column:
    """SHA-256 of the finding as JSON: the same finding has the same id in every run."""
    return F.sha2(F.to_json(F.struct(_col(code).alias("code"), _col(observed).alias("observed"), _col(threshold).alias("threshold"))), 256)


def area_bin(value: Column | str) -> Column:
    """One of nine half-open bins of an area share; negative and non-finite values are errors."""
    v = _col(value)
    # Lower edges of the bins and their names.
    edges = (
        (0.50, "ge_50pct"), (0.40, "40_50pct"), (0.25, "25_40pct"), (0.10, "10_25pct"),
        (0.05, "5_10pct"), (0.01, "1_5pct"), (0.001, "0.1_1pct"),
    )
    bad = F.isnan(v) | (v < 0) | (v == F.lit(float("inf")))
    chain = F.when(bad, F.raise_error(F.lit("area share must be finite and not negative")).cast("string")).when(v == 0, "zero")
    for edge, name in edges:
        chain = chain.when(v >= edge, name)
    return F.when(v.isNotNull(), chain.otherwise("lt_0.1pct"))


def rate_bin(value: Column | str, eps: float = 1e-12) -> Column:
    """One of five bins of a positive rate in [0, 1], every edge with a small tolerance."""
    v = _col(value)
    bad = F.isnan(v) | (v < -eps) | (v > 1 + eps)
    return F.when(
        v.isNotNull(),
        F.when(bad, F.raise_error(F.lit("rate out of range")).cast("string"))
        .when(v <= eps, "zero")
        .when(v < 0.01 - eps, "very_low")
        .when(v < 0.30 - eps, "low_mid")
        .when(v < 0.60 - eps, "mid_high")
        .otherwise("very_high"),
    )


#: Names of the rate bins in order.
RATE_BINS = ("zero", "very_low", "low_mid", "mid_high", "very_high")
AREA_BINS = ("zero", "lt_0.1pct", "0.1_1pct", "1_5pct", "5_10pct", "10_25pct", "25_40pct", "40_50pct", "ge_50pct")
