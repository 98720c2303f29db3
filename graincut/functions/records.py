"""Annotation records in VARIANT payloads, as columns: typed fields and rule chains.

A payload is an object with objects ``data_info`` and ``image_info`` and a list
``defects`` of objects (name, points). Wrong types never raise: a field of
another type is absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CLASS_ALIASES, IGNORED_CLASSES, canonical_class, class_token

DEFECT = "struct<name:string,points:string>"
# Data types that stand for kind B.
KIND_B_TYPES = ("rgb", "ext", "exterior")


def variant_kind(value: Column, path: str) -> Column:
    """Type name of what is at ``path``, NULL if nothing is there; a JSON null is VOID."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def typed(value: Column, path: str, kind: str, cast: str) -> Column:
    """The value at ``path`` if it has the JSON type ``kind``, without casts between types."""
    return F.when(variant_kind(value, path) == kind, F.try_variant_get(value, path, cast))


def normal_flag(value: Column) -> tuple[Column, Column]:
    """(type name, True or False if boolean): the first of image_info, root and data_info
    that holds the key ``is_normal``."""
    paths = ("$.image_info.is_normal", "$.is_normal", "$.data_info.is_normal")
    kind = F.coalesce(*[variant_kind(value, p) for p in paths])
    at = F.coalesce(*[F.try_variant_get(value, p, "variant") for p in paths])
    return kind, F.when(kind == "BOOLEAN", F.try_variant_get(at, "$", "boolean"))


def defects(value: Column) -> Column:
    """Array of (name, points as JSON); list members that are no objects are dropped."""
    members = F.coalesce(F.try_variant_get(value, "$.defects", "array<variant>"), F.array().cast("array<variant>"))
    objects = F.filter(members, lambda d: F.schema_of_variant(d).startswith("OBJECT"))
    one = lambda d: F.struct(F.try_variant_get(d, "$.name", "string").alias("name"), F.to_json(F.try_variant_get(d, "$.points", "variant")).alias("points"))
    return F.transform(objects, one)


def without_repeats(found: Column) -> Column:
    """Defects of one record without later ones of equal name and points."""
    return F.array_distinct(found)


def targets(found: Column, kind: Column) -> Column:
    """Defects with their class, outlines left out; class is NULL where the name is unknown."""
    seen = F.filter(found, lambda d: ~F.coalesce(class_token(d["name"]).isin(*IGNORED_CLASSES), F.lit(False)))
    return F.transform(seen, lambda d: F.struct(canonical_class(d["name"], kind).alias("class"), d["name"].alias("name"), d["points"].alias("points")))


def unknown_classes(found: Column) -> Column:
    """Distinct raw names of targets whose class is not known, in their first order; a missing name is empty."""
    return F.array_distinct(F.transform(F.filter(found, lambda t: t["class"].isNull()), lambda t: F.coalesce(t["name"], F.lit(""))))


def record_fields(payload: Column) -> dict[str, Column]:
    """Columns that the rules read, by name, from one payload."""
    is_kind, is_normal = normal_flag(payload)
    data_type = F.lower(F.trim(typed(payload, "$.data_info.data_type", "STRING", "string")))
    roi_kind = variant_kind(payload, "$.data_info.roi")
    pair = F.when(
        (roi_kind == "ARRAY<BIGINT>") & F.try_variant_get(payload, "$.data_info.roi[2]", "variant").isNull(),
        F.try_variant_get(payload, "$.data_info.roi", "array<bigint>"),
    )
    return {
        "json_kind": F.when(data_type == "ct", "A").when(data_type.isin(*KIND_B_TYPES), "B"),
        "json_file": typed(payload, "$.image_info.file_name", "STRING", "string"),
        "json_width": typed(payload, "$.image_info.width", "BIGINT", "int"),
        "json_height": typed(payload, "$.image_info.height", "BIGINT", "int"),
        "roi_given": roi_kind.isNotNull() & (roi_kind != "VOID"),
        "roi": F.when(F.size(pair) == 2, pair),
        "normal_type": is_kind,
        "is_normal": is_normal,
        "defects": defects(payload),
    }


def record_rules() -> list[tuple[str, Column]]:
    """The chain, first failure wins. Columns: parsed (struct of the file name, NULL if
    unparsed), payload, json_group_id, stem, width and height of the decoded picture (NULL:
    corrupt), those of record_fields, and targets."""
    c = F.col
    no = lambda x: ~F.coalesce(x, F.lit(False))
    json_stem = F.regexp_replace(F.substring_index(c("json_file"), "/", -1), r"\.[^.]*$", "")
    in_frame = (c("roi")[0] > 0) & (c("roi")[0] <= c("width")) & (c("roi")[1] > 0) & (c("roi")[1] <= c("height"))
    ruled = c("parsed.kind") == "A"
    return [
        ("filename_parse_error", c("parsed").isNull()),
        ("json_parse_error", c("payload").isNull()),
        ("group_id_mismatch", no(c("json_group_id") == c("parsed.group_id"))),
        ("kind_mismatch", c("json_kind") != c("parsed.kind")),
        ("file_name_mismatch", no(json_stem == c("stem"))),
        ("corrupt_image", c("width").isNull() | c("height").isNull()),
        ("image_size_mismatch", no((c("json_width") == c("width")) & (c("json_height") == c("height")))),
        ("missing_roi", ruled & ~c("roi_given")),
        ("invalid_roi", ruled & no(in_frame)),
        ("undefined_class", F.exists("targets", lambda t: t["class"].isNull())),
        ("no_target_and_not_explicit_normal", (F.size("targets") == 0) & no(c("is_normal"))),
    ]


def record_anomalies() -> list[tuple[str, Column]]:
    """Codes beside the chain that exclude nothing; all that hold are given."""
    return [
        ("duplicate_annotation", F.size(without_repeats(F.col("defects"))) < F.size("defects")),
        ("is_normal_type", ~F.coalesce(F.col("normal_type") == "BOOLEAN", F.lit(False))),
        ("normal_with_target", F.coalesce(F.col("is_normal"), F.lit(False)) & (F.size("targets") > 0)),
    ]


def class_id(name: Column, kind: Column) -> Column:
    """Number of a class among the classes of its kind, in their listed order."""
    chain = F.lit(None).cast("int")
    for k in sorted({k for k, _ in CLASS_ALIASES}):
        for number, known in enumerate(dict.fromkeys(v for (own, _), v in CLASS_ALIASES.items() if own == k)):
            chain = F.when((kind == k) & (name == known), number).otherwise(chain)
    return chain


def split_label(kind: Column, role: Column, fold: Column, merged: bool = False) -> Column:
    """A group's split: kind_test, kind_fold_k or kind_role; ``merged`` reports folds as development."""
    folded = F.lit("development") if merged else F.concat(F.lit("fold_"), fold.cast("string"))
    return F.concat_ws("_", kind, F.when(role == "development", folded).otherwise(role))


def stratum_text(*parts: Column) -> Column:
    """A stratum as JSON text, for ties; booleans are cast to integers first."""
    return F.to_json(F.array(*[p.cast("string") for p in parts]), {"ignoreNullFields": "false"})
