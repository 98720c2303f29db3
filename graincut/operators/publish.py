"""Sinks: manifest, label text, membership, training views, checks of what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import RATE_BINS, area_bin, fixed8_unit, natural_key
from .metrics import share


def box_text(class_id: Column, box: Column) -> Column:
    """One label line: class and centre, width, height with 8 decimals."""
    return F.concat_ws(" ", class_id.cast("string"), *[fixed8_unit(box[c]) for c in ("cx", "cy", "w", "h")])


def ring_text(class_id: Column, ring: Column) -> Column:
    """One label line: class and normalized vertices x y."""
    points = F.transform(ring, lambda p: F.concat_ws(" ", fixed8_unit(p["x"]), fixed8_unit(p["y"])))
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(points, " "))


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One table by partition folders; refuses to overwrite."""
    df.write.mode("errorifexists").partitionBy(*by).parquet(path)


def write_report(df: DataFrame, path: str, order: list) -> None:
    """A report of any size as ordered CSV files, each with a header; refuses to overwrite.

    Rows are sorted by ranges of ``order``: the files, in the order of their numbers, hold the whole order, and no
    task more than its range. A small report is one file.
    """
    df.orderBy(*order).write.mode("errorifexists").csv(path, header=True)


# Leading columns of each report's order. Every order ends with all columns as text.
REPORT_ORDERS = {
    "manifest": ("item_id",),
    "issues": ("item_id", "issue"),
    "variants": ("item_id", "raw_class"),
    "pairs": ("path", "reason"),
    "corrupt": ("path", "error"),
    "duplicates": ("dup_group", "item_id"),
    "leakage": ("left_split", "right_split"),
}


def report_order(report: str, columns: list[str]) -> list[Column]:
    """Order of a report's rows: groups by kind and natural id, rate bins by scope (overall, folds,
    test) and bin, the reports of REPORT_ORDERS by those columns, others by all columns.

    Columns that a report lacks, and NULLs, count as empty text; paths are compared with slashes.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in columns else F.lit("")
    if report == "groups":
        first = [text("kind"), natural_key(text("group_id"))]
    elif report == "rate_bins":
        rank = F.when(text("scope") == "overall", 0).when(text("scope") == "test", 2).otherwise(1)
        first = [rank, text("scope"), F.array_position(F.array(*map(F.lit, RATE_BINS)), text("bin"))]
    else:
        first = [F.translate(text(c), "\\", "/") if c == "path" else text(c) for c in REPORT_ORDERS.get(report, ())]
    return [*first, *map(text, columns)]


def manifest(items: DataFrame, groups: DataFrame, classes: dict[str, str], tasks: tuple[str, ...] = ("box", "ring")) -> DataFrame:
    """One row per scanned item with its assignment, verdict and measures; no item is left out.

    ``items``: item_id, path, kind, group_id, facet, segment, eligible, policy_reason, sampled, and
    included_<task> and reason_<task> from the scan, extents, and the count columns of ``classes``
    (name -> column). ``groups``: kind, group_id, role, fold of assigned groups, unique.

    included_<task> then holds only for items of assigned groups that policy and sampling keep; the
    reason is the policy's, group_not_picked or sampling_cap, else the scan's. group_rate is the
    share of positive items among the group's eligible ones with boxes, 0 without any. Extents, bin
    and stratum are kind A's alone. NULL flags count as false (a NULL eligible
    leaves the scan's reason), and items without a group as not picked.
    """
    key = ["kind", "group_id"]
    true = lambda c: F.coalesce(F.col(c), F.lit(False))
    counted = true("eligible") & true(f"included_{tasks[0]}")
    rates = items.where(counted).groupBy(*key).agg(share(F.count(F.when(F.col("n_annotations") > 0, 1)), F.count(F.lit(1))).alias("group_rate"))
    df = items.drop("role", "fold", "group_rate").join(groups.select(*key, "role", "fold"), key, "left").join(rates, key, "left")
    known, selected = F.col("role").isNotNull(), true("eligible") & true("sampled") & F.col("role").isNotNull()
    is_a = F.coalesce(F.col("kind") == "A", F.lit(False))
    suffix = F.when(is_a, ".jpg").otherwise(F.lower(F.regexp_extract("path", r"(\.[^./\\]*)$", 1)))
    why = lambda t: (
        F.when(~F.col("eligible"), F.col("policy_reason"))
        .when(true(f"included_{t}") & ~selected, F.when(known, "sampling_cap").otherwise("group_not_picked"))
        .otherwise(F.col(f"reason_{t}"))
    )
    measures = {"extent_sum": F.col("extent_sum"), "extent_max": F.col("extent_max"), "area_bin": area_bin("extent_sum")}
    measures["stratum"] = F.concat_ws("|", F.coalesce("facet", F.lit("")), measures["area_bin"])
    derived = {
        **{f"included_{t}": true(f"included_{t}") & selected for t in tasks},
        **{f"reason_{t}": why(t) for t in tasks},
        **{name: F.when(is_a, value) for name, value in measures.items()},
        **{f"has_{name}": F.coalesce(F.col(c) > 0, F.lit(False)) for name, c in classes.items()},
        "selected": selected,
        "group_rate": F.coalesce("group_rate", F.lit(0.0)),
        "output_name": F.concat(F.col("item_id").cast("string"), F.coalesce(suffix, F.lit(""))),
        "destination": F.when(selected, F.concat_ws("/", "kind", F.when(F.col("role") == "test", "test").otherwise("trainval"))),
    }
    return df.withColumns(derived)


def memberships(items: DataFrame, fold: str, folds: int) -> DataFrame:
    """Every item once per fold number, val in its own fold and train in the others."""
    each = items.withColumn("view", F.explode(F.array(*map(F.lit, range(folds)))))
    return each.withColumn("role", F.when(F.col(fold) == F.col("view"), "val").otherwise("train"))


def label_issues(lines: Column, n_classes: int, fields: int | None = None) -> Column:
    """Codes of faults of written label lines: field count, class id, coordinates.

    ``fields`` is the count per line; None stands for rings: odd and at least 7.
    """
    parts = F.transform(lines, lambda x: F.split(x, " "))
    ok_size = (lambda p: F.size(p) == fields) if fields else (lambda p: (F.size(p) >= 7) & (F.size(p) % 2 == 1))
    ok_class = lambda p: F.coalesce(p[0].try_cast("int").between(0, n_classes - 1), F.lit(False))
    ok_unit = lambda p: F.forall(F.slice(p, 2, F.size(p)), lambda v: F.coalesce(v.try_cast("double").between(0, 1), F.lit(False)))
    checks = [("field_count", ok_size), ("class_id", ok_class), ("coordinate", ok_unit)]
    return F.array_compact(F.array(*[F.when(~F.forall(parts, check), code) for code, check in checks]))


def label_faults(lines: Column, is_normal: Column, n_classes: int, fields: int | None = None) -> Column:
    """label_issues, and normal_not_empty or defect_empty where the lines belie the item's flag; NULL lines are empty."""
    none = F.coalesce(F.size(lines) == 0, F.lit(True))
    belied = F.array_compact(F.array(F.when(is_normal & ~none, "normal_not_empty"), F.when(~is_normal & none, "defect_empty")))
    return F.concat(F.coalesce(label_issues(lines, n_classes, fields), F.array().cast("array<string>")), belied)


def training_view(items: DataFrame, labels: DataFrame, images: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(view, missing): items with a label, and those of them whose image is missing. See view_rows for the choice of items."""
    # Semi and anti joins take repeated keys as they are: a step that drops them would only hold them in memory.
    labelled = items.join(labels.select(key), key, "left_semi")
    return labelled.join(images.select(key), key, "left_semi"), labelled.join(images.select(key), key, "left_anti")


def view_rows(items: DataFrame, kind: str, task: str, fold: int | None = None, include_test: bool = False) -> DataFrame:
    """Items of a kind that a task includes (column included_<task>), with role train, val or test.

    With ``fold``, development items are val in that fold and train in the others; without, their
    own role counts. Test items come only with ``include_test``; items without a role never.
    """
    own = items.where((F.col("kind") == kind) & F.col(f"included_{task}"))
    role = F.when(F.col("role") == "test", F.lit("test") if include_test else F.lit(None))
    if fold is None:
        role = role.when(F.col("role").isin("train", "val"), F.col("role"))
    else:
        role = role.when(F.col("role") == "development", F.when(F.col("fold") == fold, "val").otherwise("train"))
    return own.withColumn("role", role).where(F.col("role").isNotNull())


def copies_differ(source: DataFrame, sink: DataFrame, key: str, digest: str) -> DataFrame:
    """Keys whose digest at the sink is missing or not the source's."""
    s, t = source.select(key, F.col(digest).alias("expected")), sink.select(key, F.col(digest).alias("found"))
    return s.join(t, key, "left").where(~F.col("expected").eqNullSafe(F.col("found")))
