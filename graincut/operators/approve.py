"""Approval of a selection by fingerprints, and the check of it before publishing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit import value_set_hash

AUDIT_FIELDS = ("approver", "approved_at", "reason")


def exception_faults(findings: DataFrame, exceptions: DataFrame) -> DataFrame:
    """(finding_id, fault) of exceptions that don't cover the findings: missing, unknown,
    changed, not approved, or without audit fields; empty if all is well.

    Both have finding_id, code, observed, threshold; exceptions also status and AUDIT_FIELDS.
    """
    f = findings.select("finding_id", F.struct("code", "observed", "threshold").alias("f"))
    e = exceptions.select("finding_id", F.struct("code", "observed", "threshold").alias("e"), "status", *AUDIT_FIELDS)
    blank = reduce(lambda a, b: a | b, [F.coalesce(F.trim(c), F.lit("")) == "" for c in AUDIT_FIELDS])
    fault = (
        F.when(F.col("e").isNull(), "missing")
        .when(F.col("f").isNull(), "unknown")
        .when(~F.col("f").eqNullSafe(F.col("e")), "changed")
        .when(~F.coalesce(F.col("status") == "approved", F.lit(False)), "not_approved")
        .when(blank, "audit_field_missing")
    )
    return f.join(e, "finding_id", "full_outer").select("finding_id", fault.alias("fault")).where("fault is not null")


def approval_record(spark: SparkSession, policy: dict[str, str], sets: dict[str, tuple[DataFrame, str]], reports: dict[str, DataFrame]) -> DataFrame:
    """One row: policy map, hashes of value sets, and hashes of whole reports by content.

    A report's hash is that of its set of rows as JSON, so file layout and row order don't matter.
    Source fingerprint, the mapping of groups to splits and findings are reports like any other:
    pass their tables, so that publishing stops when one of them has changed.
    """
    hashes = {name: value_set_hash(df, column).first()["set_hash"] for name, (df, column) in sets.items()}
    as_json = lambda df: df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("v"))
    report_hashes = {name: value_set_hash(as_json(df), "v").first()["set_hash"] for name, df in reports.items()}
    return spark.createDataFrame([(policy, hashes, report_hashes)], "policy map<string,string>, sets map<string,string>, reports map<string,string>")


def write_approval(record: DataFrame, path: str) -> None:
    """JSON of one row; refuses to overwrite."""
    record.coalesce(1).write.mode("errorifexists").json(path)


def approval_faults(approved: DataFrame, current: DataFrame) -> DataFrame:
    """(part, name, approved, current) where two records differ; empty if publishing may go on."""
    long = lambda df, side: reduce(
        DataFrame.unionByName, [df.select(F.lit(p).alias("part"), F.explode(p).alias("name", side)) for p in ("policy", "sets", "reports")]
    )
    both = long(approved, "approved").join(long(current, "current"), ["part", "name"], "full_outer")
    return both.where(~F.col("approved").eqNullSafe(F.col("current")))


def structural_faults(items: DataFrame, exclusions: DataFrame, key: str) -> DataFrame:
    """Failures that no approval covers: excluded items that the exclusion table lacks, or
    the other way, and selected items that the policy excludes."""
    out = items.where("not eligible").select(key)
    named = lambda df, code: df.select(F.lit(code).alias("code"), F.col(key).cast("string").alias("subject"))
    parts = [
        named(out.join(exclusions, key, "left_anti"), "not_in_exclusions"),
        named(exclusions.join(out, key, "left_anti"), "not_excluded"),
        named(items.where("selected and not eligible"), "selected_but_excluded"),
    ]
    return reduce(DataFrame.unionByName, parts)


def count_faults(scan: DataFrame, selected: DataFrame, distributions: dict[str, DataFrame]) -> DataFrame:
    """(code, subject, expected, found) of counts that don't add up: by group, valid = eligible +
    excluded; and each distribution's total (column n) against the number of selected items."""
    off = scan.where("n_valid <> n_eligible + n_excluded").select(
        F.lit("valid_count").alias("code"), F.col("group_id").cast("string").alias("subject"), F.col("n_valid").alias("expected"), (F.col("n_eligible") + F.col("n_excluded")).alias("found")
    )
    whole = selected.agg(F.count(F.lit(1)).alias("expected"))
    parts = [
        whole.join(df.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("found"))).where("expected <> found").select(F.lit("distribution_total").alias("code"), F.lit(name).alias("subject"), "expected", "found")
        for name, df in distributions.items()
    ]  # one row each
    return reduce(DataFrame.unionByName, parts, off)
