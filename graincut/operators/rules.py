"""Ordered rule chains, file pairing, policy and preservation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Paths that the pairing shows of a key; their number is always whole.
LISTED_PATHS = 10


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """Code of the first rule whose predicate is true; NULL if none is. NULL predicates don't fire."""
    return F.coalesce(*[F.when(predicate, F.lit(code)) for code, predicate in rules])


def all_failures(rules: list[tuple[str, Column]]) -> Column:
    """Codes of all rules that fire, in order."""
    return F.array_compact(F.array(*[F.when(predicate, F.lit(code)) for code, predicate in rules]))


def issue_rows(items: DataFrame, key: list[str], codes: Column) -> DataFrame:
    return items.select(*key, F.explode(codes).alias("issue"))


def json_group_id(value: Column, *paths: str) -> Column:
    """Group id in a VARIANT: the first path that is there; a list of one is unwrapped;
    text or whole numbers of digits only, never booleans."""

    def at(path: str) -> Column:
        raw = F.try_variant_get(value, path, "variant")
        one = F.when(F.schema_of_variant(raw).startswith("ARRAY"), F.when(F.try_variant_get(raw, "$[1]", "variant").isNull(), F.try_variant_get(raw, "$[0]", "variant"))).otherwise(raw)
        kind = F.schema_of_variant(one)
        text = F.when(kind.isin("STRING", "BIGINT"), F.try_variant_get(one, "$", "string"))
        return F.when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=.)", ""))

    present = [F.when(F.try_variant_get(value, p, "variant").isNotNull(), F.lit(k)) for k, p in enumerate(paths)]
    first = F.coalesce(*present)
    chain = F.when(first == 0, at(paths[0]))
    for k, p in enumerate(paths[1:], 1):
        chain = chain.when(first == k, at(p))
    return chain


def strict_int(value: Column, path: str) -> Column:
    """An integer in a VARIANT; NULL for booleans, text and fractions."""
    raw = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(raw) == "BIGINT", F.try_variant_get(raw, "$", "int"))


def pair_files(left: DataFrame, right: DataFrame, key: list[str], path: str) -> DataFrame:
    """Full outer pairing with a cardinality check.

    key, n_left, n_right, status (paired, left_only, right_only, ambiguous), left_paths
    and right_paths: the first LISTED_PATHS of a key in path order, joined by ``|``.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias(f"n_{name}"))
        ranked = df.withColumn("__k", F.row_number().over(Window.partitionBy(*key).orderBy(path))).where(F.col("__k") <= LISTED_PATHS)
        listed = F.array_join(F.array_sort(F.collect_list(path)), "|")
        paths = ranked.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(listed.alias(f"{name}_paths"))
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key])
        return counts.join(paths, same).select(*key, f"n_{name}", f"{name}_paths")

    both = side(left, "left").join(side(right, "right"), key, "full_outer")
    n_left, n_right = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_left", "n_right"))
    status = (
        F.when((n_left == 1) & (n_right == 1), "paired").when(n_right == 0, "left_only").when(n_left == 0, "right_only").otherwise("ambiguous")
    )
    return both.select(*key, n_left.alias("n_left"), n_right.alias("n_right"), status.alias("status"), "left_paths", "right_paths")


def apply_policy(items: DataFrame, kind: str, extent: Column, limit: float, reason: str) -> DataFrame:
    """``items`` with eligible and policy_reason; nothing is dropped. A missing, negative
    or non-finite extent of the ruled kind is an error."""
    ruled = F.col("kind") == kind
    bad = extent.isNull() | F.isnan(extent.cast("double")) | (extent < 0)
    over = F.when(ruled & bad, F.raise_error(F.lit("extent must be finite and not negative")).cast("boolean")).otherwise(ruled & (extent >= F.lit(limit)))
    return items.withColumn("eligible", ~over).withColumn("policy_reason", F.when(over, reason))


def preserve_groups(discovered: DataFrame, stats: DataFrame, counts: list[str]) -> DataFrame:
    """Every discovered group with its later stats; groups that lost all items keep zeros."""
    found = stats.withColumn("__there", F.lit(True))
    joined = discovered.join(found, ["kind", "group_id"], "left")
    kept = [c for c in discovered.columns if c not in ("kind", "group_id")]
    return joined.select(
        "kind", "group_id", *kept, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.col("__there").isNull().alias("emptied")
    )
