"""Apportionment, quantile bins, stratified and seeded sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import order_key
from ..sources.tables import settle


#: Levels that one aggregate counts seats at, and seats that one window ranks.
LEVELS = 24
RANKED_SEATS = 10_000


def same_keys(left: list[str], right: list[str]) -> Column:
    """Pairs of columns that are equal, NULL being a value; true without columns."""
    return reduce(lambda x, y: x & y, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)], F.lit(True))


def quantile_bins(groups: DataFrame, by: list[str], order: list[Column], bins: int) -> DataFrame:
    """``groups`` with bin = min(bins - 1, rank * bins div n), rank from 0. Not NTILE.

    Ranges of ``by`` and ``order`` are ranked in tasks of their own and moved on by the counts of the
    ranges before, so that no task sorts all of a large ``by``. ``order`` should tell groups apart; an older bin is replaced.
    """
    dealt = groups.repartitionByRange(*map(F.col, by), *order).withColumn("__range", F.spark_partition_id())
    ranged = settle(dealt, "ranges")
    counts = ranged.groupBy("__range", *[F.col(c).alias(f"__by{k}") for k, c in enumerate(by)]).agg(F.count(F.lit(1)).alias("__in"))
    keys = [f"__by{k}" for k in range(len(by))]
    each = Window.partitionBy(*keys)  # a row per range
    earlier = each.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("*", F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__before"), F.sum("__in").over(each).alias("__n"))
    offsets = offsets.withColumnRenamed("__range", "__r").drop("__in")
    place = F.row_number().over(Window.partitionBy("__range", *by).orderBy(*order)) - 1
    ranked = ranged.withColumn("__place", place).join(offsets, (F.col("__range") == F.col("__r")) & same_keys(by, keys))
    bin_ = F.least(F.lit(bins - 1), F.floor((F.col("__before") + F.col("__place")) * bins / F.col("__n"))).cast("int")
    return ranked.select(*[c for c in groups.columns if c != "bin"], bin_.alias("bin"))


def largest_remainder(weights: DataFrame, seats: int, key: str, weight: str, cap: str) -> DataFrame:
    """``key`` and quota: ``seats`` shared out by weight, at most ``cap`` each.

    Seats beyond the floors go one by one to the largest residue, ties by larger weight, then key; a
    key that takes one goes on with a residue less by one. Raises if caps or weights leave too few places.

    A key's seats stand at the residues r, r - 1, r - 2, ...: an aggregate over the keys counts the seats at and
    above each of a row of levels, and the two levels around the last seat are divided again, until few seats lie
    between them or no number does. Seats above are taken whole and those between are ranked, by ranges if they are
    many. So a key is a row, however many seats it takes, and no task sorts all keys.
    """
    whole = float(weights.agg(F.sum(weight)).first()[0] or 0)
    raw = F.col(weight).cast("double") * seats / F.lit(whole) if whole else F.lit(0.0)
    based = weights.withColumn("__raw", raw).withColumn("__floor", F.least(F.floor("__raw"), F.col(cap)).cast("long"))
    floors = settle(based.select(key, weight, "__floor", (F.col(cap) - F.col("__floor")).cast("long").alias("__room"), (F.col("__raw") - F.col("__floor")).alias("__residue")), "floors")
    sums = floors.agg(F.coalesce(F.sum("__floor"), F.lit(0)).alias("given"), F.coalesce(F.sum("__room"), F.lit(0)).alias("room"), F.max(F.when(F.col("__room") > 0, F.col("__residue"))).alias("high")).first()
    left = seats - sums["given"]
    if sums["room"] < left:
        raise ValueError(f"not enough capacity for {left} of {seats} seats")
    if left <= 0:
        return floors.select(key, weight, F.col("__floor").alias("quota"))
    at_or_above = lambda level: F.least(F.greatest(F.floor(F.col("__residue") - F.lit(level)) + 1, F.lit(0)), F.col("__room")).cast("long")
    low, high, over_high = sums["high"] - left - 1.0, None, 0
    top = sums["high"]
    while True:
        end = top if high is None else high
        levels = sorted({low + (end - low) * k / LEVELS for k in range(LEVELS)} | ({end} if high is None else set()))
        stand = floors.agg(*[F.sum(at_or_above(x)) for x in levels]).first()
        last = max(k for k, n in enumerate(stand) if n >= left)
        low, over_low = levels[last], stand[last]
        if last + 1 < len(levels):
            high, over_high = levels[last + 1], stand[last + 1]
        if over_low - over_high <= RANKED_SEATS or len(levels) < 3:
            break
    first = at_or_above(high) if high is not None else F.lit(0).cast("long")
    placed = floors.withColumns({"__first": first, "__past": at_or_above(low)})
    step = F.explode(F.sequence("__first", F.col("__past") - 1)).alias("__step")
    between = placed.where("__past > __first").select(F.col(key).alias("__key"), F.col(weight).alias("__w"), "__residue", step).select("__key", "__w", (F.col("__residue") - F.col("__step")).alias("__at"))
    order = [F.col("__at").desc(), F.col("__w").desc(), F.col("__key")]
    open_ = left - over_high
    if over_low - over_high <= RANKED_SEATS:
        picked = between.withColumn("__k", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).where(F.col("__k") <= open_)
    else:
        picked = numbered(between, order, "__k").where(F.col("__k") <= open_)
    won = picked.groupBy("__key").agg(F.count(F.lit(1)).alias("__won"))
    return placed.join(won, F.col(key) == F.col("__key"), "left").select(key, weight, (F.col("__floor") + F.col("__first") + F.coalesce("__won", F.lit(0))).cast("long").alias("quota"))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place from 1 in ``order`` as ``name``, by ranges of the order: no task gets more than its range."""
    dealt = settle(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "numbered")
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__in"))
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = counts.select(F.col("__range").alias("__r"), F.coalesce(F.sum("__in").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    ranked = dealt.withColumn("__place", place).join(offsets, F.col("__range") == F.col("__r"))
    return ranked.select(*rows.columns, (F.col("__before") + F.col("__place")).cast("long").alias(name))


def stratified_sample(items: DataFrame, by: list[str], item: str, positive: Column, cap: int, seed: int, scope: Column) -> DataFrame:
    """At most ``cap`` items of each group, positives in proportion (halves to even).

    Order inside a group is seeded: scope:p for positives, scope:n for others. Groups are counted
    map-side, and no task hands on more than ``cap`` items of a group and side.
    """
    marked = items.withColumn("__pos", F.coalesce(positive, F.lit(False)))
    sizes = marked.groupBy(*[F.col(c).alias(f"__by{k}") for k, c in enumerate(by)]).agg(F.count(F.lit(1)).alias("__n"), F.count(F.when(F.col("__pos"), 1)).alias("__np"))
    key = order_key(seed, F.concat(scope.cast("string"), F.when(F.col("__pos"), ":p").otherwise(":n")), F.col(item))
    rank = F.row_number().over(Window.partitionBy(*by, "__pos").orderBy("__key", item))
    first = marked.withColumn("__key", key).withColumn("__r", rank).where(F.col("__r") <= cap)
    same = same_keys(by, [f"__by{k}" for k in range(len(by))])
    want = F.least(F.lit(cap), F.col("__n"))
    wanted_pos = F.least(F.rint(want * F.col("__np") / F.col("__n")).cast("long"), F.col("__np"))
    wanted_pos = F.greatest(wanted_pos, want - (F.col("__n") - F.col("__np")))
    wanted = F.when(F.col("__pos"), wanted_pos).otherwise(want - wanted_pos)
    return first.join(sizes, same).where(F.col("__r") <= wanted).select(*items.columns)


def nearest_to_mean(groups: DataFrame, quotas: DataFrame, stratum: list[str], value: str, group: str, seed: int, scope: str) -> DataFrame:
    """Of each stratum, as many groups as its quota: those nearest to the stratum's mean
    value, ties by seeded key, then id. ``quotas``: stratum columns and quota."""
    mean = F.avg(value).over(Window.partitionBy(*stratum))
    apart = F.round(F.abs(F.col(value) - mean), 12)
    near = groups.withColumn("__apart", apart)
    rank = F.row_number().over(Window.partitionBy(*stratum).orderBy("__apart", order_key(seed, scope, F.col(group)), group))
    ranked = near.withColumn("__r", rank)
    return ranked.join(quotas, stratum).where(F.col("__r") <= F.col("quota")).select(*groups.columns)


def seeded_split(groups: DataFrame, quotas: DataFrame, stratum: list[str], group: str, seed: int, roles: list[str], rest: str) -> DataFrame:
    """``groups`` with role: of each stratum the first quota_<role> groups in seeded order
    take the first role, the next the second, and so on; all others ``rest``."""
    rank = F.row_number().over(Window.partitionBy(*stratum).orderBy(order_key(seed, "split", F.col(group)), group))
    placed = groups.withColumn("__r", rank).join(quotas, stratum, "left")
    upto, role = F.lit(0), None
    for name in roles:
        upto = upto + F.coalesce(F.col(f"quota_{name}"), F.lit(0))
        role = F.when(F.col("__r") <= upto, name) if role is None else role.when(F.col("__r") <= upto, name)
    return placed.select(*groups.columns, role.otherwise(rest).alias("role"))


def sample_by_role(items: DataFrame, by: list[str], item: str, positive: Column, cap: int, seed: int, scope: Column, role: str, whole: str = "test") -> DataFrame:
    """Items of role ``whole`` all, of each other group at most ``cap``; the role is part of the seed's scope."""
    rest = stratified_sample(items.where(F.col(role) != whole), by, item, positive, cap, seed, F.concat_ws(":", scope.cast("string"), F.col(role)))
    return items.where(F.col(role) == whole).unionByName(rest)


def require_class_in_roles(groups: DataFrame, role: str, roles: list[str], flag: str) -> DataFrame:
    """Those of ``roles`` that have no group with ``flag``; empty if all do."""
    wanted = groups.sparkSession.createDataFrame([(r,) for r in roles], f"{role} string")
    return wanted.join(groups.where(F.col(flag)).select(role).distinct(), role, "left_anti")
