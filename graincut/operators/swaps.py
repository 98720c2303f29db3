"""Search for the best swap of two groups between splits, by boxes of counts.

Classes of groups with equal counts are gathered into cells, level by level: a cell's key is its
classes' counts without their last bits. A pair of cells has bounds of all swaps between its members,
so whole pairs of cells are settled or dropped at once, and only the rest is opened, by equi-joins on
the keys. The result is that of a comparison of all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import settle

HEAD = 3  # items, positives, annotations
ROUND = 12  # digits that objectives are compared at, so that ties are ties
BITS = 2  # bits of every count that a level leaves out
#: Cells that are paired without a coarser level: pairs of the first level are at most the square.
CELLS = 512

Range = tuple[np.ndarray, np.ndarray]  # least and greatest values


def _ratio(part: Range, whole: Range) -> Range:
    """part / whole of counts; an empty whole gives 0."""
    share = lambda p, w: np.where(w == 0, 0.0, p / w)
    maybe = (whole[0] <= 0) & (whole[1] > 0)
    return np.where(maybe, 0.0, share(part[0], whole[1])), np.where(maybe, np.inf, share(part[1], whole[0]))


def _apart(a: Range, b: Range) -> np.ndarray:
    """Least distance of a value of a from one of b."""
    return np.maximum(0.0, np.maximum(a[0] - b[1], b[0] - a[1]))


def swap_scores(sums: dict, free: list, fixed: float | None, mapped: bool) -> Callable[[DataFrame, str, str], Column]:
    """Function of the columns low and high to a struct of the least o and g that a swap in a pair of cells can reach.

    o is the largest relative deviation of a split's density (0 where the density aimed at is 0), g the
    largest gap of a rate of positives; the swap of a single pair has its counts as low and as high.
    Unknown counts give NaN. ``sums``: split to its counts n, p, a; ``fixed``: the density aimed at, or
    None for that after the swap. Arrow batches, since expressions over many splits outgrow generated code.
    """
    names = list(sums)
    base = np.array([[r[c] for c in "npa"] for r in sums.values()], dtype=float)
    own = [names.index(x) for x in free]

    @F.pandas_udf("o double, g double")
    def least(left: pd.Series, right: pd.Series, l_low: pd.Series, l_high: pd.Series, r_low: pd.Series, r_high: pd.Series) -> pd.DataFrame:
        m = len(left)
        rows, x, y = np.arange(m), left.to_numpy(), right.to_numpy()

        def at(counts: pd.Series, split: np.ndarray) -> np.ndarray:
            f = np.array(counts.tolist(), dtype=float).reshape(m, -1)
            return f.reshape(m, -1, HEAD)[rows, split] if mapped else f[:, :HEAD]

        low, high = np.repeat(base[None], m, axis=0), np.repeat(base[None], m, axis=0)
        low[rows, x] += at(r_low, x) - at(l_high, x)
        high[rows, x] += at(r_high, x) - at(l_low, x)
        low[rows, y] += at(l_low, y) - at(r_high, y)
        high[rows, y] += at(l_high, y) - at(r_low, y)
        of = lambda k, part=slice(None): (low[:, part, k], high[:, part, k])
        total = lambda k, part=slice(None): tuple(v.sum(axis=1, keepdims=True) for v in of(k, part))
        with np.errstate(divide="ignore", invalid="ignore"):
            target = _ratio(total(2, own), total(0, own)) if fixed is None else (np.full((m, 1), fixed),) * 2
            density = _ratio(of(2, own), of(0, own))
            bounds = np.where(target[1] > 0, density[0] / target[1], 1.0), np.where(target[0] > 0, density[1] / target[0], np.inf)
            o = np.where(target[1] <= 0, 0.0, _apart(bounds, (1.0, 1.0)))
            g = _apart(_ratio(of(1), of(0)), _ratio(total(1), total(0)))
        return pd.DataFrame({"o": np.round(o.max(axis=1), ROUND), "g": g.max(axis=1)})

    least = least.asNondeterministic()  # so that a filter on the result does not run it twice
    number = lambda c: (F.array_position(F.array(*[F.lit(x) for x in names]), F.col(c)) - 1).cast("int")
    return lambda low, high: least(number("l_split"), number("r_split"), *[F.col(f"{s}_{c}") for s in "lr" for c in (low, high)])


def _coarser(cells: DataFrame) -> DataFrame:
    n = len(cells.first()["key"])
    edge = lambda c, how: F.array(*[how(F.col(c)[k]) for k in range(n)]).alias(c)
    first = F.min_by(F.struct("id", "f"), F.col("id").cast("string"))
    up = cells.groupBy("split", "stratum", _parent(F.col("key")).alias("key")).agg(edge("low", F.min), edge("high", F.max), first.alias("one"))
    return up.select("split", "stratum", "key", "low", "high", "one.*")


def _parent(key: Column) -> Column:
    return F.transform(key, lambda x: F.shiftright(x, BITS))


def _sided(cells: DataFrame, side: str, *more: Column) -> DataFrame:
    return cells.select(*[F.col(c).alias(f"{side}_{c}") for c in cells.columns], *more)


def best_swap(classes: DataFrame, pairs_of: list[tuple], sums: dict, free: list, fixed: float | None, mapped: bool, below: float, spread: float, n_classes: int):
    """The swap (o, l_id, r_id, l_split, r_split) of least o, ties by ids as text; None without one whose
    o is less than ``below`` and whose gap of rates is ``spread`` at most.

    ``classes``: split, stratum, id (the first of the class) and f, its counts as one flat array.
    ``pairs_of``: splits that may swap, as (left, right). Only classes of one stratum are swapped.
    """
    levels = [classes.select("split", "stratum", F.col("f").alias("key"), F.col("f").alias("low"), F.col("f").alias("high"), "id", "f")]
    while n_classes > CELLS and len(levels) * BITS < 62:
        levels.append(settle(_coarser(levels[-1]), "cells"))
        n_classes = levels[-1].count()
    partner = F.explode(F.array_compact(F.array(*[F.when(F.col("split") == F.lit(x), F.lit(y)) for x, y in pairs_of])))
    left, right = _sided(levels[-1], "l", partner.alias("partner")), _sided(levels[-1], "r")
    pairs = left.join(right, (F.col("partner") == F.col("r_split")) & F.col("l_stratum").eqNullSafe(F.col("r_stratum"))).drop("partner")
    texts = [F.col(f"{s}_id").cast("string") for s in "lr"]
    best = None

    scores = swap_scores(sums, free, fixed, mapped)
    reach = lambda c: (F.col(f"{c}.g") <= spread) & (F.col(f"{c}.o") < below)

    def better(scored: DataFrame):
        """The better of ``best`` and the best of the scored pairs."""
        row = scored.where(reach("one")).agg(
            F.min_by(F.struct(F.col("one.o"), "l_id", "r_id", "l_split", "r_split"), F.struct(F.col("one.o"), *texts)).alias("b")
        ).first()["b"]
        rank = lambda b: (b["o"], str(b["l_id"]).encode(), str(b["r_id"]).encode())
        return min(filter(None, (best, row)), key=rank, default=None)

    for finer in levels[-2::-1]:
        # The first groups of both cells are a swap that exists: what can't be better than the best of these goes.
        scored = pairs.select("*", scores("f", "f").alias("one"), scores("low", "high").alias("all"))
        scored = settle(scored.where(reach("all")), "swaps")
        best = better(scored)
        if best is not None:
            found = F.struct(F.lit(best["o"]), *[F.lit(str(best[f"{s}_id"])) for s in "lr"])
            scored = scored.where(F.struct(F.col("all.o"), *texts) < found)
        keys = [f"{s}_{c}" for s in "lr" for c in ("split", "stratum", "key")]
        pairs = scored.select(*[F.col(c).alias(f"up_{c}") for c in keys])
        for s in "lr":
            same = (F.col(f"up_{s}_split") == F.col(f"{s}_split")) & F.col(f"up_{s}_stratum").eqNullSafe(F.col(f"{s}_stratum"))
            pairs = pairs.join(_sided(finer, s), same & (F.col(f"up_{s}_key") == _parent(F.col(f"{s}_key"))))
        pairs = pairs.drop(*[f"up_{c}" for c in keys])
    return better(pairs.select("l_id", "r_id", "l_split", "r_split", scores("f", "f").alias("one")))
