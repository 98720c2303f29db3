"""Exact top-k inner-product search with a KD-tree per shard.

Vectors fall into shards by a hash of their row number; a shard's tree splits at
medians of its widest dimension and keeps a tight bounding box per node, and is
stored as one binary row. Queries go in blocks; a block runs through the trees
of a group of shards one after another in one task, so the k-th score found in
one shard prunes the next. Groups are as large as leaves enough tasks. In a tree, nodes are taken best first by the most
that any point of their box could score. Memory holds one block and one tree.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

SCALE = 1024
SHARD_ROWS = 2048
LEAF_ROWS = 64
#: Every tree goes to every block, so blocks are as large as a task's memory allows.
BLOCK_QUERIES = 4096
#: Shards that one task searches: fewer while there are less than TASKS tasks, so that none searches alone.
LEAST_GROUP, GROUP_SHARDS, TASKS = 4, 64, 64
MAX_PARTITIONS = 65_536
EXACT = 2.0**53
LONG = 2**63
OUT = "query long, query_id long, vec_id long, score long"


def scaled_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and integer components v: floor(1024 * x), a row per usable row. Vectors that are
    NULL or hold NULL or non-finite components, and NULL ids, are left out."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).select("vec_id", v.alias("v"))


def _matrix(rows: Iterable[np.ndarray]) -> np.ndarray:
    """Rows as 64-bit integers; shorter ones are filled with zeros."""
    rows = [np.asarray(r, dtype=np.int64) for r in rows]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def build_tree(ids: np.ndarray, rows: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict:
    """Arrays of a KD-tree: ids, row numbers and points in leaf order, and per node its box, range, children and least id."""
    order = np.arange(len(ids))
    lo, hi, span, children, least = [], [], [], [], []

    def node(a: int, b: int) -> int:
        at, own = len(span), points[order[a:b]]
        lo.append(own.min(axis=0))
        hi.append(own.max(axis=0))
        span.append((a, b))
        least.append(ids[order[a:b]].min())
        children.append((-1, -1))
        if b - a > leaf_rows:
            widest = int(np.argmax(hi[at] - lo[at])) if points.shape[1] else 0
            middle = (b - a) // 2
            if points.shape[1]:
                order[a:b] = order[a:b][np.argpartition(own[:, widest], middle)]
            children[at] = (node(a, a + middle), node(a + middle, b))
        return at

    node(0, len(ids))
    return {"ids": ids[order], "rows": rows[order], "points": points[order], "lo": np.array(lo), "hi": np.array(hi), "span": span, "children": children, "least": [int(x) for x in least]}


def _narrow(a: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them, for the shuffle."""
    low, high = int(a.min(initial=0)), int(a.max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return a.astype(kind)


def _width(a: np.ndarray, d: int) -> np.ndarray:
    return a[:, :d] if a.shape[1] >= d else np.pad(a, ((0, 0), (0, d - a.shape[1])))


def _largest(a: np.ndarray) -> float:
    return max(float(a.max(initial=0)), -float(a.min(initial=0)))


class BlockSearch:
    """The best k candidates so far of each query of a block."""

    def __init__(self, ids: np.ndarray, numbers: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.numbers, self.queries, self.k = ids, numbers, queries, k
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in ids]  # heaps of (score, -vec_id, -row number)

    def search(self, tree: dict) -> None:
        d = self.queries.shape[1]
        points, lo, hi = (_width(tree[x], d) for x in ("points", "lo", "hi"))
        reach = _largest(self.queries) * _largest(points) * max(1, d)
        kind = np.float64 if reach < EXACT else object  # Python's integers where doubles aren't exact
        q, points, lo, hi = (a.astype(kind) for a in (self.queries, points, lo, hi))
        bounds = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        for k in range(len(self.ids)):
            self._search_one(k, tree, points, q[k], bounds[k])

    def _search_one(self, k: int, tree: dict, points: np.ndarray, q: np.ndarray, bounds: np.ndarray) -> None:
        best, own, ids, numbers, least = self.best[k], self.numbers[k], tree["ids"], tree["rows"], tree["least"]
        frontier = [(-bounds[0], least[0], 0)]
        while frontier:
            bound, low_id, at = heapq.heappop(frontier)
            if len(best) == self.k and (-bound, -low_id) <= best[0]:
                break  # nothing further can beat the k-th
            left, right = tree["children"][at]
            if left >= 0:
                for child in (left, right):
                    if len(best) < self.k or (bounds[child], -least[child]) > best[0]:
                        heapq.heappush(frontier, (-bounds[child], least[child], child))
                continue
            a, b = tree["span"][at]
            scores = points[a:b] @ q
            may = np.flatnonzero(scores >= best[0][0]) if len(best) == self.k else range(b - a)
            for x in may:
                if (number := int(numbers[a + x])) != own:
                    item = (int(scores[x]), -int(ids[a + x]), -number)
                    if len(best) < self.k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for number, q, best in zip(self.numbers, self.ids, self.best, strict=True):
            for score, vec, _ in best:
                yield int(number), int(q), -vec, max(-LONG, min(LONG - 1, score))


def _pack_shard(group: pd.DataFrame) -> pd.DataFrame:
    tree = build_tree(group["vec_id"].to_numpy(np.int64), group["row"].to_numpy(np.int64), _matrix(group["v"]))
    tree |= {x: _narrow(tree[x]) for x in ("points", "lo", "hi")}
    return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "payload": [pickle.dumps(tree)]})


def _pack_block(group: pd.DataFrame) -> pd.DataFrame:
    block = (group["vec_id"].to_numpy(np.int64), group["row"].to_numpy(np.int64), _narrow(_matrix(group["v"])))
    return pd.DataFrame({"block": [int(group["block"].iloc[0])], "payload": [pickle.dumps(block)]})


def _run(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        names = [x.split()[0] for x in OUT.split(", ")]
        flush = lambda: pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] if (rows := list(state.rows())) else [pa.array([], pa.int64())] * 4, names=names)
        for batch in batches:
            for block, part, shard, payload in zip(*(batch[c] for c in ("block", "part", "shard", "payload")), strict=True):
                loaded = pickle.loads(payload.as_py())
                if shard.as_py() < 0:
                    if state is not None:
                        yield flush()
                    key, state = (block.as_py(), part.as_py()), BlockSearch(*loaded, k)
                elif key == (block.as_py(), part.as_py()):
                    state.search(loaded)
        if state is not None:
            yield flush()

    return run


def top_k(vectors: DataFrame, is_query, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each query row.

    ``vectors`` has vec_id and integer array v (see scaled_vectors); ``is_query``
    is a condition on it. Rows that share a vec_id are rows of their own, as queries
    and as candidates. Vectors of unequal length are compared as if filled
    with zeros. Ties go to the smaller vec_id; with fewer than k others, all
    are given. Scores beyond a long stop at its limits. Without rows or queries
    the result is empty.
    """
    # Row numbers hold as long as the written table does.
    vectors = materialize(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = vectors.where(is_query)
    n, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_queries / BLOCK_QUERIES))
    parts = max(math.ceil(shards / GROUP_SHARDS), min(math.ceil(shards / LEAST_GROUP), math.ceil(TASKS / blocks)))
    in_group = math.ceil(shards / parts)
    hashed = lambda m, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(m)).cast("int")
    trees = vectors.withColumn("shard", hashed(shards, 1)).groupBy("shard").applyInPandas(_pack_shard, "shard int, payload binary")
    trees = materialize(trees, "trees")
    packed = queries.withColumn("block", hashed(blocks, 2)).groupBy("block").applyInPandas(_pack_block, "block int, payload binary")
    heads = packed.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(-1).alias("shard"), "payload")
    # The stated query set against all rows, in blocks: each tree goes to each block.
    bodies = trees.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.expr(f"cast(shard div {in_group} as int)").alias("part"), "shard", "payload"
    )
    # A given number of partitions, as groups are heavy for their bytes and would be merged.
    runs = heads.unionByName(bodies).repartition(min(2 * blocks * parts, MAX_PARTITIONS), "block", "part").sortWithinPartitions("block", "part", "shard")
    found = runs.mapInArrow(_run(k), OUT)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are all rows whose vec_id is divisible by 100; see scaled_vectors for rows that take no part."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(scaled_vectors(vectors), F.col("vec_id") % 100 == 0, 10)


OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 10
"""
