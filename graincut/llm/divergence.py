"""Divergence of sources by count-level bitmaps.

A term's share in a group depends on its count there alone, so the divergence
of two groups is a sum over joint cells (count here, count there): the number
of terms in the cell times a function of two shares.

Kept terms are numbered by language and falling count and cut into blocks of
1,024. In a block, a group holds one bitset per count that occurs, a bit per
term with that count. For two groups, AND and popcount of each pair of bitsets
give the cells of terms that both have; what a bitset has beyond them falls
into the cells of count zero there, and what is left of the block into the
cell of zero and zero. So zeros cost nothing, and rare terms, of which most
blocks consist, have two or three counts a block.

Groups are paired by language and block in a join; a row is one block of one
group, of at most 1,024 bitsets, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table, running_totals

#: Bytes of terms, A-Z lowered, and spaces for all others. Terms are ASCII letters and whatever is not ASCII.
LETTERS = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))
LEAST_DOCS = 3
UNIT = 1_000_000_000
BLOCK = 1_024
MOST_TERMS = 200
#: Bytes of text that a task counts at once.
HELD_BYTES = 32_000_000

COUNTS = "lang string, source string, term string, n long, docs long"
FIELDS = ["lang", "source", "term", "n", "docs"]
EXACT = pa.decimal128(38, 0)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about HELD_BYTES of text each, or of one row."""
    upto = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + HELD_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, term) of every occurrence of a term, in lower case."""
    # A byte becomes a byte, so the translated texts keep their places.
    _, offsets, data = texts.buffers()
    spaced = pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, pa.py_buffer((data or pa.py_buffer(b"")).to_pybytes().translate(LETTERS))], offset=texts.offset)
    words = pc.ascii_split_whitespace(spaced)
    row, term = pc.list_parent_indices(words), words.flatten()
    real = pc.not_equal(term, "")
    return row.filter(real).to_numpy(), term.filter(real).dictionary_encode()


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in a sorted array."""
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(keys)))


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (lang, source, term) in each slice, and a row with a NULL term for every group seen."""
    for batch in batches:
        for part in _slices(batch):
            groups: dict[tuple[str, str], int] = {}
            of_row = np.array([groups.setdefault(g, len(groups)) for g in zip(part["lang"].to_pylist(), part["source"].to_pylist(), strict=True)], np.int64)
            row, terms = _terms(part["text"])
            # Row and term in one number: sorted, its runs are the counts of a term in a text.
            key = np.sort(row.astype(np.int64) << 32 | terms.indices.to_numpy())
            starts, n = _runs(key)
            key = key[starts]
            key = of_row[key >> 32] << 32 | key & 0xFFFFFFFF
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            starts, docs = _runs(key)
            group, term = key[starts] >> 32, pc.take(terms.dictionary, pa.array(key[starts] & 0xFFFFFFFF))
            sums = np.add.reduceat(n, starts) if len(starts) else n
            names = [pa.array([g[k] for g in groups], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(pc.take(x, pa.array(group)) for x in names), term, pa.array(sums, pa.int64()), pa.array(docs, pa.int64())], names=FIELDS)
            none = pa.array(np.zeros(len(groups)), pa.int64())
            yield pa.RecordBatch.from_arrays([*names, pa.nulls(len(groups), pa.string()), none, none], names=FIELDS)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it), written; a NULL term is the group itself, with zeros."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").alias("text")).mapInArrow(_count_terms, COUNTS)
    return materialize(rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)), exact; decimals only where the product is beyond a long."""
    wide = lambda c: c.cast("decimal(38,0)")
    narrow = F.call_function("div", F.lit(UNIT).cast("long") * (n + 1), total + kept)
    return F.when(n < 9_000_000_000, narrow).otherwise(F.call_function("div", wide(F.lit(UNIT)) * wide(n + 1).cast("decimal(19,0)"), wide(total + kept))) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most UNIT + 1, so that squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each (group, block): the counts that occur, their shares, and a bitset of the block for each."""
    for batch in batches:
        shares, bits = [], []
        flat = batch["terms"].flatten()
        every_bit, every_n = flat.field("bit").to_numpy(), flat.field("n").to_numpy()
        held = pc.fill_null(pc.list_value_length(batch["terms"]), 0).to_numpy()
        ends = np.cumsum(held)
        for total, kept, first, last in zip(batch["total"].to_pylist(), batch["kept"].to_pylist(), ends - held, ends, strict=True):
            at = every_bit[first:last]
            levels, row = np.unique(every_n[first:last], return_inverse=True)
            words = np.zeros((len(levels), BLOCK // 64), np.uint64)
            np.bitwise_or.at(words, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
            # The share of count zero comes first.
            shares.append([1 + UNIT * (n + 1) // (total + kept) for n in (0, *levels.tolist())])
            bits.append(words.tobytes())
        names = ["lang", "source", "block", "size"]
        columns = [*(batch[c] for c in names), pa.array(shares, pa.list_(pa.int64())), pa.array(bits, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "shares", "bits"])


def joint_cells(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Terms of a block by (count in a, count in b), row and column 0 being count zero, from two stacks of bitsets."""
    cells = np.zeros((len(a) + 1, len(b) + 1), np.int64)
    for k, level in enumerate(a):
        cells[k + 1, 1:] = np.bitwise_count(b & level).sum(axis=1, dtype=np.int64)
    cells[1:, 0] = np.bitwise_count(a).sum(axis=1, dtype=np.int64) - cells[1:, 1:].sum(axis=1)
    cells[0, 1:] = np.bitwise_count(b).sum(axis=1, dtype=np.int64) - cells[1:, 1:].sum(axis=0)
    cells[0, 0] = size - cells.sum()
    return cells


def cell_sum(cells: np.ndarray, p: np.ndarray, q: np.ndarray) -> int:
    """Sum over cells of their terms times floor((p - q)^2 / q), exact."""
    i, j = np.nonzero(cells)
    d = p[i] - q[j]
    f = d * d // q[j]
    n = cells[i, j]
    if not len(f) or int(f.max()) < 2**62 // BLOCK:
        return int((f * n).sum())
    return sum(x * y for x, y in zip(f.tolist(), n.tolist(), strict=True))


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ab, ba = [], []
        stack = lambda x: np.frombuffer(x, np.uint64).reshape(-1, BLOCK // 64)
        for size, sa, ba_bits, sb, bb_bits in zip(*(batch[c].to_pylist() for c in ("size", "a_shares", "a_bits", "b_shares", "b_bits")), strict=True):
            cells = joint_cells(stack(ba_bits), stack(bb_bits), size)
            p, q = np.array(sa, np.int64), np.array(sb, np.int64)
            ab.append(Decimal(cell_sum(cells, p, q)))
            ba.append(Decimal(cell_sum(cells.T, q, p)))
        columns = [batch["lang"], batch["a"], batch["b"], pa.array(ab, EXACT), pa.array(ba, EXACT)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "a", "b", "ab", "ba"])


def divergences(groups: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, item, value of every two sources of a language, both ways.

    ``groups``: lang, source, total, kept; ``kept``: lang, term, block, bit; ``counts``: lang, source, term, n.
    """
    own = counts.join(kept.select("lang", "term", "block", "bit"), ["lang", "term"]).groupBy("lang", "source", "block").agg(F.collect_list(F.struct("bit", "n")).alias("terms"))
    blocks = kept.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
    grid = groups.join(blocks, "lang").join(own, ["lang", "source", "block"], "left")
    packed = materialize(
        grid.select("lang", "source", "block", "size", "total", "kept", "terms").mapInArrow(_pack, "lang string, source string, block long, size long, shares array<long>, bits binary"), "bitsets"
    )
    side = lambda x: packed.select("lang", "block", "size", F.col("source").alias(x), F.col("shares").alias(f"{x}_shares"), F.col("bits").alias(f"{x}_bits"))
    # A few packed rows become as many as there are pairs of sources; they are dealt out before.
    tasks = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = side("a").repartition(tasks, "lang", "block", "a").join(side("b").drop("size"), ["lang", "block"]).where("a < b")
    summed = pairs.mapInArrow(_compare, "lang string, a string, b string, ab decimal(38,0), ba decimal(38,0)").groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"))
    both = F.inline(F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item"), F.col(x + y).cast("long").alias("value")) for x, y in ("ab", "ba")]))
    found = summed.select("lang", both)
    # A language without kept terms has no blocks: its pairs are zero.
    bare = groups.where("kept = 0").select("lang", "source")
    zeros = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return found.unionByName(zeros)


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    ``docs`` has text, lang and source; NULLs are read as ''. Part ``pair``: every other source of the
    language and the divergence from it. Part ``term``: the ``most_terms`` kept terms of a group whose
    share is furthest above the language's. A term is kept if at least ``least_docs`` rows of its language
    hold it; repeated rows count as often as they occur. A group without kept terms has pairs and no
    terms; a language of one source has no pairs. Other columns are not read. No rows, no result.
    """
    every = term_counts(docs.select("text", "lang", "source"))
    counts = every.where("term is not null")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    numbered = running_totals(terms, [F.col("lang"), F.col("in_lang").desc(), F.col("term")], {"number": F.lit(1).cast("long")}, "terms")
    kept = materialize(numbered.select("lang", "term", "in_lang", F.expr(f"number div {BLOCK}").alias("block"), (F.col("number") % BLOCK).cast("int").alias("bit")), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("in_lang").alias("lang_total"))
    of_kept = counts.join(kept.select("lang", "term", "in_lang"), ["lang", "term"])
    totals = of_kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = every.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = materialize(groups.select("lang", "source", zero("total"), zero("kept"), zero("lang_total")), "groups")

    pairs = divergences(groups, kept, counts.select("lang", "source", "term", "n")).withColumn("part", F.lit("pair"))
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    above = of_kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    best = above.select("lang", "source", "item", gap(F.col("p"), F.col("q")).alias("value"), F.lit("term").alias("part"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = lambda x: x.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(pairs).select(*columns).unionByName(ranked(best).where(F.col("rank") <= most_terms).select(*columns))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, see audit_sources."""
    return audit_sources(read_table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
u AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS ln FROM u GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(ln)::HUGEINT AS lt FROM kept GROUP BY 1),
c AS (SELECT u.lang, source, u.term, count(*)::HUGEINT AS n FROM u JOIN kept k ON k.lang = u.lang AND k.term = u.term GROUP BY 1, 2, 3),
g AS (SELECT lang, source, coalesce(t, 0) AS t, coalesce(v, 0) AS v, coalesce(lt, 0) AS lt FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS t FROM c GROUP BY 1, 2) USING (lang, source) LEFT JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 1) // (t + v) AS p, 1 + 1000000000 * (ln + 1) // (lt + v) AS q
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(s, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS xs, y.source AS ys, sum((x.p - y.p) * (x.p - y.p) // y.p)::HUGEINT AS s FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) f
    ON f.lang = a.lang AND xs = a.source AND ys = b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
every AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
