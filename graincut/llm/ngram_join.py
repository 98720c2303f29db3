"""Near-duplicates by Jaccard similarity of word shingles: a grouped prefix join.

A text is its set of distinct five-word shingles, as 64-bit hashes. Texts of
equal sets (a 128-bit digest) are one class. Shingles have one global order, by
rising frequency and then by hash; frequency is read off a table of 2^20 counts
over all texts, in eighths of a doubling, so that the order is a function of the
shingle and its megabyte of levels may be sent to every task. Two sets with
Jaccard similarity 0.8 or more share a shingle among the first s - ceil(0.8 s) + 1
of either, and among the first s - ceil(8/9 s) + 1 of the smaller one.

1. Classes of equal prefix and size are one group; a group posts its prefix once.
2. A posting counts only where its shingle is in the short prefix of another group.
   Sizes and the places of the shared shingle bound the overlap and drop pairs.
3. Stars: every shingle has a centre, the posting with the fewest rarer shingles
   before it, which in a family of near copies is the least edited one. Pairs with
   a centre are verified first and joined to components. They are as many as postings.
4. Then all pairs that remain, those of different components, are verified. Inside
   a component no link can change the result, so families of copies are never paired out.
5. Groups are expanded to their classes in both steps; verification counts the common
   shingles of the two texts themselves, which travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table, refuse_names
from .simhash import components

SHINGLE = 5
# A pair is linked if 100 x common >= PERCENT x all.
PERCENT = 80
SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 14
STEPS = 8  # levels in a doubling of frequency
#: Bits of a shingle's hash that postings carry; a clash there only adds a pair to verify.
TOKEN_BITS = 48


def word_list(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case; bytes.split() splits at the same ASCII white space."""
    return text.lower().split()


def shingle_hashes(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a text of one to four words is one shingle.

    Equal word sequences have equal hashes; that two different ones of the texts compared clash has odds of 2^-64 a pair.
    """
    words = word_list(text)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)
    each = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    n = len(words) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):  # a mixing step for each word, so that order counts
            h = (h ^ each[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    return np.unique(h)


def class_key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def prefix_length(size: int | Column, short: bool = False) -> int | Column:
    """Places of the prefix that one text of a linked pair must have the shared shingle in; ``short``: of the smaller text.

    The least overlap with a text as small as may be is ceil(0.8 s), with one of at least this size ceil(8/9 s).
    """
    part, whole = (2 * PERCENT, 100 + PERCENT) if short else (PERCENT, 100)
    if isinstance(size, Column):
        return size - F.ceil((size * part).cast("decimal(38,0)") / whole).cast("long") + 1
    return size - -(-size * part // whole) + 1


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kept, n, class) of texts; at the end of a task blocks of its frequency table."""
    table = np.zeros(1 << SKETCH_BITS, np.uint32)
    kept_type = None
    names = ["kept", "n", "class", "block", "counts"]
    for batch in batches:
        kept_type = batch["kept"].type
        sizes, keys = [], []
        for text in batch["text"]:
            hashes = shingle_hashes(text.as_buffer().to_pybytes())
            # A shingle occurs once in a set, but two may share a slot.
            np.add.at(table, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
            sizes.append(len(hashes))
            keys.append(class_key(hashes) if len(hashes) else None)
        nulls = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([batch["kept"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *nulls], names=names)
    if kept_type is None:
        return
    for k, part in enumerate(table.reshape(-1, SKETCH_BLOCK)):
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, kept_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=names
            )


def _sum_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the blocks that a task reads, one at a time; at most a row per block."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, counts in zip(batch["block"].to_pylist(), batch["counts"], strict=True):
            sums.setdefault(k, np.zeros(SKETCH_BLOCK, np.int64))
            sums[k] += np.frombuffer(counts.as_buffer(), np.uint32)
    levels = {k: np.round(STEPS * np.log2(v + 1)).clip(0, 255).astype(np.uint8).tobytes() for k, v in sums.items()}
    yield pa.RecordBatch.from_arrays([pa.array(list(levels), pa.int32()), pa.array(list(levels.values()), pa.binary())], names=["block", "levels"])


def frequency_levels(blocks: DataFrame) -> np.ndarray:
    """Level of each slot: a megabyte at any size of the corpus."""
    levels = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint8)
    dealt = blocks.select("block", "counts").repartition("block")
    for r in dealt.mapInArrow(_sum_blocks, "block int, levels binary").collect():
        levels[r["block"] * SKETCH_BLOCK : (r["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(r["levels"], np.uint8)
    return levels


def _prefixes(levels: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, groups, sizes, prefixes = [], [], [], []
            for text in batch["text"]:
                hashes = shingle_hashes(text.as_buffer().to_pybytes())
                if not len(hashes):
                    continue
                order = np.argsort(levels[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")  # hashes rise already
                first = hashes[order[: prefix_length(len(hashes))]]
                tokens = (first & np.uint64((1 << TOKEN_BITS) - 1)).astype(np.int64)
                keys.append(class_key(hashes))
                groups.append(xxhash.xxh3_64_intdigest(first.tobytes(), len(hashes) & 0xFFFFFFFF) - (1 << 63))
                sizes.append(len(hashes))
                prefixes.append(tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(groups, pa.int64()), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=["class", "group", "n", "prefix"],
            )

    return run


def _packed_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class and compressed text."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        keys, texts = [], []
        for text in batch["text"]:
            data = text.as_buffer().to_pybytes()
            hashes = shingle_hashes(data)
            if len(hashes):
                keys.append(class_key(hashes))
                texts.append(pack(data.lower()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.binary())], names=["class", "packed"])


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that are linked. The set of the first text is kept from row to row, as rows of one centre come together."""
    unpack = zstandard.ZstdDecompressor().decompress
    last, own = None, np.zeros(0, np.uint64)
    for batch in batches:
        linked = []
        for key, x, y in zip(batch["a"].to_pylist(), batch["packed_a"], batch["packed_b"], strict=True):
            if key != last:
                last, own = key, shingle_hashes(unpack(x.as_py()))
            other = shingle_hashes(unpack(y.as_py()))
            common = len(np.intersect1d(own, other, assume_unique=True))
            linked.append(100 * common >= PERCENT * (len(own) + len(other) - common))
        yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(linked, pa.bool_())), batch["b"].filter(pa.array(linked, pa.bool_()))], names=["a", "b"])


def may_link(n_a: Column, at_a: Column, n_b: Column, at_b: Column) -> Column:
    """Whether texts of these sizes can be linked if the first shingle that they share has these places (from 0)."""
    least = F.ceil(((n_a + n_b) * PERCENT).cast("decimal(38,0)") / (100 + PERCENT))
    short = F.when(n_a <= n_b, at_a < prefix_length(n_a, True)).otherwise(at_b < prefix_length(n_b, True))
    return (100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)) & short & (F.least(n_a - at_a, n_b - at_b) >= least)


def shared_postings(prefixes: DataFrame) -> DataFrame:
    """token, group, n, at, centre (at, group, n): postings whose token another group has in its short prefix, written."""
    posted = prefixes.select("group", "n", F.posexplode("prefix").alias("at", "token"))
    short = posted.where(F.col("at") < prefix_length(F.col("n"), True))
    centre = F.min(F.struct("at", "group", "n")).alias("centre")
    # Counted before the shuffle; copies of a group are one group.
    tokens = short.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most"), centre)
    met = posted.join(tokens, "token").where((F.col("least") != F.col("group")) | (F.col("most") != F.col("group")))
    return materialize(met.select("token", "group", "n", "at", "centre").distinct(), "postings")


def star_pairs(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes (a, b): each class with the centre of every shingle it shares, and with the first class of its group."""
    bound = may_link(F.col("centre.n"), F.col("centre.at"), F.col("n"), F.col("at"))
    met = shared.where(F.col("group") != F.col("centre.group")).where(bound).select(F.col("centre.group").alias("centre"), "group").distinct()
    first = classes.groupBy("group").agg(F.min("class").alias("a"), F.max("class").alias("last"))
    of_centre = met.join(first.select(F.col("group").alias("centre"), "a"), "centre").join(classes.select("group", F.col("class").alias("b")), "group")
    inside = classes.join(first.where("a <> last").select("group", "a"), "group").where("class <> a").select("a", F.col("class").alias("b"))
    return of_centre.select("a", "b").unionByName(inside)


def remaining_pairs(shared: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of classes (a, b) that share a shingle as linked ones must, of different components; ``roots``: node, root."""
    own = classes.join(roots, F.col("class") == F.col("node"), "left").select("group", "n", "class", F.coalesce("root", "class").alias("root"))
    posted = shared.select("token", "group", "at").join(own, "group").select("token", "class", "n", "at", "root")
    # Classes of one group have their prefix in common: the group is a shingle in first place.
    groups = own.select(F.col("group").alias("token"), "class", "n", F.lit(0).alias("at"), "root")
    posted = posted.withColumn("kind", F.lit("t")).unionByName(groups.withColumn("kind", F.lit("g")))
    mixed = posted.groupBy("kind", "token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("kind", "token")
    open_ = materialize(posted.join(mixed, ["kind", "token"]), "open")
    # Components of a shingle are paired before their members, so that a component is never paired with itself. Bounds
    # over the members of each drop pairs in which no two could be linked; of two single texts they are those of may_link.
    short = F.bool_or(F.col("at") < prefix_length(F.col("n"), True)).alias("short")
    found = open_.groupBy("kind", "token", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("at")).alias("left"), short)
    other = found.select("kind", "token", *[F.col(c).alias(f"{c}_b") for c in ("root", "least", "most", "left", "short")])
    overlap = F.ceil(((F.col("least") + F.col("least_b")) * PERCENT).cast("decimal(38,0)") / (100 + PERCENT))
    near = (100 * F.col("most") >= PERCENT * F.col("least_b")) & (100 * F.col("most_b") >= PERCENT * F.col("least")) & (F.col("short") | F.col("short_b"))
    near = near & (F.least("left", "left_b") >= overlap)
    both = found.join(other, ["kind", "token"]).where((F.col("root") < F.col("root_b")) & near).select("kind", "token", "root", "root_b")
    left = open_.join(both, ["kind", "token", "root"])
    right = open_.select("kind", "token", *[F.col(c).alias(f"{c}_b") for c in ("class", "n", "at", "root")])
    pairs = left.join(right, ["kind", "token", "root_b"]).where(may_link(F.col("n"), F.col("at"), F.col("n_b"), F.col("at_b")))
    return pairs.select(F.least("class", "class_b").alias("a"), F.greatest("class", "class_b").alias("b"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked, written; ``texts``: class, packed."""
    side = lambda x: texts.select(F.col("class").alias(x), F.col("packed").alias(f"packed_{x}"))
    return materialize(pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "packed_a", "packed_b").mapInArrow(_verify, "a binary, b binary"), "links")


def jaccard_components(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_shingles and component_id, a row per row of ``docs``, which has doc_id and text.

    component_id is the least doc_id that links reach. Texts without words (NULL, empty, white space) are
    linked with nothing: their component is their own doc_id. A NULL doc_id counts in no minimum; a
    component of such rows alone has a NULL id. Repeated rows get the same result each. ``keep`` may
    not name results; other columns are not read.
    """
    refuse_names(keep, ["n_shingles", "component_id"])
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    row = docs.select(F.struct(F.col("doc_id").alias("id"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("row")).alias("kept"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    kept_type = row.schema["kept"].dataType.simpleString()
    measured = materialize(row.mapInArrow(_measure, f"kept {kept_type}, n long, class binary, block int, counts binary"), "measured")
    rows = measured.where("block is null").select("kept", "n", "class")
    levels = frequency_levels(measured.where("block is not null"))

    prefixes = materialize(texts.mapInArrow(_prefixes(levels), "class binary, group long, n long, prefix array<long>"), "prefixes")
    classes = materialize(prefixes.select("class", "group", "n").distinct(), "classes")
    shared = shared_postings(prefixes)
    stars = materialize(star_pairs(shared, classes).distinct(), "star-pairs")
    # Texts that a pair may need: of shared postings, and of groups of several classes.
    several = classes.groupBy("group").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("group")
    wanted = materialize(classes.join(shared.select("group").unionByName(several).distinct(), "group", "left_semi").select("class"), "wanted")
    packed = texts.mapInArrow(_packed_texts, "class binary, packed binary").join(wanted, "class", "left_semi")
    packed = materialize(packed.groupBy("class").agg(F.first("packed").alias("packed")), "packed")

    links = verified(stars, packed)
    rest = materialize(remaining_pairs(shared, classes, components(links)).distinct().join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "rest-pairs")
    more = verified(rest, packed)
    roots = components(links.unionByName(more))

    placed = rows.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = placed.where("class is not null").groupBy("root").agg(F.min("kept.id").alias("least")).withColumnRenamed("root", "r")
    named = placed.join(least, F.col("root") == F.col("r"), "left")
    of = F.when(F.col("class").isNull(), F.col("kept.id")).otherwise(F.col("least"))
    return named.select(*[F.col(f"kept.row.`{c}`").alias(c) for c in keep], F.col("n").alias("n_shingles"), of.alias("component_id"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, see jaccard_components."""
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
c AS (SELECT min(r) AS c, len(any_value(sh)) AS n, any_value(sh) AS sh, list_sort(any_value(sh)) AS k, list(r) AS rs FROM (SELECT *, list_sort(sh) AS key FROM s WHERE len(sh) > 0) GROUP BY key),
x AS (SELECT c, n, hash(unnest(sh)) AS h FROM c),
i AS (SELECT a.c AS a, b.c AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.c <> b.c GROUP BY 1, 2),
e AS (SELECT a, b FROM i WHERE 100 * i.i >= 80 * (na + nb - i.i)),
reach AS (SELECT c AS a, c AS b FROM c UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
root AS (SELECT a, min(b) AS root FROM reach GROUP BY 1),
m AS (SELECT unnest(rs) AS r, root FROM c JOIN root ON root.a = c.c),
ids AS (SELECT root, min(doc_id) AS least FROM m JOIN s USING (r) GROUP BY 1)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, CASE WHEN root IS NULL THEN doc_id ELSE least END AS component_id FROM s LEFT JOIN m USING (r) LEFT JOIN ids USING (root)
"""
