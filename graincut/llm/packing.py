"""Best-fit packing planned on a histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The plan works on
counts by length (at most ``capacity`` of them), longest first: pieces of one
length go, run by run, into the open sequences with the least room that still
holds them, as many into each as it holds, else into new sequences. A run is a range of ranks within the
length placed into a range of sequences, so the plan has no row per document;
pieces take their slots by a join on their rank within their length. The plan
reads narrow rows; the ids of the pieces join their slots at the end.
"""

from __future__ import annotations

import os
import re
import struct
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table
from .token_counts import byte_letters

CAPACITY = 4096
END_ID = 1
RANK_BUCKETS = 256
#: The plan is sent to all tasks up to this many rows (48 bytes each); it has a few per length in use.
MAX_SENT_PLAN = 200_000
#: Words kept in a worker's memory, in two generations of this many; longer words are not kept.
CACHE_WORDS = 300_000
CACHE_WORD_BYTES = 48
#: The vocabulary's published pre-tokenizer pattern, after its lower-casing.
PRETOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Letters that composition leaves alone: ASCII, Latin-1 and Latin Extended-A.
SIMPLE = re.compile("[\x21-\x7e\u00a1-\u017f]+")
BYTE_LETTERS = {b: c for c, b in byte_letters().items()}
PIECE_FIELDS = ("piece", "start", "length", "ids")
PIECES = "array<struct<piece:int,start:long,length:long,ids:binary>>"

_state: dict[str, "WordEncoder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts, as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer never joins across white space, so a text's
    ids are those of its words (split at ASCII white space) one after another.
    Words are remembered. A new word of Latin letters is cut into its
    pre-tokens here, each given to the library's model once; any other word
    (combining marks, other scripts, special tokens) goes through the whole
    library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            found = self.old_pieces.get(piece)
            if found is None:
                shown = piece if piece.isascii() else "".join([BYTE_LETTERS[b] for b in piece.encode()])
                ids = [t.id for t in self.tokenize(shown)]
                found = struct.pack(f"<{len(ids)}I", *ids)
            if len(piece) <= CACHE_WORD_BYTES:
                self.pieces[piece] = found
        return found

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if SIMPLE.fullmatch(text) and "<|" not in text:
            return b"".join([self.piece(p) for p in PRETOKENS.findall(text.lower())])
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        words = text.encode("utf-8", "surrogatepass").split()
        found = list(map(self.new.get, words))
        if None in found:
            new, old = self.new, self.old
            for k, x in enumerate(found):
                if x is None:
                    w = words[k]
                    x = found[k] = new.get(w) or old.get(w) or self.word(w)
                    if len(w) <= CACHE_WORD_BYTES:
                        new[w] = x
            if len(new) > CACHE_WORDS:
                self.old, self.new = new, {}
            if len(self.pieces) > CACHE_WORDS:
                self.old_pieces, self.pieces = self.pieces, {}
        return b"".join(found)


def _encoder(path: str) -> WordEncoder:
    if path not in _state:
        _state.clear()
        _state[path] = WordEncoder(path)
    return _state[path]


def cut_pieces(ids: bytes, capacity: int) -> list[tuple[int, int, int, bytes]]:
    """(piece, start, length, ids) of one document's ids, with its end id among them."""
    step = 4 * capacity
    return [(k, k * capacity, len(x) // 4, x) for k, x in enumerate(ids[a : a + step] for a in range(0, len(ids), step))]


def text_pieces(docs: DataFrame, keep: list[str], capacity: int, tokenizer: str) -> DataFrame:
    """``keep`` columns and piece, start, length, ids: a row per piece. NULL text: empty.

    ``ids`` holds the piece's token ids as little-endian 32-bit bytes.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    @F.pandas_udf(PIECES)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(tokenizer_path(tokenizer))
        for texts in batches:
            out = [cut_pieces(encoder.encode(x or "") + end, capacity) for x in texts]
            yield pd.Series([[dict(zip(PIECE_FIELDS, p, strict=True)) for p in ps] for ps in out])

    kept = [F.col(f"`{c}`") for c in keep]
    return docs.select(*kept, F.explode(cut("text")).alias("__p")).select(*kept, "__p.*")


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows (length, first_rank, count, first_sequence, per_sequence, offset): the
    piece of rank r = first_rank + j goes to sequence first_sequence + j div
    per_sequence, at offset + (j mod per_sequence) * length.
    """
    rooms: list[int] = []  # rooms left that some open sequences have, ascending
    open_runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, count)
    plan, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if not open_runs[room]:
                insort(rooms, room)
            open_runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (k := bisect_left(rooms, length)) < len(rooms):
            room = rooms[k]
            first, n = open_runs[room].pop()
            if not open_runs[room]:
                rooms.pop(k)
            per = room // length
            full = min(n, left // per)
            rest = left % per if full < n else 0
            use = full * per + rest
            plan.append((length, rank, use, first, per, capacity - room))
            put(room - per * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
                full += 1
            put(room, first + full, n - full)
            rank, left = rank + use, left - use
        if left:
            per = capacity // length
            plan.append((length, rank, left, sequences, per, 0))
            put(capacity - per * length, sequences, left // per)
            if left % per:
                put(capacity - left % per * length, sequences + left // per, 1)
            sequences += -(-left // per)
    return plan


def pack(docs: DataFrame, keep: list[str], capacity: int = CAPACITY, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """A row per piece: ``keep``, piece, start, length, ids, ids_crc32, sequence_id, offset.

    ``ids`` holds the token ids as little-endian 32-bit bytes, so that the ids of
    a sequence are those of its pieces by offset, one after another. ``docs`` has
    a text column; NULL text is the end token alone. Repeated rows are packed one
    by one; which of two equal pieces takes which slot does not show. An empty
    table gives no rows. A name of a result in ``keep`` raises an error.
    """
    clash = {*PIECE_FIELDS, "ids_crc32", "sequence_id", "offset"} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"reserved names {sorted(clash)}")
    spark = docs.sparkSession
    cut = text_pieces(docs, keep, capacity, tokenizer).withColumn("ids_crc32", F.crc32("ids"))
    names = cut.columns
    ordered = [F.col(f"`{c}`") for c in names]
    # Row numbers hold as long as the written table does.
    pieces = materialize(cut.withColumns({"__hash": F.xxhash64(*ordered), "__row": F.monotonically_increasing_id()}), "pieces")
    bucketed = pieces.select("length", "__hash", "__row", F.pmod("__hash", F.lit(RANK_BUCKETS)).alias("__b"))
    counts = materialize(bucketed.groupBy("length", "__b").agg(F.count(F.lit(1)).alias("__n")), "lengths")
    # At most `capacity` rows reach the driver.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    slots_by_run = plan_slots(histogram, capacity)
    plan = spark.createDataFrame(slots_by_run, "__length long, __first long, __count long, __sequence long, __per long, __at long")
    # Sent to the pieces, so that pieces of a hot length stay where they are; beyond the bound the planner chooses.
    plan = F.broadcast(plan) if len(slots_by_run) <= MAX_SENT_PLAN else plan
    before = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("length").alias("__l"), F.col("__b").alias("__ob"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("length", "__b").orderBy("__hash", "__row")
    ranked = (
        bucketed.withColumn("__k", F.row_number().over(inside) - 1)
        .join(offsets, (F.col("length") == F.col("__l")) & (F.col("__b") == F.col("__ob")))
        .withColumn("__rank", F.col("__before") + F.col("__k"))
    )
    j = F.col("__rank") - F.col("__first")
    slots = ranked.join(plan, (F.col("length") == F.col("__length")) & (j >= 0) & (j < F.col("__count"))).select(
        "__row",
        (F.col("__sequence") + F.expr("(__rank - __first) div __per")).alias("sequence_id"),
        (F.col("__at") + j % F.col("__per") * F.col("length")).alias("offset"),
    )
    return pieces.drop("__hash").join(slots, "__row").select(*ordered, "sequence_id", "offset")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents with a digest of their ids in place of the ids; NULL and empty texts are an end token."""
    return pack(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]).drop("ids")
