"""Language-model scores: a word unigram base, and the marginal probability of a
text over all segmentations into the subwords of an existing vocabulary.

Pieces never cross white space, so a text's lattice is a chain of word
lattices, and the forward recursion runs once per distinct word of the corpus.
Documents are indexed in chunks: a chunk has one row per distinct word with
the places and counts of the word in its documents. Counts are summed by word
over training documents, words get their log-probabilities, and a join by word
brings these back to the chunks, where they are summed by document.

Piece probabilities are relative counts (plus 0.1) over all training words:
first of the vocabulary's own segmentation, then, in EM_ROUNDS rounds, expected
counts over all segmentations, which raise the marginal likelihood. The
vocabulary is never trained.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from decimal import Decimal
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_of_id, materialize, read_table, refuse_names

VOCABULARY = "piece_bpe_32k.model"
ALPHA = 0.1
#: Passes over the distinct training words that replace piece counts by expected ones.
EM_ROUNDS = 1
#: Expected uses are summed as whole parts of this size, so that no order of adding shows; sums are decimals.
PARTS = 1 << 24
#: Longest words whose probabilities are tried without logarithms, and the least such value.
PLAIN_CHARS, TINY = 40, 1e-280
#: A chunk ends at this many documents or bytes of text.
CHUNK_DOCS, CHUNK_BYTES = 4096, 12_000_000
COUNT_BITS = 19  # a posting is document number * 2^19 + count; larger counts take several
END = "\n"  # stands for the end token; no word holds white space
INDEX = "row long, train boolean, n_words long, word binary, chunk long, postings array<int>, train_count long"
PART_SUM = pa.decimal128(38, 0)
MODEL_SCHEMA = "word binary, c long, lattice double"


def _index_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Batches of documents (True, word NULL; one for each batch read) and of distinct
    words by chunk (False, row NULL)."""
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 24
    postings: dict[bytes, list[int]] = {}
    learned: list[bool] = []  # by document of the chunk
    docs, size, top = 0, 0, (1 << COUNT_BITS) - 1

    def words_of() -> pa.RecordBatch:
        n = len(postings)
        sizes = np.fromiter(map(len, postings.values()), dtype=np.int32, count=n)
        flat = np.fromiter(chain.from_iterable(postings.values()), dtype=np.int32, count=int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))
        counted = (flat & top).astype(np.int64) * np.array(learned, dtype=np.int64)[flat >> COUNT_BITS]
        return pa.RecordBatch.from_arrays(
            [
                pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.bool_()),
                pa.nulls(n, pa.int64()),
                pa.array(list(postings), pa.binary()),
                pa.array(np.full(n, chunk)),
                lists,
                pa.array(np.add.reduceat(counted, starts[:-1])),
            ],
            names=[x.split()[0] for x in INDEX.split(", ")],
        )

    for batch in batches:
        at, n_words = [], []
        for text, train in zip(batch["text"], batch["train"].to_pylist(), strict=True):
            data = (text.as_py() or "").encode("utf-8", "surrogatepass").lower()
            words = data.split()
            place = docs << COUNT_BITS
            for w, c in Counter(words).items():
                own = postings.get(w)
                if own is None:
                    own = postings[w] = []
                while c > top:
                    own.append(place | top)
                    c -= top
                own.append(place | c)
            learned.append(bool(train))
            at.append(chunk * CHUNK_DOCS + docs)
            n_words.append(len(words))
            docs, size = docs + 1, size + len(data)
            if docs == CHUNK_DOCS or size > CHUNK_BYTES:
                if postings:
                    yield False, words_of()
                chunk, docs, size = chunk + 1, 0, 0
                postings.clear()
                learned.clear()
        n = len(at)
        yield True, pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), batch["train"], pa.array(n_words, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.int64())],
            names=[x.split()[0] for x in INDEX.split(", ")],
        )
    if postings:
        yield False, words_of()


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Forward recursion over all segmentations of a word, in natural logarithms."""

    def __init__(self, log_p: dict[str, float], byte_log_p: list[float]):
        self.byte_log_p = byte_log_p
        #: Every prefix of a piece, with the piece's log-probability or None.
        self.trie: dict[str, float | None] = {}
        for piece in log_p:
            for k in range(1, len(piece)):
                self.trie.setdefault(piece[:k], None)
        self.trie.update(log_p)
        self.plain = {x: None if p is None else math.exp(p) for x, p in self.trie.items()}

    def log_probability(self, word: str) -> float:
        """Plain probabilities for words of usual length, logarithms where those run out."""
        text = "▁" + word
        if len(text) <= PLAIN_CHARS and (p := self._probability(text)) > TINY:
            return math.log(p)
        return self._log_probability(text)

    def _probability(self, text: str) -> float:
        n = len(text)
        get, missing = self.plain.get, object()
        alpha = [1.0] + [0.0] * n
        for i in range(n):
            at, single = alpha[i], False
            for j in range(i + 1, n + 1):
                p = get(text[i:j], missing)
                if p is missing:
                    break
                if p is not None:
                    alpha[j] += at * p
                    single = single or j == i + 1
            if not single:
                alpha[i + 1] += at * math.exp(self._bytes(text[i]))
        return alpha[n]

    def _log_probability(self, text: str) -> float:
        n = len(text)
        get, exp, log = self.trie.get, math.exp, math.log
        trie, missing = self.trie, object()
        incoming: list[list[float]] = [[] for _ in range(n + 1)]
        alpha = 0.0
        for i in range(n):
            if i:
                terms = incoming[i]
                top = max(terms)
                alpha = top if len(terms) == 1 else top + log(sum([exp(t - top) for t in terms]))
                incoming[i] = []
            single = False
            for j in range(i + 1, n + 1):
                p = get(text[i:j], missing)
                if p is missing:
                    break
                if p is not None:
                    incoming[j].append(alpha + p)
                    single = single or j == i + 1
            if not single:  # a character that is no piece is spelled in bytes
                data = text[i].encode("utf-8", "surrogatepass")
                incoming[i + 1].append(alpha + sum(self.byte_log_p[b] for b in data))
        terms = incoming[n]
        top = max(terms)
        return top + log(sum([exp(t - top) for t in terms]))


    def expect(self, word: str, times: int, uses: dict[str, int], byte_uses: list[int]) -> None:
        """Adds the expected uses, in PARTS, of each piece and byte over all segmentations of
        ``times`` words: the forward recursion, then its shares handed back along the arcs.

        Each arc carries its share of its end's probability. Words of usual length need no
        logarithms for that; where plain probabilities run out, they are taken.
        """
        text = "▁" + word
        arcs = self._shares(text) if len(text) <= PLAIN_CHARS else None
        mass = [0.0] * len(text) + [float(times * PARTS)]
        used = uses.get
        for a, b, share, piece in reversed(self._log_shares(text) if arcs is None else arcs):
            part = mass[b] * share
            mass[a] += part
            n = int(part + 0.5)
            if piece is not None:
                uses[piece] = used(piece, 0) + n
            else:
                for x in text[a:b].encode("utf-8", "surrogatepass"):
                    byte_uses[x] += n

    def _shares(self, text: str) -> list[tuple[int, int, float, str | None]] | None:
        """Arcs (start, end, share of the end's probability, piece or None for bytes) by start; None if a probability runs out."""
        n = len(text)
        get, missing = self.plain.get, object()
        alpha = [1.0] + [0.0] * n
        arcs = []
        add = arcs.append
        for i in range(n):
            at, single = alpha[i], False
            for j in range(i + 1, n + 1):
                piece = text[i:j]
                p = get(piece, missing)
                if p is missing:
                    break
                if p is not None:
                    w = at * p
                    alpha[j] += w
                    add((i, j, w, piece))
                    single = single or j == i + 1
            if not single:
                w = at * math.exp(self._bytes(text[i]))
                alpha[i + 1] += w
                add((i, i + 1, w, None))
        if min(alpha) < TINY:
            return None
        return [(i, j, w / alpha[j], piece) for i, j, w, piece in arcs]

    def _log_shares(self, text: str) -> list[tuple[int, int, float, str | None]]:
        n = len(text)
        exp, missing = math.exp, object()
        incoming: list[list[float]] = [[] for _ in range(n + 1)]
        alpha, arcs = [0.0] * (n + 1), []
        for i in range(n + 1):
            if i:
                top = max(incoming[i])
                alpha[i] = top + math.log(sum([exp(t - top) for t in incoming[i]]))
                incoming[i] = []
            single = i == n
            for j in range(i + 1, n + 1):
                p = self.trie.get(text[i:j], missing)
                if p is missing:
                    break
                if p is not None:
                    incoming[j].append(alpha[i] + p)
                    arcs.append((i, j, alpha[i] + p, text[i:j]))
                    single = single or j == i + 1
            if not single:
                incoming[i + 1].append(alpha[i] + self._bytes(text[i]))
                arcs.append((i, i + 1, incoming[i + 1][-1], None))
        return [(i, j, exp(t - alpha[j]), piece) for i, j, t, piece in arcs]

    def _bytes(self, character: str) -> float:
        return sum(self.byte_log_p[b] for b in character.encode("utf-8", "surrogatepass"))


def _lattice(model, log_p: np.ndarray) -> Lattice:
    """log_p: natural log-probability by piece id."""
    plain = {model.id_to_piece(i): float(log_p[i]) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    return Lattice(plain, [float(log_p[i]) for i in _byte_ids(model)])


def _byte_ids(model) -> list[int]:
    return [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def _expect_pieces(path: str, log_p: np.ndarray):
    def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(path)
        lattice = _lattice(model, log_p)
        uses: dict[str, int] = {}
        byte_uses = [0] * 256
        for batch in batches:
            for word, times in zip(batch["word"].to_pylist(), batch["c"].to_pylist(), strict=True):
                lattice.expect(word.decode("utf-8", "replace"), times, uses, byte_uses)
        found = [(model.piece_to_id(x), n) for x, n in uses.items() if n] + [(i, n) for i, n in zip(_byte_ids(model), byte_uses, strict=True) if n]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([Decimal(n) for _, n in found], PART_SUM)], names=["piece", "n"])

    return expect


def _count_pieces(path: str):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _load(path)
        total = np.zeros(model.get_piece_size(), dtype=np.int64)
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch["word"].to_pylist()]
            times = batch["c"].to_numpy()
            ids = model.encode(words, num_threads=1)
            flat = np.fromiter((x for xs in ids for x in xs), dtype=np.int64)
            total += np.bincount(flat, np.repeat(times, [len(x) for x in ids]), minlength=len(total)).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array([Decimal(int(n)) for n in total[seen]], PART_SUM)], names=["piece", "n"])

    return count


def _score_words(path: str, log_p: np.ndarray):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(_load(path), log_p)
        for batch in batches:
            out = [lattice.log_probability(w.decode("utf-8", "replace")) for w in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["word"], batch["c"], pa.array(out, pa.float64())], names=["word", "c", "lattice"])

    return score


def score_documents(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns with n_tokens, n_known, train_tokens, base_score and score, a row per row.

    ``docs`` has text and train (boolean; NULL: not learned from). NULL and
    empty texts are the end token alone. Repeated rows are scored one by one,
    and learned from as often as they occur. With nothing to learn from, all
    pieces are equally likely. ``keep`` may not name results; kept columns may have any types.
    """
    refuse_names(keep, ["n_tokens", "n_known", "train_tokens", "base_score", "score"])
    path = vocabulary_path(vocabulary)
    kept = [F.col(f"`{c}`") for c in keep]
    # The kept columns ride along, so that rows and chunks come from one pass.
    index_in = docs.select(F.coalesce("train", F.lit(False)).alias("train"), "text", F.struct(F.lit(0).alias("_"), *kept).alias("kept"))
    kept_type = index_in.schema["kept"].dataType

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        kinds: list[pa.DataType] = []

        def watched() -> Iterator[pa.RecordBatch]:
            for b in batches:
                held.append(b["kept"])
                kinds[:] = [b["kept"].type]
                yield b

        for of_docs, out in _index_chunks(watched()):
            own = held.pop(0) if of_docs else pa.nulls(out.num_rows, kinds[0])
            yield pa.RecordBatch.from_arrays([*out.columns, own], names=[*out.schema.names, "kept"])

    indexed = materialize(index_in.mapInArrow(index, T.StructType([*T.StructType.fromDDL(INDEX).fields, T.StructField("kept", kept_type)])), "index")
    rows = indexed.where("row is not null")
    words = indexed.where("word is not null")
    counts = materialize(words.groupBy("word").agg(F.sum("train_count").alias("c")), "counts")
    t = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    ends = rows.where("train").count()
    n, v = t["n"] + ends, t["v"] + (ends > 0)
    model = _load(path)

    def learned(uses, parts: int) -> np.ndarray:
        """Log-probabilities from uses by task; at most one row per piece (32,000) reaches the driver."""
        n = np.zeros(model.get_piece_size())
        for r in counts.where("c > 0").mapInArrow(uses, "piece long, n decimal(38,0)").groupBy("piece").agg(F.sum("n").alias("n")).collect():
            n[r["piece"]] = int(r["n"]) / parts
        n[model.eos_id()] = ends
        return np.log((n + ALPHA) / (n.sum() + ALPHA * len(n)))

    log_p = learned(_count_pieces(path), 1)
    for _ in range(EM_ROUNDS):
        log_p = learned(_expect_pieces(path, log_p), PARTS)
    scored = counts.mapInArrow(_score_words(path, log_p), MODEL_SCHEMA)
    base = lambda c: F.log10((c + F.lit(ALPHA)) / F.lit(n + ALPHA * (v + 1)))
    posted = words.select("word", "chunk", "postings").join(materialize(scored, "words"), "word")
    posted = posted.select("chunk", F.explode("postings").alias("p"), "c", "lattice", base(F.col("c")).alias("base"))
    times = F.col("p").bitwiseAND((1 << COUNT_BITS) - 1).cast("long")
    sums = posted.groupBy((F.col("chunk") * CHUNK_DOCS + F.shiftright("p", COUNT_BITS)).alias("__row")).agg(
        F.sum(F.when(F.col("c") > 0, times)).alias("__known"), F.sum(times * F.col("base")).alias("__base"), F.sum(times * F.col("lattice")).alias("__lattice")
    )
    zero = lambda c, d: F.coalesce(F.col(c), F.lit(d))
    return rows.join(sums, F.col("row") == F.col("__row"), "left").select(
        *[F.col(f"kept.`{c}`").alias(c) for c in keep],
        (F.col("n_words") + 1).alias("n_tokens"),
        (zero("__known", 0) + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (zero("__base", 0.0) + base(F.lit(ends))).alias("base_score"),
        ((zero("__lattice", 0.0) + float(log_p[model.eos_id()])) / math.log(10)).alias("score"),
    )


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL doc_id is not held out, and learned from."""
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 10 == 0, F.lit(False))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"), (~held_out).alias("train"))
    return score_documents(docs, ["doc_id", "held_out"])
