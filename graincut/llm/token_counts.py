"""Token counts by prefix dynamic programming.

For a byte-level BPE, the last token of a prefix's encoding is the only
vocabulary entry that ends the prefix and may follow the last token of what
comes before it (two tokens may stand side by side if encoding their joined
bytes gives the two again). So one pass over the bytes finds last token and
token count of every prefix: count[i] = count[i - length of last] + 1.

The result for a text is the change of the count at each character, one signed
byte per character. Its running sum is the exact token count of every prefix,
so budgets and truncation points need no further encoding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, refuse_names

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: The published pre-tokenizer pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Python's white space holds all of the pattern's.
UNEVEN_SPACES = re.compile(r"\s\s|\A\s|\s\Z")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: Remembered pre-tokens, in two generations of this many; longer ones are not kept.
CACHE_PIECES = 300_000
CACHE_PIECE_CHARS = 48
CACHE_PAIRS = 1_000_000
NEVER = 1 << 60
COLUMNS = "n_tokens long, limit_chars long, deltas binary"

_state: dict[str, "PrefixCounter"] = {}


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file, back to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PrefixCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        as_bytes = lambda token: bytes(letter[c] for c in token)
        special = {t["content"] for t in spec["added_tokens"]}
        self.vocab = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = [(self.vocab[as_bytes(a)], self.vocab[as_bytes(b)], self.vocab[as_bytes(a + b)]) for a, b in pairs]
        self.merge_rank = {(a << 20) | b: k for k, (a, b, _) in enumerate(ids)}
        self.made = {c: (a, b, k) for k, (a, b, c) in reversed([*enumerate(ids)])}
        self.edges: tuple[dict[int, list[tuple[int, int]]], ...] = ({}, {})
        self.longest = max(map(len, self.vocab))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.pieces = regex.compile(PATTERN)
        self.spaces = regex.compile(r"\s{2,}(?=\S)")
        self.side_by_side: dict[int, bool] = {}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge while ``token`` is built, last first, each
        with the rank of the merge that uses it up. side: 0 left, 1 right."""
        if (known := self.edges[side].get(token)) is None:
            known, used, at = [], NEVER, token
            while True:
                known.append((at, used))
                if (made := self.made.get(at)) is None:
                    break
                used, at = made[2], made[side]
            self.edges[side][token] = known
        return known

    def may_follow(self, a: int, b: int) -> bool:
        """False if, merging by rank, some pair joins across the border of a and b.

        The pair (x, y) would, if its merge comes before those that use x and y up
        inside their own tokens. At equal rank the left one goes first.
        """
        right = self.edge(b, 0)
        for x, x_used in self.edge(a, 1):
            for y, y_used in right:
                rank = self.merge_rank.get((x << 20) | y, NEVER)
                if rank < x_used and rank <= y_used and rank < NEVER:
                    return False
        return True

    def byte_counts(self, data: bytes) -> list[int]:
        """Token count of every byte prefix of one pre-token, from 0."""
        vocab, longest, known, n = self.vocab.get, self.longest, self.side_by_side, len(data)
        if len(known) > CACHE_PAIRS:
            known.clear()
        last, count, begin = [0] * (n + 1), [0] * (n + 1), 0
        for i in range(1, n + 1):
            # Only one token fits, so any order finds it: first the one before made longer, then short ones.
            a, nearer = begin, i - 1
            while True:
                token = vocab(data[a:i])
                if token is not None:
                    if not a:
                        break
                    pair = (last[a] << 20) | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = self.may_follow(last[a], token)
                    if fits:
                        break
                if nearer == begin:
                    nearer -= 1
                a = nearer
                nearer -= 1
                if a < 0 or a < i - longest:
                    raise ValueError("a byte is missing in the vocabulary")
            last[i], count[i], begin = token, count[a] + 1, a
        return count

    def piece_counts(self, piece: str) -> list[int]:
        """Token count of every character prefix of one pre-token, from 1."""
        count = self.byte_counts(piece.encode("utf-8", "surrogatepass"))
        if piece in CONTRACTIONS:  # cut short, "'re" is the two pre-tokens "'" and "r"
            return [*range(1, len(piece)), count[-1]]
        if len(count) == len(piece) + 1:
            return count[1:]
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in piece])
        return [count[e] for e in ends]

    def piece_deltas(self, piece: str) -> bytes:
        at, out = 0, []
        for c in self.piece_counts(piece):
            out.append((c - at) & 255)
            at = c
        return bytes(out)

    def segment_deltas(self, text: str) -> bytearray:
        """Deltas of a text without special tokens."""
        new, old = self.new, self.old
        out = []
        for p in self.pieces.findall(text):
            d = new.get(p)
            if d is None:
                d = old.get(p)
                if d is None:
                    d = self.piece_deltas(p)
                if len(p) <= CACHE_PIECE_CHARS:
                    new[p] = d
            out.append(d)
        joined = bytearray(b"".join(out))
        if len(new) > CACHE_PIECES:
            self.old, self.new = new, {}
        # A run of white space before a word gives its last character to what follows,
        # but a prefix that ends with the run has it as one pre-token.
        for m in self.spaces.finditer(text):
            run, at = m.group(), m.end() - 1
            whole = self.piece_counts(run)[-1]
            apart = self.piece_counts(run[:-1])[-1] + self.piece_counts(run[-1])[-1]
            if whole != apart:
                joined[at] = (joined[at] + whole - apart) % 256
                joined[at + 1] = (joined[at + 1] - whole + apart) % 256
        return joined

    def spaced_deltas(self, text: str) -> bytes:
        """Deltas of a text whose white space stands alone and inside: each space begins
        a pre-token, so what lies between two spaces is counted apart and remembered."""
        first, *chunks = text.split(" ")
        found = list(map(self.chunks.get, chunks))
        if None in found:
            new, old = self.chunks, self.old_chunks
            for k, x in enumerate(found):
                if x is None:
                    c = chunks[k]
                    x = found[k] = new.get(c) or old.get(c) or self.chunk_deltas(c)
                    if len(c) <= CACHE_PIECE_CHARS:
                        new[c] = x
            if len(new) > CACHE_PIECES:
                self.old_chunks, self.chunks = new, {}
        return bytes(self.segment_deltas(first)) + b"".join(found)

    def chunk_deltas(self, chunk: str) -> bytes:
        """Deltas of a space and what follows up to the next; plain letters are one pre-token."""
        piece = " " + chunk
        if not (chunk.isascii() and chunk.isalpha()):
            return bytes(self.segment_deltas(piece))
        d = self.new.get(piece) or self.old.get(piece) or self.piece_deltas(piece)
        if len(chunk) < CACHE_PIECE_CHARS:
            self.new[piece] = d
        return d

    def deltas(self, text: str) -> bytes:
        """Signed bytes: entry k is count(text[:k + 1]) - count(text[:k])."""
        if not any(x in text for x in self.special):
            return self.spaced_deltas(text) if text and not UNEVEN_SPACES.search(text) else bytes(self.segment_deltas(text))
        out = bytearray()
        parts = self.split_special.split(text)
        for k in range(0, len(parts), 2):
            if k + 1 == len(parts):
                out += self.segment_deltas(parts[k])
                break
            # Up to its last character a special token is ordinary text after what precedes it.
            segment, token = parts[k], parts[k + 1]
            grown = self.segment_deltas(segment + token[:-1])
            total = int(np.frombuffer(self.segment_deltas(segment), np.int8).sum(dtype=np.int64)) + 1
            out += grown
            out.append((total - int(np.frombuffer(grown, np.int8).sum(dtype=np.int64))) % 256)
        return bytes(out)


def counts_at(deltas: bytes) -> np.ndarray:
    """Exact token count of each prefix of 1, 2, ... characters."""
    return np.cumsum(np.frombuffer(deltas, np.int8), dtype=np.int64)


def longest_prefix(deltas: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    within = np.flatnonzero(counts_at(deltas) <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def _counter(path: str) -> PrefixCounter:
    if path not in _state:
        _state.clear()
        _state[path] = PrefixCounter(path)
    return _state[path]


def prefix_counts(docs: DataFrame, keep: list[str], limit: int = LIMIT, tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` columns, n_tokens, limit_chars and deltas, a row per row of ``docs``.

    limit_chars: characters of the longest prefix of at most ``limit`` tokens.
    deltas: see counts_at. A NULL text counts as an empty one: 0 tokens. ``keep`` may not name results.
    """
    refuse_names(keep, ["n_tokens", "limit_chars", "deltas"])

    @F.pandas_udf(COLUMNS)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        counter = _counter(public_tokenizers.path(tokenizer))
        for texts in batches:
            rows = []
            for text in texts:
                d = counter.deltas(text or "")
                n = int(np.frombuffer(d, np.int8).sum(dtype=np.int64))
                rows.append((n, len(d) if n <= limit and len(d) <= limit else longest_prefix(d, limit), d))
            yield pd.DataFrame(rows, columns=["n_tokens", "limit_chars", "deltas"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], counted("text").alias("__t")).select(*[F.col(f"`{c}`") for c in keep], "__t.*")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, row by row; NULL and empty texts have 0 bytes and 0 tokens."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    counted = prefix_counts(docs, ["doc_id", "n_bytes"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "limit_chars")
