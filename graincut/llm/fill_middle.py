"""Fill-in-the-middle transformation over a piece table.

A document is a list of descriptors (buffer, start, length) over two immutable
buffers: the UTF-8 bytes of its text, and the sentinels. Nothing is copied to
transform it:

* ``cut`` splits descriptors at a byte of the document,
* ``arrange`` permutes the parts and puts sentinel descriptors between them,
* ``restore`` cuts an output at its sentinels, drops them and applies the
  inverse permutation, which gives descriptors over the output,
* ``stream`` hands the described bytes on, to a digest or to the one join that
  writes a real text.

A text is divided in units, a run of white space with the word after it, or the
white space at its end; cuts fall between units. White space is ASCII, so all
of it works on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, refuse_names

TEXT, SENTINELS = 0, 1
# Sentinels before prefix, suffix and middle.
SENTINEL_BYTES = b"<P><S><M>"
SENTINEL = {"P": (SENTINELS, 0, 3), "S": (SENTINELS, 3, 3), "M": (SENTINELS, 6, 3)}
#: Order of the parts by form; a part without a sentinel follows what stands before it.
FORMS = {"psm": (("P", 0), ("S", 2), ("M", 1)), "spm": (("S", 2), ("P", 0), ("M", 1))}
RATE, SPM_SHARE, SEED = 50, 80, "42"

Descriptor = tuple[int, int, int]
RESULTS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
DIGESTS = [("output_sha256", pa.string()), ("restored_sha256", pa.string())]
OUTPUT = [("pieces", pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))), ("output", pa.string())]
_SQL = {pa.int64(): "long", pa.string(): "string", OUTPUT[0][1]: "array<struct<buffer:int,start:bigint,length:bigint>>"}


def unit_ends(text: bytes) -> np.ndarray:
    """Byte ends of the units of a text; none for an empty one."""
    if not text:
        return np.zeros(0, np.int64)
    b = np.frombuffer(text, np.uint8)
    space = (b == 0x20) | ((b >= 0x09) & (b <= 0x0D))
    return np.append(np.flatnonzero(space[1:] & ~space[:-1]) + 1, len(b))


def n_chars(text: bytes) -> int:
    """Code points: the bytes that continue none."""
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def cut(pieces: list[Descriptor], at: int) -> tuple[list[Descriptor], list[Descriptor]]:
    """The descriptors of the first ``at`` bytes, and those of the rest; at most one is split."""
    left: list[Descriptor] = []
    for k, (buffer, start, length) in enumerate(pieces):
        if at < length:
            head = [(buffer, start, at)] if at else []
            return left + head, [(buffer, start + at, length - at), *pieces[k + 1 :]]
        left.append((buffer, start, length))
        at -= length
    return left, []


def arrange(parts: list[list[Descriptor]], form: str) -> list[Descriptor]:
    """Prefix, middle and suffix in the order of ``form``, with its sentinels."""
    return [d for name, part in FORMS[form] for d in (SENTINEL[name], *parts[part])]


def stream(pieces: Iterable[Descriptor], buffers: tuple[bytes, bytes]) -> Iterator[memoryview]:
    views = [memoryview(b) for b in buffers]
    return (views[buffer][start : start + length] for buffer, start, length in pieces)


def digest(pieces: Iterable[Descriptor], buffers: tuple[bytes, bytes]) -> str:
    h = hashlib.sha256()
    for part in stream(pieces, buffers):
        h.update(part)
    return h.hexdigest()


def restore(output: bytes, form: str) -> list[Descriptor]:
    """Descriptors over ``output`` that give the text back.

    A transformed text holds no sentinel of its own, and none can arise where its parts are cut
    and joined, since each begins with < and ends with >; so the first of each kind is the one set.
    """
    whole: list[Descriptor] = [(TEXT, 0, len(output))]
    if form == "plain":
        return whole
    parts: dict[int, list[Descriptor]] = {}
    rest, done = whole, 0
    order = FORMS[form]
    for k, (name, part) in enumerate(order):
        _, rest = cut(rest, len(name) + 2)
        done += len(name) + 2
        end = output.index(b"<%s>" % order[k + 1][0].encode(), done) if k + 1 < len(order) else len(output)
        parts[part], rest = cut(rest, end - done)
        done = end
    return [d for part in sorted(parts) for d in parts[part]]


def choose(doc_id: object, n: int, text: bytes, seed: str = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple[str, int, int]:
    """(form, units before the middle, units up to its end), by the seed and the id alone."""
    code = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(code[k : k + 8], 16) for k in (0, 8, 16, 24))
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or h3 % 100 >= rate or b"<P>" in text or b"<S>" in text or b"<M>" in text:
        return "plain", first, last
    return ("spm" if h4 % 100 < spm_share else "psm"), first, last


def transform(doc_id: object, text: bytes, seed: str = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple[int, str, list[Descriptor], int | None, int | None]:
    """(units, form, descriptors of the output, characters of prefix and middle) of one text."""
    ends = unit_ends(text)
    form, first, last = choose(doc_id, len(ends), text, seed, rate, spm_share)
    whole = [(TEXT, 0, len(text))] if text else []
    if form == "plain":
        return len(ends), form, whole, None, None
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, last))
    prefix, rest = cut(whole, a)
    middle, suffix = cut(rest, b - a)
    return len(ends), form, arrange([prefix, middle, suffix], form), n_chars(text[:a]), n_chars(text[a:b])


def _rows(docs: DataFrame, keep: list[str], fields: list[tuple[str, pa.DataType]], more: Callable, seed: str, rate: int, spm_share: int) -> DataFrame:
    """``keep`` columns and the results; ``more`` gives the fields beyond RESULTS from (descriptors, buffers, form)."""
    refuse_names(keep, [name for name, _ in [*RESULTS, *fields]])
    columns = [F.col(f"`{c}`") for c in keep]
    given = docs.select(*columns, F.col("doc_id").cast("string").alias("__id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("__text"))
    schema = T.StructType([*docs.select(*columns).schema, *T.StructType.fromDDL(", ".join(f"{name} {_SQL[kind]}" for name, kind in [*RESULTS, *fields]))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1)
            rows = []
            for k, doc_id in enumerate(ids):
                text = texts[k].as_buffer().to_pybytes()
                n, form, pieces, prefix, middle = transform(doc_id, text, seed, rate, spm_share)
                rows.append((n, form, prefix, middle, *more(pieces, (text, SENTINEL_BYTES), form)))
            made = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows, strict=True), [*RESULTS, *fields], strict=True)] if rows else [pa.array([], kind) for _, kind in [*RESULTS, *fields]]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=schema.names)

    return given.mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, keep: list[str], seed: str = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """``keep`` columns, n, form, prefix_chars, middle_chars, pieces and output, a row per row.

    ``docs`` has doc_id and text. ``pieces`` are the descriptors (buffer 0: the text, 1: the sentinels),
    ``output`` the text that they describe. A NULL text is an empty one; empty texts and texts that
    hold a sentinel stay plain. A NULL doc_id draws as an empty one. Rows that are equal give equal
    rows. ``keep`` may not name results; other columns of ``docs`` are not read.
    """

    def more(pieces: list[Descriptor], buffers: tuple[bytes, bytes], form: str) -> tuple:
        rows = [{"buffer": b, "start": s, "length": n} for b, s, n in pieces]
        return rows, b"".join(stream(pieces, buffers)).decode("utf-8", "replace")

    return _rows(docs, keep, OUTPUT, more, seed, rate, spm_share)


def restore_text(transformed: DataFrame, output: str = "output", form: str = "form", into: str = "restored") -> DataFrame:
    """``transformed`` with the text of before in ``into``, from the output and its form alone; NULL where one is NULL."""
    refuse_names(transformed.columns, [into])

    @F.pandas_udf("string")
    def back(outputs, forms):
        import pandas as pd

        def one(text: str | None, kind: str | None) -> str | None:
            if text is None or kind is None:
                return None
            data = text.encode("utf-8", "surrogatepass")
            return b"".join(stream(restore(data, kind), (data, b""))).decode("utf-8", "surrogatepass")

        return pd.Series([one(t, f) for t, f in zip(outputs, forms, strict=True)], dtype=object)

    return transformed.withColumn(into, back(F.col(f"`{output}`"), F.col(f"`{form}`")))


def digest_rows(docs: DataFrame, keep: list[str], seed: str = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """As fill_in_middle, with the SHA-256 of output and of the text restored from it in place of both texts.

    The output's digest streams its descriptors. The restored one streams descriptors over the output
    itself, found from its bytes and the form; no other knowledge of the text enters it.
    """

    def more(pieces: list[Descriptor], buffers: tuple[bytes, bytes], form: str) -> tuple:
        output = b"".join(stream(pieces, buffers)) if form != "plain" else buffers[TEXT]
        return digest(pieces, buffers), digest(restore(output, form), (output, b""))

    return _rows(docs, keep, DIGESTS, more, seed, rate, spm_share)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, row by row, see digest_rows."""
    return digest_rows(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
k AS (
  SELECT *, len(u)::BIGINT AS n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS hs FROM d),
c AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS a, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 50 THEN 'plain' WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle, coalesce(array_to_string(u[b + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
