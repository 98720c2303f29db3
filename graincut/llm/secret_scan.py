"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

The guess cost of a value is the least cost of cutting it into words, dates,
repeats, keyboard walks and brute-force spans. A span costs the log10 of the
guesses it takes; a dynamic program over positions adds span costs and finds
the cheapest cut. Every value in a credential context is priced, also those
inside a base span; values that stay expensive are secrets, while dictionary
words, counters, dates and walks are not.

Words are ranked by the number of documents they occur in, counted over the
whole corpus outside credential contexts, so that secrets don't teach words.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

KINDS = ("assign", "access", "hex", "guess")
MASK = "[SECRET]"

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: A base assignment cannot match a text that has none of these in lower case.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT_HINTS = (*ASSIGN_HINTS, "pwd", "passphrase", "passcode", "credential", "auth", "bearer", "private_key", "access_key", "login")
#: A scheme word may stand before a value, after ``auth`` any of the usual ones.
_SCHEME = r"(?(auth)(?:(?:bearer|basic|digest|token|negotiate)\x20+)?|(?:bearer\x20+)?)"
#: Wider credential contexts, with any printable value; in quotes it may hold spaces and ends at the quote.
CONTEXT = re.compile(
    r"(?:password|passwd|passphrase|passcode|pwd|secret|token|api_?key|access_key|private_key|credentials?|(?P<auth>auth(?:orization)?)|bearer|login)"
    r"""["']?(?:\x20*(?:[:=]|=>)\x20*"""
    + _SCHEME
    + r"""|\x20+is\x20+(?=["']))(?:"%(s)s(?P<a>[^"\x00-\x1f]+)"|'%(s)s(?P<b>[^'\x00-\x1f]+)'|["']?%(s)s(?P<c>[^"'\x00-\x20]+))""" % {"s": _SCHEME},
    re.I | re.A,
)
MIN_VALUE = 6
#: log10 of the guesses above which a value counts as a secret.
MIN_COST = 8.0

#: The dictionary: at most this many words, those of most documents, two at least; 3 to 24 letters each.
DICTIONARY_WORDS = 100_000
MIN_WORD, MAX_WORD = 3, 24
#: Distinct words that a task counts before it hands the counts on.
COUNTED_WORDS = 400_000
EDGES = ".,;:!?()[]{}<>\"'`*_-/\\|~"

# Common words and password stems, most common first; the rank is the cost.
COMMON_WORDS = (
    "password the and for you with this that have from your name user admin login test none null true false "
    "example sample changeme default value string text data secret token key access public private root guest "
    "welcome hello world love monkey dragon master letmein sunshine princess football baseball shadow superman "
    "money home work time year day people please enter here required optional field form page site email mail "
    "phone address number code file path server client host local production staging development config setting "
    "settings environment variable placeholder dummy foobar foo bar baz qwerty iloveyou summer winter spring "
    "autumn january february march april june july august september october november december monday tuesday "
    "wednesday thursday friday saturday sunday change reset forgot account service database session cookie header "
    "bearer basic hidden redacted masked removed unknown empty".split()
)
WORD_RANK = {w: k for k, w in enumerate(COMMON_WORDS, 1)}
# Rows of the common keyboard layout, and letters that digits and signs stand for.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
STAND_INS = str.maketrans("4@8301!$57", "aabeoiisst")
WALKS = {a + b for row in (*KEY_ROWS, *(x[::-1] for x in KEY_ROWS)) for a, b in zip(row, row[1:])}
WALKS |= {a + b for x, y in zip(KEY_ROWS, KEY_ROWS[1:]) for p, q in ((x, y), (y, x)) for a, b in zip(p, q)}
ORDERS = {chr(c) + chr(c + s) for lo, hi in ((48, 57), (97, 122)) for c in range(lo, hi + 1) for s in (1, -1) if lo <= c + s <= hi}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")
MIN_DATE, MAX_DATE, DATE_COST = 4, 10, 4.6
#: Pairs of neighbours, cost of a walk's start, and of each further key; a walk has three keys at least.
STEPS = ((WALKS, 1.9, 0.1), (ORDERS, 1.4, 0.1))
CAPITALS, STOOD_IN = 0.3, 0.9
LEAST_BRUTE = 1.0


def brute_cost(c: str) -> float:
    """log10 of the alphabet that a character of a brute-force span comes from."""
    if c.isdigit():
        return LEAST_BRUTE
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return math.log10(26 if c.islower() else 52)
    return 1.5 if c < "\x7f" else 2.5


def word_cost(piece: str, ranks: Mapping[str, int]) -> float:
    """Cost of a piece as one dictionary word, in its own letters or those that signs stand for; infinite if it is none."""
    low = lower_letters(piece)
    if rank := ranks.get(low):
        return math.log10(rank + 1) + CAPITALS * (piece != low)
    rank = ranks.get(low.translate(STAND_INS))
    return math.log10(rank + 1) + STOOD_IN if rank else math.inf


def lower_letters(value: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = value.lower()
    return low if len(low) == len(value) else "".join([x if len(x) == 1 else c for c in value for x in (c.lower(),)])


def guess_cost(value: str, ranks: Mapping[str, int] = WORD_RANK, enough: float = math.inf) -> float:
    """log10 guesses of the cheapest segmentation of ``value``; 0 for an empty one.

    A word costs its rank, a date and each walk a fixed start, a repeat (a unit twice or more, three
    characters at least) its unit by brute force and the count, any up to the value's length.

    The cost is exact below ``enough``; from there on, some value that is not less is returned, as
    soon as no segmentation can stay below. That needs units shorter than ``enough`` only, as a
    character costs 1 at least, so time grows with the length, not with its square.
    """
    n = len(value)
    if not n:
        return 0.0
    low = lower_letters(value)
    plain = low.translate(STAND_INS)
    cost = list(map(brute_cost, value))
    longest = max(map(len, ranks), default=1) if not isinstance(ranks, Ranks) else ranks.longest
    count_cost = math.log10(n)
    units = [p for p in range(1, int(min(n // 2, enough / LEAST_BRUTE)) + 1) if p * LEAST_BRUTE + count_cost < enough]
    matched = [0] * (len(units) + 1)  # by unit length: characters so far that equal the one a unit before
    starts = {p: [math.inf] * p for p in units}  # by unit length and place in the unit: least cost before a repeat in this run
    lead, begun = [0] * len(STEPS), [math.inf] * len(STEPS)
    reach = max(longest, MAX_DATE, 2 * len(units), 3)
    best = [0.0] + [math.inf] * n
    for k in range(1, n + 1):
        c = best[k - 1] + cost[k - 1]
        for length in range(2, min(longest, k) + 1):
            before = best[k - length]
            if before >= c:
                continue
            rank = ranks.get(low[k - length : k])
            if rank:
                c = min(c, before + math.log10(rank + 1) + CAPITALS * (value[k - length : k] != low[k - length : k]))
            elif rank := ranks.get(plain[k - length : k]):
                c = min(c, before + math.log10(rank + 1) + STOOD_IN)
        if value[k - 1].isdigit():
            for length in range(MIN_DATE, min(MAX_DATE, k) + 1):
                if best[k - length] + DATE_COST < c and DATE.fullmatch(value, k - length, k):
                    c = best[k - length] + DATE_COST
        for w, (pairs, start, step) in enumerate(STEPS):
            if k < 2 or low[k - 2 : k] not in pairs:
                lead[w], begun[w] = k - 1, math.inf
            elif k - 3 >= lead[w]:
                begun[w] = min(begun[w], best[k - 3] - step * (k - 3))
                c = min(c, begun[w] + start + step * k)
        for p in units:
            if k <= p or value[k - 1] != value[k - 1 - p]:
                if matched[p]:
                    matched[p], starts[p] = 0, [math.inf] * p
                continue
            matched[p] += 1
            times = 3 if p == 1 else 2
            if matched[p] >= (times - 1) * p:
                open_at = starts[p]
                open_at[k % p] = min(open_at[k % p], best[k - times * p])
                c = min(c, open_at[k % p] + sum(cost[k - p : k]) + count_cost)
        best[k] = c
        if k % 32 == 0 and min(best[max(0, k - reach) : k + 1]) >= enough:
            walking = min(b + start + step * k for b, (_, start, step) in zip(begun, STEPS, strict=True))
            if min([walking, *[min(starts[p]) + p * LEAST_BRUTE + count_cost for p in units]]) >= enough:
                return enough
    return best[n]


class Ranks(dict):
    """A dictionary of word ranks that knows its longest word."""

    def __init__(self, ranks: Mapping[str, int]):
        super().__init__(ranks)
        self.longest = max(map(len, self), default=1)

    def __reduce__(self):
        return Ranks, (dict(self),)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch["text"].to_pylist():
            low = (text or "").lower()
            if any(h in low for h in CONTEXT_HINTS):
                low = CONTEXT.sub(" ", low)
            words = {w if w.isalpha() else w.strip(EDGES) for w in set(low.split())}
            counts.update([w for w in words if MIN_WORD <= len(w) <= MAX_WORD and w.isalpha()])
            if len(counts) > COUNTED_WORDS:
                yield out()
                counts.clear()
    yield out()


def learn_words(docs: DataFrame, max_words: int = DICTIONARY_WORDS) -> Ranks:
    """Rank by word: the fixed common words, and the words of ``docs`` (text) that most documents
    hold, ties by the word. Words of one document, whole tokens with digits or signs inside, and
    whatever stands in a credential context are not counted.

    Words fall into classes by the logarithm of their count, eight for each doubling; the classes
    of highest counts that have ``max_words`` words together, at most, are taken whole, so that no
    task sends more than its share of them.
    """
    counted = docs.select("text").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counts = materialize(counted.withColumn("class", F.floor(8 * F.log2("n")).cast("int")), "words")
    # A few hundred classes, then at most max_words short rows, reach the driver.
    room, least = max_words, None
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("class")).collect():
        room -= r["n"]
        if room < 0:
            break
        least = r["class"]
    taken = [] if least is None else counts.where(F.col("class") >= least).select("word", "n").collect()
    ranks = {r["word"]: k for k, r in enumerate(sorted(taken, key=lambda r: (-r["n"], r["word"])), 1)}
    return Ranks(ranks | {w: min(k, ranks.get(w, k)) for w, k in WORD_RANK.items()})


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, whole matches."""
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        yield from ((m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN)
    if "AKIA" in text:
        yield from ((m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS)
    yield from ((m.start(), 2, m.end()) for m in HEX.finditer(text))


def priced_part(value: str, ranks: Mapping[str, int]) -> str:
    """What of a value must be guessed: of several parts between spaces those that are no dictionary words, put together.

    So running text in quotes costs nothing, and digits in groups cost what they cost without spaces.
    """
    parts = value.split(" ")
    if len(parts) == 1:
        return value
    return "".join([p for p in parts if lower_letters(p).strip(EDGES) not in ranks])


def guessed_spans(text: str, ranks: Mapping[str, int] = WORD_RANK, min_cost: float = MIN_COST) -> Iterator[tuple[int, int, int]]:
    """Values in credential contexts that cost enough; closing signs after unquoted ones are left out."""
    low = text.lower()
    if not any(h in low for h in CONTEXT_HINTS):
        return
    for m in CONTEXT.finditer(text):
        a, b = next(m.span(k) for k in "abc" if m.start(k) >= 0)
        while b > a and m.start("c") == a and text[b - 1] in ".,;:)]}>":
            b -= 1
        if b - a >= MIN_VALUE and guess_cost(priced_part(text[a:b], ranks), ranks, min_cost) >= min_cost:
            yield a, 3, b


def find_spans(text: str | None, ranks: Mapping[str, int] = WORD_RANK) -> list[tuple[int, int, int]]:
    """All spans of a whole text, by start, then kind. NULL and empty texts have none."""
    text = text or ""
    return sorted([*base_spans(text), *guessed_spans(text, ranks)])


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def mask_text(text: str | None, ranks: Mapping[str, int] = WORD_RANK) -> str | None:
    """The text with every span, overlapping ones merged, replaced by MASK."""
    spans = find_spans(text, ranks)
    if not spans:
        return text
    out, at, open_to = [], 0, -1
    for a, _, b in spans:
        if a >= open_to:
            out += [text[at:a], MASK]
        open_to = max(open_to, b)
        at = open_to
    return "".join([*out, text[at:]])


def scan(text: Column | str, ranks: Mapping[str, int] = WORD_RANK) -> Column:
    """Struct of counts by kind, the digest of the base spans, and all spans as text.

    NULL and empty texts have no spans: counts of 0, the digest of no bytes, and empty text.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
    def scan_batch(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for x in texts:
            spans = find_spans(x, ranks)
            kinds = [k for _, k, _ in spans]
            base = _join([s for s in spans if s[1] < 3])
            rows.append((kinds.count(0), kinds.count(1), kinds.count(2), kinds.count(3), hashlib.sha256(base.encode()).hexdigest(), _join(spans)))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    return scan_batch(text)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, secrets in ``text`` masked; n_chars follows. No row goes, NULL texts stay NULL."""
    ranks = learn_words(docs)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([mask_text(x, ranks) for x in texts], dtype=object)

    masked = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with a dictionary learned from all of them; NULL and empty texts have no spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", scan("text", learn_words(docs)).alias("s")).select("doc_id", "s.*")
