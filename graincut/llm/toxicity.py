"""Toxicity scores: a linear classifier on character n-grams whose features are
scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (2 to 5 letters, word borders
included) of a text's distinct words, hashed. A logistic regression on presence
times log-count ratio is fitted on labelled rows; its weights, ratios folded in,
are one dense vector that scores all texts in one pass.

All n-grams of a text's distinct words are hashed at once: a rolling hash over
the code points of the words set side by side, without the grams that cross a
border between two words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of_id, read_table

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
GRAMS = (2, 3, 4, 5)
#: The classifier is fitted on at most this many labelled rows, those of least id hash.
MAX_TRAIN_ROWS = 8000
#: Words are hashed in blocks of about this many characters, so that memory does not grow with the text.
BLOCK_CHARS = 1 << 18
#: Parameters of the fit: a feature takes part if this many training rows hold it and its log-count ratio is this far from 0.
MIN_DOCS = 3
MIN_RATIO = 0.5
PENALTY = 30.0  # of the squared weights, against the summed logistic loss
ROUNDS = 60
THRESHOLD = 0.3
#: Start and factors of the rolling hash and of its last mixing, modulo 2^32.
HASH_START, HASH_FACTOR, MIX_FACTOR = np.uint32(2_166_136_261), np.uint32(16_777_619), np.uint32(739_982_445)


def gram_features(words: list[str]) -> np.ndarray:
    """Features of all n-grams of the words, each between < and >; repeats included."""
    joined = "<" + "><".join(words) + ">"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    word_of = np.repeat(np.arange(len(words), dtype=np.int32), np.fromiter(map(len, words), np.int64, len(words)) + 2)
    found, h = [], (codes ^ HASH_START) * HASH_FACTOR
    for n in range(2, max(GRAMS) + 1):
        if len(codes) < n:
            break
        h = (h[:-1] ^ codes[n - 1 :]) * HASH_FACTOR
        if n in GRAMS:
            x = h[word_of[n - 1 :] == word_of[: len(codes) - n + 1]]
            x = (x ^ (x >> np.uint32(15))) * MIX_FACTOR
            found.append(x >> np.uint32(32 - FEATURE_BITS))
    return np.concatenate(found).astype(np.int32)


class TextFeatures:
    """The distinct features of texts; one array of places tells first from later ones."""

    def __init__(self):
        self.place = np.zeros(FEATURES, np.int32)

    def distinct(self, features: np.ndarray) -> np.ndarray:
        """Each feature once, where it stands last."""
        at = np.arange(len(features), dtype=np.int32)
        self.place[features] = at
        return features[self.place[features] == at]

    def of(self, text: str | None) -> np.ndarray:
        """Distinct features of one whole text; none for NULL and empty ones."""
        words = list(dict.fromkeys((text or "").lower().split()))
        found, block, size = np.zeros(0, np.int32), [], 0
        for w in words if len(text or "") > BLOCK_CHARS else ():
            block.append(w)
            size += len(w)
            if size > BLOCK_CHARS:
                found = self.distinct(np.concatenate([found, gram_features(block)]))
                block, size = [], 0
        block = words if len(text or "") <= BLOCK_CHARS else block
        return self.distinct(np.concatenate([found, gram_features(block)])) if block else found


_features = TextFeatures()


def _minimize(loss, x: np.ndarray, rounds: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with step halving; ``loss`` gives value and gradient."""
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step, used = slope.copy(), []
        for s, y in reversed(moves):
            used.append(s @ step / (s @ y))
            step -= used[-1] * y
        step *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, float(np.linalg.norm(slope)))
        for (s, y), a in zip(moves, reversed(used), strict=True):
            step += s * (a - y @ step / (s @ y))
        size = 1.0
        while True:
            after, new_slope = loss(x - size * step)
            if after <= value - 1e-4 * size * (slope @ step) or size < 1e-6:
                break
            size /= 2
        s, y = -size * step, new_slope - slope
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        small = abs(value - after) < 1e-6 * max(1.0, abs(value))
        x, value, slope = x + s, after, new_slope
        if small:
            break
    return x


def fit(features: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by feature (float32, ratios folded in) and intercept.

    Without both classes among the rows, all weights are 0 and the intercept
    is the smoothed log odds.
    """
    y = toxic.astype(np.float64)
    n, n_pos = len(y), y.sum()
    odds = float(np.log((n_pos + 1) / (n - n_pos + 1)))
    weights = np.zeros(FEATURES, np.float32)
    if n_pos == 0 or n_pos == n:
        return weights, odds
    flat = np.concatenate(features)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in features])
    docs = np.bincount(flat, minlength=FEATURES)
    pos = np.bincount(flat, y[row], minlength=FEATURES)
    ratio = np.log((pos + 1) / (n_pos + 2)) - np.log((docs - pos + 1) / (n - n_pos + 2))
    used = np.flatnonzero((docs >= MIN_DOCS) & (np.abs(ratio) > MIN_RATIO))
    number = np.full(FEATURES, -1, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    col = number[flat]
    row, col, r = row[col >= 0], col[col >= 0], ratio[used]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        theta = x[:-1]
        z = x[-1] + np.bincount(row, (r * theta)[col], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        value = np.mean(np.logaddexp(0, z) - y * z) + PENALTY / n / 2 * (theta @ theta)
        return value, np.append(np.bincount(col, error[row], minlength=len(used)) * r + PENALTY / n * theta, error.sum())

    x = _minimize(loss, np.append(np.zeros(len(used)), odds), ROUNDS)
    weights[used] = r * x[:-1]
    return weights, float(x[-1])


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("doc_id", kind="stable")
    weights, bias = fit([_features.of(x) for x in rows["text"]], rows["toxic"].to_numpy())
    return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights and intercept from documents (doc_id, text) with labels (doc_id, toxic).

    A doc_id with several labels is toxic if any says so; with several texts,
    the least text counts; NULL ids, labels and texts teach nothing. The rows
    used are the max_rows of least id hash, fitted in one task.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("toxic"))
    # Labels without a text don't use up the bound.
    with_text = docs.where("text is not null").select(F.col("doc_id").alias("__doc"))
    chosen = known.join(with_text, F.col("__id") == F.col("__doc"), "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
    # At most max_rows narrow rows: the bound that allows the broadcast.
    rows = docs.where("text is not null").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    model = rows.groupBy().applyInPandas(_fit_group, "weights binary, bias double").first()
    if model is None:
        return np.zeros(FEATURES, np.float32), 0.0
    return np.frombuffer(model["weights"], np.float32), model["bias"]


def score(text: Column | str, weights: np.ndarray, bias: float) -> Column:
    """Probability of toxicity of whole texts; that of no features for NULL and empty ones."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            z = np.array([bias + float(weights[_features.of(x)].sum(dtype=np.float64)) for x in texts])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))), dtype="float64")

    return scored(text)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a NULL doc_id is not held out and has no label, NULL and empty texts get the score of no features."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lambda c: F.coalesce(crc32_of_id(F.col(c)) % 4 == 2, F.lit(False))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id"))
    weights, bias = train(docs, labels)
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), score("text", weights, bias).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
