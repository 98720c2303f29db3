"""What each method itself gives, against plain loops: mixes by content, guess costs, model scores, long texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from graincut.llm import lm_scores, mixing, packing, quality, queries, secret_scan, simhash, toxicity

from .conftest import DOCS, odd_documents

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def as_key(row):
    return tuple((x is None, str(x)) for x in row)


# Mixing.
def mixed_by_hand(rows, names, seed="42"):
    """The mix of rows (tuples by names), one source, document and word at a time."""
    source, text = names.index("source"), names.index("text")
    sized = [(r, len(WORD.findall((r[text] or "").encode()))) for r in rows]
    totals = defaultdict(int)
    for r, n in sized:
        totals[r[source]] += n
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, room = {}, set(order), 1.5 * sum(totals.values())
    while left:
        level = room / sum(weight[s] for s in left)
        full = {s for s in left if 2 * totals[s] <= level * weight[s]}
        for s in full or left:
            target[s] = 2 * totals[s] if full else level * weight[s]
        room -= sum(2 * totals[s] for s in full)
        left -= full or left

    def key(r):
        parts = ["~" if x is None else f"{len(str(x).encode())}:{x}" for x in r]
        return hashlib.md5("|".join([seed, *parts]).encode()).hexdigest()

    out = []
    for s in order:
        own = sorted([(r, n) for r, n in sized if r[source] == s and n], key=lambda x: key(x[0]))
        epochs = int(target[s] // totals[s]) if totals[s] else 0
        rest = math.floor(target[s]) - epochs * totals[s]
        for r, n in own:
            out += [r] * epochs
            if rest >= n:
                out.append(r)
            elif rest > 0:
                data = r[text].encode()
                cut = data[: [m.end() for m in WORD.finditer(data)][rest - 1]].decode()
                out.append(tuple(cut if k == text else len(cut) if name == "n_chars" else x for k, (x, name) in enumerate(zip(r, names))))
            rest = max(0, rest - n)
    return out


CLASHES = [
    (1, "2|foo bar baz", "x", 1), (2, "foo bar baz", "x|1", 1), (3, "~", "y", 1), (3, None, "y", 1), (4, "~", None, 1), (4, "~", "~", 1),
    *[(5, "the same row of six words", "y", 1)] * 7, *[(6, "rows that differ in one column only", "z", k) for k in range(5)], (7, "", "z", None), (8, " \n\t ", "only blanks", 1),
]


@pytest.mark.parametrize("case", ["clashes", "odd", "one document", "empty"])
def test_mixed_documents_by_content(spark, case):
    if case == "odd":
        rows, schema = odd_documents(), DOCS
    else:
        schema = "doc_id long, text string, source string, extra int"
        rows = {"clashes": CLASHES, "one document": CLASHES[:1], "empty": []}[case]
    docs = spark.createDataFrame(rows, schema)
    found = [tuple(r) for r in mixing.mix_documents(docs).collect()]
    assert sorted(found, key=as_key) == sorted(mixed_by_hand(rows, docs.columns), key=as_key)


def test_equal_rows_hold_the_cut(spark, monkeypatch):
    monkeypatch.setattr(mixing, "EXPAND_CHUNK", 4)
    rows = [(1, "a b c d e", "s", 1)] * 33 + [(2, "one two", "t", 1)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(3)
    found = [tuple(r) for r in mixing.mix_documents(docs).collect()]
    assert sorted(found, key=as_key) == sorted(mixed_by_hand(rows, docs.columns), key=as_key)


def test_row_keys_tell_rows_apart(spark):
    rows = [(a, b) for a in (None, "~", "", "1:x", "x", "x|1", "x|1:y") for b in (None, "~", "", "1:y", "y", "1:x|y")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(mixing.row_key("42", df.a, df.b).alias("k")).distinct().count() == len(rows)


# Quality.
def test_hosts_stand_out_against_the_prior(spark):
    good = " ".join(f"w{k}" for k in range(12))
    rows = [(h * 1000 + k, "bad" if k < (40 if h == 7 else 5) else good, f"host{h}") for h in range(12) for k in range(100)]
    rows += [(90_000, None, None), (90_001, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = {r["doc_id"]: r for r in quality.judge_documents(docs, ["doc_id"]).collect()}
    assert {i for i, r in judged.items() if not r["kept"] and not r["base_failed"]} == {7000 + k for k in range(40, 100)}
    assert judged[7099]["host_rate"] < 0.5
    assert {r["doc_id"] for r in quality.keep_documents(docs).collect()} == {i for i, r in judged.items() if r["kept"]}


# Secrets.
def span_cost(value, i, j, ranks):
    piece = value[i:j]
    low, n, costs = secret_scan.lower_letters(piece), j - i, [math.inf]
    if n == 1:
        costs.append(secret_scan.brute_cost(piece))
    else:
        costs.append(secret_scan.word_cost(piece, ranks))
    if secret_scan.DATE.fullmatch(piece):
        costs.append(secret_scan.DATE_COST)
    if n >= 3:
        costs += [start + step * n for pairs, start, step in secret_scan.STEPS if all(low[k : k + 2] in pairs for k in range(n - 1))]
        costs += [sum(map(secret_scan.brute_cost, piece[:u])) + math.log10(len(value)) for u in range(1, n // 2 + 1) if piece == piece[:u] * (n // u) and n % u == 0]
    return min(costs)


def cheapest(value, ranks):
    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + span_cost(value, i, j, ranks) for i in range(j)))
    return best[-1]


def test_guess_cost_is_that_of_the_cheapest_segmentation():
    rng = random.Random(1)
    parts = ["password", "123", "qwe", "zxcv", "2021-03-04", "aa", "abab", "x7$", "Q", "19990101", "P4ss", "cat", "xyz1xyz1", "0", "İ", "é"]
    ranks = secret_scan.Ranks({"cat": 7, "password": 1, "ba": 3})
    for t in range(800):
        value = "".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))[: rng.randint(1, 30)] if t % 2 else "".join(rng.choice("ab1q") for _ in range(rng.randint(1, 18)))
        want, short = cheapest(value, ranks), secret_scan.guess_cost(value, ranks, 8.0)
        assert math.isclose(secret_scan.guess_cost(value, ranks), want, abs_tol=1e-9)
        assert math.isclose(short, want, abs_tol=1e-9) if want < 8 else short >= 8


def test_guess_cost_knows_no_length():
    cost = secret_scan.guess_cost
    for n in (256, 257, 2000):
        assert math.isclose(cost("ab" * n, enough=8.0), 2 * math.log10(26) + math.log10(2 * n))
    nine = "k9#Lq$7xZ"
    assert cost(nine * 2) < cost(nine) + 2
    assert cost("-" * 100_000, enough=8.0) < 8 <= cost("x7$kQ9!pLmZ" * 9000, enough=8.0)


def test_words_of_the_corpus_are_no_secrets(spark):
    texts = ["Documentation, and understanding!", "see the documentation of elephant", "understanding an elephant", "pass x9k2 here, see", None, ""]
    texts += ["auth: zebrafish", "login = zebrafish"]  # words in a context teach nothing
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id long, text string")
    ranks = secret_scan.learn_words(docs)
    assert {"documentation", "understanding", "elephant"} <= set(ranks) and "zebrafish" not in ranks and "x9k2" not in ranks
    spans = lambda x: secret_scan.find_spans(x, ranks)
    assert not any(map(spans, ("auth: documentation", "bearer: Understanding", "login: elephant.", "login is 'see the documentation'")))
    assert spans("auth: x7$kQ9!pLmZ, ok") == [(6, 3, 17)]
    assert spans('secret: "k9#Lq x$71Zp!" ok') == [(9, 3, 22)]
    assert spans("password=hJ8fK2qLw9") == [(0, 0, 19), (9, 3, 19)] and spans("password=changeme") == [(0, 0, 17)]
    scanned = spark.createDataFrame([(k, x) for k, x in enumerate(["login: x7$kQ9!pLmZ", None, ""])], "k int, text string").select("k", secret_scan.scan("text", ranks).alias("s"))
    assert sorted((r["k"], r["s"]["n_guess"], r["s"]["spans"]) for r in scanned.collect()) == [(0, 1, "guess:7:18"), (1, 0, ""), (2, 0, "")]


def test_masks_on_odd_rows(spark):
    docs = spark.createDataFrame(odd_documents(), DOCS)
    ranks = secret_scan.learn_words(docs)
    want = []
    for r in odd_documents():
        masked = secret_scan.mask_text(r[1], ranks)
        want.append((r[0], masked, *r[2:4], None if masked is None else len(masked), *r[5:]))
    assert sorted((tuple(r) for r in secret_scan.mask_secrets(docs).collect()), key=as_key) == sorted(want, key=as_key)
    assert "x7$kQ9!pLmZ" not in str(want) and "AKIAABCD" not in str(want)


# Toxicity.
def grams_by_hand(text):
    found = set()
    for word in set((text or "").lower().split()):
        shown = f"<{word}>"
        for n in toxicity.GRAMS:
            for i in range(len(shown) - n + 1):
                h = int(toxicity.HASH_START)
                for c in shown[i : i + n]:
                    h = ((h ^ ord(c)) * int(toxicity.HASH_FACTOR)) & 0xFFFFFFFF
                found.add((((h ^ (h >> 15)) * int(toxicity.MIX_FACTOR)) & 0xFFFFFFFF) >> (32 - toxicity.FEATURE_BITS))
    return found


@pytest.mark.parametrize("block", [7, 1 << 18])
def test_features_are_the_ngrams_of_the_words(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK_CHARS", block)
    features = toxicity.TextFeatures()
    for text in [r[1] for r in odd_documents(14)] + ["a", "< > <> ><", "x" * 300]:
        found = features.of(text).tolist()
        assert len(found) == len(set(found)) and set(found) == grams_by_hand(text)


def test_weights_are_log_count_ratios_times_fitted_ones():
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 120)
    features = [np.unique(rng.integers(0, 30, 8) + 40 * int(t)).astype(np.int32) for t in y]
    weights, bias = toxicity.fit(features, y)
    n_pos, used = int(y.sum()), {}
    for f in range(80):
        pos, docs = (sum(f in x.tolist() for x, t in zip(features, y) if t >= least) for least in (1, 0))
        ratio = math.log((pos + 1) / (n_pos + 2)) - math.log((docs - pos + 1) / (len(y) - n_pos + 2))
        if docs >= toxicity.MIN_DOCS and abs(ratio) > toxicity.MIN_RATIO:
            used[f] = ratio
    assert set(np.flatnonzero(weights)) <= set(used)

    def loss(theta, b):
        z = [b + sum(used[f] * theta[f] for f in x.tolist() if f in used) for x in features]
        return sum(math.log1p(math.exp(-v if t else v)) for v, t in zip(z, y)) + toxicity.PENALTY / 2 * sum(v * v for v in theta.values())

    theta = {f: float(weights[f]) / r for f, r in used.items()}
    least = loss(theta, bias)
    for f in list(used)[::5]:
        assert all(loss({**theta, f: theta[f] + d}, bias) > least - 1e-3 for d in (-0.02, 0.02))
    assert all(loss(theta, bias + d) > least - 1e-3 for d in (-0.05, 0.05))


def test_scores_of_the_query_are_those_of_the_fitted_rows(spark, tables):
    labels = defaultdict(int)
    for r in spark.read.parquet(tables["odd"] + "/labels.parquet").collect():
        if r["doc_id"] is not None and r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            labels[r["doc_id"]] = max(labels[r["doc_id"]], r["toxic"])
    texts = {}
    for r in odd_documents():
        if r[0] in labels and r[1] is not None:
            texts[r[0]] = min(r[1], texts.get(r[0], r[1]))
    features, ids = toxicity.TextFeatures(), sorted(texts)
    weights, bias = toxicity.fit([features.of(texts[i]) for i in ids], np.array([labels[i] for i in ids]))
    want = [(r[0], round(1 / (1 + math.exp(-bias - float(weights[list(grams_by_hand(r[1]))].sum(dtype=np.float64)))), 9)) for r in odd_documents()]
    found = [(r["doc_id"], round(r["score"], 9)) for r in queries.QUERIES["op4_toxicity"](spark, tables["odd"]).collect()]
    assert sorted(found, key=as_key) == sorted(want, key=as_key)


def test_labels_without_a_text_use_up_no_rows(spark):
    docs = spark.createDataFrame([(k, f"horrid word{k}" if k % 2 else f"calm word{k}") for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(2000)], "doc_id long, toxic int")
    weights, _ = toxicity.train(docs, labels, 20)
    assert np.count_nonzero(weights)


# Language-model scores.
def arcs_of(text, pieces, byte_p, longest):
    for i, c in enumerate(text):
        if c not in pieces:
            yield i, i + 1, sum(byte_p[b] for b in c.encode()), c
        yield from ((i, j, pieces[text[i:j]], text[i:j]) for j in range(i + 1, min(len(text), i + longest) + 1) if text[i:j] in pieces)


def add_logs(values):
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def lattice_by_hand(text, pieces, byte_p):
    """(log-probability, expected uses of pieces, of bytes) over all segmentations, forwards and backwards."""
    arcs = list(arcs_of(text, pieces, byte_p, max(map(len, pieces))))
    ahead, back = {0: 0.0}, {len(text): 0.0}
    for j in range(1, len(text) + 1):
        ahead[j] = add_logs([ahead[a] + p for a, b, p, _ in arcs if b == j])
    for i in range(len(text) - 1, -1, -1):
        back[i] = add_logs([p + back[b] for a, b, p, _ in arcs if a == i])
    uses, of_bytes = Counter(), Counter()
    for a, b, p, x in arcs:
        share = math.exp(ahead[a] + p + back[b] - back[0])
        if x in pieces:
            uses[x] += share
        else:
            of_bytes.update({byte: share * x.encode().count(byte) for byte in set(x.encode())})
    return back[0], uses, of_bytes


def test_document_scores_by_hand(spark):
    texts = ["the cat sat on the mat", "The cat naïve 日本 cat", "", None, "banana bandana", "the 🙂 q", "cat cat cat cat"]
    rows = [(k, x, k != 5) for k, x in enumerate(texts)]
    found = lm_scores.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), ["doc_id"]).collect()
    model = lm_scores._load(lm_scores.vocabulary_path(lm_scores.VOCABULARY))
    names = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    tokens = lambda x: (x or "").lower().split()
    words, ends = Counter(w for _, x, train in rows if train for w in tokens(x)), sum(train for *_, train in rows)

    def learned(n):
        n[model.eos_id()] = ends
        return np.log((n + 0.1) / (n.sum() + 0.1 * len(n)))

    n = np.zeros(model.get_piece_size())
    for w, c in words.items():
        for i in model.encode(w):
            n[i] += c
    log_p = learned(n)
    for _ in range(lm_scores.EM_ROUNDS):
        n = np.zeros(model.get_piece_size())
        for w, c in words.items():
            _, uses, of_bytes = lattice_by_hand("▁" + w, {x: log_p[i] for x, i in names.items()}, log_p[byte_ids])
            for x, v in uses.items():
                n[names[x]] += c * v
            for b, v in of_bytes.items():
                n[byte_ids[b]] += c * v
        log_p = learned(n)
    pieces = {x: log_p[i] for x, i in names.items()}
    for r in found:
        want = log_p[model.eos_id()] + sum(lattice_by_hand("▁" + w, pieces, log_p[byte_ids])[0] for w in tokens(texts[r["doc_id"]]))
        assert math.isclose(r["score"], want / math.log(10), rel_tol=1e-5), r


def test_index_over_many_chunks(monkeypatch):
    import pyspark

    monkeypatch.setattr(lm_scores, "CHUNK_DOCS", 4)
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 400)
    monkeypatch.setattr(lm_scores, "COUNT_BITS", 3)
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 2})()))
    texts = ["a b a", "", None, "b " * 20, "c", "d e " * 150, "a", "a", "a", "a"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + 3], pa.string()), pa.array([True] * len(texts[k : k + 3]))], names=["text", "train"]) for k in range(0, len(texts), 3)]
    found, n_words, chunks = defaultdict(Counter), {}, set()
    for of_docs, out in lm_scores._index_chunks(iter(batches)):
        for r in out.to_pylist():
            if of_docs:
                n_words[r["row"]] = r["n_words"]
            else:
                chunks.add(r["chunk"])
                for p in r["postings"]:
                    found[r["chunk"] * 4 + (p >> 3)][r["word"].decode()] += p & 7
    want = [Counter((x or "").split()) for x in texts]
    assert len(chunks) >= 3 and sorted(n_words.values()) == sorted(sum(c.values()) for c in want)
    assert sorted(sorted(found[r].items()) for r in n_words) == sorted(sorted(c.items()) for c in want)
    assert all(sum(found[r].values()) == n for r, n in n_words.items())


# Near-duplicates and packing.
def test_fingerprint_of_a_long_text():
    words = [f"w{k * k % 977}" for k in range(simhash.BLOCK + 700)]
    ones = [0] * 64
    shingles = Counter(" ".join(words[k : k + 3]) for k in range(len(words) - 2))
    for s, n in shingles.items():
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += n * (h >> b & 1)
    want = sum(1 << b for b in range(64) if 2 * ones[b] > sum(shingles.values()))
    assert simhash.fingerprint_text(" ".join(words)) % (1 << 64) == want


def test_keep_one_leaves_the_least_of_each_component(spark):
    rows = odd_documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    component = defaultdict(set)
    for r in simhash.near_duplicates(docs, ["doc_id", "text"]).collect():
        component[r["component_id"]].add(r["text"])
    kept = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert sorted(r[0] for r in kept) == sorted(component) and set(kept) <= set(rows)
    assert all(r[1] in component[r[0]] for r in kept)


def test_names_of_results_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, "x")], "length long, text string"), ["length"])
