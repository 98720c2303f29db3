"""Every operator against brute force on odd rows, and on empty tables."""

import hashlib
import math
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from graincut.llm import lm_scores, mixing, packing, queries, secret_scan, sharding, simhash, token_counts, topk, toxicity

from .conftest import odd_documents

DOCS = [(r[0], r[1]) for r in odd_documents()]


def rows(spark, name, folder):
    return queries.QUERIES[name](spark, folder).collect()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables_give_no_rows(spark, tables, name):
    assert rows(spark, name, tables["empty"]) == []


def test_pipeline_on_odd_and_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables["empty"]).collect() == []
    docs = spark.read.parquet(tables["odd"] + "/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, tables["odd"]).cache()
        assert after.columns == docs.columns
        docs = after
    packed = corpus_pipeline.run(spark, tables["odd"]).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())


def test_sharding_is_even_gapless_and_reproducible(spark, tables):
    found = rows(spark, "op1_sharding", tables["odd"])
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(DOCS) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    key = lambda r: tuple(str(x) for x in r)
    docs = spark.read.parquet(tables["odd"] + "/documents.parquet")
    a, b = (sharding.shard_rows(docs.repartition(k).select("doc_id", "text"), ["doc_id", "text"], 3).collect() for k in (1, 9))
    assert sorted(a, key=key) == sorted(b, key=key)
    copies = sharding.shard_rows(spark.range(70_000).selectExpr("1 as same"), ["same"], 8)
    assert copies.selectExpr("count(distinct position)", "max(position)").first() == (70_000, 69_999)


def test_quality_measures(spark, tables):
    found = Counter((r["doc_id"], r["n_words"], r["n_repeat_words"], r["base_failed"]) for r in rows(spark, "op2_quality_rules", tables["odd"]))
    want = Counter()
    for i, text in DOCS:
        w = (text or "").encode().split()
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + d for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for d in range(5)}
        want[i, len(w), len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)] += 1
    assert found == want


def test_blocked_host_loses_all_its_documents(spark):
    from graincut.llm import quality

    good = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(k, good if k % 10 else "bad", "clean") for k in range(50)] + [(100 + k, "bad" if k % 10 else good, "spam") for k in range(50)], "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in quality.keep_documents(docs).collect()}
    assert kept == {k for k in range(50) if k % 10}
    assert {r["doc_id"] for r in quality.judge_documents(docs, ["doc_id"]).where("kept").collect()} == kept


def nearest(vectors, queries, k):
    """(query_id, rank, vec_id, score) of each query row against every other row."""
    for n, (q, own) in enumerate(vectors):
        if queries(q):
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own, v)))), i) for m, (i, v) in enumerate(vectors) if m != n)
            yield from ((q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1))


def test_topk_matches_brute_force(spark, tables):
    vectors = []
    for r in spark.read.parquet(tables["odd"] + "/embeddings.parquet").collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((r["vec_id"], [min(math.floor(x * 1024), 2**63 - 1) for x in v]))
    want = nearest(vectors, lambda q: q % 100 == 0, 10)
    assert sorted(tuple(r) for r in rows(spark, "op3_topk_search", tables["odd"])) == sorted(want)


def test_topk_over_many_shards_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 15)
    rng = np.random.default_rng(4)
    vectors = [(int(i), [int(x) for x in rng.integers(-4, 5, 6)]) for i in rng.integers(0, 500, 700)]
    vectors += [(1000, [1] * 6)] * 90  # one id, one vector, many rows
    found = topk.top_k(spark.createDataFrame(vectors, "vec_id long, v array<bigint>"), F.col("vec_id") % 20 == 0, 5)
    assert sorted(tuple(r) for r in found.collect()) == sorted(nearest(vectors, lambda q: q % 20 == 0, 5))


def test_tree_search_is_exact_with_many_ties():
    rng = np.random.default_rng(0)
    points = rng.integers(-3, 4, (700, 5))
    points[:300] = points[0]
    ids, numbers = rng.permutation(700), np.arange(700)
    search = topk.BlockSearch(ids[:20], numbers[:20], points[:20], 10)
    for part in np.array_split(np.arange(700), 3):
        search.search(topk.build_tree(ids[part], numbers[part], points[part], 16))
    for k, best in enumerate(search.best):
        scores = points @ points[k]
        want = sorted((-int(s), int(i)) for s, i in zip(scores, ids) if i != ids[k])[:10]
        assert sorted((-s, -i) for s, i, _ in best) == want


def test_toxicity_learns_planted_words():
    rng = np.random.default_rng(1)
    words = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna"]
    texts, y = [], []
    for k in range(300):
        w = list(rng.choice(words, 30))
        if k % 5 == 0:
            w[3] = "horrid"
        texts.append(" ".join(w))
        y.append(int(k % 5 == 0))
    features = toxicity.TextFeatures()
    weights, bias = toxicity.fit([features.of(t) for t in texts[:200]], np.array(y[:200]))
    z = np.array([bias + weights[features.of(t)].sum() for t in texts[200:]])
    assert ((z > 0) == np.array(y[200:], bool)).all()


def test_toxicity_scores_every_row(spark, tables):
    found = rows(spark, "op4_toxicity", tables["odd"])
    assert len(found) == len(DOCS) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)


def test_mixing_takes_exact_budgets(spark, tables):
    docs = spark.read.parquet(tables["odd"] + "/documents.parquet")
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(DOCS) and all(0 <= r["taken"] <= 2 * r["size"] for r in plan)
    by = defaultdict(int)
    for r in plan:
        by[r["source"], r["target"]] += r["taken"]
    assert all(n == math.floor(t) for (_, t), n in by.items())
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r["text"].encode().split()) for r in mixed.collect()) == sum(r["taken"] for r in plan)


def test_packing_round_trip(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path("word_bpe_49k.json"))
    found = packing.pack(spark.read.parquet(tables["odd"] + "/documents.parquet"), ["doc_id"], capacity=64).collect()
    want = Counter()
    for i, text in DOCS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            piece = ids[k : k + 64]
            want[i, k // 64, k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 64


def test_packed_sequences_are_built_from_the_result_alone(spark, tables):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.tokenizer_path("word_bpe_49k.json"))
    docs = spark.read.parquet(tables["odd"] + "/documents.parquet")
    found = packing.pack(docs.union(docs), ["doc_id"], capacity=64).collect()
    sequences = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == len(sequences[r["sequence_id"]])
        sequences[r["sequence_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert max(map(len, sequences.values())) <= 64
    texts = defaultdict(list)
    for r in found:
        texts[r["doc_id"], r["piece"]].append(sequences[r["sequence_id"]][r["offset"] :][: r["length"]])
    want = defaultdict(list)
    for i, text in DOCS:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 64):
            want[i, k // 64] += [ids[k : k + 64]] * 2
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}


def test_last_pipeline_stage_returns_token_ids(spark, tables):
    name, stage = corpus_pipeline.STAGES[-1]
    packed = stage(spark, spark.read.parquet(tables["odd"] + "/documents.parquet"), tables["odd"]).collect()
    assert name == "packing" and packed and all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in packed)


def test_plan_fills_sequences_like_best_fit():
    rng = np.random.default_rng(2)
    lengths = Counter(int(x) for x in rng.integers(1, 65, 3000))
    plan = packing.plan_slots(lengths, 64)
    used = Counter()
    for length, _, count, first, per, _ in plan:
        for j in range(count):
            used[first + j // per] += length
    assert sum(used.values()) == sum(k * n for k, n in lengths.items()) and max(used.values()) <= 64
    open_rooms = []
    for length in sorted(lengths.elements(), reverse=True):
        fits = [k for k, r in enumerate(open_rooms) if r >= length]
        if fits:
            open_rooms[min(fits, key=lambda k: open_rooms[k])] -= length
        else:
            open_rooms.append(64 - length)
    assert len(used) == len(open_rooms)


def hot_lengths():
    rng = np.random.default_rng(3)
    yield Counter({n: 800 for n in (2500, 798, 533, 450, 300)})
    yield Counter([*[2500] * 700, *[790] * 900, *rng.integers(400, 801, 900).tolist()])
    yield Counter([*[3000] * 500, *[7] * 5000, *rng.integers(1, 600, 900).tolist()])


@pytest.mark.parametrize("lengths", list(hot_lengths()))
def test_plan_fills_open_sequences_where_few_lengths_hold_many_rows(lengths):
    places = defaultdict(list)
    ranks = Counter()
    for length, rank, count, first, per, offset in packing.plan_slots(lengths, 4096):
        assert rank == ranks[length]
        ranks[length] += count
        for j in range(count):
            places[first + j // per].append((offset + j % per * length, length))
    assert ranks == lengths
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:k]) for k in range(len(p))] and sum(n for _, n in p) <= 4096
    rooms, opened = [], 0
    for length in sorted(lengths.elements(), reverse=True):
        k = bisect_left(rooms, length)
        if k == len(rooms):
            opened += 1
        insort(rooms, (rooms.pop(k) if k < len(rooms) else 4096) - length)
    assert len(places) == opened


def test_token_counts_of_every_prefix(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.TOKENIZER)
    library, counter = Tokenizer.from_file(path), token_counts.PrefixCounter(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for _, text in DOCS[:14]:
        head = (text or "")[:150]
        assert list(token_counts.counts_at(counter.deltas(head))) == [count(head[:k]) for k in range(1, len(head) + 1)]
    for r in rows(spark, "op7_token_counts", tables["odd"]):
        if r["doc_id"] is not None:
            text = dict(DOCS)[r["doc_id"]] or ""
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (count(text), len(text.encode()), count(text) > 1024)
            assert count(text[: r["limit_chars"]]) <= 1024


def test_secret_spans(spark, tables):
    import re

    for r in rows(spark, "op8_secrets", tables["odd"]):
        text = dict(DOCS)[r["doc_id"]] or ""
        pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        spans = [(m.start(), 0, m.end()) for m in re.finditer(pattern, text, re.I | re.A) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
    assert secret_scan.mask_text("password = 'x7$kQ9!pLmZ' ok") == "password = '[SECRET]' ok"
    assert secret_scan.mask_text("password: changeme123") != "password: changeme123"  # a base span stays a span
    assert secret_scan.mask_text("pwd: changeme") == "pwd: changeme"


def test_guess_cost_order():
    cost = secret_scan.guess_cost
    assert max(map(cost, ("password", "2021-03-04", "qwertyuiop", "aaaaaaaaaa", "letmein", "p4ssw0rd"))) < 6 < cost("x7$kQ9!p") < cost("x7$kQ9!pLmZ2")
    assert cost("") == 0 and cost("ab" * 500) > 0


def test_simhash_components(spark, tables):
    found = rows(spark, "op9_simhash", tables["odd"])
    prints = []
    for i, text in DOCS:
        w = (text or "").encode().lower().split()
        s = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        prints.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    assert Counter((r["doc_id"], int(r["fingerprint"], 16)) for r in found) == Counter(prints)
    parent = {f: f for _, f in prints}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in parent:
        for b in parent:
            if (a ^ b).bit_count() <= 3:
                parent[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i, f in prints:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    assert Counter(r["component_id"] for r in found) == Counter(least.get(top(f)) for _, f in prints)


def test_near_pairs_connect_all_within_three_bits(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 12)]
    prints = set(base)
    for x in base:
        for bits in (1, 2, 3, 4):
            y = x
            for b in rng.choice(64, bits, replace=False):
                y ^= 1 << int(b)
            prints.add(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    links = simhash.near_pairs(spark.createDataFrame([(signed(x),) for x in prints], "fp long"))
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    for a in prints:
        for b in prints:
            if a != b and (a ^ b).bit_count() <= 3:
                assert roots[signed(a)] == roots[signed(b)]


def test_lattice_sums_over_all_segmentations():
    p = {"▁": 0.1, "a": 0.2, "b": 0.3, "ab": 0.15, "▁a": 0.05, "▁ab": 0.07}
    lattice = lm_scores.Lattice({k: math.log(v) for k, v in p.items()}, [math.log(0.001)] * 256)

    def brute(s):
        return 1.0 if not s else sum(p[s[:k]] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in p)

    for word in ("a", "ab", "abab", "ba"):
        assert math.isclose(math.exp(lattice.log_probability(word)), brute("▁" + word), rel_tol=1e-12)
    assert math.isclose(math.exp(lattice.log_probability("é")), 0.1 * 0.001**2, rel_tol=1e-12)


def test_expected_uses_are_those_of_all_segmentations():
    p = {"▁": 0.1, "a": 0.2, "b": 0.3, "ab": 0.15, "▁a": 0.05, "▁ab": 0.07}
    lattice = lm_scores.Lattice({k: math.log(v) for k, v in p.items()}, [math.log(0.001)] * 256)

    def cuts(s):
        if not s:
            yield 1.0, []
        for k in range(1, len(s) + 1):
            if s[:k] in p:
                yield from ((p[s[:k]] * q, [s[:k], *rest]) for q, rest in cuts(s[k:]))

    for word, times in (("a", 1), ("ab", 3), ("abab", 7), ("baab", 2)):
        uses, all_cuts = Counter(), list(cuts("▁" + word))
        total = sum(q for q, _ in all_cuts)
        lattice.expect(word, times, uses, [0] * 256)
        for piece in p:
            want = times * sum(q * pieces.count(piece) for q, pieces in all_cuts) / total
            assert abs(uses[piece] / lm_scores.PARTS - want) < 1e-6
    uses, of_bytes = Counter(), [0] * 256
    lattice.expect("aé", 2, uses, of_bytes)
    assert [b for b in range(256) if of_bytes[b]] == sorted("é".encode()) and of_bytes[0xC3] == 2 * lm_scores.PARTS


def test_expected_uses_with_and_without_logarithms():
    model = lm_scores._load(lm_scores.vocabulary_path(lm_scores.VOCABULARY))
    lattice = lm_scores._lattice(model, np.random.default_rng(5).normal(-11, 2, model.get_piece_size()))
    for word in ("a", "banana", "naïve", "日本語", "𝔘x9", "supercalifragilistic"):
        plain, logs = lattice._shares("▁" + word), lattice._log_shares("▁" + word)
        assert [x[:2] for x in plain] == [x[:2] for x in logs]
        assert np.allclose([x[2] for x in plain], [x[2] for x in logs], rtol=1e-9)
    assert lattice._shares("▁" + "日本" * 300) is None  # too small for plain probabilities
    uses, of_bytes = {}, [0] * 256
    lattice.expect("ab" * 2500, 1, uses, of_bytes)
    assert abs(sum(len(x) * n for x, n in uses.items()) / lm_scores.PARTS - 5001) < 50


def test_each_round_raises_the_smoothed_likelihood():
    """With smoothed counts, what a round can't lower is likelihood + ALPHA x the sum of log-probabilities."""
    path = lm_scores.vocabulary_path(lm_scores.VOCABULARY)
    model = lm_scores._load(path)
    times = Counter((r[1] or "").encode().lower().split()[k] for r in odd_documents() for k in range(min(50, len((r[1] or "").split()))))
    batch = pa.RecordBatch.from_arrays([pa.array(list(times), pa.binary()), pa.array(list(times.values()), pa.int64())], names=["word", "c"])
    log_p, found = np.full(model.get_piece_size(), -math.log(model.get_piece_size())), []
    for _ in range(4):
        lattice = lm_scores._lattice(model, log_p)
        found.append(sum(c * lattice.log_probability(w.decode()) for w, c in times.items()) + lm_scores.ALPHA * log_p.sum())
        n = np.full(len(log_p), lm_scores.ALPHA)
        for out in lm_scores._expect_pieces(path, log_p)([batch]):
            n[out["piece"].to_pylist()] += np.array(out["n"].to_pylist(), float) / lm_scores.PARTS
        log_p = np.log(n / n.sum())
    assert found == sorted(found) and found[-1] > found[0]


def test_lm_base_scores(spark, tables):
    counts, ends = Counter(), 0
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    tokens = lambda t: (t or "").encode().lower().split()
    for i, text in DOCS:
        if not held(i):
            counts.update(tokens(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    g = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    want = Counter((i, held(i), len(tokens(t)) + 1, 1 + sum(counts[w] > 0 for w in tokens(t)), n, round(g(ends) + sum(g(counts[w]) for w in tokens(t)), 6)) for i, t in DOCS)
    found = rows(spark, "op10_lm_scores", tables["odd"])
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    assert all(r["score"] < 0 for r in found)
