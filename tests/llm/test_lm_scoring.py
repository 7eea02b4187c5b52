"""Language-model scores: base score by brute force, the filter against exact counts, held-out quality."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from rankshelf.llm import lm_scoring as L, queries

LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + [None]


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base) by plain counting."""
    def out(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0

    counts = Counter(w for i, t in rows if not out(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    result = []
    for i, t in rows:
        ws = words(t)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        result.append((i, out(i), len(ws), sum(counts[w] > 0 for w in ws), n, base))
    return result


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    expect = sorted(brute(rows), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    assert [g[:5] for g in got] == [e[:5] for e in expect]
    assert np.allclose([g[5] for g in got], [e[5] for e in expect], rtol=1e-9, atol=1e-6)


def sample(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(n):
        at, text = rnd.randrange(300), []
        for _ in range(rnd.randint(5, 60)):
            at = (at * 7 + rnd.choice([1, 1, 1, 2, 3])) % 300  # the next word depends on the last
            text.append(vocabulary[at])
        texts.append(" ".join(text))
    return [(i, t) for i, t in enumerate(texts)] + [(9001, None), (9002, ""), (9003, " \n"), (None, "null id w1"), (9004, "Ünïcode W1\x0bw2"), (3, texts[3])]


def test_base_scores_match_brute_force(spark):
    rows = sample(200)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    check(L.lm_scores(docs).collect(), rows)


def test_model_beats_words_alone_on_held_out_text(spark):
    rows = sample(600)
    got = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    out = [r for r in got if r.held_out and r.n_tokens > 3]
    assert len(out) > 20 and sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)
    assert all(r.score <= 0 for r in got)


def test_filter_reads_back_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, np.uint64))
    counts = rng.geometric(0.02, len(keys))
    levels = L.level_of(counts)
    assert (levels == np.floor(np.log2(counts)).astype(int) + 1).all()
    bits = int(levels.sum()) * L.BITS_PER_ENTRY // 8 * 8
    part = np.zeros(bits, bool)
    for level in range(1, levels.max() + 1):
        for at in L.positions(keys[levels >= level], 1, level, bits):
            part[at.astype(np.int64)] = True
    bloom = L.Filter([(0, bits, np.packbits(part, bitorder="little").tobytes())], 1)
    read = bloom.counts(keys, 1)
    assert (read >= L.middle_of(levels)).all()  # a Bloom filter never forgets
    assert (read == L.middle_of(levels)).mean() > 0.97
    assert (bloom.counts(rng.integers(0, 2**64, 20000, np.uint64), 1) > 0).mean() < 0.02


def test_bound_of_the_filter_holds(spark):
    rows = sample(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(L.lm_scores(docs, max_bits=64 * 64 * 4).collect(), rows)  # the base score does not depend on it


def test_scores_match_a_model_with_the_same_estimates(spark):
    """Score recomputed token by token from exact counts put through the levels."""
    rows = sample(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # with 96 bits a level false positives are rarer than one in a million
    got, usual = ({(r.doc_id, r.n_tokens): r.score for r in L.lm_scores(docs, bits_per_entry=b).collect()} for b in (96, L.BITS_PER_ENTRY))
    train = [words(t) for i, t in rows if not L.held_out(i)]
    one = Counter(w for ws in train for w in ws)
    two = Counter((a, b) for ws in train for a, b in zip([None] + ws[:-1], ws))
    v = len(one)
    mid = lambda c: float(L.middle_of(L.level_of(np.array([c])))[0]) if c else 0.0
    norm = sum(mid(c) for c in one.values()) + 0.1 * (v + 1)
    close = 0
    for i, t in rows:
        ws, total = words(t), 0.0
        for a, b in zip([None] + ws[:-1], ws):
            pair = mid(two[a, b]) if two[a, b] >= L.MIN_BIGRAM else 0.0
            total += math.log10((min(pair, mid(one[a])) + L.MASS * min(1, (mid(one[b]) + 0.1) / norm)) / (mid(one[a]) + L.MASS))
        assert abs(total - got[i, len(ws)]) < 1e-6
        close += abs(total - usual[i, len(ws)]) < 1e-6
    assert close > 0.7 * len(rows)  # the rest met a false positive
    # the probabilities of the next token sum to one within the stated bound
    nexts = [*one, "unknown"]
    share = np.array([(mid(one[b]) + 0.1) / norm for b in nexts])
    assert abs(share.sum() - 1) < 1e-9
    sums = [L.next_token(np.array([mid(two[a, b]) for b in nexts]), np.full(len(nexts), mid(one[a])), share, L.MASS).sum() for a in list(one)[:60]]
    assert 0.5 <= min(sums) and max(sums) <= 2 and 0.8 < np.median(sums) < 1.25


def test_scores_do_not_depend_on_the_size_of_a_part(spark):
    rows = sample(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, small = ({(r.doc_id, r.n_tokens): r.score for r in L.lm_scores(docs, max_bits=b).collect()} for b in (L.MAX_BITS, 64 * 64 * 4))
    # parts differ in their false positives only; dropped n-grams would take away far more
    assert sum(abs(whole[k] - small[k]) < 0.35 for k in whole) > 0.8 * len(whole)
    assert abs(sum(whole.values()) - sum(small.values())) < 0.01 * abs(sum(whole.values()))


def test_every_counted_pair_is_stored():
    rng = np.random.default_rng(2)
    pairs = np.unique(rng.integers(0, 1 << 40, 20000, np.uint64))
    words = np.unique(rng.integers(0, 2**64, 3000, np.uint64))
    group = L.pa.table(
        {
            "chunk": [7], "shard": [0], "words": [words.tobytes()], "word_counts": [np.ones(len(words), np.uint32).tobytes()],
            "pairs": [L.pack40(pairs)], "pair_counts": [np.full(len(pairs), 2, np.uint32).tobytes()],
        }
    )
    built = L._build(group, 2, 1)
    part, asked = built.to_pylist()
    bloom = L.Filter([(0, part["bits"], part["part"])], 1)
    levels = next(L._probe(iter(built.slice(1).to_batches()), bloom)).to_pylist()[0]
    assert min(levels["words"]) >= 1 and min(levels["pairs"]) >= 2
    assert (L.unplanes(asked["counts"]) == 1).all() and part["n"] == part["total"] == part["estimate"] == len(words)


def test_passes_hold_bounded_parts():
    sizes = [(3, 10), (0, 30), (1, 20), (2, 60), (7, 5)]
    assert L._passes(sizes, 50) == [(0, 1), (2, 2), (3, 7)]
    assert L._passes(sizes, 1) == [(0, 0), (1, 1), (2, 2), (3, 3), (7, 7)]
    assert L._passes([], 50) == []


def test_scores_do_not_depend_on_the_passes(spark):
    rows = sample(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = sorted((r.n_tokens, r.score) for r in L.lm_scores(docs).collect())
    many = L.lm_scores(docs, pass_bytes=1 << 10, chunk=2000).collect()  # several passes, parts of a few hundred bytes
    check(many, rows)
    assert np.allclose(sorted((r.n_tokens, r.score) for r in many), one)


def test_texts_of_several_chunks(spark):
    rows = sample(80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expect = sorted((r.n_tokens, round(r.score, 6)) for r in L.lm_scores(docs).collect())
    check(L.lm_scores(docs, chunk=200).collect(), rows)
    assert sorted((r.n_tokens, round(r.score, 6)) for r in L.lm_scores(docs, chunk=200).collect()) == expect


def test_bigrams_seen_once_count(spark):
    trained = [i for i in range(40) if not L.held_out(i)]
    out = [i for i in range(100, 200) if L.held_out(i)][:2]
    # each word occurs twice, each bigram of the first held-out text once in training
    rows = [(i, f"a{i} b{i} c{i}") for i in trained] + [(500 + i, f"c{i} a{i} b{i}") for i in trained if not L.held_out(500 + i)]
    few = [i for i in trained if not L.held_out(500 + i)][:8]
    rows += [(out[0], " ".join(f"b{i} c{i}" for i in few)), (out[1], " ".join(f"c{i} b{i}" for i in few))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.score for r in L.lm_scores(docs).collect()}
    assert got[out[0]] > got[out[1]] + 0.5  # the seen order beats the unseen one
    cut = {r.doc_id: r.score for r in L.lm_scores(docs, min_bigram=2).collect()}
    assert abs(cut[out[0]] - cut[out[1]]) < 0.2  # as an option, a higher cutoff tells them apart no longer


def test_empty_table_and_nothing_to_train_on(spark):
    assert L.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = next(i for i in range(100) if L.held_out(i))
    rows = [(only, "a b")]
    check(L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(queries.QUERIES["op8_lm_scoring"](spark, sf).collect(), rows)
