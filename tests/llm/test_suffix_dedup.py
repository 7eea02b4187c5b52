"""Repeat removal against a plain count of all strings of the given length."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rankshelf.llm import queries, suffix_dedup as S


def brute(texts, length):
    """Covered bytes of every text: list of flags."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    flags = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        flags.append(gone)
    return flags


def spans_of(gone):
    edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(int), 0]))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def compare(got, texts, length):
    flags = brute(texts, length)
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        raw, gone = (texts[r.doc_id] or "").encode(), flags[r.doc_id]
        assert r.n_bytes == len(raw)
        assert [(s.start, s.stop) for s in r.spans] == spans_of(gone), r.doc_id
        assert bytes(r.kept) == bytes(np.frombuffer(raw, np.uint8)[~gone])


def corpus(seed):
    rnd = random.Random(seed)
    letters = "abcdefgh é"
    make = lambda n: "".join(rnd.choices(letters, k=n))
    passages = [make(rnd.randint(20, 120)) for _ in range(6)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            p = rnd.choice(passages)
            cut = rnd.randint(0, len(p))
            parts += [make(rnd.randint(0, 60)), rnd.choice([p, p[:cut], p[cut:], p + p])]
        texts.append("".join(parts))
    texts += [texts[0], texts[1] + "x", "a" * 300, "a" * 39, "ab" * 100, "xyz" * 50 + "q" + "xyz" * 50]
    texts += [None, "", "é" * 60, "b" + "a" * 200 + "c", make(3000) + passages[0]]
    return texts


RULE = dict(length=40, gram=13)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_offsets_of_contexts_match_brute_force(seed):
    rnd = random.Random(seed)
    rule = S.Repeats(**RULE)
    groups, before, texts = [], [], []
    for g in range(60):
        core = "".join(rnd.choices("ab", k=rule.gram))
        around = ["".join(rnd.choices("ab", k=rule.reach)) for _ in range(2)], ["".join(rnd.choices("ab", k=rule.reach)) for _ in range(2)]
        for _ in range(rnd.randint(2, 9)):
            x, y = rnd.choice(around[0]), rnd.choice(around[1])
            x = "".join(c if rnd.random() < 0.97 else "c" for c in x)[rnd.choice([0, 0, 5]) :]
            y = "".join(c if rnd.random() < 0.97 else "c" for c in y)[: rnd.choice([rule.reach, rule.reach, 20])]
            groups.append(g)
            before.append(len(x))
            texts.append((x + core + y).encode())
    first, last = S.repeated_offsets(np.array(groups), np.array(before), texts, rule)
    for i in range(len(texts)):
        hits = []
        for o in range(before[i] + 1):
            w = texts[i][before[i] - o :][: rule.length]
            if len(w) == rule.length and any(
                j != i and groups[j] == groups[i] and before[j] >= o and texts[j][before[j] - o :][: rule.length] == w for j in range(len(texts))
            ):
                hits.append(o)
        assert (first[i], last[i]) == ((hits[0], hits[-1]) if hits else (-1, -1))


@pytest.mark.parametrize("seed", [1, 2])
def test_contexts_of_a_frequent_gram_are_sorted_in_bounded_groups(monkeypatch, seed):
    """op4: all contexts of a gram were sorted at once, up to 50,000 of them."""
    import pyarrow as pa

    rnd = random.Random(seed)
    rule = S.Repeats(**RULE)
    rows = []
    for gram in range(4):
        core = rnd.choices("ab", k=rule.gram)
        sides = [(rnd.choices("ab", k=rule.reach), rnd.choices("ab", k=rule.reach)) for _ in range(3)]
        for n in range((60, 2, 1, 25)[gram]):
            x, y = rnd.choice(sides)[0], rnd.choice(sides)[1]
            x = [c if rnd.random() < 0.97 else "c" for c in x][rnd.choice([0, 0, 5, rule.reach]) :]
            y = [c if rnd.random() < 0.97 else "c" for c in y][: rnd.choice([rule.reach, rule.reach, 20])]
            rows.append((gram, n, len(x), "".join([*x, *core, *y]).encode()))
    rows += [rows[-1]]  # another copy of a context
    batches = [pa.RecordBatch.from_pylist([dict(zip(("gram", "context", "before", "bytes"), r)) for r in rows[at : at + 7]]) for at in range(0, len(rows), 7)]
    expected, own = {}, rows[:-1]
    first, last = S.repeated_offsets(np.array([r[0] for r in own]), np.array([r[2] for r in own]), [r[3] for r in own], rule)
    expected = {r[:2]: (o, rule.length - f) for r, f, o in zip(own, first.tolist(), last.tolist()) if f >= 0}
    sizes, real = [], S.repeated_offsets
    monkeypatch.setattr(S, "repeated_offsets", lambda group, *a: (sizes.append(len(group)), real(group, *a))[1])
    for most in (1, 3, 8, 1000):
        monkeypatch.setattr(S, "SORTED", most)
        sizes.clear()
        out = [r for b in S._sorted(iter(batches), rule) for r in b.to_pylist()]
        got = {(r["gram"], r["context"]): (r["left"], r["right"]) for r in out}
        assert len(out) == len(got)  # one row a context, however many offsets repeat
        assert got == expected and len(expected) > 10
        assert all(n <= most for n in sizes) and (most < 3 or sizes)


def test_collisions_are_caught(monkeypatch):
    rule = S.Repeats(**RULE)
    rnd = random.Random(4)
    texts = [bytes(rnd.choices(b"ab", k=rule.reach + rule.length)) for _ in range(6)] * 2
    texts = [t[:-1] + bytes([97 + k]) for k, t in enumerate(texts)]
    args = (np.zeros(len(texts), np.int64), np.full(len(texts), rule.reach), texts, rule)
    good = S.repeated_offsets(*args)
    monkeypatch.setattr(S, "_BYTES", np.ones(256, np.uint64))  # every string of one length has one hash
    assert all((a == b).all() for a, b in zip(good, S.repeated_offsets(*args)))


@pytest.mark.parametrize("hot", [50_000, 1], ids=["sorted", "counted"])
def test_spans_match_brute_force(spark, hot):
    for seed in (1, 2) if hot > 1 else (1,):
        texts = corpus(seed)
        docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, key int").repartition(3)
        compare(S.strip_repeats(docs, rule=S.Repeats(**RULE, hot=hot)).collect(), texts, 40)


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    rule = S.Repeats(**RULE)
    raw = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = S.Found([raw], [(0, len(raw))], rule)
    monkeypatch.setattr(S, "CORE", 700)
    got = []
    for first, last, low, high in S.pieces_of(len(raw), rule.length):
        f = S.Found([raw[low:high]], [(first - low, last - low)], rule)
        got += list(zip(f.place + low, f.gram, f.context))
    assert got == list(zip(whole.place, whole.gram, whole.context))


def test_repeated_rows_nulls_and_empty_table(spark):
    rule = S.Repeats(**RULE)
    long = "".join(random.Random(1).choices("abcdefgh", k=100))
    docs = spark.createDataFrame([(1, long), (1, long), (None, "short"), (2, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in S.strip_repeats(docs, rule=rule).collect())
    assert got == [(0, 5, 5), (1, 100, 0), (1, 100, 0), (2, 0, 0)]
    assert S.strip_repeats(spark.createDataFrame([], "doc_id long, text string"), rule=rule).count() == 0


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(texts)
    flags = dict(zip(ids, brute([texts[i] for i in ids], 400)))
    got = queries.QUERIES["op4_suffix_dedup"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == ids
    for r in got:
        raw, gone = texts[r.doc_id].encode(), flags[r.doc_id]
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (
            len(raw), int(gone.sum()), len(spans_of(gone)), hashlib.sha256(kept).hexdigest(),
        )
    assert any(r.n_removed for r in got)
