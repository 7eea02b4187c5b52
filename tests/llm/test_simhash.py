"""SimHash classes against direct comparison of all fingerprints."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from rankshelf.llm import queries, simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """Smallest id reachable by links of at most three bits."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    arr = np.array([prints[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(arr[k + 1 :] ^ arr[k]) <= 3):
            x, y = find(i), find(ids[k + 1 + j])
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_anchor_cover_is_complete():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 200, np.uint64)
    for weight in (1, 2, 3):
        y = x.copy()
        for row in range(len(y)):
            for b in rng.choice(64, weight, replace=False):
                y[row] ^= np.uint64(1) << np.uint64(b)
        for a, b in zip(x, y):
            ka, ha, _ = simhash.anchor_rows(np.array([a]))
            kb, _, _ = simhash.anchor_rows(np.array([b]))
            assert set(ka[ha]) & set(kb), (hex(a), hex(b))
    keys, _, _ = simhash.anchor_rows(x)
    assert len(keys) <= 34 * len(x)


def test_spanning_links_connect_what_links_connect():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 6, np.uint64)
    fps = np.unique(np.array([base[rng.integers(6)] ^ (np.uint64(1) << np.uint64(rng.integers(10))) ^ (np.uint64(1) << np.uint64(rng.integers(10))) for _ in range(120)]))
    a, b = simhash.spanning_links(fps[:40], fps)
    expect, got = {}, {}
    for out, pairs in ((expect, [(x, y) for x in fps[:40] for y in fps if np.bitwise_count(x ^ y) <= 3]), (got, list(zip(a, b)))):
        root = {int(v): int(v) for v in fps}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for x, y in pairs:
            p, q = find(int(x)), find(int(y))
            root[max(p, q)] = min(p, q)
        out.update({v: find(v) for v in root})
    assert expect == got
    assert len(a) <= len(fps) + 40


def _classes(nodes, pairs):
    root = {int(v): int(v) for v in nodes}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for x, y in pairs:
        p, q = find(int(x)), find(int(y))
        root[max(p, q)] = min(p, q)
    return {v: find(v) for v in root}


@pytest.mark.parametrize("width", [1, 2, 7])
def test_spanning_links_in_several_parts(width):
    rng = np.random.default_rng(3)
    for _ in range(40):
        # chains of three bits a step, in any order
        fps = [rng.integers(0, 2**64, dtype=np.uint64)]
        while len(fps) < 60:
            step = sum(1 << int(p) for p in rng.choice(24, 3, replace=False))
            fps.append(fps[rng.integers(max(0, len(fps) - 3), len(fps))] ^ np.uint64(step))
        fps = rng.permutation(np.unique(np.array(fps)))
        homes = fps[:25]
        a, b = simhash.spanning_links(homes, fps, cells=width * len(homes))
        assert _classes(fps, zip(a, b)) == _classes(fps, [(x, y) for x in homes for y in fps if np.bitwise_count(x ^ y) <= 3])
        assert len(a) <= len(fps) + len(homes)


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_classes_of_one_crowded_anchor(spark, cells):
    # one low half for all; the high halves are chains within a few bits
    rng = np.random.default_rng(4)
    low, high = np.uint64(0), [0]
    while len(high) < 300:
        high.append(high[rng.integers(max(0, len(high) - 3), len(high))] ^ sum(1 << int(p) for p in rng.choice(32, 3, replace=False)))
    fps = np.unique(np.array(high, np.uint64) << np.uint64(32) | low)
    prints = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    links = simhash.near_links(prints, simhash.Limits(small=0, cells=cells)).collect()
    got = _classes(fps, [(r.a % 2**64, r.b % 2**64) for r in links])
    assert got == _classes(fps, [(x, y) for x in fps for y in fps if x < y and np.bitwise_count(x ^ y) <= 3])


WORDS = [f"w{i}" for i in range(400)]


def _documents(n, seed=3):
    rnd = random.Random(seed)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randint(40, 120))) for _ in range(n // 4)]
    while len(texts) < n:
        words = rnd.choice(texts[: n // 4]).split()
        words[rnd.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    return texts + [None, "", " \t\n", "one", "One two", "x" * 50_000, "a " * 30_000]


@pytest.mark.parametrize("limits", [simhash.Limits(), simhash.Limits(homes=2, small=0, rows=8)], ids=["plain", "split"])
def test_classes_match_brute_force(spark, limits):
    texts = _documents(120)
    rows = [(i * 7 + 3, t, "c") for i, t in enumerate(texts)] + [(3, texts[0], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    prints = {i: brute_fingerprint(t) for i, t, _ in rows}
    classes = brute_classes(prints)
    got = simhash.simhash_classes(docs, limits=limits).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{prints[i]:016x}", classes[i]) for i, _, _ in rows)
    assert len(set(classes.values())) < len(classes) - 10


def test_drop_keeps_one_of_each_class(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(_documents(40))], "doc_id long, text string")
    classes = {r.doc_id: r.component_id for r in simhash.simhash_classes(docs).collect()}
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect()) == sorted(set(classes.values()))


def test_empty_table_and_null_ids(spark):
    assert simhash.simhash_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "lonely text of its own")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.simhash_classes(docs).collect()}
    assert got == {(None, 5), (5, 5), (None, None)}
    assert simhash.drop_near_duplicates(docs).count() == 3


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    classes = brute_classes(prints)
    got = queries.QUERIES["op5_simhash"](spark, sf).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((i, f"{prints[i]:016x}", classes[i]) for i in texts)
