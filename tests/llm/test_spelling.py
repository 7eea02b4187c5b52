"""Near words against edit distances, and the query against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rankshelf.llm import queries, spelling as P


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=2):
    """Rows of the operator, by the words that a deletion at each place leaves."""
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i] + "\x00" + w[i + 1 :]].add(w)
    around = defaultdict(set)
    for hole, group in holes.items():
        for a in group | ({hole} if hole in counts else set()):
            around[a] |= {b for b in group | ({hole} if hole in counts else set()) if near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(around[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(around[w]), counts.get(form[w], -1)) for w, n in counts.items())


def rows(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in frame.collect())


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abé\U0001f600", min_size=1, max_size=5), min_size=2, max_size=30), st.integers(1, 5))
def test_tiles_find_each_near_pair_once(words, tile):
    words = sorted(words)
    n = len(words)
    got = Counter()
    for short in range(0, 6):  # one key for all words, with a segment that holds every position
        i, j = P.near_pairs(words, np.zeros(n, np.int64), np.full(n, short), np.zeros(n, np.int64), np.full(n, short), tile)
        got.update((words[a], words[b]) for a, b in zip(i, j))
    assert got == Counter((a, b) for k, a in enumerate(words) for b in words[k + 1 :] if near(a, b))


@pytest.mark.parametrize("limit,tile", [(1, 3), (7, 256), (1024, 16)])
def test_variants_match_the_plain_version(spark, limit, tile):
    rng = random.Random(limit)
    counts = {}
    for _ in range(700):
        counts["".join(rng.choice("abc") for _ in range(rng.randrange(1, 8)))] = rng.randrange(1, 60)
    for stem in ("prefixprefixprefix", "ééé" * 4):
        for _ in range(60):
            counts[stem + "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 4)))] = rng.randrange(1, 99)
            counts["".join(rng.choice("xyz") for _ in range(rng.randrange(0, 4))) + stem] = rng.randrange(1, 99)
    k = 1500 if limit > 1000 else 15
    counts.update({"l" * 2 * k: 5, "l" * (2 * k - 1): 50, "l" * k + "k" + "l" * (k - 1): 2, "a\x00": 4, "a\x00\x00": 9})
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows(P.spelling_variants(table, limit=limit, tile=tile)) == plain(counts)


def test_odd_rows(spark):
    table = spark.createDataFrame([(None, 3), ("", 5), ("same", 1), ("same", 2), ("sane", 3), ("came", 6), ("game", 6), ("\U0001f600me", 1)], "word string, n long")
    table = table.selectExpr("*", "1 AS key", "2 AS `a.b`", "'x' AS form")
    assert rows(P.spelling_variants(table)) == plain({"same": 3, "sane": 3, "came": 6, "game": 6, "\U0001f600me": 1})
    assert P.spelling_variants(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        P.spelling_variants(table, ratio=1)
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "Words words WORDS Àb àb"), (3, "x" * 100000 + " words")], "doc_id long, text string").selectExpr("*", "1 AS t", "2 AS n")
    got = {r.word: r.n for r in P.word_counts(docs.unionByName(docs.where("doc_id IS NULL")), min_chars=1, min_count=1).collect()}
    assert got == {"words": 7, "Àb": 2, "àb": 2, "x" * 100000: 1}
    assert P.word_counts(docs.limit(0)).count() == 0


def test_query_matches_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    counts = Counter()
    for d in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d.doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    expect = plain({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = queries.QUERIES["op11_spelling"](spark, folder)
    assert rows(got) == expect and sum(e[1] != "" for e in expect) > 100
