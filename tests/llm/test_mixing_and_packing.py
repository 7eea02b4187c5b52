"""Packing against an exhaustive search, mixing on odd rows."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import pytest

from rankshelf.llm import mixing, packing


def padding(histogram, tops):
    return sum(n * (min(t for t in tops if t >= length) - length) for length, n in histogram)


@pytest.mark.parametrize("seed", range(25))
def test_boundaries_are_optimal(seed):
    rnd = random.Random(seed)
    histogram = sorted((length, rnd.randint(1, 50)) for length in rnd.sample(range(1, 60), rnd.randint(1, 11)))
    k = rnd.randint(1, 4)
    tops = packing.boundaries(histogram, k)
    lengths = [length for length, _ in histogram]
    best = min(padding(histogram, c + (lengths[-1],)) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1))
    assert padding(histogram, tops) == best and tops[-1] == lengths[-1] and len(tops) == min(k, len(lengths))
    assert tops == sorted(set(tops))


def test_many_lengths():
    rnd = random.Random(1)
    histogram = [(length, rnd.randint(1, 1000)) for length in range(1, 20_001)]
    tops = packing.boundaries(histogram, 16)
    assert len(tops) == 16 and padding(histogram[::50], tops) >= 0


def test_batches_fill_the_budget(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 2, 3, 10, 11, 40]))) for i in range(300)]
    rows += [(None, "a b"), (7, rows[7][1]), (400, None), (401, ""), (402, "w " * 500)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, bucket int, _rank int").repartition(4)
    got = packing.pack(docs, buckets=3, budget=100).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len((t or "").split()) + 1) for i, t in rows)
    batches = defaultdict(list)
    for r in got:
        assert r.padding == r.bucket - r.n_tokens >= 0
        batches[r.bucket, r.batch].append(r.slot)
    for (bucket, batch), slots in batches.items():
        room = max(1, 100 // bucket)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert len(slots) == room or (bucket, batch + 1) not in batches  # only a bucket's last batch is short
    by_bucket = defaultdict(list)
    for r in got:
        by_bucket[r.bucket].append(((r.batch, r.slot), (r.doc_id is not None, r.doc_id or 0)))
    assert all([x for _, x in sorted(v)] == sorted(x for _, x in v) for v in by_bucket.values())


def test_packing_an_empty_table(spark):
    out = packing.pack(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_tokens", "bucket", "batch", "slot", "padding"] and out.count() == 0


def test_mixing_odd_rows(spark):
    rows = [(i, "some words " * 5, f"s{i % 2}", "en") for i in range(40)]
    rows += [(None, None, None, None), (50, "", None, "de"), (51, "1 2 3 4", "s0", None), (3, rows[3][1], "s1", "en"), (52, "# # #", "s1", "en")]
    docs = spark.createDataFrame([(*r, 1.0, "t") for r in rows], "doc_id long, text string, source string, lang string, tokens double, topic string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(0 < r.probability <= 1 for r in got)
    assert len({r.sampled for r in got if r._row.doc_id == 3}) == 1  # rows that share an id are drawn alike
    assert {r.topic for r in got} >= {"prose", "numbers", "symbols"}
    assert mixing.sample_mix(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_given_targets_are_met_in_expectation(spark):
    rows = [(i, "word " * 9, "a" if i % 4 else "b", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "value string, target double")}
    got = mixing.mix(docs, targets).collect()
    expected = Counter()
    for r in got:
        expected[r.source] += r.probability * r.tokens
    assert abs(expected["a"] - expected["b"]) < 1e-6
    drawn = Counter(r.source for r in got if r.sampled)
    assert abs(drawn["a"] - drawn["b"]) < 40 and 150 < sum(drawn.values()) < 250


def test_every_default_target_is_met(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).cache()
    report = mixing.marginals(got).collect()
    assert {r.dimension for r in report} == set(mixing.DIMENSIONS)
    assert all(r.error < 1e-6 for r in report)
    for d in mixing.DIMENSIONS:
        assert abs(sum(r.expected for r in report if r.dimension == d) - 1) < 1e-9
    assert max(r.probability for r in got.collect()) == 1.0  # no higher share of the tokens could be kept
    got.unpersist()


def test_a_given_rate_rakes_on_beyond_full_cells(spark):
    # b/x is full at this rate; b/y makes up for it, so both marginals are still met
    rows = [(i, "word " * 9, "a", "x") for i in range(300)] + [(400 + i, "word " * 9, "a", "y") for i in range(100)]
    rows += [(600 + i, "word " * 9, "b", "x") for i in range(50)] + [(700 + i, "word " * 9, "b", "y") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {
        "source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "value string, target double"),
        "lang": spark.createDataFrame([("x", 0.6), ("y", 0.4)], "value string, target double"),
    }
    got = mixing.mix(docs, targets, rate=0.5, rounds=12)
    chances = {(r.source, r.lang): r.probability for r in got.select("source", "lang", "probability").distinct().collect()}
    assert chances["b", "x"] == 1.0 and max(v for k, v in chances.items() if k != ("b", "x")) < 1
    assert all(r.error < 1e-2 for r in mixing.marginals(got, targets).collect())  # limits slow the rounds down
    kept = sum(10 * chances[s, l] for _, _, s, l in rows)
    assert abs(kept / (10 * len(rows)) - 0.5) < 1e-3


def test_a_target_beyond_the_documents_is_reported(spark):
    rows = [(i, "word " * 9, "a" if i else "b", "x") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "value string, target double")}
    report = {(r.dimension, r.value): r for r in mixing.marginals(mixing.mix(docs, targets, rate=0.5, rounds=3), targets).collect()}
    assert report["source", "b"].error > 0.9  # one document cannot be half of fifty
    exact = {(r.dimension, r.value): r for r in mixing.marginals(mixing.mix(docs, targets), targets).collect()}
    assert exact["source", "b"].error < 1e-6


def test_report_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert mixing.marginals(mixing.mix(docs)).count() == 0
