"""Fingerprints against exact similarities and against a plain version of the packing."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash

from pyspark.sql import functions as F

from rankshelf.llm import fingerprints as P, queries

LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_fingerprint(text):
    """Bins, densification and packing, bin by bin."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    as_bytes = lambda x, size: (x & ((1 << 8 * size) - 1)).to_bytes(size, "little")

    def chain(parts):  # Spark's xxhash64 of several columns: each hash is the next one's seed
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part, seed)
        return signed(seed)

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return []
    words = [chain([w.encode()]) for w in words]
    hashes = {chain([as_bytes(w, 8) for w in words[i : i + P.SHINGLE]]) for i in range(max(1, len(words) - P.SHINGLE + 1))}
    of_bin = lambda h: (h >> (64 - P.BIN_BITS)) + P.BINS // 2
    least = {}
    for h in hashes:
        least[of_bin(h)] = min(h, least.get(of_bin(h), h))
    full = []
    for b in range(P.BINS):
        source = b
        for k in range(P.PROBES):
            if source in least:
                break
            source = chain([as_bytes(b, 4), as_bytes(k, 4)]) % P.BINS
        if source not in least:
            source = min(least, key=lambda x: chain([as_bytes(b, 4), as_bytes(x, 4), as_bytes(P.PROBES, 4)]))
        full.append(least[source])
    return [
        signed(sum((v & ((1 << P.BITS) - 1)) << (P.BITS * (P.PER_LONG - 1 - i)) for i, v in enumerate(full[at : at + P.PER_LONG])))
        for at in range(0, P.BINS, P.PER_LONG)
    ]


def test_every_fingerprint_matches_the_plain_version(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t", "One", "one", "ONE two\x0bthree", "a b c d e", "a b c d e f", "É é Ü ü #"]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(n)) for n in (7, 12, 40, 200, 3000)]
    texts += ["x" * 50000, "same " * 1000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("*", "1 AS fingerprint", "2 AS _fingerprint_w", "3 AS t", "4 AS `a.b`")
    got = {r.doc_id: r.fingerprint for r in P.fingerprints(docs).collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert P.fingerprints(docs.limit(0)).count() == 0
    assert got[3] == got[4] and got[0] == got[1] == got[2] == []


def test_likeness_follows_the_similarity(spark):
    rng = random.Random(5)
    rows, truth = [], {}
    for i, (size, share) in enumerate((size, share) for size in (30, 300, 2000) for share in (0.0, 0.1, 0.3, 0.5, 0.8, 0.95, 1.0) for _ in range(12)):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        cut = int(size * share)
        other = words[:cut] + [f"v{rng.randrange(10**6)}" for _ in range(size - cut)]
        rows.append((i, " ".join(words), " ".join(other)))
        truth[i] = (size, share, jaccard(" ".join(words), " ".join(other)))
    pairs = spark.createDataFrame(rows, "i long, a string, b string")
    both = P.with_fingerprint(P.with_fingerprint(pairs, F.col("a"), "x"), F.col("b"), "y")
    got = {r.i: r.l for r in both.select("i", P.likeness("x", "y").alias("l")).collect()}
    errors = {}
    for i, (size, share, exact) in truth.items():
        assert 0 <= got[i] <= 1 and abs(got[i] - exact) < (0.3 if size == 30 else 0.17)
        errors.setdefault((size, share), []).append(got[i] - exact)
    for (size, share), e in errors.items():  # no bias: the mean of 12 is near the truth
        assert abs(sum(e) / len(e)) < (0.12 if size == 30 else 0.05), (size, share, sum(e) / len(e))


def test_query_matches_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op12_fingerprints"](spark, folder).collect()}
    assert sorted(got) == sorted(texts)
    hexed = lambda x: "".join(f"{v & ((1 << 64) - 1):016x}" for v in x)
    for k, i in enumerate(order):
        text, following = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == hexed(plain_fingerprint(text)) and row.edited_fingerprint == hexed(plain_fingerprint(edited))
        if len(shingles(text)) > 60:
            assert abs(row.near_edited - jaccard(text, edited)) < 0.16 and abs(row.near_next - jaccard(text, following)) < 0.16


def test_order_of_odd_rows(spark):
    rows = [(5, "five f"), (5, "five f"), (5, "fifth g"), (3, None), (None, "none"), (None, None), (9, "nine nine"), (-1, "minus")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS half", "2 AS place")
    got = P.beside_next(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -99, r.text) for r in got) == sorted((i if i is not None else -99, t or "") for i, t in rows)
    heads = {(r.doc_id, r.text): r.next_head for r in got}
    assert heads[9, "nine nine"] in ("five", "fift") and heads[3, ""] == ""
    assert heads[-1, "minus"] in ("no", "") and {heads[5, "five f"], heads[5, "fifth g"]} in ({"fif", ""}, {"fiv", ""})
    assert {heads[None, "none"], heads[None, ""]} <= {"", "ni"}
    assert P.beside_next(docs.limit(0)).count() == 0
    one = P.beside_next(docs.where("doc_id = 9")).collect()
    assert [(r.next_head, r.fingerprint == r.next_fingerprint) for r in one] == [("nine", True)]


def test_native_plan_sends_texts_twice_at_most(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = queries.QUERIES["op12_fingerprints"](spark, "/root/testdata/sf0.001")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the texts by their own keys (used twice), the links, and the heads by their takers' keys
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 3
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
