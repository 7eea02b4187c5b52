"""Token shards: exact round trip, permutation, random access, encoder against the plain library."""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
import pytest

from rankshelf.llm import queries, token_shards as T

VOCABULARY = open(T.VOCABULARY, "rb").read() if os.path.exists(T.VOCABULARY) else None
pytestmark = pytest.mark.skipif(VOCABULARY is None, reason="no vocabulary file")


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, VOCABULARY.splitlines())}
    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "it's a dog 's 12 34", "x y z", "tab\tand space b\u0085 c",
    "nul \0 in it", "é" * 700, "word " * 3000, "Mixed, case. \"Quotes\"\nNew line\n", "\U0001F600 smile \x1c sep", "a\x0bb c", "z" * 5000,
]


def test_encoder_equals_the_library(plain):
    encoder = T.Encoder(VOCABULARY)
    texts = [t for t in TEXTS if t is not None] * 2
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == plain(text), repr(text[:40])


def test_encoder_in_small_slices_and_memory(plain, monkeypatch):
    monkeypatch.setattr(T, "SLICE", 50)
    monkeypatch.setattr(T, "MEMORY", 5)
    encoder = T.Encoder(VOCABULARY)
    texts = [f"word{i % 7}, and number {i}.\nNext! ({i})" for i in range(60)]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == plain(text)


def test_encoder_on_mixed_white_space_and_marks(plain, monkeypatch):
    marks = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\0", "\x85", "\xa0", "\u2003", "\u3000", ".", ",", "?!", "'s", "'", "-", "(", "\u201c", "a", "Word", "7", "\xe9", "\u65e5", "\U0001F600"]
    rng = np.random.default_rng(5)
    texts = ["".join(marks[i] for i in rng.integers(0, len(marks), rng.integers(0, 12))) for _ in range(3000)]
    for size, memory in [(1, 3), (40, 0), (1 << 22, 1 << 20)]:
        monkeypatch.setattr(T, "SLICE", size)
        monkeypatch.setattr(T, "MEMORY", memory)
        encoder = T.Encoder(VOCABULARY)
        given = pa.array(["before", *texts])[1:]
        expect = [plain(t) for t in texts]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(given)] == expect
        assert list(encoder.lengths(given)) == list(map(len, expect))


def test_known_words_are_not_merged_again(plain):
    """Paragraphs, marks and new words go to the library once, in one call; the counting pass makes no ids."""
    encoder, calls = T.Encoder(VOCABULARY), []
    for name in ("_plain", "_words"):
        merge = getattr(encoder, name, None)
        setattr(encoder, name, lambda text, merge=merge: calls.append(text) or merge(text))
    texts = pa.array([f"New paragraph{i},\n\nwith  word{i}; and\ttab.\r\n" for i in range(200)])
    lengths = [len(plain(t)) for t in texts.to_pylist()]
    assert list(encoder.lengths(texts)) == lengths
    assert len(calls) < 10 and sum(map(len, calls)) < 200 * 30
    calls.clear()
    assert [len(ids) // 2 for ids in encoder.encode(texts)] == lengths
    assert not any(calls)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(size):
    out = T.permute(np.arange(size), size, 42)
    assert sorted(out) == list(range(size))
    assert (T.permute(np.arange(size), size, 42) == out).all()
    if size > 100:
        assert (T.permute(np.arange(size), size, 43) != out).mean() > 0.9
        assert abs(np.corrcoef(np.arange(size), out)[0, 1]) < 0.1


def test_round_trip_and_random_access(spark, tmp_path, plain):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no id", 2), (5, "a", 3)]
    spark.createDataFrame(rows, "doc_id long, text string, slot int").repartition(3).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    layout = T.write_shards(docs, f"{tmp_path}/out", seq_len=32, shard_rows=50)
    got = T.read_shards(spark, f"{tmp_path}/out").collect()
    assert sorted(r.slot for r in got) == list(range(layout.sequences)) and layout.shards > 2
    assert all(r.shard == r.slot // 50 and len(r.ids) == r.n_tokens for r in got)
    texts = {}
    for r in sorted(got, key=lambda r: r.seq_no):
        texts.setdefault(r.doc_id, []).append(r)
    for i, t, _ in rows[: len(TEXTS)]:
        ids = [x for r in texts[i] for x in r.ids]
        expect = plain(t or "") + [T.END]
        assert ids == (expect * 2 if i == 5 else expect)
    assert [x for r in texts[None] for x in r.ids] == plain("no id") + [T.END]
    # the bytes on disk: fixed stride, slot order
    for shard in range(layout.shards):
        (name,) = [f for f in os.listdir(f"{tmp_path}/out/shards/shard={shard}") if f.startswith("part-")]
        content = open(f"{tmp_path}/out/shards/shard={shard}/{name}", "rb").read()
        assert len(content) == layout.stride * min(50, layout.sequences - 50 * shard)
    some = T.read_shards(spark, f"{tmp_path}/out", 60, 140).collect()
    key = lambda r: r.slot
    assert sorted(some, key=key) == sorted([r for r in got if 60 <= r.slot < 140], key=key)
    assert T.read_shards(spark, f"{tmp_path}/out", layout.sequences).count() == 0


def test_changed_input_fails(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    rows = spark.read.parquet(f"{tmp_path}/docs").selectExpr("doc_id", "text AS t")
    words = spark.sparkContext.broadcast(VOCABULARY)
    parts = spark.sparkContext.broadcast({0: (0, 1)})
    from functools import partial

    emit = partial(T._emit, vocabulary=words, parts=parts, layout=T.Layout(2))
    with pytest.raises(Exception, match="partitions changed"):
        rows.mapInArrow(emit, "slot long, record binary").collect()


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.write_shards(docs, f"{tmp_path}/out").sequences == 0
    assert T.read_shards(spark, f"{tmp_path}/out").count() == 0


def test_registered_query(spark, plain):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op3_token_shards"](spark, sf).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    lengths = {}
    for r in got:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.n_tokens
    assert lengths == {i: len(plain(t)) + 1 for i, t in texts.items()}
