"""Language-model scoring with a broadcast log-frequency Bloom filter.

The model is a bigram model over the training documents (crc32 of the id as text
mod 10 is not 0). It is made and used in three steps:

1. *Count.* The texts are written in chunks. A chunk sends its distinct words and
   bigrams with their counts to shards of the hash space (equal parts whatever the
   words are, so no shard is hot). A shard sums them and builds its part of the
   Bloom filter: an n-gram with count c is stored under the levels 1 to
   1 + floor(log2 c). The n-grams that the chunks ask for are written in bundles of
   neighbouring shards, next to the parts.
2. *Probe.* The parts are broadcast in passes of at most ``PASS_BYTES``, sizes
   checked before. A pass reads only the bundles whose parts it has, and deletes them,
   so every n-gram is read once, however many passes there are. The count of an n-gram is read back
   by probing level 1, 2, ... until a probe fails; the last level that held gives the
   middle of its range of counts.
3. *Score.* The levels meet the texts of their chunk. A token's probability is
   the bigram estimate smoothed towards the word estimate (Dirichlet prior ``MASS``).

Every n-gram with its least count is stored, in ``BITS_PER_ENTRY`` bits for each
level. The number of shards follows the size of the texts, so that a part has
about ``MAX_BITS`` bits at most; a chunk has a row for a shard only if it has n-grams
there, so there are never more rows than n-grams. The base score takes the exact
word counts, which the shards return to the chunks; the model does not see them.

Normalisation. Word estimates are divided by their own sum, so the word shares of all
trained words and one unknown word sum to one. The middle of a level is 0.75 to 1.5
times the count, for bigrams and contexts alike, so the probabilities of all next tokens
of a context sum to a value between 0.5 and 2; a bigram estimate above its context's is cut to it.
A false positive (about 0.16 % of the probes of absent levels at 16 bits and 5 probes) raises one estimate.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rankshelf.session import scratch_dir, stage, unstage, unstage_folders
from rankshelf.shipping import ship

MIN_BIGRAM = 1  # least count of a stored bigram: all; a higher one is an option
BITS_PER_ENTRY = 16
PROBES = 5  # bits of one stored level
MAX_BITS = 1 << 28  # bits of one shard's part
PASS_BYTES = 64 << 20  # parts broadcast at a time
MASS = 50.0  # weight of the word estimate in the bigram estimate
CHUNK = 6 << 20  # bytes of text counted and scored at a time
MIN_SHARDS = 64

END = np.uint64(0x9E3779B97F4A7C15)  # the end token; also the context of the first word
_LOW40 = np.uint64((1 << 40) - 1)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def tokens_of(text: bytes) -> np.ndarray:
    """Hashes of the words of one text, then the end token."""
    words = text.translate(_LOWER).split()
    hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    return np.append(hashes, END)


def held_out(doc_id: int | None) -> bool:
    """Held out of training; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def bigrams_of(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of every token with the one before it (the end token at the start of a text)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = END
    return mix(mix(before) + tokens)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def pack40(hashes: np.ndarray) -> bytes:
    """The low 40 bits of each hash; the shard already tells the high ones apart."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8").astype(np.uint64)


_TEXTS = pa.schema([("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("texts", pa.binary())])


def _chunks(batches: Iterator[pa.RecordBatch], about: int) -> Iterator[pa.RecordBatch]:
    """Whole documents, ``about`` so many bytes in a row."""
    chunk = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
    codec = pa.Codec("zstd", compression_level=6)  # texts lie on disk twice: here and in the last shuffle

    def row(ids: list, texts: list) -> pa.RecordBatch:
        values = chunk, ids, [len(t) for t in texts], codec.compress(b"".join(texts), asbytes=True)
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _TEXTS)], schema=_TEXTS)

    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["t"]):
            ids.append(doc_id)
            texts.append(text.as_buffer().to_pybytes())
            size += len(texts[-1]) + 1
            if size >= about:
                yield row(ids, texts)
                chunk, ids, texts, size = chunk + 1, [], [], 0
    if ids:
        yield row(ids, texts)


def _tokens(ids: pa.Scalar, sizes: pa.Scalar, texts: pa.Scalar) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, tokens, text starts and numbers of tokens of one chunk."""
    sizes = sizes.as_py()
    whole = pa.decompress(texts.as_buffer(), sum(sizes), "zstd", asbytes=True) if sum(sizes) else b""
    parts = [tokens_of(whole[e - n : e]) for e, n in zip(accumulate(sizes), sizes)]
    lengths = np.array([len(p) for p in parts])
    return ids.as_py(), np.concatenate(parts), np.cumsum(np.r_[0, lengths[:-1]]), lengths


_COUNTS = pa.schema(
    [("chunk", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("word_counts", pa.binary()), ("pairs", pa.binary()), ("pair_counts", pa.binary())]
)


def _count(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct words (whole hashes) and bigrams (40 bits) of each chunk for each shard, with their counts in training documents."""
    edges = np.arange(shards + 1, dtype=np.uint64)
    for batch in batches:
        for chunk, *packed in zip(batch["chunk"].to_pylist(), batch["ids"], batch["sizes"], batch["texts"]):
            ids, tokens, starts, lengths = _tokens(*packed)
            trained = np.repeat([not held_out(i) for i in ids], lengths)
            found = []
            for values in (tokens, bigrams_of(tokens, starts)):
                keys, which = np.unique(values, return_inverse=True)
                found.append((keys, np.bincount(which, trained, len(keys)).astype(np.uint32), np.searchsorted(shard_of(keys, shards), edges)))
            (words, word_counts, w), (pairs, pair_counts, p) = found
            rows = [
                (
                    chunk, int(s), words[w[s] : w[s + 1]].tobytes(), word_counts[w[s] : w[s + 1]].tobytes(),
                    pack40(pairs[p[s] : p[s + 1]]), pair_counts[p[s] : p[s + 1]].tobytes(),
                )
                for s in np.flatnonzero(np.diff(w) + np.diff(p))
            ]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _COUNTS)], schema=_COUNTS)


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def middle_of(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level, 0 for level 0."""
    return np.where(levels > 0, (np.exp2(levels - 1.0) + np.exp2(levels * 1.0) - 1) / 2, 0.0)


def positions(keys: np.ndarray, kind: int, level, bits) -> list[np.ndarray]:
    """The bits of stored (n-gram, level) pairs in a part of ``bits`` bits."""
    # the level is hashed with the key: strides of one key's levels could fall onto one another in a small part
    x = mix((keys & _LOW40) | ((np.asarray(level).astype(np.uint64) << np.uint64(2) | np.uint64(kind + 1)) << np.uint64(40)))
    step = mix(x ^ END) | np.uint64(1)
    return [(((x + np.uint64(i) * step) >> np.uint64(32)) * np.asarray(bits).astype(np.uint64)) >> np.uint64(32) for i in range(PROBES)]


class Filter:
    """Parts of the filter: one packed array and the place of each shard in it."""

    def __init__(self, parts: Iterable[tuple[int, int, bytes]], shards: int):
        self.shards = shards
        self.bits, self.start = np.full(shards, 64, np.uint64), np.zeros(shards, np.uint64)
        data, size = [bytes(8)], 8  # shards without a part look into eight empty bytes
        for shard, bits, part in parts:
            self.bits[shard], self.start[shard] = bits, size * 8
            data.append(part)
            size += len(part)
        self.data = np.frombuffer(b"".join(data), np.uint8)

    def counts(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        """Estimated counts."""
        return middle_of(self.levels(hashes, kind))

    def levels(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        """Levels are probed until one is missing."""
        return self.levels_in(shard_of(hashes, self.shards).astype(np.int64), hashes, kind)

    def levels_in(self, shard, hashes: np.ndarray, kind: int) -> np.ndarray:
        """The same for n-grams whose shard (one for all, or one each) is known; their low 40 bits are enough."""
        bits, start = (np.broadcast_to(x[shard], len(hashes)) for x in (self.bits, self.start))
        levels, alive, level = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 1
        while len(alive):
            there = np.ones(len(alive), bool)
            for at in positions(hashes[alive], kind, level, bits[alive]):
                at = at + start[alive]
                there &= (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[there]
            levels[alive] = level
            level += 1
        return levels


_ASKED = pa.schema(
    [
        ("chunk", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary()), ("words", pa.binary()), ("pairs", pa.binary()),
        ("n", pa.int64()), ("total", pa.int64()), ("estimate", pa.float64()), ("bits", pa.int64()), ("part", pa.binary()), ("bundle", pa.int32()),
    ]
)
ASKED = (
    "chunk long, shard int, counts binary, words binary, pairs binary, n long, total long, estimate double, bits long, part binary, bundle int"
)


def planes(counts: np.ndarray) -> bytes:
    """Whole numbers byte by byte, so that the high zeros compress."""
    return np.ascontiguousarray(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def part_of(ngrams: list[tuple[np.ndarray, np.ndarray]], per_entry: int = BITS_PER_ENTRY) -> tuple[int, bytes]:
    """Bits and packed bytes of one shard's part, with all the words and bigrams given, each with its counts."""
    entries = int(sum(level_of(c).sum() for _, c in ngrams))
    bits = max(64, -(-entries * per_entry // 8) * 8)
    part = np.zeros(bits, bool)
    for kind, (k, c) in enumerate(ngrams):
        levels = level_of(c)
        for level in range(1, int(levels.max(initial=0)) + 1):
            for at in positions(k[levels >= level], kind, level, bits):
                part[at.astype(np.int64)] = True
    return bits, np.packbits(part, bitorder="little").tobytes()


def _build(group: pa.Table, min_bigram: int, per_bundle: int, per_entry: int = BITS_PER_ENTRY) -> pa.Table:
    """Of one shard: a row without a chunk that has the part and its totals, then what each chunk asks, with the exact counts of its words."""
    sent = []
    for name, kind, unpack in (("words", "word_counts", lambda x: np.frombuffer(x, np.uint64)), ("pairs", "pair_counts", unpack40)):
        keys = [unpack(x.as_buffer()) for x in group[name]]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group[kind]])
        sent.append((distinct, np.bincount(which, counts, len(distinct)).astype(np.int64), which, cuts))
    (words, word_counts, w, w_cuts), (pairs, pair_counts, _, _) = sent
    known, some = word_counts > 0, pair_counts >= max(1, min_bigram)
    bits, part = part_of([(words[known], word_counts[known]), (pairs[some], pair_counts[some])], per_entry)
    rows, shard = group.num_rows, group["shard"][0].as_py()
    estimate = float(middle_of(level_of(word_counts[known])).sum())
    columns = [
        [None] + group["chunk"].to_pylist(), [shard] * (rows + 1), [None] + [planes(x) for x in np.split(word_counts[w], w_cuts)],
        [None] + group["words"].to_pylist(), [None] + group["pairs"].to_pylist(),
        [int(known.sum())] + [None] * rows, [int(word_counts.sum())] + [None] * rows, [estimate] + [None] * rows,
        [bits] + [None] * rows, [part] + [None] * rows, [shard // per_bundle] * (rows + 1),
    ]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ASKED)], schema=_ASKED)


def _passes(sizes: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """Ranges (first, last) of bundles whose parts have at most ``most`` bytes, or one bundle alone."""
    out, size = [], 0
    for bundle, n in sorted(sizes):
        if out and size + n <= most:
            out[-1], size = (out[-1][0], bundle), size + n
        else:
            out.append((bundle, bundle))
            size = n
    return out


_LEVELS = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("counts", pa.binary()), ("words", pa.binary()), ("pairs", pa.binary())])


def _probe(batches: Iterator[pa.RecordBatch], bloom: Filter) -> Iterator[pa.RecordBatch]:
    """Levels, a byte each, of the n-grams that chunks ask for, in the order asked."""
    for batch in batches:
        words = [bloom.levels(np.frombuffer(x.as_buffer(), np.uint64), 0).astype(np.uint8).tobytes() for x in batch["words"]]
        pairs = []
        for shard, x in zip(batch["shard"].to_pylist(), batch["pairs"]):
            pairs.append(bloom.levels_in(shard, unpack40(x.as_buffer()), 1).astype(np.uint8).tobytes())
        columns = batch["chunk"], batch["shard"], batch["counts"], pa.array(words, pa.binary()), pa.array(pairs, pa.binary())
        yield pa.record_batch([c.cast(f.type) for c, f in zip(columns, _LEVELS)], schema=_LEVELS)


_SCORES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
)


def next_token(pair: np.ndarray, context: np.ndarray, share: np.ndarray, mass: float) -> np.ndarray:
    """Probability of a token from the estimates of its bigram and its context and from its word share."""
    return (np.minimum(pair, context) + mass * np.minimum(share, 1.0)) / (context + mass)


def _score(state: pa.Table, answers: pa.Table, norm: float, mass: float) -> pa.Table:
    """The documents of one chunk, with the levels and the exact counts of their words."""
    ids, tokens, starts, lengths = _tokens(state["ids"][0], state["sizes"][0], state["texts"][0])
    # shards are ranges of the hashes: in their order the answers follow the distinct values
    answers = answers.sort_by("shard")
    whole = lambda name: np.frombuffer(b"".join(answers[name].to_pylist()), np.uint8).astype(np.int64)
    words, which = np.unique(tokens, return_inverse=True)
    _, pair_of = np.unique(bigrams_of(tokens, starts), return_inverse=True)
    exact, word_counts = np.concatenate([unplanes(x) for x in answers["counts"].to_pylist()]), middle_of(whole("words"))
    base = np.add.reduceat(np.log10(exact + 0.1)[which], starts)
    known = np.add.reduceat((exact > 0)[which].astype(np.int64), starts)
    # the model
    context = np.empty(len(tokens))
    context[1:] = word_counts[which[:-1]]
    context[starts] = word_counts[np.searchsorted(words, END)]
    chance = next_token(middle_of(whole("pairs"))[pair_of], context, ((word_counts + 0.1) / norm)[which], mass)
    score = np.add.reduceat(np.log10(chance), starts)
    return pa.table([pa.array(c, f.type) for c, f in zip((ids, lengths, known, base, score), _SCORES)], schema=_SCORES)


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bigram: int = MIN_BIGRAM,
    max_bits: int = MAX_BITS,
    mass: float = MASS,
    chunk: int = CHUNK,
    pass_bytes: int = PASS_BYTES,
    bits_per_entry: int = BITS_PER_ENTRY,
) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null and empty texts are the end token alone. Repeated rows are scored alike
    (and counted as often as they occur); a null id is held out. Without training
    documents every count is zero. An empty table gives no rows; other columns
    are ignored. Ids are integers. A text must fit a worker as a list of words.
    At most ``pass_bytes`` of the filter are broadcast at a time (a part is never split, so at
    least one); more passes give the same scores.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("t"),
    )
    # a text has a word for every two bytes at most, and the end token; a word or bigram has no more levels than occurrences
    most = texts.agg(F.sum(F.octet_length("t") / 2 + 1).alias("tokens")).first().tokens or 0
    most_bits = 2 * bits_per_entry * most
    shards = max(MIN_SHARDS, int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(most_bits / max_bits))
    per_bundle = max(1, int(shards * pass_bytes * 8 // max(most_bits, 1)))
    chunks = stage(texts.mapInArrow(partial(_chunks, about=chunk), "chunk long, ids array<long>, sizes array<long>, texts binary"), "lm-texts")
    packed = chunks.mapInArrow(
        partial(_count, shards=shards), "chunk long, shard int, words binary, word_counts binary, pairs binary, pair_counts binary"
    )

    def build(group: pa.Table) -> pa.Table:
        return _build(group, min_bigram, per_bundle, bits_per_entry)

    asked = stage(packed.groupBy("shard").applyInArrow(build, ASKED), "lm-asked", by="bundle")
    parts = asked.where("chunk IS NULL")
    sums = parts.agg(F.sum("total").alias("tokens"), F.sum("n").alias("distinct"), F.sum("estimate").alias("estimate")).first()
    n_train, distinct = sums.tokens or 0, sums.distinct or 0
    floor = n_train + 0.1 * (distinct + 1)
    norm = (sums.estimate or 0.0) + 0.1 * (distinct + 1)

    levels_at = scratch_dir(spark, "lm-levels") + "/data"
    levels_of = "chunk long, shard int, counts binary, words binary, pairs binary"
    spark.createDataFrame([], levels_of).write.parquet(levels_at)
    sizes = parts.groupBy("bundle").agg((F.sum("bits") / 8).cast("long").alias("size")).collect()
    for first, last in _passes([(r.bundle, r.size) for r in sizes], pass_bytes):
        here = F.col("bundle").between(first, last)
        bloom = spark.sparkContext.broadcast(Filter([(r.shard, r.bits, r.part) for r in parts.where(here).select("shard", "bits", "part").toLocalIterator()], shards))

        def probe(batches: Iterator[pa.RecordBatch], bloom=bloom) -> Iterator[pa.RecordBatch]:
            return _probe(batches, bloom.value)

        wanted = asked.where(here & F.col("chunk").isNotNull()).select("chunk", "shard", "counts", "words", "pairs")
        wanted.mapInArrow(probe, levels_of).write.mode("append").option("compression", "zstd").parquet(levels_at)
        bloom.unpersist()
        unstage_folders(asked, "bundle", range(first, last + 1))
    unstage(asked)
    answers = spark.read.schema(levels_of).parquet(levels_at)

    def score(state: pa.Table, found: pa.Table) -> pa.Table:
        return _score(state, found, norm, mass)

    per_row = (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(score, "doc_id long, n_tokens long, n_known long, base double, score double")
    )
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    return per_row.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(math.log10(floor))).alias("base_score"), "score",
    )
