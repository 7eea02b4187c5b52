"""Token ids in training order: fixed-stride binary shards behind a keyed permutation.

Every document is tokenised and cut into sequences of ``seq_len`` ids. The
sequences are numbered 0 to N - 1 in input order, and a keyed Feistel permutation
(with cycle-walking back into the range) turns the number into the sequence's
slot in the training order. Slots are dealt to range partitions and written as
shards in which every record has the same size, so a reader finds slot s at byte
(s mod shard_rows) * stride of shard s div shard_rows, and training can stop and
resume anywhere.

Numbering takes two passes over the documents, as a sequence's number depends on
all partitions before its own: the first counts sequences per input partition
(one row each) and makes no ids, the second tokenises and emits records. Both passes read
the same partitions of the input, so ``docs`` should be a table read from files;
a checksum of ids and lengths makes the second pass fail, rather than mislabel,
if a partition differs.

Shards are written by Spark's text writer: it commits whole tasks (a lost
executor leaves no half shard) and reaches every store Spark does. A record is
16 bytes of header, ``seq_len`` unsigned 16-bit ids, and the writer's line end.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from rankshelf.llm.text import whole_text
from rankshelf.session import scratch_dir
from rankshelf.shipping import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed pattern that belongs to the vocabulary: how a text is cut before byte pairs are merged.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50_256  # free id of the vocabulary: end of text, and padding
MEMORY = 200_000  # words that a worker remembers
SLICE = 1 << 21  # bytes encoded at a time

_HEADER = struct.Struct("<qiHH")  # doc_id, number in the document, ids, 1 if the doc_id is null


@dataclass(frozen=True)
class Layout:
    """How shards are cut; written beside them."""

    sequences: int
    seq_len: int = 256
    shard_rows: int = 16_384
    key: int = 42

    @property
    def stride(self) -> int:
        return _HEADER.size + 2 * self.seq_len + 1

    @property
    def shards(self) -> int:
        return -(-self.sequences // self.shard_rows)


# ---- tokeniser -------------------------------------------------------------------------------

_WORKER: dict[int, "Encoder"] = {}  # one encoder per worker and vocabulary


_BLANK, _SPACE, _ALNUM, _MARK, _LEAD = 1, 2, 4, 8, 16


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[32] = _BLANK | _SPACE
    kinds[9:14] = _SPACE
    kinds[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _ALNUM
    kinds[list(b",.;:!?")] = _MARK
    kinds[[0xC2, 0xE1, 0xE2, 0xE3]] = _LEAD  # of white space beyond ASCII, and of much else
    return kinds


_KINDS = _byte_kinds()
_WIDE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Equal to PATTERN where each run of white space is a line feed and a blank at most, and faster, as it looks at nothing behind a match.
_WORDS_PATTERN = PATTERN.replace(r"|\s+(?!\S)|\s+", r"|\s")
_WORD = rf"^ ?[^\s\x0b{_WIDE}]+$"


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (sizes[0] numbers), first[1], ..."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Encoder:
    """Byte-pair encoder that remembers the ids of words.

    Byte pairs are merged within the pattern's matches only, so a text may be cut wherever a match ends,
    and these places show in its bytes. A match ends before a run of white space; before the run's last
    character unless the text ends there; after that character unless it is a blank; and between an ASCII
    letter or digit and a closing mark. Only texts in which white space beyond ASCII meets other white
    space are encoded whole. The pieces of many texts, which are mostly single words, are looked up at
    once, and unknown ones encoded in one call.

    Memory is bounded: beyond ``MEMORY`` pieces (some 50 bytes each) only the half that is used most is kept,
    and none of over 32 bytes.
    """

    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        self._plain, self._words = (tiktoken.Encoding("own", pat_str=p, mergeable_ranks=ranks, special_tokens={}).encode_ordinary for p in (PATTERN, _WORDS_PATTERN))
        (self._between,) = self._words("\n")
        self._meeting = re.compile(rf"[{_WIDE}]\s|\s[{_WIDE}]")
        # pieces, how often they were used, where their ids start, how many these are, ids
        self._pieces = pa.array([], pa.large_binary())
        self._uses, self._first, self._sizes = (np.zeros(0, np.int64) for _ in range(3))
        self._ids = np.zeros(0, "<u2")

    @classmethod
    def of(cls, vocabulary: bytes) -> "Encoder":
        key = zlib.crc32(vocabulary)
        if key not in _WORKER:
            _WORKER[key] = cls(vocabulary)
        return _WORKER[key]

    def encode(self, texts: pa.StringArray) -> Iterator[bytes]:
        """Packed ids of each text, as the plain encoder gives them."""
        for whole, edges, pieces in self._slices(texts):
            sizes = self._sizes[pieces]
            flat = self._ids[_runs(self._first[pieces], sizes)].tobytes()
            at = (2 * np.r_[0, np.cumsum(sizes)][edges]).tolist()
            for n, (start, end) in enumerate(zip(at, at[1:])):
                yield whole[n].tobytes() if n in whole else flat[start:end]

    def lengths(self, texts: pa.StringArray) -> Iterator[int]:
        """Number of ids of each text."""
        for whole, edges, pieces in self._slices(texts):
            sizes = np.diff(np.r_[0, np.cumsum(self._sizes[pieces])][edges])
            for n, size in enumerate(sizes.tolist()):
                yield len(whole[n]) if n in whole else size

    def _slices(self, texts: pa.StringArray) -> Iterator[tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]]:
        """For slices of about SLICE bytes: ids of the texts that cannot be cut, first piece of each text (and the end),
        and the pieces, as numbers among those remembered."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        at = 0
        while at < len(texts):
            stop = min(len(texts), max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE))))
            whole, edges, pieces = self._slice(texts[at:stop], offsets[at : stop + 1])
            yield whole, edges, pieces
            self._forget(pieces)
            at = stop

    def _slice(self, texts: pa.LargeStringArray, offsets: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray, np.ndarray]:
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets, kinds, whole = offsets - offsets[0], _KINDS[data], {}
        for n in np.unique(np.searchsorted(offsets, np.flatnonzero(kinds & _LEAD), "right") - 1).tolist():
            text = texts[n].as_py()
            if self._meeting.search(text):
                whole[n] = np.array(self._plain(text), "<u2")
        if whole:
            sizes = np.diff(offsets)
            cut = np.zeros(len(sizes), bool)
            cut[list(whole)] = True
            keep = np.repeat(~cut, sizes)
            data, kinds, offsets = data[keep], kinds[keep], np.r_[0, np.cumsum(np.where(cut, 0, sizes))]
        starts = self._starts(kinds, offsets)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[starts, len(data)]), pa.py_buffer(data)])
        found = pc.index_in(parts, value_set=self._pieces)
        pieces = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if found.null_count:
            new = parts.filter(found.is_null()).dictionary_encode()
            pieces[pieces < 0] = len(self._pieces) + new.indices.to_numpy()
            self._learn(new.dictionary)
        return whole, np.searchsorted(starts, offsets), pieces

    @staticmethod
    def _starts(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pieces of texts that lie one after the other start."""
        cut = np.zeros(len(kinds), bool)
        if len(cut):
            filled = offsets[:-1][np.diff(offsets) > 0]
            space = (kinds & _SPACE) > 0
            before, after = space[:-1], space[1:]
            last = np.zeros(len(cut), bool)  # of a run, with other characters of its text behind it
            last[:-1] = before & ~after
            last[filled[1:] - 1] = False
            cut[1:] = after & ~before | last[1:] | ~after & before & ((kinds[:-1] & _BLANK) == 0) | ((kinds[1:] & _MARK) > 0) & ((kinds[:-1] & _ALNUM) > 0)
            cut[filled] = True
        return np.flatnonzero(cut)

    def _learn(self, new: pa.LargeBinaryArray) -> None:
        """Remember new pieces. Words are encoded in one call: a line feed between them is always a match, and an id, of its own."""
        texts = new.cast(pa.large_string())
        word = pc.match_substring_regex(texts, _WORD)
        ids = np.array(self._words("\n".join(texts.filter(word).to_pylist())), "<u2")
        ends = np.r_[np.flatnonzero(ids == self._between), len(ids)]
        first, sizes = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        words = np.flatnonzero(word.to_numpy(zero_copy_only=False))
        if len(words):
            first[words] = np.r_[0, ends[:-1] + 1]
            sizes[words] = ends - first[words]
        others = [self._plain(t) for t in texts.filter(pc.invert(word)).to_pylist()]
        if others:
            at = np.flatnonzero(~word.to_numpy(zero_copy_only=False))
            sizes[at] = [len(x) for x in others]
            first[at] = len(ids) + np.cumsum(sizes[at]) - sizes[at]
            ids = np.r_[ids, np.array([i for x in others for i in x], "<u2")]
        self._pieces = pa.concat_arrays([self._pieces, new])
        self._uses = np.r_[self._uses, np.zeros(len(new), np.int64)]
        self._first, self._sizes, self._ids = np.r_[self._first, len(self._ids) + first], np.r_[self._sizes, sizes], np.r_[self._ids, ids]

    def _forget(self, used: np.ndarray) -> None:
        """Beyond MEMORY pieces, or if some are long, keep the half that was used most, counting past uses less and less."""
        self._uses += np.bincount(used, minlength=len(self._uses))
        if len(self._pieces) <= MEMORY and self._pieces.nbytes <= 32 * MEMORY:
            return
        keep = pc.binary_length(self._pieces).to_numpy() <= 32
        if MEMORY // 2 < len(keep):
            keep[np.argpartition(self._uses, len(keep) - MEMORY // 2 - 1)[: len(keep) - MEMORY // 2]] = False
        self._pieces, self._uses = self._pieces.filter(pa.array(keep)), self._uses[keep] // 2
        first, self._sizes = self._first[keep], self._sizes[keep]
        self._ids, self._first = self._ids[_runs(first, self._sizes)], np.cumsum(self._sizes) - self._sizes


# ---- permutation -----------------------------------------------------------------------------


def _round(x: np.ndarray, key: int, number: int) -> np.ndarray:
    seed = (key * 0x9E3779B97F4A7C15 + (number + 1) * 0xD1B54A32D192ED03) % (1 << 64)
    x = x ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permute(numbers: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """A bijection of 0 .. size - 1: a balanced Feistel network on the next even number of bits, walked
    until it is back in the range (fewer than four steps on average)."""
    half = max(1, -(-(max(size - 1, 1)).bit_length() // 2))
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for number in range(rounds):
            left, right = right, left ^ (_round(right, key, number) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


# ---- passes ----------------------------------------------------------------------------------


def _partition() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def _check(so_far: int, doc_id: int | None, size: int) -> int:
    return zlib.crc32(f"{doc_id}:{size};".encode(), so_far)


def _count(batches: Iterator[pa.RecordBatch], vocabulary, seq_len: int) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(vocabulary.value)
    sequences = check = 0
    for batch in batches:
        for doc_id, size in zip(batch["doc_id"].to_pylist(), encoder.lengths(batch["t"]), strict=True):
            sequences += -(-(size + 1) // seq_len)  # the end id counts
            check = _check(check, doc_id, size + 1)
    yield pa.record_batch([pa.array([_partition()], pa.int64()), pa.array([sequences], pa.int64()), pa.array([check], pa.int64())], names=["part", "sequences", "check"])


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[tuple[int | None, bytes]]:
    encoder = Encoder.of(vocabulary.value)
    for batch in batches:
        for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["t"]), strict=True):
            yield doc_id, ids + END.to_bytes(2, "little")


def _emit(batches: Iterator[pa.RecordBatch], vocabulary, parts, layout: Layout) -> Iterator[pa.RecordBatch]:
    first, expected = parts.value[_partition()]
    check, number, records = 0, first, []
    width = 2 * layout.seq_len

    def rows():
        slots = permute(np.arange(number - len(records), number), layout.sequences, layout.key)
        return pa.record_batch([pa.array(slots), pa.array(records, pa.binary())], names=["slot", "record"])

    for doc_id, ids in _encoded(batches, vocabulary):
        check = _check(check, doc_id, len(ids) // 2)
        for nth, at in enumerate(range(0, len(ids), width)):
            part = ids[at : at + width]
            head = _HEADER.pack(doc_id or 0, nth, len(part) // 2, doc_id is None)
            records.append(head + part + END.to_bytes(2, "little") * ((width - len(part)) // 2))
            number += 1
            if len(records) == 4096:
                yield rows()
                records = []
    if check != expected:
        raise RuntimeError("the input's partitions changed between counting and writing")
    if records:
        yield rows()


def write_shards(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    seq_len: int = 256,
    shard_rows: int = 16_384,
    key: int = 42,
) -> Layout:
    """Write the shards of ``docs`` under ``path`` and return their layout (also kept there as JSON).

    Null and empty texts are one sequence with the end id; the last sequence of a
    document is padded with it. Repeated rows are written as often as they occur,
    null ids are marked in the header, an empty table writes no shard. Other
    columns are ignored. Ids are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        words = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").alias("t"))
    # one row for each partition of the input
    counted = sorted(rows.mapInArrow(partial(_count, vocabulary=words, seq_len=seq_len), "part long, sequences long, check long").collect())
    parts, total = {}, 0
    for r in counted:
        parts[r.part] = (total, r.check)
        total += r.sequences
    layout = Layout(total, seq_len, shard_rows, key)
    spark.createDataFrame([(json.dumps(asdict(layout)),)], "value string").coalesce(1).write.text(f"{path}/layout")
    if total:
        shared = spark.sparkContext.broadcast(parts)
        records = rows.mapInArrow(partial(_emit, vocabulary=words, parts=shared, layout=layout), "slot long, record binary")
        # ranges of slots are known, so no sampling: each partition gets a run of whole shards
        tasks = min(layout.shards, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
        run = -(-layout.shards // tasks)
        shard = F.expr(f"slot div {shard_rows}")
        (
            records.withColumn("shard", shard)
            .repartitionById(tasks, F.expr(f"cast(shard div {run} as int)"))
            .sortWithinPartitions("shard", "slot")
            .select("shard", F.col("record").cast("string").alias("value"))
            .write.partitionBy("shard").text(f"{path}/shards")
        )
    return layout


def _parse(batches: Iterator[pa.RecordBatch], layout: Layout, first: int, last: int) -> Iterator[pa.RecordBatch]:
    kind = np.dtype([("doc_id", "<i8"), ("seq_no", "<i4"), ("n", "<u2"), ("null", "<u2"), ("ids", "<u2", layout.seq_len), ("end", "u1")])
    for batch in batches:
        for shard, content in zip(batch["shard"].to_pylist(), batch["content"]):
            records = np.frombuffer(content.as_buffer(), kind)
            slots = shard * layout.shard_rows + np.arange(len(records))
            records, slots = records[(slots >= first) & (slots < last)], slots[(slots >= first) & (slots < last)]
            for at in range(0, len(records), 1024):
                r = records[at : at + 1024]
                ids = r["ids"][np.arange(layout.seq_len)[None, :] < r["n"][:, None]].astype(np.int32)
                yield pa.record_batch(
                    [
                        pa.array(slots[at : at + 1024]), pa.array(np.full(len(r), shard, np.int64)),
                        pa.array(r["doc_id"], pa.int64(), mask=r["null"] == 1), pa.array(r["seq_no"].astype(np.int32)),
                        pa.array(r["n"].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(r["n"].astype(np.int32))].astype(np.int32)), pa.array(ids)),
                    ],
                    names=["slot", "shard", "doc_id", "seq_no", "n_tokens", "ids"],
                )


def read_layout(spark: SparkSession, path: str) -> Layout:
    return Layout(**json.loads(spark.read.text(f"{path}/layout").first().value))


def read_shards(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """``slot, shard, doc_id, seq_no, n_tokens, ids`` of the slots in [first, last); other shards are not opened."""
    ship(spark)
    layout = read_layout(spark, path)
    last = layout.sequences if last is None else min(last, layout.sequences)
    columns = "slot long, shard long, doc_id long, seq_no int, n_tokens int, ids array<int>"
    if first >= last:
        return spark.createDataFrame([], columns)
    files = (
        spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, shard long").load(f"{path}/shards")
        .where(F.col("shard").between(first // layout.shard_rows, (last - 1) // layout.shard_rows))
    )
    return files.select("shard", "content").mapInArrow(partial(_parse, layout=layout, first=first, last=last), columns)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` as shards in the session's shared folder and read all of them back."""
    path = scratch_dir(docs.sparkSession, "token-shards")
    write_shards(docs, path, **options)
    return read_shards(docs.sparkSession, path)
