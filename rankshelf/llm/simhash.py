"""SimHash near duplicates by anchor-point covering.

A fingerprint has 64 bits; documents link at ``MAX_BITS`` = 3 or fewer differing
bits. Of two linked fingerprints, one of their 32-bit halves differs in at most
one bit. Each half has its own anchors: the words of the [31, 26] Hamming code
with either value of the last bit. This covering code has radius 1, so

* the *home* of a half is the one anchor within distance 1 (the covering radius);
* a fingerprint is replicated to all anchors within 1 + 1 (radius plus the
  threshold of the half): 17 at most, 2 when the half is an anchor itself.

If two halves differ in one bit, each is within 2 of the other's home, so every
linked pair meets at an anchor where one of the two is at home. Per anchor, homes
are compared with all replicas on the full 64 bits.

Fingerprints are made distinct first, so exact groups of any size are one row.
An anchor with many homes is split into blocks of homes which are separate
groups for the shuffle; replicas stream past one block in batches, so a task
holds one block and one batch whatever the size of the group. Large groups send
on a spanning set of links (one per replica, plus those that connect the homes),
never all pairs. The components of the links give the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rankshelf.llm.components import connected_components
from rankshelf.session import stage
from rankshelf.shipping import ship

SHINGLE = 3  # words
SEED = 42
MAX_BITS = 3  # two halves with one bit each at most: see above
BATCH = 1 << 16  # shingles hashed at a time

@dataclass(frozen=True)
class Limits:
    """Sizes of the work units; they change no result."""

    homes: int = 4096  # homes in one block
    small: int = 4096  # comparisons of a group whose links are listed one by one
    rows: int = 1 << 16  # rows of one group held at a time
    cells: int = 1 << 22  # comparisons of a large group made at a time


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text; zero without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))  # each one past the blank after its word
    if len(words) < shingle:
        first, last = [0], [len(joined)]
    else:
        first = [0] + ends[: len(words) - shingle]
        last = [e - 1 for e in ends[shingle - 1 :]]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), BATCH):
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(first[at : at + BATCH], last[at : at + BATCH])], np.uint64)
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp``; ``fp`` is the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("t"))
    schema = pa.schema([pa.field("doc_id", pa.int64()), pa.field("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle, seed) for t in batch["t"]], np.uint64)
            yield pa.record_batch([batch["doc_id"].cast(pa.int64()), pa.array(prints.view(np.int64))], schema=schema)

    return rows.mapInArrow(run, "doc_id long, fp long")


# ---- anchors ---------------------------------------------------------------------------------

_POSITIONS = np.arange(1, 32, dtype=np.uint32)
_LAST = np.uint32(1 << 31)


def _bit(position: int) -> int:
    """Mask of a code position 1 to 31; position 0 is no change."""
    return 1 << (position - 1) if position else 0


def _reach() -> np.ndarray:
    """For each syndrome the changes that lead to an anchor within distance 2, home first; unused places repeat it."""
    out = np.zeros((32, 17), np.uint32)
    for s in range(32):
        masks = [_bit(s), _bit(s) | int(_LAST)]
        if s:
            masks += [_bit(j) | _bit(j ^ s) for j in range(1, 32) if j < j ^ s]
        out[s] = masks + masks[:1] * (17 - len(masks))
    return out


REACH = _reach()


def syndrome(half: np.ndarray) -> np.ndarray:
    """Hamming syndrome of the low 31 bits: the position to change, 0 for an anchor."""
    out = np.zeros(half.shape, np.uint32)
    for p in _POSITIONS:
        out ^= ((half >> np.uint32(p - 1)) & np.uint32(1)) * p
    return out


def anchor_rows(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (half number above the anchor), home flags and fingerprints of all replicas."""
    keys, homes, owners = [], [], []
    for number, half in enumerate(((fps & np.uint64(0xFFFFFFFF)).astype(np.uint32), (fps >> np.uint64(32)).astype(np.uint32))):
        s = syndrome(half)
        anchors = half[:, None] ^ REACH[s]
        used = np.ones(anchors.shape, bool)
        used[s == 0, 2:] = False
        home = np.zeros(anchors.shape, bool)
        home[:, 0] = True
        keys.append((anchors.astype(np.int64) | (np.int64(number) << np.int64(32)))[used])
        homes.append(home[used])
        owners.append(np.repeat(fps[:, None], 17, axis=1)[used])
    return np.concatenate(keys), np.concatenate(homes), np.concatenate(owners)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
        keys, homes, owners = anchor_rows(fps)
        yield pa.record_batch([pa.array(keys), pa.array(homes), pa.array(owners.view(np.int64))], names=["anchor", "home", "fp"])


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= MAX_BITS


def spanning_links(homes: np.ndarray, others: np.ndarray, cells: int = Limits.cells) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links between ``homes`` and ``others`` connect, at most one for each row."""
    a, b, label = [], [], np.arange(len(homes))
    width = max(1, cells // len(homes))
    for at in range(0, len(others), width):
        part = others[at : at + width]
        linked = _near(homes[:, None], part[None, :])
        some = linked.any(axis=0)
        part, linked = part[some], linked[:, some]
        a.append(part)
        b.append(homes[linked.argmax(axis=0)])
        while part.size:
            lowest = np.where(linked, label[:, None], len(homes)).min(axis=0)
            reached = np.minimum(label, np.where(linked, lowest[None, :], len(homes)).min(axis=1))
            # a class moves as a whole: what earlier parts joined stays joined
            root = np.arange(len(homes))
            np.minimum.at(root, label, reached)
            while (root[root] != root).any():
                root = root[root]
            merged = root[label]
            if (merged == label).all():
                break
            label = merged
    a.append(homes)
    b.append(homes[label])
    a, b = np.concatenate(a), np.concatenate(b)
    return a[a != b], b[a != b]


def _links_of(group: np.ndarray, home: np.ndarray, fp: np.ndarray, small_work: int, cells: int = Limits.cells) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole groups; ``group`` numbers the rows' groups, homes come first in each."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    n_homes = np.add.reduceat(home.astype(np.int64), starts)
    work = n_homes * sizes
    a, b = [], []
    for g in np.flatnonzero((work > small_work) & (sizes > 1)):
        rows = slice(starts[g], starts[g] + sizes[g])
        x, y = spanning_links(fp[rows][: n_homes[g]], fp[rows], cells)
        a.append(x)
        b.append(y)
    small = (work <= small_work) & (sizes > 1) & (n_homes > 0)
    # each home of a small group beside each row of its group
    at = np.repeat(starts[small], n_homes[small])
    count = np.repeat(sizes[small], n_homes[small])
    if len(at):
        nth = np.arange(len(at)) - np.repeat(np.cumsum(n_homes[small]) - n_homes[small], n_homes[small])
        x = np.repeat(fp[at + nth], count)
        y = fp[np.repeat(at, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        hit = _near(x, y) & (x != y)
        a.append(x[hit])
        b.append(y[hit])
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _compare(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor and block, homes first: the links of every group."""
    held = None

    def links(anchor, block, home, fp):
        if not len(fp):
            return None
        group = np.cumsum(np.r_[0, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])])
        x, y = _links_of(group, home, fp, limits.small, limits.cells)
        return pa.record_batch([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    for batch in batches:
        new = [
            batch["anchor"].to_numpy(zero_copy_only=False), batch["block"].to_numpy(zero_copy_only=False),
            batch["home"].to_numpy(zero_copy_only=False), batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64),
        ]
        rows = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        if not len(rows[0]):
            continue
        same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
        cut = int(np.argmax(same))  # where the last group begins
        done = links(*[x[:cut] for x in rows])
        if done is not None:
            yield done
        held = [x[cut:] for x in rows]
        if len(held[0]) > limits.rows and not held[2][-1]:
            yield links(*held)  # a long group: its homes stay for the rows to come
            held = [x[held[2]] for x in held]
    if held is not None and len(held[0]):
        yield links(*held)


def near_links(prints: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints of ``prints(fp)``, enough to connect every class."""
    distinct = stage(prints.select("fp").distinct(), "simhash-distinct")
    rows = stage(distinct.mapInArrow(_replicate, "anchor long, home boolean, fp long"), "simhash-anchors")
    busy = rows.where("home").groupBy("anchor").count().where(f"count > {limits.homes}").select(
        "anchor", F.ceil(F.col("count") / limits.homes).cast("int").alias("blocks")
    )
    # beside a busy anchor's block of homes stand all rows of the anchor
    spread = rows.join(busy, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("anchor", "block", (F.col("home") & (F.col("block") == F.col("own"))).alias("home"), "fp")
    ordered = spread.repartition("anchor", "block").sortWithinPartitions("anchor", "block", F.desc("home"))
    return ordered.mapInArrow(partial(_compare, limits=limits), "a long, b long")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, limits: Limits = Limits()) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable.

    Texts without words (null, empty, blank) have fingerprint zero and link like
    any other. Repeated rows share fingerprint and class. Null ids are ignored by
    the minimum; a class with null ids only has a null ``component_id``. An empty
    table gives no rows; other columns are ignored. Ids are integers.
    """
    ship(docs.sparkSession)
    prints = stage(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-prints")
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    nodes = stage(connected_components(near_links(prints, limits)), "simhash-roots")
    linked = nodes.join(smallest, nodes.node == smallest.fp).select("node", "root", "first_id")
    of_root = linked.groupBy("root").agg(F.min("first_id").alias("class_id"))
    of_print = stage(
        smallest.join(linked.select(F.col("node").alias("fp"), "root").join(of_root, "root"), "fp", "left").select(
            "fp", F.coalesce("class_id", "first_id").alias("component_id")
        ),
        "simhash-classes",
    )
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all their columns whatever their names.

    Rows are told apart by id: rows that share one stay or go together, and a row
    without an id, which cannot be named, stays.
    """
    gone = stage(
        simhash_classes(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("_sim_gone")).distinct(),
        "simhash-gone",
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))  # no column can clash with the id
    return rows.join(gone, F.col(f"_row.`{id_col}`") == F.col("_sim_gone"), "left_anti").select("_row.*")
