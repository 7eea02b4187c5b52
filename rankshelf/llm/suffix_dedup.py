"""Removal of repeated byte strings by a suffix sort compared with hashes.

A byte goes when a string of ``length`` bytes that covers it starts at another
place too, in any document. Three steps find these strings without listing the
suffixes of the whole corpus:

1. *Anchors.* Of every window of ``length`` bytes, the ``gram``-byte string with
   the smallest hash (the leftmost of equal ones) is its anchor. Equal windows
   have their anchors at the same place, so two equal windows meet at anchors
   with equal grams. An anchor's context is all that windows around its gram can
   cover. Anchors with equal contexts repeat as a whole; counting (gram, context)
   pairs, map-side first, settles them without sending any text, however large
   the group.
2. *Suffix sort.* Anchors that share a gram in different contexts send one copy of
   each context to the task of the gram. There the suffixes from the anchors are
   merge-sorted; two suffixes are compared by a binary search over polynomial
   prefix hashes for their common extension and by the byte after it. The same is
   done for the strings before the anchors, read backwards. The extensions of
   neighbours are then verified byte by byte (a collision would lead to a sort of
   the plain bytes). Suffixes that agree in the first ``length - o`` bytes to the
   right and the first ``o`` to the left are equal windows at offset ``o``. A gram with
   more than ``SORTED`` contexts is first split into groups of those that can have a
   window in common, by the bytes that all windows at some offsets share.
3. *Removal.* The covered range around each anchor goes back to the documents
   that hold it.

Grams with more than ``hot`` contexts do not go to one task. Each of their windows
is sent as a hash of its own and counted, again map-side first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankshelf.llm.text import whole_text
from rankshelf.session import stage
from rankshelf.shipping import ship

U64 = np.uint64
CORE = 1 << 19  # bytes of one text worked on at a time; longer texts are cut into overlapping pieces
CHUNK = 1 << 19  # bytes of a chunk of texts
SORTED = 2048  # contexts that are sorted at once
BITMAP = 1 << 27  # bits of the broadcast filter of repeated grams: 16 MB


@dataclass(frozen=True)
class Repeats:
    """What counts as a repeat, and the size above which a gram's contexts are counted window by window."""

    length: int = 400
    gram: int = 128
    hot: int = 50_000

    @property
    def reach(self) -> int:
        """Windows around an anchor's gram start up to this many bytes before it."""
        return self.length - self.gram


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


# ---- polynomial prefix hashes modulo 2**64 ---------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U64(_BASE))  # a 64-bit value for each byte
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the worker."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, U64)
            step, done = base, 1
            while done < size:  # out[done + i] = out[i] * base ** done
                out[done : 2 * done] = out[:done] * U64(step)
                step, done = step * step % (1 << 64), 2 * done
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


class Prefixes:
    """Hashes of all substrings of ``data`` by their ends."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def of_length(self, n: int) -> np.ndarray:
        """Hashes of all substrings of one length."""
        count = len(self.sums) - n
        return (self.sums[n:] - self.sums[:count]) * self.down[:count] if count > 0 else np.zeros(0, U64)


# ---- anchors ---------------------------------------------------------------------------------


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, U64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def pieces_of(size: int, length: int) -> list[tuple[int, int, int, int]]:
    """(first, last, from, to): a piece of a text owns the anchors in [first, last) and reads [from, to)."""
    return [(c, min(size, c + CORE), max(0, c - length), min(size, c + CORE + length)) for c in range(0, size, CORE)]


class Found:
    """Anchors of a chunk: the piece, place in the chunk, hashes and context of each."""

    def __init__(self, pieces: list[bytes], owned: list[tuple[int, int]], rule: Repeats):
        """``owned``: which places of each piece are its own."""
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        stops = np.cumsum(sizes)
        starts = stops - sizes
        self.prefixes = Prefixes(self.data)
        grams = self.prefixes.of_length(rule.gram)
        ranked = (mix(grams) >> U64(26) << U64(26)) | np.arange(len(grams), dtype=U64)
        minima = (window_minima(ranked, rule.reach + 1) & U64((1 << 26) - 1)).astype(np.int64)
        # windows that do not cross the end of their piece
        counts = np.maximum(sizes - rule.length + 1, 0)
        piece = np.repeat(np.arange(len(pieces)), counts)
        windows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[piece]
        at = minima[windows]
        first = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
        at, piece = at[first], piece[first]
        low, high = np.array(owned, np.int64).reshape(-1, 2).T
        mine = (at - starts[piece] >= low[piece]) & (at - starts[piece] < high[piece])
        self.at, self.piece = at[mine], piece[mine]
        self.place = self.at - starts[self.piece]
        self.left = np.minimum(self.place, rule.reach)
        self.right = np.minimum(stops[self.piece] - self.at, rule.length)
        self.gram = mix(grams[self.at])
        shape = mix((self.left.astype(U64) << U64(32)) | self.right.astype(U64))
        self.context = mix(self.prefixes.of(self.at - self.left, self.at + self.right) ^ shape)


def _chunks(batches: Iterator[pa.RecordBatch], rule: Repeats) -> Iterator[tuple[list, Found]]:
    """(doc_id, row key, start of the piece in its text) of each piece, and the anchors of the chunk."""
    owners, pieces, owned, size = [], [], [], 0
    for batch in batches:
        for doc_id, key, text in zip(batch["doc_id"].to_pylist(), batch["key"].to_pylist(), batch["t"]):
            raw = text.as_buffer().to_pybytes()
            if len(raw) < rule.length:
                continue
            for first, last, low, high in pieces_of(len(raw), rule.length):
                owners.append((doc_id, key, low))
                pieces.append(raw[low:high])
                owned.append((first - low, last - low))
                size += high - low
                if size >= CHUNK:
                    yield owners, Found(pieces, owned, rule)
                    owners, pieces, owned, size = [], [], [], 0
    if pieces:
        yield owners, Found(pieces, owned, rule)


def _anchors(batches: Iterator[pa.RecordBatch], rule: Repeats) -> Iterator[pa.RecordBatch]:
    for owners, found in _chunks(batches, rule):
        ids, keys, lows = zip(*owners)
        take = pa.array(found.piece)
        yield pa.record_batch(
            [
                pa.array(ids, pa.int64()).take(take), pa.array(keys, pa.int64()).take(take),
                pa.array(np.array(lows, np.int64)[found.piece] + found.place),
                pa.array(found.gram.view(np.int64)), pa.array(found.context.view(np.int64)),
            ],
            names=["doc_id", "key", "at", "gram", "context"],
        )


def _contexts(batches: Iterator[pa.RecordBatch], rule: Repeats, bitmap) -> Iterator[pa.RecordBatch]:
    """One copy per chunk of each context whose gram the filter holds."""
    bits = bitmap.value
    for _, found in _chunks(batches, rule):
        at = (found.gram & U64(BITMAP - 1)).astype(np.int64)
        hit = np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
        if not len(hit):
            continue
        pairs = np.stack([found.gram[hit], found.context[hit]], axis=1)
        hit = hit[np.unique(pairs, axis=0, return_index=True)[1]]
        data = found.data.tobytes()
        texts = [data[a - x : a + y] for a, x, y in zip(found.at[hit], found.left[hit], found.right[hit])]
        yield pa.record_batch(
            [
                pa.array(found.gram[hit].view(np.int64)), pa.array(found.context[hit].view(np.int64)),
                pa.array(found.left[hit].astype(np.int32)), pa.array(texts, pa.binary()),
            ],
            names=["gram", "context", "before", "bytes"],
        )


# ---- suffix sort -----------------------------------------------------------------------------


class Suffixes:
    """Strings to the right (or, backwards, to the left) of anchors in ``data``."""

    def __init__(self, data: np.ndarray, prefixes: Prefixes, at: np.ndarray, size: np.ndarray, backwards: bool):
        self.data, self.prefixes, self.at, self.size, self.backwards = data, prefixes, at, size, backwards

    def _hash(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        a = self.at[i]
        return self.prefixes.of(a - n, a) if self.backwards else self.prefixes.of(a, a + n)

    def _byte(self, i: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Byte number ``n`` of suffix ``i``, -1 past its end."""
        inside = n < self.size[i]
        place = self.at[i] - 1 - n if self.backwards else self.at[i] + n
        return np.where(inside, self.data[np.where(inside, place, 0)].astype(np.int16), -1)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common beginning, by binary search over hashes."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._hash(i, middle) == self._hash(j, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def order(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Negative, zero or positive as suffix ``i`` is before, equal to or after ``j``."""
        n = self.extension(i, j)
        return self._byte(i, n) - self._byte(j, n)

    def verified(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> bool:
        """Do the first ``n`` bytes agree and the next ones differ?"""
        if (self._byte(i, n) == self._byte(j, n))[n < np.minimum(self.size[i], self.size[j])].any():
            return False
        for at in range(0, len(i), 1024):
            part = slice(at, at + 1024)
            count = n[part]
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            if (self._byte(np.repeat(i[part], count), step) != self._byte(np.repeat(j[part], count), step)).any():
                return False
        return True

    def plain(self, i: int) -> bytes:
        a, n = int(self.at[i]), int(self.size[i])
        return self.data[a - n : a][::-1].tobytes() if self.backwards else self.data[a : a + n].tobytes()


def merge_sort(suffixes: Suffixes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sort every group's suffixes; ``start`` and ``size`` are those of the group of each place.

    All pairs of neighbouring runs of all groups are merged at once: a suffix
    moves by the number of suffixes in the other run that come before it, which
    a binary search over that run finds.
    """
    order, run = np.arange(len(start)), 1
    while run < size.max(initial=0):
        place = np.flatnonzero(size > run)
        begin, nth = start[place], place - start[place]
        own = nth // run
        other = begin + (own ^ 1) * run
        low, high = np.zeros(len(place), np.int64), np.clip(begin + size[place] - other, 0, run)
        item = order[place]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) >> 1
            compared = suffixes.order(order[other[open_] + middle], item[open_])
            before = (compared < 0) | ((compared == 0) & (own[open_] % 2 == 1))
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        merged = order.copy()
        merged[begin + (own // 2) * 2 * run + nth % run + low] = item
        order, run = merged, 2 * run
    return order


def sorted_extensions(suffixes: Suffixes, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order, and at each place the verified common extension with the place before; -1 where a group begins."""
    order = merge_sort(suffixes, start, size)
    inner = np.flatnonzero(np.arange(len(start)) != start)
    out = np.full(len(start), -1, np.int64)
    out[inner] = suffixes.extension(order[inner - 1], order[inner])
    if not suffixes.verified(order[inner - 1], order[inner], out[inner]):  # a hash collision: sort the plain bytes
        order = np.array(sorted(range(len(start)), key=lambda i: (start[i], suffixes.plain(i))), np.int64)
        for t in inner:
            x, y = suffixes.plain(order[t - 1]), suffixes.plain(order[t])
            out[t] = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    return order, out


def repeated_offsets(group: np.ndarray, before: np.ndarray, texts: list[bytes], rule: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """For each context the first and last offset whose window another context of its group has too; -1 without.

    ``group`` numbers the groups in order, ``before`` is the place of the anchor in its text.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum(sizes) - sizes + before
    begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[begin, n])
    start, size = np.repeat(begin, size), np.repeat(size, size)
    prefixes = Prefixes(data)
    right = sorted_extensions(Suffixes(data, prefixes, at, sizes - before, False), start, size)
    left = sorted_extensions(Suffixes(data, prefixes, at, before.astype(np.int64), True), start, size)

    def longest(order, extension):
        out = np.zeros(n, np.int64)
        out[order] = np.maximum(extension, np.r_[extension[1:], -1])
        return out

    most_right, most_left = longest(*right), longest(*left)
    first, last = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    able = most_right + most_left >= rule.length
    if not able.any():
        return first, last

    def classes(order, extension, depth):
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(extension < depth)
        return out

    for o in range(rule.reach + 1):
        some = np.flatnonzero(able & (most_right >= rule.length - o) & (most_left >= o))
        if len(some) < 2:
            continue
        pair = classes(*right, rule.length - o)[some] * (n + 1) + classes(*left, o)[some]
        order = np.argsort(pair, kind="stable")
        same = pair[order][1:] == pair[order][:-1]
        twice = some[order[np.r_[False, same] | np.r_[same, False]]]
        last[twice] = o
        first[twice] = np.where(first[twice] < 0, o, first[twice])
    return first, last


def _sorted(batches: Iterator[pa.RecordBatch], rule: Repeats) -> Iterator[pa.RecordBatch]:
    """Contexts in order of gram: the range around the anchor that repeats (bytes before, bytes from it on), one row each."""

    def work(rows: list[tuple], groups: Iterator[tuple[list[int], int | None]]) -> pa.RecordBatch:
        left, right = np.full(len(rows), -1, np.int64), np.full(len(rows), -1, np.int64)
        for some, group in _together(groups):
            if isinstance(group, int):  # one offset, at which these contexts have the same window
                first = last = np.full(len(some), group, np.int64)
            else:
                first, last = repeated_offsets(group, np.array([rows[i][2] for i in some], np.int64), [rows[i][3] for i in some], rule)
            some, first, last = np.array(some)[first >= 0], first[first >= 0], last[first >= 0]
            # a context is once in a group, but may be in several that are sorted together
            np.maximum.at(left, some, last)
            np.maximum.at(right, some, rule.length - first)
        hit = np.flatnonzero(left >= 0)
        column = lambda n: pa.array(np.array([r[n] for r in rows], np.int64)[hit])
        return pa.record_batch([column(0), column(1), pa.array(left[hit]), pa.array(right[hit])], names=["gram", "context", "left", "right"])

    rows: list[tuple] = []
    groups: list[list[int]] = []  # of several contexts each, sorted together
    for own in _of_grams(batches):
        if len(own) > SORTED:
            yield work(own, split(own, list(range(len(own))), rule, SORTED, 0, rule.reach))
        elif len(own) > 1:
            if rows and len(rows) + len(own) > SORTED:
                yield work(rows, ((g, None) for g in groups))
                rows, groups = [], []
            groups.append(list(range(len(rows), len(rows) + len(own))))
            rows += own
    if rows:
        yield work(rows, ((g, None) for g in groups))


def _of_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The different contexts ``(gram, context, before, bytes)`` of each gram."""
    rows: list[tuple] = []
    for batch in batches:
        columns = zip(batch["gram"].to_pylist(), batch["context"].to_pylist(), batch["before"].to_pylist(), batch["bytes"])
        for gram, context, before, text in columns:
            if rows and rows[-1][:2] == (gram, context):
                continue  # another copy of the same context
            if rows and rows[-1][0] != gram:
                yield rows
                rows = []
            rows.append((gram, context, before, text.as_buffer().to_pybytes()))
    if rows:
        yield rows


def _together(groups: Iterator[tuple[list[int], int | None]]) -> Iterator[tuple[list[int], np.ndarray | int]]:
    """Groups put together to at most ``SORTED`` places, with the number of the group of each; those with an offset as they are."""
    held: list[list[int]] = []
    size = 0

    def put() -> tuple[list[int], np.ndarray]:
        return [i for g in held for i in g], np.repeat(np.arange(len(held)), [len(g) for g in held])

    for group, offset in groups:
        if offset is not None:
            yield group, offset
            continue
        if held and size + len(group) > SORTED:
            yield put()
            held, size = [], 0
        held.append(group)
        size += len(group)
    if held:
        yield put()


def split(rows: list[tuple], some: list[int], rule: Repeats, most: int, low: int, high: int) -> Iterator[tuple[list[int], int | None]]:
    """Groups of at most ``most`` of the contexts ``some`` that hold every two with an equal window at an offset in [low, high].

    Windows at these offsets share ``length - (high - low)`` bytes around the anchor, so contexts meet by them, compared
    as bytes. What is still too large is split by halves of the offsets. At a single offset these bytes are the window,
    and contexts that meet have it in common: they come with that offset, and need no sorting. So what is sorted at
    once does not grow with the contexts of a gram.
    """
    for low, high in ((low, (low + high) // 2), ((low + high) // 2 + 1, high)) if low < high else ((low, high),):
        met: dict[bytes, list[int]] = {}
        for i in some:
            _, _, before, text = rows[i]
            if before >= low and before + rule.length - high <= len(text):
                met.setdefault(text[before - low : before + rule.length - high], []).append(i)
        while met:
            group = met.popitem()[1]
            if low == high and len(group) > 1:
                yield group, low
            elif len(group) > most:
                yield from split(rows, group, rule, most, low, high)
            elif len(group) > 1:
                yield group, None


def _windows(batches: Iterator[pa.RecordBatch], rule: Repeats) -> Iterator[pa.RecordBatch]:
    """Contexts of hot grams: a hash of every window around the anchor."""
    for batch in batches:
        for gram, context, before, text in zip(batch["gram"].to_pylist(), batch["context"].to_pylist(), batch["before"].to_pylist(), batch["bytes"]):
            hashes = Prefixes(np.frombuffer(text.as_buffer(), np.uint8)).of_length(rule.length)[: before + 1]
            n = len(hashes)
            yield pa.record_batch(
                [
                    pa.array(np.full(n, gram, np.int64)), pa.array(np.full(n, context, np.int64)),
                    pa.array(before - np.arange(n, dtype=np.int64)), pa.array(mix(hashes).view(np.int64)),
                ],
                names=["gram", "context", "offset", "window"],
            )


# ---- the operator ----------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge each text's ranges and drop their bytes."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in (whole.slice(at, 1024) for whole in batches for at in range(0, whole.num_rows, 1024)):
        texts = [t.as_buffer().to_pybytes() for t in batch["t"]]
        all_spans, kept = [], []
        for text, ranges in zip(texts, batch["ranges"].to_pylist()):
            merged: list[list[int]] = []
            for start, stop in sorted((max(0, r["start"]), min(len(text), r["stop"])) for r in ranges or []):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], stop)
                else:
                    merged.append([start, stop])
            edges = [0] + [x for m in merged for x in m] + [len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            all_spans.append([{"start": a, "stop": b} for a, b in merged])
        yield pa.record_batch(
            [batch["doc_id"], pa.array([len(t) for t in texts], pa.int64()), pa.array(all_spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )


def _bitmap(grams: DataFrame) -> np.ndarray:
    """Packed filter of the grams' low bits: at most BITMAP bits, whatever the number of grams."""
    low = F.col("gram").bitwiseAND(F.lit(BITMAP - 1))
    parts = (
        grams.select(F.shiftright(low, 15).alias("part"), low.bitwiseAND(F.lit((1 << 15) - 1)).alias("bit"))
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    )
    out = np.zeros(BITMAP // 8, np.uint8)
    for r in parts:
        out[r.part << 12 : (r.part + 1) << 12] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Repeats = Repeats()) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, spans, kept``.

    ``spans`` are the maximal removed runs of bytes, ``kept`` the other bytes.
    Null and empty texts have none. Texts shorter than ``length`` keep all bytes.
    Repeated rows are copies of one another, so each of their strings starts
    elsewhere too. An empty table gives no rows; other columns are ignored. Ids
    are integers or null. Rows are told apart by their id and a hash of their text.
    """
    spark = docs.sparkSession
    ship(spark)
    text = whole_text(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("t"))

    def anchor_rows(batches):
        return _anchors(batches, rule)

    anchors = stage(rows.mapInArrow(anchor_rows, "doc_id long, key long, at long, gram long, context long"), "suffix-anchors")
    classes = stage(anchors.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n")), "suffix-classes")
    shared = stage(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-grams")
    bitmap = spark.sparkContext.broadcast(_bitmap(shared))

    def context_rows(batches):
        return _contexts(batches, rule, bitmap)

    contexts = rows.mapInArrow(context_rows, "gram long, context long, before int, bytes binary")
    many = shared.where(F.col("n") > rule.hot).select("gram")
    whole = classes.where("n > 1").select("gram", "context", F.lit(rule.reach).cast("long").alias("left"), F.lit(rule.length).cast("long").alias("right"))
    found = [whole]
    if many.limit(1).count():
        contexts = stage(contexts.join(many.withColumn("busy", F.lit(True)), "gram", "left"), "suffix-contexts")

        def window_rows(batches):
            return _windows(batches, rule)

        busy = contexts.where("busy").select("gram", "context", "before", "bytes")
        windows = stage(busy.mapInArrow(window_rows, "gram long, context long, offset long, window long").distinct(), "suffix-windows")
        twice = windows.groupBy("gram", "offset", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram", "offset", "window")
        found.append(
            windows.join(twice, ["gram", "offset", "window"], "left_semi").groupBy("gram", "context")
            .agg(F.max("offset").alias("left"), (F.lit(rule.length) - F.min("offset")).alias("right"))
        )
        contexts = contexts.where("busy IS NULL").drop("busy")

    def sorted_rows(batches):
        return _sorted(batches, rule)

    found.append(
        contexts.repartition("gram").sortWithinPartitions("gram", "context")
        .mapInArrow(sorted_rows, "gram long, context long, left long, right long")
    )
    reach = found[0]
    for more in found[1:]:
        reach = reach.unionByName(more)
    reach = stage(reach.groupBy("gram", "context").agg(F.max("left").alias("left"), F.max("right").alias("right")), "suffix-reach")
    ranges = (
        anchors.join(reach, ["gram", "context"])
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct((F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("stop"))).alias("ranges"))
        .select(F.col("doc_id").alias("_doc"), F.col("key").alias("_key"), "ranges")
    )
    joined = rows.join(ranges, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left")
    return joined.select("doc_id", "t", "ranges").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    )
