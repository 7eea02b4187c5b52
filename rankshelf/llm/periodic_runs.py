"""Runs of repeated words by maximal pairs of the LCP-interval tree.

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends. If the word before x differs from the word before
x + q, and the suffixes at x and x + q share exactly l words, then (x, x + q) is
a maximal pair and the stretch of q + l words at x has period q and cannot be
extended; every run is found in this way at its start. Only the pairs with
l >= (e - 1) q are wanted (e: least exponent), and only the smallest period of
each stretch.

Documents are taken in slices of whole texts. In a slice

1. prefix doubling ranks the suffixes of all its documents together; only groups
   that are not yet told apart are sorted again, and the ranks of every round
   are kept, because they give the common prefix of any two suffixes;
2. suffixes stay out if, for every power 2^k, no equal string of 2^k words starts
   near enough to be part of a wanted pair (this loses no pair: both ends of one
   with 2^k <= l < 2^(k+1) are at most l / (e - 1) words apart);
3. the suffixes left are joined bottom-up, in the order of the LCP-interval tree.
   A node keeps its positions in order, cut where the left word changes, as lists
   of one left-word class. The smaller child looks up its partners in the larger.
   All occurrences within l / (e - 1) words lie one period apart, and but for the
   first have the same left word, so a lookup meets one class besides its own.

Work beyond the sorts grows with the wanted positions and the pairs reported
(at most a quarter of the exponents of all runs), not with the square of a group.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankshelf.llm.text import whole_text
from rankshelf.shipping import ship

MIN_LENGTH = 6  # words
MIN_EXPONENT = 4  # length / period
SLICE_WORDS = 1 << 19  # words worked on at a time; a longer document is a slice of its own

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def doubled_ranks(ids: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For k = 0, 1, ...: ranks by the first 2^k words, and the positions that share theirs.

    ``ids`` are the words of all documents, ``doc`` numbers their documents and
    ``ends`` holds the end of each word's document. Suffixes of different
    documents never share a rank. The last ranks are all different.
    """
    n = len(ids)
    active = np.arange(n)
    rank = np.zeros(n, np.int32)
    key = doc.astype(np.int64) * (int(ids.max(initial=0)) + 1) + ids
    step = 0
    while True:
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]][: len(key)]
        old = rank[active]
        group = np.r_[True, old[1:] != old[:-1]][: len(old)]
        at = np.arange(len(active))
        rank = rank.copy()
        rank[active] = old + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        single = new & np.r_[new[1:], True][: len(new)]
        active = active[~single]
        yield rank, active
        if not len(active):
            return
        step = 2 * step or 1
        there = active + step
        follows = np.where(there < ends[active], rank[np.minimum(there, n - 1)].astype(np.int64) + 1, 0)
        key = rank[active].astype(np.int64) * (n + 1) + follows


def common_words(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Common prefix, in words, of the suffixes at ``a`` and ``b`` (different positions)."""
    out, top = np.zeros(len(a), np.int64), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        inside = (x < ends[a]) & (y < ends[b])
        out += (inside & (levels[k][np.minimum(x, top)] == levels[k][np.minimum(y, top)])).astype(np.int64) << k
    return out


def _join(a: list, b: list, shared: int, reach: int, left: dict, found: list) -> list:
    """One node from two that share ``shared`` words: report the pairs across, return ``[positions, class ends]``."""
    if len(a[0]) < len(b[0]):
        a, b = b, a
    places, breaks = a
    for x in b[0]:
        own, k = left[x], bisect_left(places, x)
        if k:
            before = places[k - 1]
            if before >= x - reach:
                if left[before] != own:
                    found.append((before, x, shared))
                t = bisect_left(breaks, before) - 1
                while t >= 0 and breaks[t] >= x - reach:
                    if left[breaks[t]] != own:
                        found.append((breaks[t], x, shared))
                    t -= 1
        if k < len(places) and left[places[k]] != own:
            for y in places[k:]:
                if y > x + reach:
                    break
                if left[y] != own:
                    found.append((x, y, shared))
    for x in b[0]:
        own, k = left[x], bisect_left(places, x)
        after = left[places[k]] if k < len(places) else None
        if k:
            before = places[k - 1]
            was, now = after is not None and left[before] != after, left[before] != own
            if now and not was:
                insort(breaks, before)
            elif was and not now:
                del breaks[bisect_left(breaks, before)]
        if after is not None and after != own:
            insort(breaks, x)
        places.insert(k, x)
    return a


def maximal_pairs(places: list[int], shared: list[int], left: dict, least: int, ratio: int) -> list[tuple[int, int, int]]:
    """``(x, y, l)`` of all maximal pairs x < y with l >= least and y - x <= l / ratio.

    ``places`` are positions in suffix order, ``shared`` the words that each has
    in common with the next one.
    """
    found, open_nodes, node = [], [], None
    for x, l in zip(places, shared + [0]):
        node = [[x], []]
        while open_nodes and open_nodes[-1][1] >= l:
            other, depth = open_nodes.pop()
            node = _join(other, node, depth, depth // ratio, left, found)
        if l >= least:
            open_nodes.append((node, l))
    return found


def runs_of(ids: np.ndarray, doc: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int) -> dict:
    """Smallest period by ``(position, length)`` of every run; positions count through all documents.

    ``starts`` and ``ends`` bound each word's document.
    """
    ratio = min_exponent - 1
    least = next(l for l in range(ratio, ratio + min_length + 1) if l + l // ratio >= min_length)
    n = len(ids)
    if not n:
        return {}
    levels, wanted = [], np.zeros(n, bool)
    for k, (rank, active) in enumerate(doubled_ranks(ids, doc, ends)):
        levels.append(rank)
        longest = (2 << k) - 1  # common words of the pairs that this round tells about
        if longest >= least and len(active):
            order = np.argsort(rank[active].astype(np.int64) * n + active)
            place = active[order]
            near = (rank[place[1:]] == rank[place[:-1]]) & (place[1:] - place[:-1] <= longest // ratio)
            wanted[place[1:][near]] = True
            wanted[place[:-1][near]] = True
    place = np.flatnonzero(wanted)
    if len(place) < 2:
        return {}
    place = place[np.argsort(levels[-1][place])]
    shared = common_words(place[:-1], place[1:], levels, ends)
    before = np.where(place > starts[place], ids[place - 1], -1)
    left = dict(zip(place.tolist(), before.tolist()))
    runs: dict = {}
    for x, y, l in maximal_pairs(place.tolist(), shared.tolist(), left, least, ratio):
        period, length = y - x, y - x + l
        if length >= min_length and period < runs.get((x, length), period + 1):
            runs[x, length] = period
    return runs


def _slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    """Ids and word lists of whole documents, about ``limit`` words at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for name, text in zip(batch[0], batch[1]):
            words = text.as_buffer().to_pybytes().split()  # bytes split at exactly the six blanks
            if texts and size + len(words) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(name.as_py())
            texts.append(words)
            size += len(words)
    if texts:
        yield ids, texts


def _find(batches: Iterator[pa.RecordBatch], min_length: int, min_exponent: int, limit: int) -> Iterator[pa.RecordBatch]:
    for names, texts in _slices(batches, limit):
        sizes = np.array([len(t) for t in texts], np.int64)
        stops = np.cumsum(sizes)
        number: dict = defaultdict()
        number.default_factory = number.__len__
        ids = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
        found = runs_of(
            ids, np.repeat(np.arange(len(texts)), sizes), np.repeat(stops - sizes, sizes), np.repeat(stops, sizes), min_length, min_exponent
        )
        runs: list[list] = [[] for _ in texts]
        for (x, length), period in found.items():
            d = int(np.searchsorted(stops, x, "right"))
            runs[d].append((x - int(stops[d] - sizes[d]), length, period))
        kept = []
        for words, own in zip(texts, runs):
            if own:
                own.sort(key=lambda r: (r[0], r[2]))
                stay = np.ones(len(words), bool)
                for start, length, period in own:
                    stay[start + period : start + length] = False
                words = [words[i] for i in np.flatnonzero(stay)]
            kept.append(b" ".join(words))
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in runs]
        yield pa.record_batch(
            [pa.array(names, pa.int64()), pa.array(sizes), pa.array(rows, pa.list_(RUN)), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    ``runs`` is an array of structs (start, length, period), in words, of all runs
    with at least ``min_length`` words and ``min_exponent`` periods (3 or more),
    by start, then period. ``collapsed`` are the words, joined by one blank,
    without those that a run holds after its first period. Null, empty and blank
    texts have no words, no runs and an empty ``collapsed``. Ids are integers and
    may be null or repeated: every row is worked on by itself. A text of any length
    is held whole by one task, about 100 bytes a word. An empty table gives no
    rows; other columns are ignored. Nothing is shuffled.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").cast("binary").alias("t"))
    work = partial(_find, min_length=min_length, min_exponent=min_exponent, limit=slice_words)
    return rows.mapInArrow(
        work, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
