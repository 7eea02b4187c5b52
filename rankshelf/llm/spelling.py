"""Spelling variants of words by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point leads from one
to the other: their common prefix and suffix together reach the longer length
minus one. A tile compares a block of words with another one in padded
code-point matrices, column by column, and has both lengths for all its pairs.

Which words must meet in a tile: let L be the length of the shorter of two near
words and e the length of their common prefix. The positions 0 to L are cut into
segments; for the segment [lo, hi) that holds e both words have the same first lo
and the same last L - hi code points. So each word has one key for every segment,
with L its own length and its own length minus one, and only blocks with equal
keys are compared. A pair counts in the one segment that holds e, so it counts
once. Segments begin as halves. A key that holds more than ``limit`` words is
dealt anew with its segment halved, until it is small or its segment is a single
position, where at most a few thousand different words fit on the alphabet: no
group grows with the input, and the tiles of a hot prefix are spread.

A tile sends on one row for each word with near words in it (their number and the
best), never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankshelf.llm.text import whole_text
from rankshelf.session import stage, unstage
from rankshelf.shipping import ship

RUN_OF_LETTERS = "[A-Za-zÀ-ÿ]+"
LIMIT = 1024  # words of a key that is not cut further
TILE = 256  # words of a block
TASK_ROWS = 1 << 16  # keyed words of a task that compares tiles
PART = 1 << 17  # different words counted at a time in one task

# ---- words and their counts ------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch], pattern: str, drop_every: int, part: int) -> Iterator[pa.RecordBatch]:
    letters, total = re.compile(pattern), Counter()

    def flush():
        return pa.record_batch([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for name, text in zip(batch["doc_id"].to_pylist(), batch["t"]):
            # bytes.lower() changes A-Z only
            own = Counter(letters.findall(text.as_buffer().to_pybytes().lower().decode()))
            start = zlib.crc32(b"%d:" % name) if drop_every and name is not None else None
            for word, n in own.items():
                if start is not None:
                    h = zlib.crc32(word.encode(), start)
                    if h % drop_every == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                total[word] += n
            if len(total) > part:
                yield flush()
                total.clear()
    yield flush()


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = RUN_OF_LETTERS, min_chars: int = 5, min_count: int = 3,
    drop_every: int = 0,
) -> DataFrame:
    """``word, n``: the runs of ``pattern`` in all whole texts, A-Z lower-cased, with their number of occurrences.

    Words below ``min_chars`` code points or ``min_count`` occurrences are left
    out. With ``drop_every`` > 0, a run w of document d with h = crc32("d:w")
    divisible by it first loses its code point h % length, which plants misspelt
    words. Null texts have no words, documents without an id lose no code points,
    repeated rows count again, an empty table gives no rows; other columns are
    ignored. A task holds one text and the counts of 131,072 words; counts are
    summed by Spark.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(f"`{text_col}`").cast("binary").alias("t"))
    parts = rows.mapInArrow(partial(_count, pattern=pattern, drop_every=drop_every, part=PART), "word string, n long")
    return parts.where(F.length("word") >= min_chars).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- tiles -----------------------------------------------------------------------------------


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and two matrices, one row a word: code points plus one, padded with zero on the right and on the left."""
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) + np.uint32(1)
    width = int(sizes.max(initial=0))
    column = np.arange(width)
    first, last = (np.zeros((len(words), width), np.uint32) for _ in range(2))
    first[column < sizes[:, None]] = flat
    last[column >= width - sizes[:, None]] = flat
    return sizes, first, last


def _common(same: np.ndarray, a: np.ndarray, b: np.ndarray, columns: list[tuple[int, int]]) -> np.ndarray:
    """Columns, in the given order, in which the rows of ``a`` and ``b`` agree without a gap; zero where not ``same``."""
    out, alive = np.zeros(same.shape, np.int32), same.copy()
    for i, j in columns:
        alive &= a[:, i, None] == b[None, :, j]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(words: list[str], key: np.ndarray, short: np.ndarray, lo: np.ndarray, hi: np.ndarray, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of near words with equal keys; rows with equal keys stand together.

    ``short``, ``lo`` and ``hi`` are the key's length L and segment.
    """
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    blocks = [(at, *code_points(words[at : at + tile])) for at in range(0, len(words), tile)]
    for n, (at, sizes, first, last) in enumerate(blocks):
        rows = slice(at, at + len(sizes))
        for to, other_sizes, other_first, other_last in blocks[n:]:
            if to > at and key[to] != key[rows][-1]:
                break
            columns = slice(to, to + len(other_sizes))
            shorter = np.minimum(sizes[:, None], other_sizes[None, :])
            longer = np.maximum(sizes[:, None], other_sizes[None, :])
            same = (key[rows, None] == key[None, columns]) & (short[rows, None] == short[None, columns]) & (lo[rows, None] == lo[None, columns])
            same &= (shorter == short[rows, None]) & (longer - shorter <= 1)
            if to == at:
                same &= np.arange(len(sizes))[:, None] < np.arange(len(sizes))[None, :]
            if not same.any():
                continue
            w, v = first.shape[1], other_first.shape[1]
            prefix = _common(same, first, other_first, list(zip(range(w), range(v))))
            suffix = _common(same, last, other_last, list(zip(range(w - 1, -1, -1), range(v - 1, -1, -1))))
            near = same & (prefix < longer) & (prefix + suffix >= longer - 1)
            near &= (prefix >= lo[rows, None]) & ((prefix < hi[rows, None]) | (hi[rows, None] == shorter))
            i, j = np.nonzero(near)
            left.append(i + at)
            right.append(j + to)
    return np.concatenate(left), np.concatenate(right)


def _tiles(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: for each word with near words, their number, the largest count and its first word."""
    held = None

    def compare(rows):
        words, counts = rows["word"].to_pylist(), rows["n"].to_numpy()
        key, short, lo, hi = (rows[c].to_numpy() for c in ("key", "short", "lo", "hi"))
        i, j = near_pairs(words, key, short, lo, hi, tile)
        order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        number = np.bincount(i, minlength=len(words)) + np.bincount(j, minlength=len(words))
        best = np.full(len(words), len(words))
        np.minimum.at(best, i, place[j])
        np.minimum.at(best, j, place[i])
        out = np.flatnonzero(number)
        chosen = [order[k] for k in best[out]]
        return pa.record_batch(
            [pa.array([words[k] for k in out], pa.string()), pa.array(number[out]), pa.array(counts[chosen], pa.int64()), pa.array([words[k] for k in chosen], pa.string())],
            names=["word", "n_near", "best_n", "best"],
        )

    for batch in batches:
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
        if not rows.num_rows:
            continue
        key = rows["key"].to_numpy()
        cut = int(np.argmax(key == key[-1]))  # where the last key begins
        if cut:
            yield compare(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None:
        yield compare(held)


def _keyed(words: DataFrame, segments: Column) -> DataFrame:
    """``words`` with one row for every struct (short, lo, hi) of ``segments`` and the hash of what such words share."""
    rows = words.select("word", "n", F.explode(segments).alias("s")).select("word", "n", "s.short", "s.lo", "s.hi")
    # equal hashes of different keys cost comparisons, no more: the real prefix and suffix decide
    shared = F.expr("xxhash64(short, lo, hi, substring(word, 1, lo), right(word, short - hi))")
    return rows.withColumn("key", shared)


def _halves(lo: str, hi: str, short: str) -> str:
    """SQL of the non-empty halves of a segment."""
    mid = f"({lo} + ({hi} - {lo}) DIV 2)"
    part = "named_struct('short', CAST({} AS INT), 'lo', CAST({} AS INT), 'hi', CAST({} AS INT))"
    return f"filter(array({part.format(short, lo, mid)}, {part.format(short, mid, hi)}), s -> s.lo < s.hi)"


def near_words(words: DataFrame, limit: int = LIMIT, tile: int = TILE) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``words(word, n)`` with near words; words are distinct.

    ``best`` is the near word of largest ``best_n``, the first in code-point order of several.
    """
    halves = F.expr(f"concat({_halves('0', 'length(word)', 'length(word)')}, {_halves('0', 'length(word) - 1', 'length(word) - 1')})")
    rows, ready = stage(_keyed(words, halves), "spelling-keys"), None
    spent = []
    while True:
        sizes = rows.groupBy("key", "short").agg(
            F.count(F.lit(1)).alias("size"), F.max(F.length("word") == F.col("short")).alias("has_short"), F.max(F.col("hi") - F.col("lo")).alias("span")
        ).where("size > 1 AND has_short")  # two words that are both longer meet by their own length
        marked = stage(
            rows.join(sizes.select("key", "short", ((F.col("size") > limit) & (F.col("span") > 1)).alias("again")), ["key", "short"]),
            "spelling-marked",
        )
        unstage(rows)
        spent.append(marked)
        small = marked.where("NOT again").drop("again")
        ready = small if ready is None else ready.unionByName(small)
        if marked.where("again").isEmpty():
            break
        rows = stage(_keyed(marked.where("again").withColumn("segment", F.expr(_halves("lo", "hi", "short"))), F.col("segment")), "spelling-keys")
    # comparing costs far more than its bytes tell, so the number of tasks follows the rows
    tasks = max(1, sum(x.where("NOT again").count() for x in spent) // TASK_ROWS)
    ordered = ready.select("key", "short", "lo", "hi", "word", "n").repartition(tasks, "key").sortWithinPartitions("key")
    parts = ordered.mapInArrow(partial(_tiles, tile=tile), "word string, n_near long, best_n long, best string")
    out = stage(
        parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")).select(
            "word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"
        ),
        "spelling-near",
    )
    unstage(*spent)
    return out


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: the last word that the forms lead to.

    Forms have no cycle (their counts grow). Each round doubles the steps taken,
    so the rounds are the logarithm of the longest chain.
    """
    current = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(current.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        unstage(current)
        current = moved.select("word", "root")
        current._staged_at = moved._staged_at
        if moved.where("moved").isEmpty():
            return current


def spelling_variants(words: DataFrame, ratio: int = 2, limit: int = LIMIT, tile: int = TILE) -> DataFrame:
    """One row per distinct word of ``words(word, n)``: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest count (of several the first in code-point
    order) if its count is at least ``ratio`` times the word's, else null with
    ``form_n``; ``root`` is where the forms lead to, the word itself without a
    form. ``ratio`` is 2 or more. Rows with the same word are added up; null and
    empty words are left out; an empty table gives no rows; other columns are
    ignored. Words may have any length.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    ship(words.sparkSession)
    counted = stage(
        words.select("word", "n").where("word IS NOT NULL AND word <> ''").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "spelling-words"
    )
    near = near_words(counted, limit, tile)
    judged = stage(
        counted.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = last_forms(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
