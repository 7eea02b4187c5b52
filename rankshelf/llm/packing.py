"""Packing by optimal length buckets.

The lengths of all documents are counted; dynamic programming over this global
histogram chooses the bucket boundaries with the least padding (each document is
padded to the upper boundary of its bucket). Inside each bucket documents are
numbered by id and cut into batches that fit the token budget.

The histogram is the only thing that reaches the driver: it has one row per
distinct length, so at most as many rows as the longest document has tokens.
The numbering is a distributed rank (range partitions plus their sizes), so a
bucket that holds most documents is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankshelf.llm.mixing import token_count
from rankshelf.llm.text import whole_text
from rankshelf.operators.ordering import global_rank
from rankshelf.session import stage

BUCKETS = 8
BUDGET = 65_536  # padded tokens in one batch


def boundaries(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper boundaries with the least total padding for ``(length, count)`` rows in order of length.

    cost(i, j) of one bucket over the lengths i+1..j is length_j * count(i, j) -
    tokens(i, j). For a fixed j the choice of i is the lowest of the lines
    best[i] + tokens_i - count_i * x at x = length_j. Slopes fall with i and x
    rises with j, so a lower hull and a pointer find it: lengths * buckets steps,
    in exact integers. Of equal choices the smallest i wins.
    """
    n = len(histogram)
    if n <= buckets:
        return [length for length, _ in histogram]
    lengths, counts, tokens = [0], [0], [0]
    for length, count in histogram:
        lengths.append(length)
        counts.append(counts[-1] + count)
        tokens.append(tokens[-1] + length * count)
    best: list[int | None] = [0] + [None] * n
    choices = []
    for _ in range(buckets):
        hull: list[tuple[int, int, int]] = []  # slope, value at 0, i
        at, following, chosen = 0, [None] * (n + 1), [0] * (n + 1)
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                m, b = -counts[j - 1], best[j - 1] + tokens[j - 1]
                while len(hull) - at >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (b - b1) * (m1 - m2) <= (b2 - b1) * (m1 - m):
                        hull.pop()
                    else:
                        break
                hull.append((m, b, j - 1))
            if hull:
                x = lengths[j]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                    at += 1
                slope, value, i = hull[at]
                following[j] = slope * x + value + x * counts[j] - tokens[j]
                chosen[j] = i
        choices.append(chosen)
        best = following
    out, j = [], n
    for chosen in reversed(choices):
        out.append(lengths[j])
        j = chosen[j]
    return out[::-1]


def _by_bucket(bucket: Column, values: dict[int, int]) -> Column:
    """The value of each row's bucket; there are as many as buckets."""
    out = F.lit(None).cast("long")
    for key, value in values.items():
        out = F.when(bucket == key, F.lit(value)).otherwise(out)
    return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``doc_id, n_tokens, bucket, batch, slot, padding`` for every row.

    ``bucket`` is the padded length, ``batch`` numbers the batches of a bucket
    from 0 in order of id, ``slot`` the places of a batch. A batch holds ``budget
    // bucket`` documents, at least one: a document longer than the budget is a
    batch of its own. Null and empty texts have the end token only. Repeated rows
    take places of their own; null ids come first. An empty table gives no rows;
    other columns are ignored.
    """
    rows = stage(  # read three times: histogram, range bounds, numbering
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), token_count(whole_text(f"`{text_col}`")).alias("n_tokens")), "lengths"
    )
    histogram = sorted((r.n_tokens, r.n) for r in rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect())
    if not histogram:
        return rows.select(
            "doc_id", "n_tokens", *[F.lit(0).cast("long").alias(c) for c in ("bucket", "batch", "slot", "padding")]
        )
    tops = boundaries(histogram, buckets)
    bucket = F.lit(tops[-1])
    for top in reversed(tops[:-1]):
        bucket = F.when(F.col("n_tokens") <= top, F.lit(top)).otherwise(bucket)
    before, room, seen, place = {}, {}, 0, 0
    for top in tops:
        before[top], room[top] = seen, max(1, budget // top)
        while place < len(histogram) and histogram[place][0] <= top:
            seen += histogram[place][1]
            place += 1
    ranked = global_rank(rows.withColumn("bucket", bucket.cast("long")), [F.col("bucket"), F.col("doc_id"), F.col("n_tokens")], rank_col="_rank")
    nth = F.col("_rank") - 1 - _by_bucket(F.col("bucket"), before)
    size = _by_bucket(F.col("bucket"), room)
    return ranked.select(
        "doc_id", "n_tokens", "bucket",
        ((nth - F.pmod(nth, size)) / size).cast("long").alias("batch"), F.pmod(nth, size).cast("long").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
