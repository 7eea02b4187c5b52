"""Global ranking without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no ``PARTITION BY`` pulls the whole
table into one task. ``global_rank`` instead range-partitions the rows on the
sort key, numbers rows inside each partition, writes them once, and adds the
row counts of the partitions before it (a table with one row per partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankshelf.session import stage

_LOCAL_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row index


def global_rank(
    df: DataFrame,
    order: list[Column],
    rank_col: str = "rank",
    total_col: str | None = None,
) -> DataFrame:
    """Add a 1-based BIGINT rank in ``order``; ``order`` must be a total order (end it with an id).

    ``total_col`` also attaches the row count of the whole input to every row.
    """
    # The numbered rows are written once and read back: the partition sizes and the rows
    # must come from the same range partitioning, and two evaluations of the plan could
    # sample different range bounds (or differ after a lost executor).
    ranged = stage(
        df.repartitionByRange(*order)  # no fixed count: adaptive execution merges small ranges
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS))
        .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_pid"), _LOCAL_BITS) + F.lit(1)),
        "ranked",
    )
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a bounded table, safe to order in one task and broadcast
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy()).cast("bigint").alias("_total"),
    )
    out = ranged.join(F.broadcast(offsets), "_pid").withColumn(
        rank_col, (F.col("_off") + F.col("_local")).cast("bigint")
    )
    out = out.drop("_mid", "_pid", "_local", "_off")
    return out.withColumnRenamed("_total", total_col) if total_col else out.drop("_total")


def top_n_per_group(
    df: DataFrame,
    group_cols: list[str],
    order: list[Column],
    n,
    rank_col: str = "rank",
) -> DataFrame:
    """``row_number() <= n`` per group (all rows for None); Spark plans a partial WindowGroupLimit for literal n."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    ranked = df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
    if n is None:
        return ranked
    return ranked.where(F.col(rank_col) <= (F.lit(n) if isinstance(n, int) else n))
