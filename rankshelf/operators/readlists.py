"""Read lists, id splits and the history / holdout split.

Lists stay in row form ``(user_id, pos, item_id)`` in the query path; the
array form exists for callers that want the reference's list shape and is only
safe where a single user's list fits in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankshelf.functions.columns import DEFAULT_SEED, TEST_FRACTION_DIVISOR, split_key
from rankshelf.operators.ordering import global_rank


def distinct_users(reads: DataFrame) -> DataFrame:
    """AGG-1: unique user ids."""
    return reads.select("user_id").distinct()


def positions(reads: DataFrame) -> DataFrame:
    """Each user's read list in row form: ``(user_id, pos, n_items, item_id)``, 1-based, by ``seq``."""
    w = Window.partitionBy("user_id").orderBy("seq")
    return reads.select(
        "user_id",
        F.row_number().over(w).cast("bigint").alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy("user_id")).cast("bigint").alias("n_items"),
        "item_id",
    )


def user_read_lists(reads: DataFrame) -> DataFrame:
    """AGG-2 in the reference's shape: ``(user_id, items ARRAY<BIGINT>)`` in ``seq`` order, duplicates kept."""
    return reads.groupBy("user_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "item_id"))), lambda s: s["item_id"]).alias("items")
    )


def item_readers(reads: DataFrame) -> DataFrame:
    """AGG-3 in row form: ``(item_id, pos, user_id)``, each item's readers in order of id, repeats kept.

    Numbered by the global rank, so an item that everybody reads is spread over many tasks.
    """
    ranked = global_rank(reads.select("item_id", "user_id"), [F.col("item_id"), F.col("user_id")], "rn")
    first = ranked.groupBy("item_id").agg(F.min("rn").alias("first"))
    return ranked.join(first, "item_id").select("item_id", (F.col("rn") - F.col("first") + 1).alias("pos"), "user_id")


def read_list_summary(reads: DataFrame) -> DataFrame:
    """Per-user list facts computed with partial aggregation (no list is materialised)."""
    return reads.groupBy("user_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_items"),
        F.countDistinct("item_id").cast("bigint").alias("n_distinct"),
        F.min_by("item_id", "seq").alias("first_item"),
        F.max_by("item_id", "seq").alias("last_item"),
    )


def reader_summary(reads: DataFrame) -> DataFrame:
    """Per-item reader facts: reads and distinct readers."""
    return reads.groupBy("item_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_reads"),
        F.countDistinct("user_id").cast("bigint").alias("n_readers"),
    )


def split_ids(ids: DataFrame, id_col: str, seed: str = DEFAULT_SEED, distinct: bool = False) -> DataFrame:
    """SPL-1..3: repeatable shuffle by ``md5(id:seed)``; the first ``N div 5`` rows are test.

    ``distinct=True`` de-duplicates the ids first (user split); the item split
    keeps repeated ids as rows, like the reference.
    """
    base = ids.select(F.col(id_col).alias("id"))
    if distinct:
        base = base.distinct()
    base = base.withColumn("_key", split_key("id", seed))
    ranked = global_rank(base, [F.col("_key"), F.col("id")], "shuffle_pos", total_col="_total")
    return (
        ranked.select(
            F.col("id").alias(id_col),
            "shuffle_pos",
            F.when(F.col("shuffle_pos") <= F.floor(F.col("_total") / TEST_FRACTION_DIVISOR), F.lit("test"))
            .otherwise(F.lit("train"))
            .alias("split"),
        )
    )


def history_holdout(reads: DataFrame) -> DataFrame:
    """SPL-4: the first ``len // 2`` items of each list are history, the rest holdout."""
    p = positions(reads)
    return p.withColumn(
        "part",
        F.when(F.col("pos") <= F.floor(F.col("n_items") / 2), F.lit("history")).otherwise(F.lit("holdout")),
    )


def histories_of(reads: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Warm histories ``(user_id, pos, item_id)`` for ``users`` (all readers if None)."""
    hh = history_holdout(reads if users is None else reads.join(users.select("user_id"), "user_id", "left_semi"))
    return hh.where(F.col("part") == "history").select("user_id", "pos", "item_id")


def holdouts_of(reads: DataFrame, users: DataFrame | None = None) -> DataFrame:
    hh = history_holdout(reads if users is None else reads.join(users.select("user_id"), "user_id", "left_semi"))
    return hh.where(F.col("part") == "holdout").select("user_id", "pos", "item_id")
