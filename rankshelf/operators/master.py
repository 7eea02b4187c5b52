"""Ideas tier: master item table, flattening, derived slices, TF-IDF (IDEA-1..4)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankshelf.operators.embed import tokens
from rankshelf.operators.ordering import global_rank, top_n_per_group
from rankshelf.session import small_enough, stage


def genre_names(genres: DataFrame) -> DataFrame:
    """``(item_id, genre)``: map keys are comma-joined names, split and trimmed."""
    keys = genres.select("item_id", F.explode(F.map_keys("genres")).alias("key"))
    names = keys.select("item_id", F.explode(F.split("key", r",\s*")).alias("genre"))
    return names.select("item_id", F.trim("genre").alias("genre")).where(F.col("genre") != "").distinct()


TASK_CHARS = 4_000_000  # text whose terms one task counts
TASK_TERMS = 1_000_000  # (item, term) rows that one task normalises
CHUNK_ROWS = 1_024  # interactions in one nested row


def interaction_chunks(reads: DataFrame, order: list[Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """IDEA-1, nested: ``(item_id, chunk, interactions)``, every item's interactions as numbered arrays of ``chunk_rows`` at most.

    ``order`` is a total order of one item's interactions (rows that tie must be equal). Positions come from
    one range partitioning over (item, order), so a hot item is spread over tasks and no array
    grows with its readers.
    """
    fields = ["user_id", "is_read", "rating", "is_reviewed"]
    placed = global_rank(reads, [F.col("item_id"), *order], "place")
    first = placed.groupBy("item_id").agg(F.min("place").alias("first"))
    at = placed.join(first, "item_id").withColumn("pos", F.col("place") - F.col("first"))
    packed = at.groupBy("item_id", F.floor(F.col("pos") / chunk_rows).cast("bigint").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", *fields))).alias("rows")
    )
    return packed.select("item_id", "chunk", F.transform("rows", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("interactions"))


def master_table(items: DataFrame, item_authors: DataFrame, authors: DataFrame, genres: DataFrame, reads: DataFrame) -> DataFrame:
    """IDEA-1: one row per item with all its fields, author records, genre names and reading facts.

    An author record has every field of ``authors`` and every field of the link besides its ids (the role). Author
    and genre arrays are small per item. Interactions are summarised (reads, readers) here and nested, in
    bounded rows, by ``interaction_chunks``.
    """
    fields = ["author_id", *[c for c in authors.columns if c != "author_id"], *[c for c in item_authors.columns if c not in ("item_id", "author_id")]]
    auth = (
        item_authors.join(authors, "author_id", "left")
        .groupBy("item_id")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("authors"))
    )
    gen = genre_names(genres).groupBy("item_id").agg(F.array_sort(F.collect_set("genre")).alias("genres"))
    facts = reads.groupBy("item_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_reads"), F.countDistinct("user_id").cast("bigint").alias("n_readers")
    )
    return items.join(auth, "item_id", "left").join(gen, "item_id", "left").join(facts, "item_id", "left")


def flatten(items: DataFrame, item_authors: DataFrame, authors: DataFrame, genres: DataFrame) -> DataFrame:
    """IDEA-2: one row per (item, author, genre) with all item fields; items without either keep a null."""
    return (
        items.join(item_authors, "item_id", "left")
        .join(authors.select("author_id", F.col("name").alias("author_name")), "author_id", "left")
        .join(genre_names(genres), "item_id", "left")
        .select(*items.columns, "author_id", "author_name", "genre")
    )


def genre_slice(items: DataFrame, genres: DataFrame, reads: DataFrame) -> DataFrame:
    """IDEA-3: a smaller table — per genre, items and reads — from the item and genre columns alone."""
    item_genre = genre_names(genres).join(items.select("item_id"), "item_id", "left_semi")
    per_item = reads.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        item_genre.join(per_item, "item_id", "left")
        .groupBy("genre")
        .agg(F.count(F.lit(1)).cast("bigint").alias("n_items"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_reads"))
    )


def tfidf(texts: DataFrame) -> DataFrame:
    """IDEA-4: ``(item_id, term, weight)``; tf = count, idf = ln((1+N)/(1+df)) + 1, L2-normalised per item.

    The term-frequency table feeds the document count, the document
    frequencies and the weights, so it is staged once instead of tokenising
    every text three times. The tasks that count and normalise terms grow in number with
    the text, so what one of them holds does not.
    """
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # never the default number: a repartition below by the same key would stand for this one, and adaptive execution may merge its tasks
    spread = texts.select("item_id", "text").repartition(max(least + 1, math.ceil(chars / TASK_CHARS)), "item_id")
    tf = stage(
        tokens(spread).groupBy("item_id", F.col("token").alias("term")).agg(F.count(F.lit(1)).cast("double").alias("tf")),
        "tfidf-tf",
    )
    n_docs = tf.select("item_id").distinct().count()
    # one row per term; written, so that the join's two exchanges can be split where a term is in most texts
    df_ = stage(tf.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df")), "tfidf-df")
    w = tf.join(F.broadcast(df_) if small_enough(df_) else df_, "term").select(
        "item_id", "term", (F.col("tf") * (F.log((F.lit(1.0 + n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))).alias("w")
    )
    w = w.repartition(max(least, math.ceil(tf.count() / TASK_TERMS)), "item_id")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("item_id")))
    return w.select("item_id", "term", (F.col("w") / norm).alias("weight"))


def top_terms(weights: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` terms per item by weight, ties by term."""
    return top_n_per_group(weights, ["item_id"], [F.col("weight").desc(), F.col("term")], k).select(
        "item_id", "rank", "term", "weight"
    )

