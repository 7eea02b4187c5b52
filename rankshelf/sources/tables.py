"""Engine tables bound to the driver's parquet test data.

The engine works on four logical tables:

* ``users(user_id)``
* ``interactions(user_id, item_id, is_read, rating, is_reviewed, seq)``
* ``items(item_id, average_rating STRING, title, description)``
* ``embeddings(item_id, embedding ARRAY<FLOAT>)``

Ids are BIGINT everywhere (one id type, fixed at ingest). ``seq`` is a struct
that gives every user's reading list a total order; it ends in the item id
because (order key, line number) alone repeats in the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankshelf.session import stage


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("user_id"))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All interactions (read or not), one row per order line."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"
    )
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        (F.col("l_returnflag") != "R").cast("int").alias("is_read"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
        (F.col("l_linestatus") == "F").cast("int").alias("is_reviewed"),
        F.struct(
            F.col("o_orderdate").alias("ts"),
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line"),
            F.col("l_partkey").cast("bigint").alias("item"),
        ).alias("seq"),
    )


def read_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1: only rows with ``is_read == 1``."""
    return interactions(spark, sf_dir).where(F.col("is_read") == 1)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata with every scalar kept as text, as in a JSON-lines catalogue.

    ``average_rating`` is the mean line quantity of the item as a string; every
    17th item has an empty rating, items nobody bought have none at all.
    """
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    ratings = (
        _read(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.avg("l_quantity").alias("avg_q"))
    )
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out = (
        part.join(ratings, part.p_partkey == ratings.l_partkey, "left")
        .join(docs, part.p_partkey == docs.doc_id, "left")
        .select(
            F.col("p_partkey").cast("bigint").alias("item_id"),
            F.when(F.col("p_partkey") % 17 == 0, F.lit(""))
            .otherwise(F.col("avg_q").cast("string"))
            .alias("average_rating"),
            F.col("p_name").alias("title"),
            F.col("text").alias("description"),
        )
    )
    return out


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, description)`` of every item, without the aggregation that the ratings need."""
    part = _read(spark, sf_dir, "part").select(F.col("p_partkey").cast("bigint").alias("item_id"))
    docs = _read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("description"))
    # the test files have one row group each, which one task would join and encode alone
    return part.join(docs, part.item_id == docs.doc_id, "left").select("item_id", "description").repartition("item_id")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("bigint").alias("item_id"), F.col("embedding")
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors, bound to suppliers."""
    return _read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("bigint").alias("author_id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("average_rating"),
    )


def item_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item–author links: distinct (part, supplier) pairs of the line items."""
    return (
        _read(spark, sf_dir, "lineitem")
        .select(F.col("l_partkey").cast("bigint").alias("item_id"), F.col("l_suppkey").cast("bigint").alias("author_id"))
        .distinct()
    )


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item_id, genres MAP<STRING,INT>)``; keys are comma-joined names as in the catalogue."""
    part = _read(spark, sf_dir, "part")
    key = F.concat_ws(", ", F.lower(F.col("p_brand")), F.lower(F.col("p_type")))
    return part.select(
        F.col("p_partkey").cast("bigint").alias("item_id"),
        F.create_map(key, F.col("p_size").cast("int")).alias("genres"),
    )


@dataclass
class Tables:
    """All engine tables of one scale-factor folder, read lazily."""

    spark: SparkSession
    sf_dir: str

    @property
    def users(self) -> DataFrame:
        return users(self.spark, self.sf_dir)

    @property
    def interactions(self) -> DataFrame:
        return interactions(self.spark, self.sf_dir)

    @property
    def reads(self) -> DataFrame:
        return read_interactions(self.spark, self.sf_dir)

    @property
    def items(self) -> DataFrame:
        return items(self.spark, self.sf_dir)

    @property
    def descriptions(self) -> DataFrame:
        return descriptions(self.spark, self.sf_dir)

    @cached_property
    def reads_once(self) -> DataFrame:
        """The read interactions, joined once and written, for plans that use them several times."""
        return stage(self.reads, "reads")

    @property
    def embeddings(self) -> DataFrame:
        return embeddings(self.spark, self.sf_dir)

    @property
    def authors(self) -> DataFrame:
        return suppliers(self.spark, self.sf_dir)

    @property
    def item_authors(self) -> DataFrame:
        return item_authors(self.spark, self.sf_dir)

    @property
    def genres(self) -> DataFrame:
        return genres(self.spark, self.sf_dir)
