"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after lower-casing A-Z. The refinement
needs two scans and never shuffles a text it does not have to:

1. *Length and prefix.* The first scan writes two numbers per document, its
   length in bytes and a hash of its first characters. Rows whose length occurs
   once are dropped by a semi-join, then those whose (length, prefix hash) occurs
   once; what is left are the suspect keys, exact at any size.
2. *Full hash.* The second scan takes the SHA-256 of the whole text only for
   suspects. It tells them by a bitmap of hashed suspect keys, of ``BITS_PER_KEY``
   bits a key up to ``MAX_BITS``, which is sent to every task. A key that meets
   another's bit by chance costs a hash and no more: groups are formed on
   (length, prefix hash, full hash), and reported digests are checked against the
   suspect keys themselves.

A group of any size is summed map-side, so a hot group is one small row per
task; its members meet the group's row in an equi-join whose large side AQE can
split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from rankshelf.llm.text import lower_az, whole_text
from rankshelf.session import stage

PREFIX_CHARS = 64  # characters that the prefix hash covers
BITS_PER_KEY = 32  # bits of the bitmap for each suspect key
MAX_BITS = 1 << 29  # largest bitmap: 64 MB
PAGE_BITS = 1 << 15  # bits of one row of the bitmap (Spark's bitmap functions)

_KEYS = ["_bytes", "_prefix", "_full"]


def _rows(docs: DataFrame, text_col: str, row: Column) -> DataFrame:
    """``_row``, the text, its length in bytes and the hash of its prefix."""
    return docs.select(row.alias("_row"), whole_text(f"`{text_col}`").alias("_text")).select(
        "_row", "_text", F.octet_length("_text").cast("long").alias("_bytes"),
        F.xxhash64(lower_az(F.substring("_text", 1, PREFIX_CHARS))).alias("_prefix"),
    )


def suspect_keys(rows: DataFrame) -> DataFrame:
    """The pairs ``_bytes, _prefix`` that occur more than once, written."""
    keys = stage(rows.select("_bytes", "_prefix"), "dedup-keys")
    # written, so that their size is known: a list of lengths is short as a rule, and then no key is shuffled to meet it
    lengths = stage(keys.groupBy("_bytes").count().where("count > 1").select("_bytes"), "dedup-lengths")
    prefixes = keys.join(lengths, "_bytes", "left_semi").groupBy("_bytes", "_prefix").count()
    return stage(prefixes.where("count > 1").select("_bytes", "_prefix"), "dedup-suspects")


def with_suspicion(rows: DataFrame, suspects: DataFrame) -> DataFrame:
    """``rows`` plus ``_suspect``: true for all rows with a key in ``suspects``, and for few others."""
    bits = PAGE_BITS
    wanted = min(MAX_BITS, suspects.count() * BITS_PER_KEY)
    while bits < wanted:
        bits *= 2
    place = F.pmod(F.xxhash64("_bytes", "_prefix"), F.lit(bits))
    pages = (
        suspects.select((place / PAGE_BITS).cast("int").alias("_page"), (place % PAGE_BITS).alias("_bit"))
        .groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    placed = rows.withColumn("_place", place).withColumn("_page", (F.col("_place") / PAGE_BITS).cast("int"))
    # at most MAX_BITS in all, whatever the input
    beside = placed.join(F.broadcast(pages), "_page", "left")
    byte = F.conv(F.hex(F.expr(f"substring(_bits, CAST(_place % {PAGE_BITS} DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("CAST(_place % 8 AS INT)")
    hit = F.coalesce(F.call_function("getbit", byte, bit) == 1, F.lit(False))
    return beside.withColumn("_suspect", hit).drop("_page", "_place", "_bits")


def _full() -> Column:
    return F.sha2(lower_az(F.col("_text")), 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_unique: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts count as empty. The largest id of a group stays; rows of a group
    that tie on it are the same document and are all marked ``kept`` (nulls sort
    below every id; a group with null ids only has a null ``keep_id`` and is
    kept). ``text_sha256`` is null for documents whose length or prefix is
    unique, as their text is not hashed, unless ``hash_unique`` asks for all.
    The whole of a text is read by functions of the column, however long it is.
    An empty table gives no rows; other columns are ignored.
    """
    rows = _rows(docs, text_col, F.col(f"`{id_col}`"))
    suspects = suspect_keys(rows)
    hashed = stage(
        with_suspicion(rows, suspects).select(
            F.col("_row").alias("doc_id"), "_bytes", "_prefix", "_suspect",
            (_full() if hash_unique else F.when(F.col("_suspect"), _full())).alias("_full"),
        ),
        "dedup-rows",
    )
    groups = stage(  # written, so that the join below has an exchange of its own, which AQE can split
        hashed.where("_suspect").groupBy(*_KEYS)
        .agg(F.max("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .join(suspects, ["_bytes", "_prefix"], "left_semi"),
        "dedup-groups",
    )
    digest = F.col("_full") if hash_unique else F.when(F.col("_size").isNotNull(), F.col("_full"))
    return hashed.join(groups, _KEYS, "left").select(
        "doc_id",
        F.when(F.col("_size") > 1, F.col("_keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        ((F.coalesce("_size", F.lit(1)) == 1) | F.col("doc_id").eqNullSafe(F.col("_keep"))).alias("kept"),
        digest.alias("text_sha256"),
    )


def _orderable(kind: DataType) -> bool:
    """Can values of this type be compared? Maps and variants cannot, wherever they are nested."""
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row per distinct normalised text, all columns kept whatever their names.

    The row with the largest id stays; rows that tie are told apart by their
    other columns in order of name (columns that hold maps or variants excepted),
    so the choice does not depend on the partitioning. Only suspects are shuffled,
    after a map-side reduction to one row per group and task; every other row
    passes straight through.
    """
    others = sorted(f.name for f in docs.schema.fields if f.name != id_col and _orderable(f.dataType))
    rows = _rows(docs, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    marked = with_suspicion(rows, suspect_keys(rows))
    order = F.struct(*[F.col(f"_row.`{c}`") for c in [id_col, *others]])
    best = (
        marked.where("_suspect").withColumn("_full", _full())
        .groupBy(*_KEYS).agg(F.max_by("_row", order).alias("_row"))
    )
    return marked.where("NOT _suspect").select("_row.*").unionByName(best.select("_row.*"))
