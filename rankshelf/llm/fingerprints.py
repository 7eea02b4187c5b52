"""Document fingerprints by one-permutation MinHash, packed to a few bits a bin.

Every five-word shingle is hashed once. The high bits of the 64-bit hash choose
one of ``BINS`` bins, the rest is the value, and a bin keeps its least value. One
sort of the hashes finds all minima: bins follow each other in the sorted array,
and one sentinel a bin, larger than any value, marks the empty ones.

An empty bin takes the value of another bin (optimal densification): it probes
bins in an order of its own, the same for all documents, until it meets one that
is not empty. The first probes are hashed bin numbers; a bin that they all miss
takes the non-empty bin of least hashed priority, which is the end of a probe
sequence through all bins. So every empty bin is filled, each non-empty bin is
equally likely to serve, and two documents agree in a filled bin with the
probability of their similarity.

Of each value the ``BITS`` low-order bits are kept, 16 bins to a long. Two
different values agree in them by chance once in 2^BITS; ``likeness`` takes that
bias out of the share of equal bins.

Only DataFrame functions are used; a document never leaves its row.

``beside_next`` pairs every document with its successor in the order of ids. The
order is taken on narrow rows (id, length, hash); then each text is sent once by
its own key and once more, cut to the characters asked for, to its predecessor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankshelf.llm.text import lower_az, whole_text, words_of
from rankshelf.operators.ordering import global_rank
from rankshelf.session import stage

SHINGLE = 5  # words
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 4  # kept of each value; a long holds 64 / BITS bins
PER_LONG = 64 // BITS
PROBES = 16  # hashed probes of an empty bin before the priorities decide

_SHIFT = 64 - BIN_BITS


def _bin(hash_: str) -> str:
    """Bin of a signed hash; ascending hashes have ascending bins."""
    return f"CAST(shiftright({hash_}, {_SHIFT}) + {BINS // 2} AS INT)"


def _sentinel(bin_: str) -> str:
    """Largest hash of a bin."""
    return f"(shiftleft(CAST({bin_} AS BIGINT) - {BINS // 2}, {_SHIFT}) | {(1 << _SHIFT) - 1}L)"


def with_fingerprint(docs: DataFrame, text: Column, out: str) -> DataFrame:
    """``docs`` plus ``out``, the fingerprint of ``text`` as an array of longs, empty without words.

    The helper columns are arrays that later ones read element by element. Each is
    named at least twice by the next one, so the optimiser keeps it as a projection
    of its own and does not compute it anew for every element.
    """
    w, h, s, d = (f"_{out}_{x}" for x in "whsd")
    columns = docs.columns
    at = docs.withColumn(w, F.transform(words_of(lower_az(text)), lambda x: F.xxhash64(x)))
    shingles = ", ".join(f"get({w}, i + {k})" for k in range(SHINGLE))  # past the end of a short text: null, which the hash skips
    at = at.withColumn(
        h,
        F.expr(f"CASE WHEN size({w}) > 0 THEN transform(sequence(0, greatest(0, size({w}) - {SHINGLE})), i -> xxhash64({shingles})) END"),
    )
    # the hashes and one sentinel a bin, sorted: the first of each bin is its least value, or the sentinel
    at = at.withColumn(s, F.expr(f"sort_array(concat({h}, transform(sequence(0, {BINS - 1}), b -> {_sentinel('b')})))"))
    at = at.withColumn(
        d,
        F.expr(
            f"transform(filter({s}, (x, i) -> i = 0 OR {_bin('x')} != {_bin(f'get({s}, i - 1)')}), (x, b) -> CASE WHEN x != {_sentinel('b')} THEN x END)"
        ),
    )
    probes = ", ".join(f"get({d}, CAST(pmod(xxhash64(b, {k}), {BINS}) AS INT))" for k in range(PROBES))
    last = f"array_min(transform(filter({d}, y -> y IS NOT NULL), y -> struct(xxhash64(b, {_bin('y')}, {PROBES}) AS p, y AS y))).y"
    full = f"_{out}_f"
    at = at.withColumn(full, F.expr(f"transform({d}, (x, b) -> CASE WHEN x IS NOT NULL THEN x ELSE coalesce({probes}, {last}) END)"))
    packed = (
        f"transform(sequence(0, {BINS // PER_LONG - 1}), k -> aggregate(slice({full}, k * {PER_LONG} + 1, {PER_LONG}), 0L, "
        f"(a, x) -> shiftleft(a, {BITS}) | (x & {(1 << BITS) - 1})))"
    )
    value = F.coalesce(F.expr(f"CASE WHEN {full} IS NOT NULL THEN {packed} END"), F.array().cast("array<bigint>"))
    return at.select(*[F.col(f"`{c}`") for c in columns], value.alias(out))


def likeness(a: str, b: str) -> Column:
    """Similarity, 0 to 1, that the fingerprints in columns ``a`` and ``b`` tell of.

    Of two texts without words it is 1, of one with and one without words 0.
    """
    step = "x"
    for halving in range(1, BITS.bit_length()):  # fold the bits of each bin into its lowest one
        step = f"({step} | shiftrightunsigned({step}, {BITS >> halving}))"
    ones = sum(1 << (BITS * k) for k in range(PER_LONG - 1))  # lowest bit of all bins but the first, which may be the sign
    mask = f"({ones}L | shiftleft(1L, {BITS * (PER_LONG - 1)}))"
    differ = f"aggregate(zip_with({a}, {b}, (u, v) -> u ^ v), 0, (n, x) -> n + bit_count({step} & {mask}))"
    chance = 2.0**-BITS
    return F.expr(
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D WHEN size({a}) = 0 OR size({b}) = 0 THEN 0.0D "
        f"ELSE greatest(0.0D, (1.0D - {differ} / {BINS}.0D - {chance}D) / {1 - chance}D) END"
    )


def as_text(fingerprint: str) -> Column:
    """The packed bits as lowercase hex digits; empty for a text without words."""
    return F.expr(f"lower(concat_ws('', transform({fingerprint}, x -> lpad(hex(x), 16, '0'))))")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 longs of 16 bins of 4 bits).

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer than
    five words is one shingle. Null, empty and blank texts have an empty
    fingerprint. Equal texts, and texts with equal words, have equal
    fingerprints. Rows with equal or null ids are worked on one by one; a text of
    any length is one array of 8 bytes a word. An empty table gives no rows;
    other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("t"))
    return with_fingerprint(rows, F.col("t"), "fingerprint").select("doc_id", "fingerprint")


def beside_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, text, fingerprint, next_id, next_head, next_fingerprint``.

    The next document is the one with the next smaller id, after the smallest the
    largest; with a single document, that one itself. ``next_head`` is the start
    of its text, up to half the characters of the row's own text. Rows that share
    an id go by the hash of their texts; rows with the same id and text are one
    place in the order and get equal results. Null ids come after all others.
    Null texts count as empty; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text"))
    # key columns without nulls: the same hash partitioning serves both joins and the grouping
    rows = rows.withColumn("i", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("z", F.col("doc_id").isNull()).withColumn("t", F.xxhash64("text"))
    order = stage(
        global_rank(
            rows.select("doc_id", "i", "z", "t", F.length("text").alias("n")).distinct(),
            [F.col("doc_id").desc_nulls_last(), F.col("t"), F.col("n")], "place", "places",
        ),
        "document-order",
    )
    giver = order.select("i", "z", "t", F.when(F.col("place") == 1, F.col("places")).otherwise(F.col("place") - 1).alias("to"))
    taker = order.select(F.col("place").alias("to"), F.struct("i", "z", "t", F.floor(F.col("n") / 2).cast("int").alias("half")).alias("taker"))
    links = stage(giver.join(taker, "to").drop("to"), "document-links")
    base = with_fingerprint(rows, F.col("text"), "fingerprint")
    heads = (
        base.join(links, ["i", "z", "t"])
        .select("taker.i", "taker.z", "taker.t", F.struct(
            F.expr("substring(text, 1, taker.half)").alias("next_head"), F.col("fingerprint").alias("next_fingerprint"), F.col("doc_id").alias("next_id")
        ).alias("next"))
        .groupBy("i", "z", "t").agg(F.max("next").alias("next"))  # repeated rows send the same
    )
    return base.join(heads, ["i", "z", "t"]).select("doc_id", "text", "fingerprint", "next.next_id", "next.next_head", "next.next_fingerprint")
