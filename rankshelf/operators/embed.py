"""Description → embedding batch job (EMB-1..5) and token pooling.

The default encoder is a hashing encoder in plain SQL: a token's state is the
one-hot vector of its md5 bucket, and the histogram of a text's buckets is made
inside its row. A user's encoder is a factory, built once per
Python worker and called on slices of ``batch_size`` texts inside
``mapInPandas``; it returns token states and a mask. For both, the mode chooses
how the states of a text are pooled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankshelf.functions.columns import let, unicode_strip
from rankshelf.operators.ordering import global_rank
from rankshelf.shipping import ship
from rankshelf.sources import io

MODES = ("sentence", "query")
DEFAULT_DIM = 64
ENCODER_BATCH = 2048  # descriptions per encoder call (fixed value of the reference)
SHARD_ROWS = 1_048_576  # vectors per shard (fixed value of the reference)
TOKEN_PATTERN = r"[^\p{L}\p{N}]+"

_ENCODERS: dict[str, object] = {}


def check_mode(mode: str) -> None:
    """EMB-4: an unknown pooling mode fails before any work starts."""
    if mode not in MODES:
        raise ValueError(f"Invalid mode: {mode}")


def encoder_of(key: str, factory: Callable[[], object]):
    """The encoder of this worker: built at the first call with ``key``, kept for all later tasks."""
    if key not in _ENCODERS:
        _ENCODERS[key] = factory()
    return _ENCODERS[key]


def pooled(states: np.ndarray, mask: np.ndarray, mode: str) -> np.ndarray:
    """EMB-2 / EMB-3 on arrays: states (texts, tokens, dim), mask (texts, tokens); zero where nothing is masked in."""
    if mode == "sentence":
        return states[:, 0, :]
    weight = mask.astype(np.float64)[:, :, None]
    total = weight.sum(axis=1)
    return (states * weight).sum(axis=1) / np.where(total > 0, total, 1.0)


def describable(items: DataFrame) -> DataFrame:
    """FLT-4: ``(item_id, text)`` for items whose Unicode-stripped description is not empty."""
    stripped = items.select("item_id", unicode_strip("description").alias("text"))
    return stripped.where(F.col("text").isNotNull() & (F.col("text") != ""))


def embed(
    texts: DataFrame,
    encoder_factory: Callable[[], object] | None = None,
    key: str | None = None,
    batch_size: int = ENCODER_BATCH,
    mode: str = "sentence",
) -> DataFrame:
    """EMB-1: ``(item_id, text)`` → ``(item_id, embedding ARRAY<FLOAT>)``.

    A factory's encoder has ``encode(texts) -> (states, mask)``; ``key`` names it
    within the workers and is required with a factory. Without one the hashing
    encoder runs, whose pooled vectors are scaled to unit length.
    """
    check_mode(mode)
    if encoder_factory is None:
        return hashing_embed(texts, mode)
    if not key:
        raise ValueError("an encoder factory needs a key")
    ship(texts.sparkSession)

    def run(batches):
        encoder = encoder_of(key, encoder_factory)
        for pdf in batches:
            ids = pdf["item_id"].to_numpy()
            docs = pdf["text"].tolist()
            for start in range(0, len(docs), batch_size):
                states, mask = encoder.encode(docs[start:start + batch_size])
                vecs = pooled(np.asarray(states, np.float64), np.asarray(mask), mode).astype(np.float32)
                yield pd.DataFrame({"item_id": ids[start:start + batch_size], "embedding": list(vecs)})

    return texts.select("item_id", "text").mapInPandas(run, "item_id bigint, embedding array<float>")


def hashing_embed(texts: DataFrame, mode: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """EMB-5: the hashing encoder, each text inside its own row; nothing is exploded, joined or shuffled.

    ``sentence`` takes the first token, ``query`` all of them. The buckets of a text and one
    mark for each bucket are sorted together; the places where a bucket begins give
    its count, and the counts are scaled to unit length. Texts without a token (null,
    too) have zero vectors; rows that share an id keep their own.
    """
    check_mode(mode)
    found = F.filter(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), TOKEN_PATTERN), lambda t: t != "")
    taken = F.slice(found, 1, 1) if mode == "sentence" else found
    buckets = F.transform(taken, lambda t: (token_bucket(t) % dim).cast("int"))
    marked = F.sort_array(F.concat(buckets, F.sequence(F.lit(0), F.lit(dim - 1))))
    begins = lambda b: F.filter(F.transform(b, lambda x, i: F.when((i == 0) | (x != F.get(b, i - 1)), i)), lambda i: i.isNotNull())
    counts = lambda b: let(begins(b), lambda at: F.transform(at, lambda i, k: F.coalesce(F.get(at, k + 1), F.size(b)) - i - 1))
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint") * x))
    unit = lambda c: let(norm(c), lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(0.0).cast("float")))
    return texts.select("item_id", let(let(marked, counts), unit).alias("embedding"))


def embedding_job(spark, json_path: str, out_path: str, mode: str = "sentence", shard_rows: int = SHARD_ROWS, **encoder) -> None:
    """The whole job: catalogue JSON lines → non-empty descriptions → vectors → shards of ``shard_rows`` in id order."""
    items = io.items_from_json(io.read_items_json(spark, json_path, "DROPMALFORMED").drop("_corrupt_record"))
    vectors = embed(describable(items), mode=mode, **encoder)
    ranked = global_rank(vectors, [F.col("item_id")], "rn")
    io.write_embedding_shards(ranked.withColumn("batch", F.expr(f"(rn - 1) div {shard_rows}")).drop("rn"), out_path)


def tokens(texts: DataFrame) -> DataFrame:
    """``(item_id, pos, token)``, 0-based positions over the whole text."""
    parts = F.split(F.lower(F.col("text")), TOKEN_PATTERN)
    exploded = texts.select("item_id", F.posexplode(F.filter(parts, lambda t: t != "")).alias("pos", "token"))
    return exploded


def token_bucket(token_col) -> F.Column:
    return F.conv(F.substring(F.md5(token_col), 1, 8), 16, 10).cast("bigint")


def vectors_long(vectors: DataFrame) -> DataFrame:
    """``(item_id, bucket, weight)`` for the non-zero entries of ``(item_id, embedding)``."""
    # outer: for the inner form the optimiser infers a filter on the array and computes the vectors a second time for it;
    # the row of a missing vector has no weight and goes
    return vectors.select("item_id", F.posexplode_outer("embedding").alias("bucket", "weight")).where(F.col("weight") != 0)


def token_states(texts: DataFrame, dim: int = DEFAULT_DIM, mask=None) -> DataFrame:
    """Sparse per-token states ``(item_id, pos, dim, value, mask)``: one-hot of the token's bucket.

    ``mask`` is a column over ``token``; by default tokens of one character are masked out.
    """
    mask = (F.length("token") > 1).cast("int") if mask is None else mask
    return tokens(texts).select(
        "item_id", "pos", (token_bucket(F.col("token")) % dim).cast("int").alias("dim"), F.lit(1.0).alias("value"), mask.alias("mask")
    )


def pool(states: DataFrame, mode: str) -> DataFrame:
    """EMB-2 / EMB-3 on a long state table → ``(item_id, dim, value)``.

    ``sentence``: the state of the first token. ``query``: the masked mean
    ``sum(mask * h) / sum(mask)`` over positions; no row where the mask is zero throughout.
    """
    check_mode(mode)
    if mode == "sentence":
        return states.where(F.col("pos") == 0).groupBy("item_id", "dim").agg(F.sum("value").alias("value"))
    masked_in = states.where(F.col("mask") != 0)
    totals = masked_in.select("item_id", "pos", "mask").distinct().groupBy("item_id").agg(F.sum("mask").alias("m"))
    sums = masked_in.groupBy("item_id", "dim").agg(F.sum(F.col("value") * F.col("mask")).alias("s"))
    return sums.join(totals, "item_id").select("item_id", "dim", (F.col("s") / F.col("m")).alias("value"))
