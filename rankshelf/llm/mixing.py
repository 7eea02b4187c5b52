"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). The tokens of the cells are
raked: in every round the weights are scaled to the source targets, then to the
language targets, then to the topic targets, until no scaling moves a marginal by
more than ``TOLERANCE``. The ratio of a cell's raked to its own tokens gives the
probability of its documents, which are then sampled by a hash of their id.

The share that is kept is the largest at which every target is met: the cell with
the highest ratio is kept whole. A higher share may be asked for; cells then stay
at their own tokens while the others are raked on, and ``marginals`` tells by how
much a target is missed that the documents cannot meet at that share.

The documents are measured once and written with what is kept of them; all raking
works on the cell table.
Each scaling sums the weights of one dimension map-side, so a dominant source or
language is one small row per task, and joins the few sums back by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankshelf.llm.text import HAS_WORD, UPPER, whole_text
from rankshelf.session import stage, unstage

DIMENSIONS = ("source", "lang", "topic")
ALPHA = 0.9  # target share of a value = its share of tokens to this power, normalised
ROUNDS = 40  # most scalings of each dimension
TOLERANCE = 1e-9  # relative error of a marginal at which the rounds end
SEED = 42


def shape_topic(text: Column) -> Column:
    """A coarse topic from the shape of a text: numbers, symbols, capitals, lists or prose."""
    n = F.length(text)
    share = lambda chars: n - F.length(F.translate(text, chars, ""))
    return (
        F.when(share("0123456789") * 10 > n, "numbers")
        .when(share("#*$%&|<>") * 20 > n, "symbols")
        .when(share(UPPER) * 3 > n, "capitals")
        .when(share("\n") * 40 > n, "lists")
        .otherwise("prose")
    )


def token_count(text: Column) -> Column:
    """Words plus one end token."""
    return (F.regexp_count(text, F.lit(HAS_WORD + "+")) + 1).cast("long")


def with_cell(docs: DataFrame, keep: list[str], text_col: str, source_col: str, lang_col: str, topic: Column | None) -> DataFrame:
    """``_row`` (the columns ``keep`` of ``docs``), the cell columns (null as empty) and ``tokens``."""
    text = whole_text(f"`{text_col}`")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(shape_topic(text) if topic is None else topic, F.lit("")).alias("topic"),
        token_count(text).alias("tokens"),
    )


def smoothed_targets(cells: DataFrame, dimension: str, alpha: float) -> DataFrame:
    """``value, target``: shares of tokens to the power ``alpha``, normalised to one."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("n"))
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    powered = sums.select("value", F.pow(F.col("n") / total, F.lit(alpha)).alias("p"))
    norm = powered.agg(F.sum("p")).first()[0] or 1.0
    return powered.select("value", (F.col("p") / F.lit(norm)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, most: float | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` plus ``ratio``: raked share of tokens over own share.

    ``targets[dimension]`` is ``value, target`` with targets that sum to one; a
    value without a target gets weight zero. With ``most`` no ratio exceeds it: a
    cell at that limit stays there while further rounds raise the others. The
    rounds end when no factor is further than ``tolerance`` from one. Each round
    is written before the next one, so the plan stays short.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    own = F.col("tokens") / F.lit(total)
    current = stage(cells.withColumn("w", own), "rake")
    for _ in range(rounds):
        scaled = current.withColumn("moved", F.lit(0.0))
        for dimension in targets:
            goal = targets[dimension].select(F.col("value").alias(dimension), "target")
            factor = (
                scaled.groupBy(dimension).agg(F.sum("w").alias("have"))
                .join(goal, dimension, "left")
                .select(dimension, F.when(F.col("have") > 0, F.coalesce("target", F.lit(0.0)) / F.col("have")).otherwise(1.0).alias("f"))
            )
            weight = F.col("w") * F.col("f")
            scaled = scaled.join(factor, dimension).select(
                *cells.columns, (weight if most is None else F.least(weight, own * F.lit(most))).alias("w"),
                F.greatest("moved", F.abs(F.col("f") - 1)).alias("moved"),
            )
        scaled = stage(scaled, "rake")
        unstage(current)
        current = scaled.drop("moved")
        current._staged_at = scaled._staged_at
        if (scaled.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
    return current.withColumn("ratio", F.col("w") * F.lit(total) / F.col("tokens")).drop("w")


def uniform(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id; rows with one id share it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    rate: float | None = None,
    alpha: float = ALPHA,
    rounds: int = ROUNDS,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """``_row`` (struct of the columns ``keep``, all by default; the id is kept always), cell, ``tokens``, ``probability`` and ``sampled``.

    Without ``rate`` the probability is the cell's ratio over the highest one, so the
    expected token weights meet every target. With ``rate``, the share of tokens to
    keep, it is ``rate * ratio``, raked under the limit of one (see ``marginals`` for
    what is missed then). Dimensions without targets get smoothed
    ones. Null sources, languages and topics are the empty value; null texts
    count one token; rows that share an id are drawn alike; an empty table gives
    no rows.
    """
    kept = docs.columns if keep is None else list(dict.fromkeys([id_col, *keep]))
    rows = stage(with_cell(docs, kept, text_col, source_col, lang_col, topic), "mixed-rows")
    cells = stage(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    raked = rake(cells, goals_of(cells, targets, alpha), rounds, None if rate is None else 1 / rate)
    highest = (raked.agg(F.max("ratio")).first()[0] or 1.0) if rate is None else 1 / rate
    ratios = raked.select(*DIMENSIONS, F.least(F.lit(1.0), F.col("ratio") / F.lit(highest)).alias("probability"))
    return rows.join(ratios, list(DIMENSIONS), "left").withColumn(
        "sampled", uniform(F.col(f"_row.`{id_col}`"), seed) < F.col("probability")
    )


def goals_of(cells: DataFrame, targets: dict[str, DataFrame] | None, alpha: float) -> dict[str, DataFrame]:
    """The given targets, and smoothed ones for the other dimensions."""
    given = targets or {}
    return {d: given[d] if d in given else stage(smoothed_targets(cells, d, alpha), "targets") for d in DIMENSIONS}


def marginals(mixed: DataFrame, targets: dict[str, DataFrame] | None = None, alpha: float = ALPHA) -> DataFrame:
    """How well the rows of ``mix`` meet their targets: ``dimension, value, target, expected, drawn, error``.

    ``expected`` and ``drawn`` are shares of the tokens kept, in expectation and in
    the sample; ``error`` is the relative distance of ``expected`` from the target
    (null for a target of zero). Targets of values that no row has are left out; an
    empty table gives no rows.
    """
    cells = stage(
        mixed.groupBy(*DIMENSIONS).agg(
            F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("probability")).alias("e"),
            F.sum(F.when(F.col("sampled"), F.col("tokens")).otherwise(0)).alias("s"),
        ),
        "mixed-cells",
    )
    both = cells.agg(F.sum("e").alias("e"), F.sum("s").alias("s")).first()
    out = None
    for d, goal in goals_of(cells, targets, alpha).items():
        sums = cells.groupBy(F.col(d).alias("value")).agg(
            (F.sum("e") / F.lit(float(both.e or 1))).alias("expected"), (F.sum("s") / F.lit(float(both.s or 1))).alias("drawn")
        )
        one = sums.join(goal, "value", "left").select(
            F.lit(d).alias("dimension"), "value", F.coalesce("target", F.lit(0.0)).alias("target"), "expected", "drawn"
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn("error", F.expr("CASE WHEN target > 0 THEN abs(expected / target - 1) END"))


def sample_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``mix`` samples, with all their columns."""
    return mix(docs, **options).where("sampled").select("_row.*")
