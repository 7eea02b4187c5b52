"""Quality rules with a verdict per host.

Every document is measured in one pass (no shuffle of texts). Rule failures are
summed per host, each host's failure rate is shrunk towards the corpus with an
empirical beta prior (moments of the host rates, weighted by documents), and the
verdict on the host is joined back to its documents: in a rejected host only
documents that break no rule stay.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from rankshelf.llm.text import HAS_WORD, whole_text, words_of
from rankshelf.session import stage

SYMBOLS = "#*$%&|<>"  # fixed value of the rule set

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    """Thresholds. The first two decide alone; the others count against the host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_word_length: float = 2.0
    max_word_length: float = 12.0
    max_symbol_percent: int = 30
    max_dup_line_percent: int = 30
    host_limit: float = 0.5


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus the columns of ``MEASURES`` and ``n_lines`` (lines with a word).

    Windows of three words are compared by a 64-bit hash within one document.
    They are sorted with their positions, so the cost is n log n in the words of
    the document, and only documents with a repeat pay for the sort.
    """
    text = whole_text(text_col)
    at = docs.withColumn("_q_words", words_of(text)).withColumn("_q_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD)))
    at = at.withColumn("n_words", F.size("_q_words").cast("long"))
    at = at.withColumn(
        "_q_hashes",
        F.when(
            F.col("n_words") >= 3,
            F.expr("transform(sequence(0, size(_q_words) - 3), i -> xxhash64(get(_q_words, i), get(_q_words, i + 1), get(_q_words, i + 2)))"),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    at = at.withColumn(
        "_q_sorted",
        F.when(
            F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes"),
            F.expr("sort_array(transform(_q_hashes, (h, i) -> struct(h, i)))"),
        ),
    )
    at = at.withColumn(
        "_q_places",
        F.expr(
            "sort_array(transform(filter(_q_sorted, (x, k) -> get(_q_sorted, k - 1).h = x.h OR get(_q_sorted, k + 1).h = x.h), x -> x.i))"
        ),
    )
    # a window covers three words; of two that overlap, the later adds only its new ones
    covered = F.expr("aggregate(transform(_q_places, (p, k) -> least(3, get(_q_places, k + 1) - p)), 0L, (a, x) -> a + x)")
    return (
        at.withColumn("word_chars", F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("n_lines", F.size("_q_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("_q_words", "_q_lines", "_q_hashes", "_q_sorted", "_q_places")
    )


def with_failures(measured: DataFrame, rules: Rules) -> DataFrame:
    """Add ``base_failed`` and ``any_failed`` (a base rule or one that counts against the host)."""
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    soft = (
        (F.col("word_chars") < rules.min_word_length * F.col("n_words"))
        | (F.col("word_chars") > rules.max_word_length * F.col("n_words"))
        | (100 * F.col("n_symbols") > rules.max_symbol_percent * F.col("n_words"))
        | (100 * F.col("n_dup_lines") > rules.max_dup_line_percent * F.col("n_lines"))
    )
    return measured.withColumn("base_failed", base).withColumn("any_failed", base | soft)


def host_verdicts(failures: DataFrame, host_col: str, rules: Rules) -> DataFrame:
    """``_q_host, host_rate, host_rejected``: one row per host, null being a host of its own.

    With rates r_i = x_i / n_i, mean m and variance v weighted by n_i, the prior
    is Beta(m k, (1 - m) k) with k = m (1 - m) / v - 1, at least 1; the shrunk
    rate is (x_i + m k) / (n_i + k). No spread between hosts (v = 0) shrinks
    every host to the mean.
    """
    hosts = (
        failures.groupBy(F.col(host_col).alias("_q_host"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("any_failed").cast("long")).alias("x"))
    )
    prior = hosts.agg(  # one row
        (F.sum("x") / F.sum("n")).alias("m"), (F.sum(F.col("x") * F.col("x") / F.col("n")) / F.sum("n")).alias("s")
    ).first()
    m = float(prior.m or 0.0)
    v = float(prior.s or 0.0) - m * m
    if v > 1e-12:
        k = max(1.0, m * (1 - m) / v - 1)
        rate = (F.col("x") + F.lit(m * k)) / (F.col("n") + F.lit(k))
    else:
        rate = F.lit(m)
    return hosts.select("_q_host", F.round(rate, 6).alias("host_rate")).withColumn(
        "host_rejected", F.col("host_rate") >= rules.host_limit
    )


def judged(docs: DataFrame, keep: list[str], text_col: str, host_col: str, rules: Rules) -> DataFrame:
    """``_row`` (struct of the columns ``keep``), measures, ``base_failed``, ``host_rate``, ``host_rejected``, ``kept``.

    The measures are written once and read twice, so no text is measured again.
    """
    needed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col(f"`{text_col}`").alias("_q_text"), F.col(f"`{host_col}`").alias("_q_host")
    )
    measured = stage(with_failures(measure(needed, "_q_text"), rules).drop("_q_text"), "quality")
    # written, so that its size is known: few hosts are broadcast, and the texts stay where they are
    verdicts = stage(host_verdicts(measured, "_q_host", rules).withColumnRenamed("_q_host", "_q_key"), "hosts")
    joined = measured.join(verdicts, F.col("_q_host").eqNullSafe(F.col("_q_key")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_rejected") & F.col("any_failed")))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", rules: Rules = Rules()) -> DataFrame:
    """One row per input row: the id, the measures, ``base_failed``, ``host_rate``, ``host_rejected``, ``kept``.

    Null texts have no words and fail; null hosts form one host; repeated rows
    are judged alike; an empty table gives no rows; other columns are ignored.
    """
    out = judged(docs, [id_col], text_col, host_col, rules)
    return out.select(
        F.col(f"_row.`{id_col}`").alias("doc_id"), *MEASURES, "base_failed", "host_rate", "host_rejected", "kept"
    )


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns whatever their names."""
    return judged(docs, docs.columns, text_col, host_col, rules).where("kept").select("_row.*")
