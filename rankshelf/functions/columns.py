"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage code generation; nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
RRF_K = 60  # reciprocal rank fusion constant
POPULARITY_WEIGHT_SCALE = 20.0  # popularity weight = sigmoid(history length / 20)
TEST_FRACTION_DIVISOR = 5  # int(0.2 * N) == N div 5 for every N used here
DEFAULT_SEED = "42"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: the characters Python's str.strip() treats as white space.
WHITE_SPACE_CLASS = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def unicode_strip(c) -> Column:
    """``str.strip()``: drop leading and trailing Unicode white space.

    Spark's ``trim`` only removes ASCII spaces, so tabs, newlines and U+00A0
    would survive it.
    """
    c = col_(c)
    edge = F.concat(F.substring(c, 1, 1), F.substring(c, -1, 1))
    # only texts that start or end with white space pay for the full regular expression
    return F.when(edge.rlike(WHITE_SPACE_CLASS), F.regexp_replace(c, f"^{WHITE_SPACE_CLASS}+|{WHITE_SPACE_CLASS}+$", "")).otherwise(c)


def split_key(id_col, seed: str = DEFAULT_SEED) -> Column:
    """Repeatable shuffle key: ``md5(id || ':' || seed)``, identical in DuckDB."""
    return F.md5(F.concat(col_(id_col).cast("string"), F.lit(":" + str(seed))))


def reciprocal_rank(rank_col, k: int = RRF_K) -> Column:
    return F.lit(1.0) / (col_(rank_col).cast("double") + F.lit(float(k)))


def popularity_weight(history_len_col) -> Column:
    """``1 / (1 + exp(-len / 20))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(history_len_col).cast("double") / F.lit(POPULARITY_WEIGHT_SCALE)))


def dot(a, b) -> Column:
    """Dot product of two numeric arrays, in DOUBLE."""
    return F.aggregate(
        F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def l2_norm(a) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a) -> Column:
    """Unit-length copy of a vector in DOUBLE; a zero vector stays zero."""
    n = l2_norm(a)
    return F.transform(col_(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine_distance_unit(a_unit, b_unit) -> Column:
    """``1 - a.b`` for pre-normalised vectors, clipped to [0, 2]."""
    return F.least(F.greatest(F.lit(1.0) - dot(a_unit, b_unit), F.lit(0.0)), F.lit(2.0))


def discount_sum(n_col) -> Column:
    """``D(n) = sum_{j=1..n} 1/log2(j+1)``; 0 for n <= 0."""
    n = col_(n_col)
    return F.when(n <= 0, F.lit(0.0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(1), n.cast("int")),
            F.lit(0.0).cast("double"),
            lambda acc, j: acc + F.lit(1.0) / F.log2(j.cast("double") + F.lit(1.0)),
        )
    )


def ndcg_reference(m_col, r_col, a_col) -> Column:
    """NDCG as the reference computes it (sorted relevance as truth, 0/1 as score).

    With tie-averaged DCG this is, for ``m`` predictions of which ``r`` are
    relevant and ``a`` of those lie in the first ``r`` positions::

        0                                   if r = 0
        1                                   if r = m
        a/r + (r-a)/(m-r) * (D(m)-D(r))/D(r) otherwise
    """
    m, r, a = col_(m_col).cast("double"), col_(r_col).cast("double"), col_(a_col).cast("double")
    d_m, d_r = discount_sum(col_(m_col)), discount_sum(col_(r_col))
    mixed = a / r + ((r - a) / (m - r)) * (d_m - d_r) / d_r
    return F.when(r == 0, F.lit(0.0)).when(r == m, F.lit(1.0)).otherwise(mixed)


def format4(c) -> Column:
    """``{:.4f}`` of the report."""
    return F.format_string("%.4f", col_(c))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it.

    The value is bound to a lambda variable. A column of its own would not do: the
    optimiser may put its expression in place of the name (a filter pushed below it
    does so), once for every mention, and inside a lambda once for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
