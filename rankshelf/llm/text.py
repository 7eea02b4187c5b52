"""Column helpers shared by the text operators (JVM side, no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WORD_GAP = r"[\x20\x09-\x0D]+"  # what separates two words
HAS_WORD = r"[^\x20\x09-\x0D]"  # a character that belongs to a word


def whole_text(col: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``."""
    return F.array_remove(F.split(text, WORD_GAP, -1), "")
