"""Text expressions that several operators share; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The separators of the contracts' words, as Java patterns.
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged. lower() is faster and equal where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def split_words(text: Column, separator: str = SPACE) -> Column:
    """Array of words; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")
