"""Words of a text as SQL expressions: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = " \t\n\x0b\x0c\r"
_RUN = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words in order; an empty array for a null text or one without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SEPARATORS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _RUN))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for a null text."""
    return F.size(words_of(text)).cast("long")
