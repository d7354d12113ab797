"""Seeded row hashes: the source of every random order and random choice.

The hash depends on the seed and on the row's key only, so a task that runs again, or a run with
another number of partitions, gives the same order and the same choice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(seed: int, *parts: Column) -> Column:
    """Seed and key parts joined by colons."""
    return F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])


def row_hash(seed: int, *parts: Column) -> Column:
    """32 hex digits, evenly spread over the keys."""
    return F.md5(key_text(seed, *parts))
