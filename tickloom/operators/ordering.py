"""Reproducible random order, exact splits and unions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.hashing import row_hash

# Four hex digits name at most 65,536 buckets: the size bound of every frame counted by bucket.
_DIGITS = 4
_HASH_LENGTH = 32
_COPIES_PER_TASK = 100_000


def union_sets(*sets: DataFrame | None) -> DataFrame:
    """SET1: all rows of all sets, matched by column name; missing sets are skipped."""
    present = [s for s in sets if s is not None]
    if not present:
        raise ValueError("nothing to unite")
    return reduce(DataFrame.unionByName, present)


def hash_rank(df: DataFrame, keys: Sequence[str], seed: int, rank: str = "rank") -> DataFrame:
    """Position of each row, from 1, in the seeded random order of the whole table.

    Rows are numbered inside hash buckets and moved up by the size of the buckets before, so no task
    sees more than one bucket. Rows of one key are numbered in any order.
    """
    order = row_hash(seed, *[F.col(k) for k in keys])
    tagged = df.withColumn("_h", order).withColumn("_b", F.substring("_h", 1, _DIGITS))
    sizes = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_b", (F.sum("_n").over(_up_to_here("_b")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_b").orderBy("_h", *keys)
    numbered = tagged.withColumn("_r", F.row_number().over(inside)).join(F.broadcast(before), "_b")
    return numbered.withColumn(rank, F.col("_before") + F.col("_r")).drop("_b", "_h", "_r", "_before")


def exact_split(
    df: DataFrame,
    keys: Sequence[str],
    fraction: float,
    seed: int,
    labels: tuple[str, str] = ("train", "validation"),
    column: str = "split",
) -> DataFrame:
    """SRT4, MTH5: random split of exactly round(n * fraction) rows against the rest.

    The hash value at the cut is found first: one pass counts the rows by hash bucket, a second
    looks into the one bucket that holds the cut, and single rows come back to the driver. The rows
    themselves are then labelled by comparing their hash with it, without any shuffle. Copies of
    one key stay together, unless the cut falls between them: then they are told apart by their
    whole content, and rows equal in everything are counted and written out again.
    """
    order = row_hash(seed, *[F.col(k) for k in keys])
    edge = _find_edge(df.select(order.alias("_h")), lambda total: round(total * fraction))
    return _cut(df, order, edge, _Sides(seed, *labels, column))


@dataclass(frozen=True)
class _Sides:
    seed: int
    first: str
    rest: str
    column: str

    def by(self, belongs: Column) -> Column:
        return F.when(belongs, self.first).otherwise(self.rest)


@dataclass(frozen=True)
class _Edge:
    """Hash prefix the cut falls on, the rows that have it, and how many of them come first."""

    prefix: str
    size: int
    taken: int


def _cut(
    df: DataFrame, order: Column, edge: _Edge | None, sides: _Sides, by_content: bool = False
) -> DataFrame:
    if edge is None:
        return df.withColumn(sides.column, F.lit(sides.rest))
    head = F.substring(order, 1, len(edge.prefix))
    if edge.taken == edge.size:
        return df.withColumn(sides.column, sides.by(head <= edge.prefix))
    clear = df.where(head != edge.prefix).withColumn(sides.column, sides.by(head < edge.prefix))
    tied = df.where(head == edge.prefix)
    if by_content:
        return clear.unionByName(_share_copies(tied, edge.taken, sides))
    content = _content(tied, sides.seed)
    inner = _find_edge(tied.select(content.alias("_h")), lambda _: edge.taken)
    return clear.unionByName(_cut(tied, content, inner, sides, by_content=True))


def _find_edge(hashes: DataFrame, needed: Callable[[int], int]) -> _Edge | None:
    """Where the cut falls when `needed(total)` rows come first; None when no row does.

    The first level counts all rows in at most 65,536 buckets. What is left of the one bucket that
    matters, one row per distinct hash, is kept and narrowed down the same way until all rows of a
    prefix belong to one side; for unique keys that takes two or three levels.
    """
    left = hashes.select("_h", F.lit(1).cast("long").alias("_n"))
    prefix, need, kept = "", None, None
    try:
        while True:
            counted = left.groupBy(F.substring("_h", 1, len(prefix) + _DIGITS).alias("_b")).agg(
                F.sum("_n").alias("_n")
            )
            running = counted.withColumn("_upto", F.sum("_n").over(_up_to_here("_b")))
            if need is None:
                running = running.persist()
                need = needed(running.agg(F.max("_upto")).first()[0] or 0)
                kept = running
            if need <= 0:
                return None
            row = running.where(F.col("_upto") >= need).orderBy("_b").first()
            prefix, taken = row["_b"], need - (row["_upto"] - row["_n"])
            if taken == row["_n"] or len(prefix) >= _HASH_LENGTH:
                return _Edge(prefix, row["_n"], taken)
            need = taken
            narrowed = left.where(F.col("_h").startswith(prefix))
            if len(prefix) == _DIGITS:
                kept.unpersist()
                narrowed = narrowed.groupBy("_h").agg(F.sum("_n").alias("_n")).persist()
                kept = narrowed
            left = narrowed
    finally:
        if kept is not None:
            kept.unpersist()


def _share_copies(df: DataFrame, taken: int, sides: _Sides) -> DataFrame:
    """Label `taken` of a set of rows that are equal in everything.

    The copies are folded into one row and written out again in pieces, so neither the fold nor
    the writing depends on which task held which copy.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    folded = df.groupBy(_content(df, sides.seed).alias("_content")).agg(
        F.first(whole).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    pieces = folded.select(
        "_row",
        "_n",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / _COPIES_PER_TASK))).alias("_p"),
    ).repartition("_p")
    low = F.col("_p") * _COPIES_PER_TASK + 1
    high = F.least(low + (_COPIES_PER_TASK - 1), F.col("_n"))
    return pieces.select("_row", F.explode(F.sequence(low, high)).alias("_i")).select(
        "_row.*", sides.by(F.col("_i") <= taken).alias(sides.column)
    )


def _content(df: DataFrame, seed: int) -> Column:
    """Hash of a whole row by its typed values: text leaves out digits of times, so two typed hashes
    are added to it. Maps and variants, which Spark does not hash, count by their text."""
    typed = [
        F.col(f"`{f.name}`") for f in df.schema.fields if not re.search("map|variant", f.dataType.simpleString())
    ]
    hashes = [F.xxhash64(*typed), F.xxhash64(F.lit(1), *typed)] if typed else []
    return row_hash(seed, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), *hashes)


def split_counts(split: DataFrame, column: str = "split") -> DataFrame:
    """AGG6: rows per side."""
    return split.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _up_to_here(bucket: str):
    return Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
