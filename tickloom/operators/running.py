"""Running sums and maxima over an order of any length, without a window over all of it.

Rows are dealt into ranges of the order and kept there; each range is summed up, the few sums are
put in order, and inside a range a window starts from the sum of the ranges before. A group that
holds most rows is spread over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sinks.stage import staged

RANGE = "_range"


def in_ranges(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows with the number of their range; ranges follow the order inside each group.

    They are stored, because ranges are cut by a sample that another run would draw anew.
    """
    dealt = df.repartitionByRange(*group, *order).withColumn(RANGE, F.spark_partition_id())
    return staged(dealt, "ranges")


def running_sums(ranged: DataFrame, group: Sequence[str], order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """For each entry (name: column) the sum of the column up to the row, the row with it."""
    totals = ranged.groupBy(*group, RANGE).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *group, RANGE, *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums]
    )
    inside = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = ranged.select("*", *[F.sum(c).over(inside).alias(f"_i_{n}") for n, c in sums.items()])
    joined = counted.join(before, [*group, RANGE])
    return joined.select(*ranged.columns, *[(F.col(f"_b_{n}") + F.col(f"_i_{n}")).alias(n) for n in sums])


def later_max(ranged: DataFrame, group: Sequence[str], order: Sequence[Column], column: str, name: str) -> DataFrame:
    """The greatest value of the column from the row on to the end of its group."""
    tops = ranged.groupBy(*group, RANGE).agg(F.max(column).alias("_top"))
    later = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(1, Window.unboundedFollowing)
    after = tops.select(*group, RANGE, F.max("_top").over(later).alias("_after"))
    inside = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    joined = ranged.withColumn("_inside", F.max(column).over(inside)).join(after, [*group, RANGE])
    return joined.select(*ranged.columns, F.greatest("_inside", "_after").alias(name))
