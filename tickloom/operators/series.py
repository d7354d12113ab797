"""Weekly series from bars.

Bars have the columns `instrument, ts, open, high, low, close, volume`. A weekly series holds all
bars of one instrument in one week as an array of structs, so columns stay aligned and in time
order. The calendar bounds its size: a week of one-minute bars has 10,080 points. An instrument
that holds most of the table is spread over its weeks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.timekeys import week_key


def with_week(bars: DataFrame, mode: str = "iso") -> DataFrame:
    """DAT3, DAT4: add the week key."""
    return bars.withColumn("week_key", week_key(F.col("ts"), mode))


def weekly_series(
    bars: DataFrame, mode: str = "iso", columns: Sequence[str] = fixed.COLUMNS
) -> DataFrame:
    """AGG1-AGG3: one row per instrument and week with its points in time order.

    One shuffle on (instrument, week). Only `columns` travel through it. Points at the same time
    are ordered by their values, so the result does not depend on how rows were spread. `present`
    counts the values of each column, which tells series with gaps from those without.
    """
    point = F.struct("ts", *columns)
    present = F.struct(*[F.count(c).alias(c) for c in columns])
    return (
        with_week(bars.where(F.col("ts").isNotNull()), mode)
        .groupBy("instrument", "week_key")
        .agg(
            F.min("ts").alias("ts_start"),
            F.sort_array(F.collect_list(point)).alias("points"),
            present.alias("present"),
        )
    )


def weekly_index(bars: DataFrame, mode: str = "iso") -> DataFrame:
    """Start and size of every weekly series, without building the series.

    Both are aggregates that combine before the shuffle, so only one small row per instrument,
    week and task moves.
    """
    return (
        with_week(bars.where(F.col("ts").isNotNull()), mode)
        .groupBy("instrument", "week_key")
        .agg(F.min("ts").alias("ts_start"), F.count(F.lit(1)).alias("n_points"))
    )


def series_stats(index: DataFrame) -> DataFrame:
    """AGG4, ARR1: smallest and largest series, first and last start."""
    return index.agg(
        F.min("n_points").alias("min_cnt"),
        F.max("n_points").alias("max_cnt"),
        F.min("ts_start").alias("min_date"),
        F.max("ts_start").alias("max_date"),
    )


def column_points(column: str, nulls: str = "drop") -> Column:
    """Points that count for one column: all, or those with a value.

    A series without gaps, the usual case, is passed on as it is.
    """
    points = F.col("points")
    if nulls == "keep":
        return points
    whole = F.col("present")[column] == F.size(points)
    return F.when(whole, points).otherwise(F.filter(points, lambda p: p[column].isNotNull()))


def features_table(
    series: DataFrame, columns: Sequence[str] = fixed.COLUMNS, nulls: str = "drop"
) -> DataFrame:
    """One value list per column and week, the layout SQL users query as `features`."""
    lists = [column_points(c, nulls).getField(c).alias(c) for c in columns]
    return series.select("instrument", "week_key", "ts_start", *lists)


def long_series(
    series: DataFrame, columns: Sequence[str] = fixed.COLUMNS, nulls: str = "drop"
) -> DataFrame:
    """PRJ4: one row per series and value column: column_id, column, times, values.

    Columns are spread after the shuffle, on whole series, so a bar moves once and not once per
    column. Other columns of the series are carried along.
    """

    def kind(column_id: int, column: str) -> Column:
        points = column_points(column, nulls)
        return F.struct(
            F.lit(column_id).alias("column_id"),
            F.lit(column).alias("column"),
            points.getField("ts").alias("times"),
            points.getField(column).alias("values"),
        )

    carried = [c for c in series.columns if c not in ("points", "present")]
    kinds = [kind(i, c) for i, c in enumerate(columns)]
    return series.select(*carried, F.inline(F.array(*kinds)))


def first_series(series: DataFrame, limit: int) -> DataFrame:
    """LIM1: the oldest `limit` series; ties by instrument and week."""
    return series.orderBy("ts_start", "instrument", "week_key").limit(limit)
