"""Minute bars from delimited files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.paths import instrument_of
from tickloom.functions.timekeys import parse_bar_time


_CORRUPT = "_corrupt_record"

#: Why a row is no bar.
BAD_TIME, BAD_NUMBER, BAD_COLUMNS = "time", "number", "columns"


def read_bar_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] = fixed.BAR_COLUMNS,
    keep_corrupt: bool = False,
) -> DataFrame:
    """SRC1, SRC2, PRJ2: all instruments in one scan, with `Time` as text.

    The schema is declared, so no pass over the data is spent on guessing it. `columns` gives the
    order in the files, which their header must confirm. Files are named `{instrument}_1m.csv`;
    folders of that name work as well. A value that is no number is NULL. With `keep_corrupt` all
    values stay text, and the line of a row with more or fewer columns is kept as
    `_corrupt_record`, for `judged` to tell faults from missing values.
    """
    fields = [f"`{c}` {'string' if keep_corrupt or c == 'Gmt time' else 'double'}" for c in columns]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if keep_corrupt:
        fields.append(f"{_CORRUPT} string")
        reader = reader.option("columnNameOfCorruptRecord", _CORRUPT)
    return (
        reader.schema(", ".join(fields))
        .csv(paths)
        .withColumnRenamed("Gmt time", "Time")
        .select("*", instrument_of(F.col("_metadata.file_path")).alias("instrument"))
    )


def standardize(raw: DataFrame, with_zone: bool = True) -> DataFrame:
    """PRJ1, DAT1, DAT2: add the parsed time `start` in front of all columns."""
    return raw.select(parse_bar_time(F.col("Time"), with_zone).alias("start"), "*")


def rejected(standardized: DataFrame) -> DataFrame:
    """Rows whose time could not be read."""
    return standardized.where(F.col("start").isNull())


def judged(raw: DataFrame, with_zone: bool = True, columns: Sequence[str] = fixed.BAR_COLUMNS) -> DataFrame:
    """SRC1: rows of `read_bar_files` with `keep_corrupt`, with `start`, `reason`, `line` and values
    as numbers.

    `reason` is NULL for a row that is a bar; otherwise the line has more or fewer columns, the time
    cannot be read, or a value is no number. An empty value is no fault. `line` is the row's text.
    """
    values = [c for c in columns if c != "Gmt time"]
    given = ["Time" if c == "Gmt time" else c for c in columns]
    numbers = {c: F.col(f"`{c}`").try_cast("double") for c in values}
    faulty = reduce(Column.__or__, [F.col(f"`{c}`").isNotNull() & n.isNull() for c, n in numbers.items()])
    reason = (
        F.when(F.col(_CORRUPT).isNotNull(), BAD_COLUMNS).when(F.col("start").isNull(), BAD_TIME).when(faulty, BAD_NUMBER)
    )
    line = F.coalesce(_CORRUPT, F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in given]))
    told = standardize(raw, with_zone).withColumn("reason", reason).withColumn("line", line).drop(_CORRUPT)
    return told.withColumns(numbers)


def bad_rows(rows: DataFrame) -> DataFrame:
    """Rejected rows of `judged`: instrument, reason, Time and line."""
    return rows.where(F.col("reason").isNotNull()).select("instrument", "reason", "Time", "line")


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows of `judged` that are bars."""
    return to_bars(rows.where(F.col("reason").isNull()))


def to_bars(standardized: DataFrame) -> DataFrame:
    """Rows with a readable time, in the shape the series operators take."""
    return standardized.where(F.col("start").isNotNull()).select(
        "instrument",
        F.col("start").alias("ts"),
        F.col("Open").alias("open"),
        F.col("High").alias("high"),
        F.col("Low").alias("low"),
        F.col("Close").alias("close"),
        F.col("Volume").alias("volume"),
    )


def read_bars(spark: SparkSession, paths: str | Sequence[str], with_zone: bool = True) -> DataFrame:
    """Bar files to bars in one step."""
    return to_bars(standardize(read_bar_files(spark, paths), with_zone))
