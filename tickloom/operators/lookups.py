"""Names for ids and ids for names."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import fixed

def id_lookup(spark: SparkSession, names: Sequence[str], kind: str) -> DataFrame:
    """Frame (`{kind}_id`, `{kind}`) from a list; the id is the position in the list.

    The list is one literal, so a long one does not make a large plan; the join is left to Spark.
    """
    listed = F.posexplode(F.from_json(F.lit(json.dumps(list(names))), "array<string>"))
    return spark.range(0, 1, 1, 1).select(listed.alias(f"{kind}_id", kind))


def series_title(instrument: Column, column: Column, start: Column) -> Column:
    """STR5: title of a series."""
    return F.concat_ws(" ", instrument, column, start)


def with_titles(
    rows: DataFrame,
    instruments: Sequence[str] = fixed.INSTRUMENTS,
    columns: Sequence[str] = fixed.COLUMNS,
) -> DataFrame:
    """JOI3, STR5: names of the ids in `cat` and the title; rows with unknown ids stay."""
    spark = rows.sparkSession
    by_instrument = id_lookup(spark, instruments, "instrument")
    by_column = id_lookup(spark, columns, "column")
    return (
        rows.withColumn("column_id", F.get("cat", F.lit(0)))
        .withColumn("instrument_id", F.get("cat", F.lit(1)))
        .join(by_instrument, "instrument_id", "left")
        .join(by_column, "column_id", "left")
        .withColumn("title", series_title(F.col("instrument"), F.col("column"), F.col("start")))
    )
