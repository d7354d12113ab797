"""Tables a job keeps while it works."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.session import new_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: made once, and safe when executors are lost."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
