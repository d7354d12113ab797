"""Lines of text files with their file and place, so that results can be put back in that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.paths import file_name

#: The file of a line: its name, and what tells it from files of that name in other folders.
FILE = ("file", "origin")
#: A line's place: its file, the piece of the file it was read in, and its turn in the piece.
PLACE = (*FILE, "piece", "turn")


def placed_lines(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """SRC5: (file, origin, piece, turn, value) of all lines, empty ones with them.

    Large files are read in pieces by several tasks. Where a piece starts and the order inside it
    are known without counting, so no row moves.
    """
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    return lines.select(
        _decoded(file_name(F.col("_metadata.file_path"))).alias("file"),
        F.substring(F.md5("_metadata.file_path"), 1, 8).alias("origin"),
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0").alias("piece"),
        F.monotonically_increasing_id().alias("turn"),
        "value",
    )


def numbered_lines(placed: DataFrame) -> DataFrame:
    """The rows of `placed_lines` with `line`, the number of each in its file from 0, for its place.

    Rows are numbered inside their piece and moved up by the rows of the pieces before, so a large
    file is spread over its pieces.
    """
    sizes = placed.groupBy(*FILE, "piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*FILE).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*FILE, "piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*FILE, "piece").orderBy("turn")
    numbered = placed.withColumn("_i", F.row_number().over(inside) - 1).join(before, [*FILE, "piece"])
    return numbered.withColumn("line", F.col("_before") + F.col("_i")).drop("_i", "_before", "piece", "turn")


def aligned_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, origin, line, value) of a folder that `write_aligned` wrote: the value answers line
    `line` of that input file."""
    read = spark.read.option("recursiveFileLookup", True).text(path)
    where = _decoded(F.col("_metadata.file_path"))
    # What was written for a piece may itself be read in several.
    inner = F.lpad(F.col("_metadata.file_block_start").cast("string"), 15, "0")
    placed = read.select(
        *[_decoded(F.regexp_extract(where, f"/{c}=([^/]+)/", 1)).alias(c) for c in FILE],
        F.concat(F.regexp_extract(where, "/(piece=.*)", 1), F.lit("/"), inner).alias("piece"),
        F.monotonically_increasing_id().alias("turn"),
        "value",
    )
    return numbered_lines(placed)


def _decoded(path: Column) -> Column:
    """A path without percent signs; a plus stays one."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
