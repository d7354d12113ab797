"""JSON lines, binary files, views and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.paths import extension, file_name

FEATURE_SCHEMA = "cat array<int>, start string, target array<double>"
TRIAL_SCHEMA = (
    "TrainingJobName string, TrainingJobStatus string, FinalObjectiveValue double, "
    "TrainingStartTime timestamp_ntz, params map<string,double>"
)


def manifest_schema(label: str) -> str:
    """Schema of a manifest: the image reference, one label object, and the line if unreadable."""
    box = "struct<left:double,top:double,width:double,height:double>"
    return (
        f"`source-ref` string, `{label}` struct<annotations:array<{box}>>, _corrupt_record string"
    )


def read_manifest(spark: SparkSession, path: str, label: str) -> DataFrame:
    """SRC4: manifest lines as typed columns; a line that is no JSON is kept as text."""
    return (
        spark.read.schema(manifest_schema(label))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Manifest lines as text in the column `line`, for jobs that pass unknown keys through."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_feature_rows(spark: SparkSession, path: str) -> DataFrame:
    """SRC5, SRC11: feature rows from all files of JSON lines."""
    return spark.read.schema(FEATURE_SCHEMA).option("pathGlobFilter", "*.json").json(path)


def read_split(spark: SparkSession, path: str, split: str, fmt: str = "json") -> DataFrame:
    """SRC11: one split of stored feature rows; the other folders are not opened."""
    stored = spark.read.schema(f"{FEATURE_SCHEMA}, split string").format(fmt).load(path)
    return stored.where(F.col("split") == split)


def is_usable(name: Column, size: Column, min_bytes: int) -> Column:
    """STR7: a JSON file that holds more than a few bytes."""
    return (extension(name) == "json") & (size > min_bytes)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, name and length of the files below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", file_name(F.col("path")).alias("name"), "length")
    )


def usable_files(
    files: DataFrame, min_bytes: int = fixed.MIN_HOLDOUT_FILE_BYTES
) -> DataFrame:
    """SRC6: files that can serve as holdout input."""
    return files.where(is_usable(F.col("name"), F.col("length"), min_bytes))


def first_usable_file(files: DataFrame, min_bytes: int = fixed.MIN_HOLDOUT_FILE_BYTES) -> DataFrame:
    """SRC6: the usable file that comes first by name; no row where there is none."""
    return usable_files(files, min_bytes).orderBy("name", "path").limit(1)


def read_images(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC7: image bytes with their length; an unused `content` column is never loaded."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
    )


def small_enough(
    images: DataFrame,
    max_bytes: int = fixed.MAX_IMAGE_BYTES,
    limit: int | None = None,
    key: str = "path",
) -> DataFrame:
    """FLT4, LIM3: leave out images too large to score; `limit` keeps the first ones by key."""
    kept = images.where(F.col("length") <= max_bytes)
    return kept if limit is None else kept.orderBy(key).limit(limit)


def read_trials(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """SRC8: exported tuning trials."""
    reader = spark.read.schema(TRIAL_SCHEMA).format(fmt)
    if fmt == "json":
        reader = reader.option("allowNonNumericNumbers", True)
    return reader.load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SRC3: make a frame known to SQL text under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def preview(df: DataFrame, n: int = 5, *order: str) -> DataFrame:
    """SRC9, SRT1, SRT2: the first rows by time, week or any other order.

    Each task keeps its own first rows, so nothing is sorted as a whole. Without an order the rows
    are any.
    """
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def pretty_json(df: DataFrame) -> DataFrame:
    """SRC9: each row as indented JSON text."""
    return df.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("json"))
