"""Label manifests: paths, attributes, boxes and their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.jsontext import is_plain, plain_value_text, value_spans, value_text, with_plain_value, with_values
from tickloom.functions.paths import image_tail, under_root

BOX_FIELDS = ("left", "top", "width", "height")


def relocate(path: Column, root: str) -> Column:
    """STR2, STR3: the same image below another root."""
    return F.when(path.isNotNull(), under_root(root, image_tail(path)))


def rewrite_lines(lines: DataFrame, root: str) -> DataFrame:
    """SRC4, JSN3: JSON lines with the image path moved to a new root.

    Only the path is replaced in the text, so keys this job knows nothing about stay as they were
    written: long numbers, number formats, repeated keys, spaces. Adds `source_ref`, which is NULL
    for a line that is no JSON object or has no path; such a line stays as it is. Of a path given
    twice the last counts, and both are replaced.
    """
    line, key = F.col("line"), "source-ref"
    spotted = lines.withColumn("_plain", is_plain(line, key)).withColumn("_spans", F.when(~F.col("_plain"), value_spans(line, key)))
    path = F.when(F.col("_plain"), plain_value_text(line, key)).otherwise(value_text(line, F.col("_spans")))
    named = spotted.withColumn("source_ref", relocate(path, root))
    moved = F.when(F.col("_plain"), with_plain_value(line, key, F.col("source_ref"))).otherwise(
        with_values(line, F.col("_spans"), F.col("source_ref"))
    )
    return named.withColumn("line", moved).drop("_spans", "_plain")


def attributes(manifest: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ5: only the named attributes."""
    return manifest.select(*[F.col(f"`{n}`") for n in names])


def annotated(manifest: DataFrame, label: str) -> DataFrame:
    """FLT3: records that carry annotations; an empty list counts, a missing one does not."""
    return manifest.where(F.col(f"`{label}`.annotations").isNotNull())


def int_boxes(annotations: Column) -> Column:
    """ARR6, MTH6: list of (left, top, width, height) in whole pixels."""
    return F.transform(
        annotations,
        lambda a: F.struct(*[a[f].cast("int").alias(f) for f in BOX_FIELDS]),
    )


def explode_boxes(
    manifest: DataFrame, annotations: Column, *keys: str, fields: Sequence[str] = BOX_FIELDS
) -> DataFrame:
    """GEN3: one row per box with its position; a record without boxes keeps one empty row.

    `fields` names what is taken of a box, in whole numbers; `class_id` may be among them.
    """
    return manifest.select(
        *keys, F.posexplode_outer(annotations).alias("box_index", "_a")
    ).select(*keys, "box_index", *[F.col(f"_a.{f}").cast("int").alias(f) for f in fields])


def attach_files(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """JOI6: each record with the length of its file, NULL where the file is missing."""
    return manifest.join(files, key, "left")


def missing_files(manifest: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """JOI6: records whose file is missing."""
    return manifest.join(files, key, "left_anti")
