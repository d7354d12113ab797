"""Detections: threshold, pixel boxes, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.boxes import to_pixel
from tickloom.operators.lookups import id_lookup


def detection_boxes(
    scored: DataFrame, threshold: float = fixed.SCORE_THRESHOLD, *keys: str
) -> DataFrame:
    """FLT5, GEN4, MTH3, MTH4: one row per detection at or above the threshold, in pixels.

    `scored` has `detections`, an array of (class_id, score, x0, y0, x1, y1), and the image's
    `width` and `height`. `det_index` is the position in that array.
    """
    rows = scored.select(
        *keys,
        F.col("width").alias("_w"),
        F.col("height").alias("_h"),
        F.posexplode("detections").alias("det_index", "_d"),
    ).where(F.col("_d.score") >= threshold)
    corners = rows.select(
        *keys,
        "det_index",
        F.col("_d.class_id").cast("int").alias("class_id"),
        F.col("_d.score").alias("score"),
        to_pixel(F.col("_d.x0"), F.col("_w")).alias("xmin"),
        to_pixel(F.col("_d.y0"), F.col("_h")).alias("ymin"),
        to_pixel(F.col("_d.x1"), F.col("_w")).alias("xmax"),
        to_pixel(F.col("_d.y1"), F.col("_h")).alias("ymax"),
    )
    return corners.withColumn("width", F.col("xmax") - F.col("xmin")).withColumn(
        "height", F.col("ymax") - F.col("ymin")
    )


def above(detections: Column, threshold: float) -> Column:
    """FLT5 on the array itself, for frames that keep one row per image."""
    return F.filter(detections, lambda d: d["score"] >= threshold)


def detection_label(class_name: Column, score: Column) -> Column:
    """STR6: class and score as drawn beside a box."""
    return F.format_string("%s %.3f", class_name, score)


def with_labels(boxes: DataFrame, classes: Sequence[str] | DataFrame = fixed.CLASSES) -> DataFrame:
    """JOI4, STR6: class name and label; a class without a name is shown by its id.

    `classes` is a list, or a frame (`class_id`, `class`) whose join strategy is left to Spark.
    """
    if not isinstance(classes, DataFrame):
        classes = id_lookup(boxes.sparkSession, classes, "class")
    named = boxes.join(classes, "class_id", "left").withColumn(
        "class_name", F.coalesce("class", F.col("class_id").cast("string"))
    )
    return named.drop("class").withColumn(
        "label", detection_label(F.col("class_name"), F.col("score"))
    )
