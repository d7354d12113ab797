"""JOB5: truth boxes and detections of the same image side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.boxes import to_pixel
from tickloom.operators.detections import above, detection_label
from tickloom.operators.manifests import int_boxes


def overlay_labelled(
    manifest: DataFrame,
    detections: DataFrame,
    threshold: float = fixed.SCORE_THRESHOLD,
    classes: Sequence[str] = fixed.CLASSES,
    key: str = "image_id",
    limit: int | None = None,
) -> DataFrame:
    """JOB5: what an image is to show: `boxes`, its truth boxes, and `found`, its detections in pixels
    with class name and label. NULL where the image has none of them.

    A class without a name is shown by its id. `det_index` is the place among all detections.
    """
    names = F.array(*[F.lit(c) for c in classes]).cast("array<string>")

    def drawn(d: Column, i: Column) -> Column:
        name = F.coalesce(F.get(names, F.when(d["class_id"] >= 0, d["class_id"])), d["class_id"].cast("string"))
        corners = {
            c: to_pixel(d[f], F.col(size))
            for c, f, size in (("xmin", "x0", "width"), ("ymin", "y0", "height"), ("xmax", "x1", "width"), ("ymax", "y1", "height"))
        }
        return F.struct(
            i.alias("det_index"),
            d["class_id"].alias("class_id"),
            name.alias("class_name"),
            d["score"].alias("score"),
            detection_label(name, d["score"]).alias("label"),
            *[c.alias(n) for n, c in corners.items()],
            (corners["xmax"] - corners["xmin"]).alias("width"),
            (corners["ymax"] - corners["ymin"]).alias("height"),
        )

    numbered = F.transform("detections", lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    reached = F.filter(numbered, lambda n: n["d"]["score"] >= threshold)
    found = F.transform(reached, lambda n: drawn(n["d"], n["i"]))
    if limit is not None:
        manifest = manifest.orderBy(key).limit(limit)
    truth = manifest.select(key, int_boxes(F.col("annotations")).alias("boxes"))
    return truth.join(detections.select(key, found.alias("found")), key, "left")


def overlay_detections(
    manifest: DataFrame,
    detections: DataFrame,
    threshold: float = fixed.SCORE_THRESHOLD,
    key: str = "image_id",
    limit: int | None = None,
) -> DataFrame:
    """JOI2, LIM3: each record with its boxes and with the detections of that same image.

    `manifest` has the key and `annotations`; `detections` the key, `width`, `height` and
    `detections`. Records keep their place whether or not they have boxes or detections.
    `limit` keeps the first images by key; None keeps all.
    """
    if limit is not None:
        manifest = manifest.orderBy(key).limit(limit)
    truth = manifest.select(key, int_boxes(F.col("annotations")).alias("boxes"))
    kept = detections.select(
        key, "width", "height", above(F.col("detections"), threshold).alias("detections")
    )
    return truth.join(kept, key, "left")
