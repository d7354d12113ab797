"""Box arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_pixel(corner: Column, size: Column) -> Column:
    """MTH3: normalised corner to pixel, cut towards zero."""
    return (corner * size).cast("int")


def bit_length(n: Column) -> Column:
    """floor(log2(n)) of a positive integer, exact at powers of two."""
    return F.length(F.bin(n)) - 1


def overlap(start_a: Column, size_a: Column, start_b: Column, size_b: Column) -> Column:
    """Length shared by two intervals, zero when they are apart."""
    shared = F.least(start_a + size_a, start_b + size_b) - F.greatest(start_a, start_b)
    return F.greatest(shared, F.lit(0))


def iou(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Intersection over union of two boxes given as left, top, width, height."""
    inter = overlap(a["left"], a["width"], b["left"], b["width"]).cast("double") * overlap(
        a["top"], a["height"], b["top"], b["height"]
    )
    area_a = a["width"].cast("double") * a["height"]
    area_b = b["width"].cast("double") * b["height"]
    return inter / (area_a + area_b - inter)
