"""Path text: tails, roots and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_FOLDER = "images"


def image_tail(path: Column) -> Column:
    """STR2: text after the last `images/`; a path without it is its own tail."""
    return F.element_at(F.split(path, f"{IMAGE_FOLDER}/"), -1)


def file_name(path: Column) -> Column:
    """STR2: text after the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def under_root(root: str, tail: Column) -> Column:
    """STR3: image path below a new root."""
    return F.concat_ws("/", F.lit(root), F.lit(IMAGE_FOLDER), tail)


def extension(name: Column) -> Column:
    """STR7: text after the last dot; a name without a dot is its own extension."""
    return F.element_at(F.split(name, r"\."), -1)


def instrument_of(path: Column) -> Column:
    """SRC2: instrument from a file or folder called `{instrument}_1m.csv`.

    A suffix after `_1m`, as in `{instrument}_1m_partial.csv`, is allowed. Spark gives paths with
    percent signs for what a URI may not hold; they are decoded, and a plus stays one.
    """
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(F.coalesce(plain, path), r"([^/=]+?)_1m(?:_[^/]*)?\.csv", 1)
