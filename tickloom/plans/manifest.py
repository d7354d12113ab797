"""JOB3: manifest lines to a training and a validation manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.operators.manifests import rewrite_lines
from tickloom.operators.ordering import exact_split


def split_manifest(
    lines: DataFrame, root: str, fraction: float = fixed.TRAIN_FRACTION, seed: int = 42
) -> DataFrame:
    """Lines with moved image paths, dealt exactly `fraction` to training."""
    return exact_split(rewrite_lines(lines, root), ["source_ref"], fraction, seed)


def manifest_path(root: str, label: str, kind: str) -> str:
    """STR4: where a labelling job keeps its manifests."""
    return fixed.MANIFEST_PATH.format(root=root, label=label, kind=kind)


def manifest_counts(split: DataFrame) -> DataFrame:
    """AGG6: records in all, in training and in validation."""
    return split.agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "validation").alias("n_validation"),
    )
