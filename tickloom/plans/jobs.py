"""Whole jobs from folder to folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig
from tickloom.functions import fixed
from tickloom.operators.ordering import split_counts
from tickloom.operators.scoring import Scorer, batch_score
from tickloom.plans.features import ROW_KEY, build_features
from tickloom.plans.forecasting import placed_requests
from tickloom.plans.manifest import split_manifest
from tickloom.sinks.write import write_aligned, write_features, write_split
from tickloom.sources.bars import BAD_COLUMNS, BAD_NUMBER, BAD_TIME, bad_rows, good_rows, judged, read_bar_files
from tickloom.sources.files import read_lines
from tickloom.sources.lines import PLACE


@dataclass(frozen=True)
class RowCounts:
    """Rows of the bar files: all, those that became bars, and the rejected ones by reason."""

    read: int
    kept: int
    rejected: dict[str, int]


def feature_job(
    spark: SparkSession,
    bar_paths: str | Sequence[str],
    out: str,
    cfg: FeatureConfig,
    fmt: str = "json",
    rejected: str | None = None,
) -> RowCounts:
    """JOB1: bar files of all instruments to the folders split=train, split=test, split=holdout.

    Rows that are no bars go to a folder of their own, `rejected` (beside `out` if not named), with
    instrument, reason, time and line; they are counted in the pass that writes them. Rows kept and
    rejected are the rows read.
    """
    rows = judged(read_bar_files(spark, bar_paths, keep_corrupt=True))
    seen = Observation("bar rows")
    reasons = (BAD_TIME, BAD_NUMBER, BAD_COLUMNS)
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in reasons]
    observed = rows.observe(seen, F.count(F.lit(1)).alias("read"), *counts)
    bad_rows(observed).write.mode("overwrite").json(rejected or f"{out.rstrip('/')}-rejected")
    found = seen.get
    by_reason = {r: found[r] for r in reasons}
    features = build_features(good_rows(rows), cfg)
    write_features(features, out, ROW_KEY, cfg.seed, fmt=fmt, all_splits=True)
    return RowCounts(found["read"], found["read"] - sum(by_reason.values()), by_reason)


def manifest_job(
    spark: SparkSession,
    manifest: str,
    root: str,
    out: str,
    fraction: float = fixed.TRAIN_FRACTION,
    seed: int = 42,
) -> DataFrame:
    """JOB3: one manifest to a training and a validation manifest; gives the lines of each."""
    write_split(split_manifest(read_lines(spark, manifest), root, fraction, seed), out, seed=seed, all_splits=True)
    written = spark.read.schema("value string, split string").text(out)
    return split_counts(written)


def score_job(
    spark: SparkSession,
    holdout: str,
    out: str,
    load_scorer: Callable[[], Scorer],
    schema: str,
    context_len: int,
) -> None:
    """JOB7: all rows of a holdout folder to predictions that carry their request id, line by line in
    the order of their input files. A line that is no feature row has an empty answer."""
    requests = placed_requests(spark, holdout, context_len)
    usable = F.size("context") > 0
    write_aligned(batch_score(requests, load_scorer, schema, PLACE, usable), out)
