"""JOB4, JOB7: holdout rows to forecasts, and forecasts to a comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig
from tickloom.functions import fixed
from tickloom.functions.arrays import to_delta
from tickloom.functions.hashing import key_text
from tickloom.operators.baseline import fit_changes, fit_levels, predict_quantiles, predict_with_backoff
from tickloom.operators.forecasts import context_split, forecast_frame
from tickloom.operators.lookups import id_lookup
from tickloom.operators.outcomes import read_answers, request_outcomes
from tickloom.operators.series import long_series, weekly_series
from tickloom.operators.splits import Cutoffs, assign_split, bars_of_split, find_cutoffs
from tickloom.operators.windows import sample_windows
from tickloom.plans.features import build_features, listed_bars, scale_of
from tickloom.sources.files import FEATURE_SCHEMA, read_feature_rows
from tickloom.sources.lines import PLACE, placed_lines


def holdout_requests(bars: DataFrame, cfg: FeatureConfig, context_len: int) -> DataFrame:
    """Holdout windows with a request id, their context and their actual course."""
    rows = build_features(bars, cfg, splits=("holdout",))
    named = rows.withColumn(
        "request_id",
        key_text(cfg.seed, *[F.col(c) for c in ("instrument", "column", "week_key", "start_index")]),
    )
    kinds = named.withColumn("column_id", F.get("cat", F.lit(0))).withColumn(
        "instrument_id", F.get("cat", F.lit(1))
    )
    return context_split(kinds, context_len)


def with_request_id(rows: DataFrame) -> DataFrame:
    """Stored feature rows named by their ids and start, which together are unique."""
    return rows.withColumn(
        "request_id", F.concat_ws(":", F.col("cat").cast("array<string>"), F.col("start"))
    )


def stored_requests(
    spark: SparkSession,
    folder: str,
    context_len: int,
    limit: int | None = None,
) -> DataFrame:
    """SRC5, ARR3, LIM2: requests from all JSON files of a holdout folder, however short."""
    rows = with_request_id(read_feature_rows(spark, folder))
    return context_split(rows, context_len, limit=limit)


def placed_requests(spark: SparkSession, folder: str, context_len: int) -> DataFrame:
    """SRC5, SNK4: a request for every line of a holdout folder, with the line's place."""
    placed = placed_lines(spark, folder)
    rows = placed.withColumn("_r", F.from_json("value", FEATURE_SCHEMA)).select(*PLACE, "_r.*")
    return context_split(with_request_id(rows), context_len)


def series_requests(bars: DataFrame, cfg: FeatureConfig, context_len: int) -> DataFrame:
    """Whole holdout series as requests, however short: nothing is left out before it is asked for."""
    listed = listed_bars(bars, cfg)
    cfg = find_cutoffs(listed, cfg)
    cut = Cutoffs.of(listed, cfg)
    late = bars_of_split(listed, cut, "holdout", cfg.week_mode)
    series = assign_split(weekly_series(late, cfg.week_mode, cfg.columns), cut).where(F.col("split") == "holdout")
    long = long_series(series, cfg.columns, cfg.nulls).join(
        id_lookup(bars.sparkSession, cfg.instruments, "instrument"), "instrument"
    )
    target = F.col("values") if cfg.scale is None else to_delta(F.col("values"), scale_of(cfg))
    named = long.select(
        key_text(cfg.seed, *[F.col(c) for c in ("instrument", "column", "week_key")]).alias("request_id"),
        "column_id", "instrument_id", "instrument", "column", "week_key", target.alias("target"),
    )
    return context_split(named, context_len)


def answered_requests(
    requests: DataFrame, responses: DataFrame, context_len: int, fitted: DataFrame | None = None, key: str = "request_id"
) -> DataFrame:
    """JOB4: every request beside the forecast in the responses, or beside what became of it."""
    return request_outcomes(requests, read_answers(responses, key), context_len, fitted, key)


def backoff_forecasts(
    bars: DataFrame, cfg: FeatureConfig, context_len: int, quantiles: Sequence[str] = fixed.QUANTILES, only: Column | None = None
) -> DataFrame:
    """REA2: holdout requests with quantiles from the closest fit there is, and its level.

    `only` picks the training windows that are fitted; None takes all.
    """
    cfg = find_cutoffs(listed_bars(bars, cfg), cfg)
    windows = training_windows(bars, cfg)
    levels = fit_levels(windows if only is None else windows.where(only), context_len)
    return predict_with_backoff(holdout_requests(bars, cfg, context_len), levels, quantiles)


def training_windows(bars: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Windows sampled from the training weeks in the way test windows are."""
    listed = listed_bars(bars, cfg)
    cfg = find_cutoffs(listed, cfg)
    cut = Cutoffs.of(listed, cfg)
    early = bars_of_split(listed, cut, "train", cfg.week_mode)
    series = assign_split(weekly_series(early, cfg.week_mode, cfg.columns), cut)
    windows = sample_windows(series.where(F.col("split") == "train"), cfg)
    named = windows.join(id_lookup(bars.sparkSession, cfg.instruments, "instrument"), "instrument")
    if cfg.scale is None:
        return named
    return named.withColumn("target", to_delta(F.col("target"), scale_of(cfg)))


def baseline_forecasts(
    bars: DataFrame,
    cfg: FeatureConfig,
    context_len: int,
    quantiles: Sequence[str] = fixed.QUANTILES,
) -> DataFrame:
    """REA2: holdout requests with predicted quantiles."""
    cfg = find_cutoffs(listed_bars(bars, cfg), cfg)
    fitted = fit_changes(training_windows(bars, cfg), context_len)
    return predict_quantiles(holdout_requests(bars, cfg, context_len), fitted, quantiles)


def compare_forecasts(
    holdout: DataFrame, predictions: DataFrame, context_len: int, key: str = "request_id"
) -> DataFrame:
    """JOB4: holdout rows and stored predictions to the long comparison frame."""
    return forecast_frame(context_split(holdout, context_len, key), predictions, key)
