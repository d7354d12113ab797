"""JOB1, JOB2: bars to train, test and holdout rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig
from tickloom.functions.arrays import to_delta
from tickloom.functions.timekeys import start_text
from tickloom.operators.lookups import id_lookup
from tickloom.operators.series import long_series, weekly_series
from tickloom.operators.splits import (
    SPLITS,
    Cutoffs,
    assign_split,
    bars_of_split,
    find_cutoffs,
)
from tickloom.operators.windows import windows_of

ROW_KEY = ("split", "instrument", "column", "week_key", "start_index")


def build_features(
    bars: DataFrame, cfg: FeatureConfig, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """PRJ3, PRJ4: feature rows of every instrument and column, with their split.

    Columns: split, instrument, column, week_key, start_index, cat, start, target. One pass: the
    bars are shuffled once into weekly series; training series and sampled windows both come from
    that one frame. Asking for a single split looks up the dates first and reads only its weeks.
    """
    wanted = listed_bars(bars, cfg)
    if len(splits) == 1:
        cfg = find_cutoffs(wanted, cfg)
        cut = Cutoffs.of(wanted, cfg)
        wanted = bars_of_split(wanted, cut, splits[0], cfg.week_mode)
    else:
        cut = Cutoffs.of(wanted, cfg)
    series = assign_split(weekly_series(wanted, cfg.week_mode, cfg.columns), cut)
    series = series.where(F.col("split").isin(list(splits)))
    if cfg.series_limit is not None:
        series = _oldest_per_split(series, cfg.series_limit)

    long = long_series(series, cfg.columns, cfg.nulls)
    whole = F.array(
        F.struct(
            F.lit(0).alias("start_index"),
            F.col("ts_start").alias("start_ts"),
            F.col("values").alias("target"),
        )
    )
    cut_out = F.when(F.col("split") == "train", whole).otherwise(windows_of(cfg))
    rows = long.select("split", "instrument", "week_key", "column_id", "column", F.inline(cut_out))
    named = rows.join(id_lookup(bars.sparkSession, cfg.instruments, "instrument"), "instrument")
    return named.select(
        *ROW_KEY,
        F.array("column_id", "instrument_id").alias("cat"),
        start_text(F.col("start_ts")).alias("start"),
        _scaled(F.col("target"), cfg).alias("target"),
    )


def listed_bars(bars: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Bars of the instruments the config lists."""
    return bars.where(F.col("instrument").isin(list(cfg.instruments)))


def scale_of(cfg: FeatureConfig) -> Column:
    """MTH2: multiplier of a row by its instrument and column."""
    factor = F.lit(float(cfg.scale))
    # The more specific pair is tested last, so it ends up outermost and wins.
    for key, value in sorted(cfg.scale_overrides.items(), key=lambda kv: isinstance(kv[0], tuple)):
        hit = (
            (F.col("column") == key[0]) & (F.col("instrument") == key[1])
            if isinstance(key, tuple)
            else F.col("instrument") == key
        )
        factor = F.when(hit, F.lit(float(value))).otherwise(factor)
    return factor


def _scaled(target: Column, cfg: FeatureConfig) -> Column:
    return target if cfg.scale is None else to_delta(target, scale_of(cfg))


def _oldest_per_split(series: DataFrame, limit: int) -> DataFrame:
    """LIM1 within each split; Spark keeps only `limit` rows per task before the shuffle."""
    age = Window.partitionBy("split", "instrument").orderBy("ts_start", "week_key")
    return (
        series.withColumn("_age", F.row_number().over(age))
        .where(F.col("_age") <= limit)
        .drop("_age")
    )


def walk_through_config(instrument: str, **changes) -> FeatureConfig:
    """JOB2: one instrument, raw closing prices, calendar-year weeks, all series."""
    settings = {
        "instruments": (instrument,),
        "columns": ("close",),
        "scale": None,
        "week_mode": "year_major",
        "window_start": "fixed_step",
        "holdout_weeks": 7,
        "test_weeks": 8,
        "n_tests": 5,
        "length": 60,
    }
    return FeatureConfig(**{**settings, **changes})


def model_rows(features: DataFrame) -> DataFrame:
    """The columns the model reads, beside the split they are stored under."""
    return features.select("split", "cat", "start", "target")


