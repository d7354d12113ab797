"""Fixed-length windows sampled from weekly series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig
from tickloom.functions.arrays import candidate_starts
from tickloom.functions.hashing import key_text
from tickloom.functions.timekeys import plus_steps
from tickloom.operators.series import long_series


def sample_starts(
    n: Column, key: Column, length: int, n_tests: int, include_last: bool = False
) -> Column:
    """GEN1: `n_tests` distinct start positions in hash order, or all where there are fewer."""
    ranked = F.transform(
        candidate_starts(n, length, include_last),
        lambda i: F.struct(F.md5(F.concat_ws(":", key, i.cast("string"))).alias("h"), i.alias("i")),
    )
    return F.slice(F.sort_array(ranked), 1, n_tests).getField("i")


def windows_of(cfg: FeatureConfig) -> Column:
    """GEN1, ARR2, DAT8: array of (start_index, start_ts, target) of a row of `long_series`.

    Windows are cut inside one expression, so the rows it is spread into carry a window each and
    never the whole series.
    """
    key = key_text(cfg.seed, F.col("instrument"), F.col("column"), F.col("week_key"))
    n = F.size("values")

    def start_of(s: Column) -> Column:
        if cfg.window_start == "fixed_step":
            return plus_steps(F.col("ts_start"), s, cfg.step_seconds)
        return F.get("times", s)

    return F.transform(
        sample_starts(n, key, cfg.length, cfg.n_tests, cfg.include_last_window),
        lambda s: F.struct(
            s.alias("start_index"),
            start_of(s).alias("start_ts"),
            F.slice("values", s + 1, cfg.length).alias("target"),
        ),
    )


def sample_windows(series: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """GEN1, GEN2: one row per sampled window of every series and value column."""
    return long_series(series, cfg.columns, cfg.nulls).select(
        "instrument", "week_key", "column_id", "column", F.inline(windows_of(cfg))
    )


def too_short(index: DataFrame, length: int, include_last: bool = False) -> DataFrame:
    """Series that yield no window, so that they can be counted instead of lost silently."""
    needed = length if include_last else length + 1
    return index.where(F.col("n_points") < needed)
