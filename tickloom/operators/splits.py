"""Cut-off dates and the train / test / holdout periods."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig, FixedCutoffs
from tickloom.functions.timekeys import day_start, minus_weeks, week_start
from tickloom.operators.series import weekly_index

SPLITS = ("train", "test", "holdout")


def cutoff_frame(index: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """AGG5, DAT6, DAT7, DAT9: one row with the dates that separate the periods.

    All dates are cut to midnight. The newest week starts where the holdout ends, so it belongs to
    no period unless `include_last_week` moves the end by a day.
    """
    if cfg.cutoff_from is not None:
        index = index.where(F.col("instrument") == cfg.cutoff_from)
    newest = index.agg(F.max("ts_start").alias("max_date"), F.min("ts_start").alias("min_date"))
    holdout_start = minus_weeks(F.col("max_date"), cfg.holdout_weeks - 1)
    test_start = minus_weeks(holdout_start, cfg.test_weeks)
    holdout_end = day_start(F.col("max_date"))
    if cfg.include_last_week:
        holdout_end = holdout_end + F.make_dt_interval(F.lit(1))
    return newest.select(
        "min_date",
        "max_date",
        day_start(test_start).alias("test_start"),
        day_start(holdout_start).alias("holdout_start"),
        holdout_end.alias("holdout_end"),
    )


@dataclass(frozen=True)
class Cutoffs:
    """The three dates as columns any plan over the same session can use."""

    test_start: Column
    holdout_start: Column
    holdout_end: Column

    @staticmethod
    def of(bars: DataFrame, cfg: FeatureConfig) -> Cutoffs:
        """JOI5, SRC10: dates as scalar subqueries, or as literals where the config gives them.

        A scalar subquery reaches every row without a join and without a trip to the driver.
        """
        if cfg.cutoffs is not None:
            given = cfg.cutoffs
            return Cutoffs(
                *[
                    F.lit(str(d)).cast("timestamp_ntz")
                    for d in (given.test_start, given.holdout_start, given.holdout_end)
                ]
            )
        frame = cutoff_frame(weekly_index(bars, cfg.week_mode), cfg)
        return Cutoffs(
            *[
                frame.select(name).scalar()
                for name in ("test_start", "holdout_start", "holdout_end")
            ]
        )

    def bounds(self, split: str) -> tuple[Column | None, Column]:
        """FLT1, FLT2: half-open range of series starts in a period."""
        return {
            "train": (None, self.test_start),
            "test": (self.test_start, self.holdout_start),
            "holdout": (self.holdout_start, self.holdout_end),
        }[split]

    def split_of(self, ts_start: Column) -> Column:
        """Period of a series; NULL from the end of the holdout on."""
        return (
            F.when(ts_start < self.test_start, "train")
            .when(ts_start < self.holdout_start, "test")
            .when(ts_start < self.holdout_end, "holdout")
        )


def find_cutoffs(bars: DataFrame, cfg: FeatureConfig) -> FeatureConfig:
    """SRC10: the config with its split dates filled in, from one summary row.

    Worth its own small job where several plans use the dates, or where a plan reads only some
    weeks: dates known beforehand prune partitions and row groups of the scan. Without any bars
    the config stays as it is.
    """
    if cfg.cutoffs is not None:
        return cfg
    row = cutoff_frame(weekly_index(bars, cfg.week_mode), cfg).first()
    if row["max_date"] is None:
        return cfg
    found = FixedCutoffs(row["test_start"], row["holdout_start"], row["holdout_end"])
    return replace(cfg, cutoffs=found)


def assign_split(series: DataFrame, cut: Cutoffs) -> DataFrame:
    """Add the period of each series."""
    return series.withColumn("split", cut.split_of(F.col("ts_start")))


def bars_of_split(bars: DataFrame, cut: Cutoffs, split: str, mode: str = "iso") -> DataFrame:
    """Bars of the whole weeks a period touches, filtered on the bar time itself.

    Whole ISO weeks pass or fail together, so no series loses its first bars. The other week keys
    merge days of different years and must read everything.
    """
    if mode != "iso":
        return bars
    begin, end = cut.bounds(split)
    kept = bars.where(F.col("ts") < week_start(end) + F.make_dt_interval(F.lit(7)))
    return kept if begin is None else kept.where(F.col("ts") >= week_start(begin))
