"""Tuning trials: valid ones, best one, counts, parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OBJECTIVE = "FinalObjectiveValue"


def valid_trials(trials: DataFrame) -> DataFrame:
    """FLT6: trials that reported an objective. NaN and minus infinity are no objective."""
    value = F.col(OBJECTIVE)
    return trials.where(~F.isnan(value) & (value > F.lit(float("-inf"))))


def sort_trials(trials: DataFrame, minimize: bool) -> DataFrame:
    """SRT5: best first; equal objectives by name."""
    value = F.col(OBJECTIVE)
    return trials.orderBy(value.asc() if minimize else value.desc(), "TrainingJobName")


def objective_range(valid: DataFrame) -> DataFrame:
    """AGG8: one row with the number of valid trials, lowest and highest objective."""
    return valid.agg(
        F.count(F.lit(1)).alias("n_valid"),
        F.min(OBJECTIVE).alias("lowest"),
        F.max(OBJECTIVE).alias("highest"),
    )


def best_trial(valid: DataFrame, minimize: bool) -> DataFrame:
    """AGG9: the best trial, first by name among equals; no row where no trial is valid.

    A plain aggregate, so nothing is sorted and one row per task moves.
    """
    value = F.col(OBJECTIVE)
    order = F.struct((value if minimize else -value).alias("o"), "TrainingJobName")
    best: Column = F.min_by(F.struct("*"), order)
    return valid.agg(best.alias("_b")).where(F.col("_b").isNotNull()).select("_b.*")


def status_counts(trials: DataFrame) -> DataFrame:
    """AGG7: trials by status."""
    return trials.groupBy("TrainingJobStatus").agg(F.count(F.lit(1)).alias("n"))


def completed_count(trials: DataFrame) -> DataFrame:
    """AGG7: completed trials, and whether all are."""
    done = F.count_if(F.col("TrainingJobStatus") == "Completed")
    return trials.agg(done.alias("n_completed"), (done == F.count(F.lit(1))).alias("all_completed"))


def trial_params(trials: DataFrame) -> DataFrame:
    """MAP2: one row per trial and tuned parameter."""
    return trials.select("TrainingJobName", F.explode("params").alias("param", "value"))


def params_as_columns(trials: DataFrame, names: list[str]) -> DataFrame:
    """MAP2: the named parameters as columns; a parameter a trial lacks is NULL."""
    return trials.select("*", *[F.col("params").getItem(n).alias(n) for n in names]).drop("params")
