"""JOB6: report on tuning trials."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickloom.operators.trials import objective_range, sort_trials, valid_trials


def trial_report(trials: DataFrame, minimize: bool = True) -> DataFrame:
    """Valid trials, best first, each with the count and range of all valid ones."""
    valid = valid_trials(trials)
    span = objective_range(valid)
    for name in ("n_valid", "lowest", "highest"):
        valid = valid.withColumn(name, span.select(name).scalar())
    return sort_trials(valid, minimize)
