"""REA2: a baseline quantile forecaster, so that forecasts can be made and measured without a
remote model.

For each kind of series and each step ahead, the change since the last context value is taken to be
normally distributed; mean and deviation come from training windows.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.arrays import let

#: From the closest fit to the widest.
LEVELS = ("kind", "instrument", "all")
NO_LEVEL = "none"


def _fit() -> tuple[Column, Column]:
    return F.avg("_d").alias("mu"), F.coalesce(F.stddev_samp("_d"), F.lit(0.0)).alias("sigma")


def fit_changes(windows: DataFrame, context_len: int) -> DataFrame:
    """Mean and deviation of the change by (column_id, instrument_id, step); steps count from 1.

    Sums combine before the shuffle, so only one row per kind, step and task moves.
    """
    return _changes(windows, context_len).groupBy("column_id", "instrument_id", "step").agg(*_fit())


def fit_levels(windows: DataFrame, context_len: int) -> DataFrame:
    """The fit of every kind, of every instrument, and of all series: level, column_id,
    instrument_id, step, mu, sigma. Ids are NULL where a level takes all of them together."""
    sets = [["column_id", "instrument_id", "step"], ["instrument_id", "step"], ["step"]]
    changes = _changes(windows, context_len)
    level = F.grouping_id("column_id", "instrument_id", "step")
    found = changes.groupingSets(sets, "column_id", "instrument_id", "step").agg(level.alias("_g"), *_fit())
    named = F.when(F.col("_g") == 0, LEVELS[0]).when(F.col("_g") == 4, LEVELS[1]).otherwise(LEVELS[2])
    return found.select(named.alias("level"), "column_id", "instrument_id", "step", "mu", "sigma")


def _changes(windows: DataFrame, context_len: int) -> DataFrame:
    """Change since the last context value by kind and step."""
    last = F.get("target", F.lit(context_len - 1))
    steps = windows.select(
        "column_id",
        "instrument_id",
        last.alias("_last"),
        F.posexplode(F.slice("target", context_len + 1, F.size("target"))).alias("_i", "_v"),
    )
    return steps.select(
        "column_id", "instrument_id", (F.col("_i") + 1).alias("step"), (F.col("_v") - F.col("_last")).alias("_d")
    )


def predict_quantiles(
    requests: DataFrame,
    fitted: DataFrame,
    quantiles: Sequence[str],
) -> DataFrame:
    """Requests with `quantiles`, a map from quantile text to one value per step.

    A kind that was never fitted gets no prediction. How the two are joined is left to Spark.
    """
    by_kind = fitted.groupBy("column_id", "instrument_id").agg(_steps().alias("_fit"))
    joined = requests.join(by_kind, ["column_id", "instrument_id"])
    return joined.withColumn("quantiles", _lines(quantiles)).drop("_fit")


def predict_with_backoff(requests: DataFrame, levels: DataFrame, quantiles: Sequence[str]) -> DataFrame:
    """Every request, with `level` and `quantiles`: from the fit of its kind, else of its instrument,
    else of all series. Where nothing was fitted the level is `none` and there are no quantiles."""
    of = lambda level, *ids: levels.where(F.col("level") == level).groupBy(*ids).agg(_steps().alias(f"_{level}"))
    joined = requests.join(of("kind", "column_id", "instrument_id"), ["column_id", "instrument_id"], "left")
    joined = joined.join(of("instrument", "instrument_id"), "instrument_id", "left")
    joined = joined.withColumn("_all", levels.where(F.col("level") == "all").agg(_steps()).scalar())
    # Where no series was fitted at all, that list is there and empty.
    joined = joined.withColumn("_all", F.when(F.size("_all") > 0, F.col("_all")))
    level = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), n) for n in LEVELS], F.lit(NO_LEVEL))
    chosen = joined.withColumn("_fit", F.coalesce(*[f"_{n}" for n in LEVELS]))
    predicted = F.when(F.col("_fit").isNotNull(), _lines(quantiles))
    return chosen.select(*requests.columns, level.alias("level"), predicted.alias("quantiles"))


def _steps() -> Column:
    return F.sort_array(F.collect_list(F.struct("step", "mu", "sigma")))


def _lines(quantiles: Sequence[str]) -> Column:
    """Map from quantile to values by step, from `_fit` and `context`."""
    lines = [part for q in quantiles for part in (F.lit(q), _line(NormalDist().inv_cdf(float(q))))]
    return F.create_map(*lines)


def _line(z: float) -> Column:
    """Values of one quantile, `z` deviations from the mean, step by step."""
    return let(
        F.element_at("context", -1),
        lambda last: F.transform("_fit", lambda f: last + f["mu"] + f["sigma"] * F.lit(z)),
    )
