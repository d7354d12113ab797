"""REA1: weighted quantile loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.forecasts import with_predictions


def weighted_quantile_loss(
    requests: DataFrame,
    predictions: DataFrame | None = None,
    key: str = "request_id",
    quantiles: Sequence[str] | None = None,
    by: str | None = None,
) -> DataFrame:
    """One row per quantile: wql, mean_wql over the quantiles, n_steps and n_uncovered.

    The loss of quantile t is 2 * sum(t * max(z - q, 0) + (1 - t) * max(q - z, 0)) / sum(|z|) over
    the covered steps, z being what happened and q what was predicted. n_steps counts all steps
    that happened, n_uncovered those of them without a prediction, which the loss cannot see; it is
    NULL where nothing is covered. `quantiles` lists what was to be predicted: then steps of
    requests without any prediction count as well, otherwise only quantiles that occur do. `by`
    names a column of the requests, such as the level of the fit, to measure apart.
    """
    lined = with_predictions(requests.select("*"), predictions, key, "left")
    groups = [] if by is None else [by]
    if by is not None:
        lined = lined.join(requests.select(key, by), key) if predictions is not None else requests.select(
            "actual", F.size("context").alias("context_len"), "quantiles", by
        )
    ahead = F.slice("actual", F.col("context_len") + 1, F.size("actual"))
    wanted = (
        F.map_keys("quantiles") if quantiles is None else F.array(*[F.lit(q) for q in quantiles])
    )
    by_quantile = lined.select(*groups, ahead.alias("_z"), "quantiles", F.explode(wanted).alias("quantile"))
    values = F.try_element_at("quantiles", F.col("quantile"))
    none = F.array().cast("array<double>")
    steps = by_quantile.select(
        *groups, "quantile", F.inline(F.arrays_zip(F.col("_z"), F.coalesce(values, none).alias("_q")))
    ).where(F.col("_z").isNotNull())
    level = F.col("quantile").cast("double")
    miss = level * F.greatest(F.col("_z") - F.col("_q"), F.lit(0.0)) + (1 - level) * F.greatest(
        F.col("_q") - F.col("_z"), F.lit(0.0)
    )
    covered = F.col("_q").isNotNull()
    losses = (
        steps.groupBy(*groups, "quantile")
        .agg(
            F.sum(F.when(covered, miss)).alias("_miss"),
            F.sum(F.when(covered, F.abs("_z"))).alias("_size"),
            F.count(F.lit(1)).alias("n_steps"),
            F.count_if(~covered).alias("n_uncovered"),
        )
        .select(*groups, "quantile", F.try_divide(2 * F.col("_miss"), F.col("_size")).alias("wql"), "n_steps", "n_uncovered")
    )
    # One row per quantile and group is left here, a handful.
    return losses.withColumn("mean_wql", F.avg("wql").over(Window.partitionBy(*groups)))
