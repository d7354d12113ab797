"""Forecast requests, responses and the comparison with what happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import fixed
from tickloom.functions.arrays import prefix
from tickloom.functions.hashing import row_hash
from tickloom.operators.ordering import hash_rank

RESPONSE_SCHEMA = "predictions array<struct<quantiles:map<string,array<double>>>>"


def context_split(
    holdout: DataFrame, context_len: int, key: str = "request_id", limit: int | None = None
) -> DataFrame:
    """ARR3, LIM2: the first values as context, the full target as the actual course.

    `limit` keeps the first requests by key; None keeps all.
    """
    rows = holdout.withColumn("actual", F.col("target")).withColumn(
        "context", prefix(F.col("target"), context_len)
    )
    return rows if limit is None else rows.orderBy(key).limit(limit)


def request_payloads(
    requests: DataFrame,
    key: str = "request_id",
    quantiles: Sequence[str] = fixed.QUANTILES,
    num_samples: int = fixed.NUM_SAMPLES,
    batch_size: int = fixed.MAX_REQUESTS,
    seed: int = 42,
    digits: int | None = 2,
) -> DataFrame:
    """JSN1: one JSON body per batch of requests: bucket, batch, request_ids, body.

    Every request is in exactly one batch of at most `batch_size`, so a body stays small however
    many requests there are. Requests are dealt by the first `digits` hex digits of a seeded hash of
    their key into buckets, numbered there in the order of the hash and cut into batches: one
    shuffle. Only the last batch of a bucket may be shorter. Without `digits` all requests are
    numbered in one order, so that only the very last batch may be shorter; the bucket is empty.
    """
    if digits is None:
        ranked = hash_rank(requests, [key], seed).withColumn("bucket", F.lit(""))
    else:
        hashed = requests.withColumn("_h", row_hash(seed, F.col(key))).withColumn("bucket", F.substring("_h", 1, digits))
        number = F.row_number().over(Window.partitionBy("bucket").orderBy("_h", key))
        ranked = hashed.withColumn("rank", number)
    instance = F.struct("cat", "start", F.col("context").alias("target"))
    batches = (
        ranked.withColumn("batch", F.floor((F.col("rank") - 1) / batch_size))
        .groupBy("bucket", "batch")
        .agg(F.sort_array(F.collect_list(F.struct("rank", key, instance.alias("instance")))).alias("_r"))
    )
    configuration = F.struct(
        F.lit(num_samples).alias("num_samples"),
        F.array(F.lit("quantiles")).alias("output_types"),
        F.array(*[F.lit(q) for q in quantiles]).alias("quantiles"),
    )
    body = F.to_json(
        F.struct(
            F.col("_r").getField("instance").alias("instances"),
            configuration.alias("configuration"),
        )
    )
    return batches.select("bucket", "batch", F.col("_r").getField(key).alias("request_ids"), body.alias("body"))


def parse_responses(responses: DataFrame, key: str = "request_id") -> DataFrame:
    """JSN2: one row per prediction, paired with its request by position in the batch."""
    parsed = F.from_json("body", RESPONSE_SCHEMA)["predictions"]
    return responses.select(
        "request_ids", F.posexplode(parsed).alias("_i", "_p")
    ).select(
        F.get("request_ids", F.col("_i")).alias(key), F.col("_p.quantiles").alias("quantiles")
    )


def with_predictions(
    requests: DataFrame, predictions: DataFrame | None, key: str = "request_id", how: str = "inner"
) -> DataFrame:
    """JOI1: key, context length, actual course and quantiles of each request, paired by key.

    `how` is "left" where requests without a prediction are to stay, with no quantiles.

    Whole rows are paired, before any step is spread out. Requests that were scored in place hold
    their quantiles already and need no join.
    """
    if predictions is None:
        return requests.select(key, "actual", F.size("context").alias("context_len"), "quantiles")
    return requests.select(key, "actual", F.size("context").alias("context_len")).join(
        predictions.select(key, "quantiles"), key, how
    )


def forecast_frame(
    requests: DataFrame, predictions: DataFrame | None = None, key: str = "request_id"
) -> DataFrame:
    """GEN5, MAP1, ARR5, STR8: one row per request, line and step.

    Columns: key, series, position, value. Lines are the quantiles, placed after the context, and
    the actual course from position 0.
    """
    lined = with_predictions(requests, predictions, key)
    quantile_lines = F.transform(
        F.map_entries("quantiles"),
        lambda e: F.struct(
            F.concat(e["key"], F.lit(" quantile")).alias("series"),
            F.col("context_len").alias("offset"),
            e["value"].alias("values"),
        ),
    )
    actual_line = F.array(
        F.struct(
            F.lit("actual").alias("series"), F.lit(0).alias("offset"), F.col("actual").alias("values")
        )
    )
    lines = lined.select(key, F.inline(F.concat(quantile_lines, actual_line)))
    return lines.select(key, "series", "offset", F.posexplode("values").alias("_i", "value")).select(
        key, "series", (F.col("offset") + F.col("_i")).alias("position"), "value"
    )
