"""What became of every forecast request: each has exactly one outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.forecasts import RESPONSE_SCHEMA

#: In the order in which one is chosen where several would do.
TOO_SHORT = "too short"
ANSWERED = "answered"
NEVER_FITTED = "never fitted"
ANSWER_MISSING = "answer missing"
BAD_BODY = "bad body"
NEVER_SENT = "never sent"
NOT_ASKED = "not asked"

_CORRUPT = "_corrupt_record"


def read_answers(responses: DataFrame, key: str = "request_id") -> DataFrame:
    """JSN2: one row per request of a response: key, outcome, quantiles.

    `responses` has request_ids and body. A body that is no JSON, or not of the agreed shape, is a
    bad body for all its requests. A prediction that is not there, or has no value for some
    quantile, or no quantile at all, is a missing answer. Predictions beyond the requests have no
    key and the outcome `not asked`.
    """
    parsed = F.from_json("body", f"{RESPONSE_SCHEMA}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT})
    read = responses.select("request_ids", parsed.alias("_b"))
    bad = F.col("_b").isNull() | F.col(f"_b.{_CORRUPT}").isNotNull() | F.col("_b.predictions").isNull()
    none = F.array().cast("array<struct<quantiles: map<string, array<double>>>>")
    found = F.when(bad, none).otherwise(F.col("_b.predictions"))
    ids = F.coalesce("request_ids", F.array().cast("array<string>"))
    # Pairs by position, the longer side with nulls beside it.
    both = F.arrays_zip(ids.alias("id"), found.alias("p"))
    rows = read.select(bad.alias("_bad"), F.size(ids).alias("_n"), F.posexplode(both).alias("_i", "_r"))
    quantiles = F.col("_r").getField("p").getField("quantiles")
    usable = F.coalesce(
        (F.size(quantiles) > 0) & F.forall(F.map_values(quantiles), lambda v: v.isNotNull() & (F.size(v) > 0)), F.lit(False)
    )
    outcome = (
        F.when(F.col("_i") >= F.col("_n"), NOT_ASKED)
        .when(F.col("_bad"), BAD_BODY)
        .when(usable, ANSWERED)
        .otherwise(ANSWER_MISSING)
    )
    return rows.select(F.col("_r").getField("id").alias(key), outcome.alias("outcome"), F.when(usable & ~F.col("_bad"), quantiles).alias("quantiles"))


def request_outcomes(
    requests: DataFrame,
    answers: DataFrame,
    context_len: int,
    fitted: DataFrame | None = None,
    key: str = "request_id",
) -> DataFrame:
    """JOI1, JOB4: the requests, each once, with outcome, n_answers and the quantiles of its answer.

    `requests` has the key and `actual`, and with `fitted` also column_id and instrument_id; `fitted`
    holds the kinds a model knows. A course that ends with the context leaves nothing to forecast and
    is too short, whatever was answered. Of several answers the first that holds a forecast counts.
    What has no forecast is never fitted if its kind is not known; otherwise its answer is missing
    or came in a bad body; a request no response speaks of was never sent. Answers to nobody's
    request are left out.
    """
    grade = F.when(F.col("outcome") == ANSWERED, 2).when(F.col("outcome") == ANSWER_MISSING, 1).otherwise(0)
    best = (
        answers.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.max_by("outcome", grade).alias("_answer"),
            F.count_if(F.col("outcome") == ANSWERED).alias("n_answers"),
            F.max_by("quantiles", F.struct(grade, F.to_json("quantiles"))).alias("quantiles"),
        )
    )
    joined = requests.join(best, key, "left")
    known: Column = F.lit(True)
    if fitted is not None:
        kinds = fitted.select("column_id", "instrument_id").distinct().withColumn("_known", F.lit(True))
        joined = joined.join(kinds, ["column_id", "instrument_id"], "left")
        known = F.coalesce("_known", F.lit(False))
    outcome = (
        F.when(F.coalesce(F.size("actual"), F.lit(0)) <= context_len, TOO_SHORT)
        .when(F.col("_answer") == ANSWERED, ANSWERED)
        .when(~known, NEVER_FITTED)
        .otherwise(F.coalesce("_answer", F.lit(NEVER_SENT)))
    )
    return joined.select(
        *requests.columns,
        outcome.alias("outcome"),
        F.coalesce("n_answers", F.lit(0)).alias("n_answers"),
        F.when(outcome == ANSWERED, F.col("quantiles")).alias("quantiles"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Requests by outcome; the counts add up to the requests."""
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
