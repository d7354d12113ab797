"""Tuning trials, over orders and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.standins import table, tidy
from tickloom.operators.trials import (
    best_trial,
    completed_count,
    objective_range,
    params_as_columns,
    status_counts,
    trial_params,
    valid_trials,
)
from tickloom.plans.trials import trial_report
from tickloom.session import new_folder
from tickloom.sources.files import read_trials


def order_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trials; two priorities stand for trials without a usable objective."""
    orders = table(spark, sf_dir, "orders")
    objective = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(float("nan")))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(float("-inf")))
        .otherwise(F.col("o_totalprice"))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "Completed")
        .when(F.col("o_orderstatus") == "P", "Failed")
        .otherwise("InProgress")
    )
    return orders.select(
        F.concat(F.lit("job-"), "o_orderkey").alias("TrainingJobName"),
        status.alias("TrainingJobStatus"),
        objective.alias("FinalObjectiveValue"),
        F.col("o_orderdate").alias("TrainingStartTime"),
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(trial_report(order_trials(spark, sf_dir)))


def _stored_range(fmt: str):
    """Trials exported and read back, with objectives that are no finite numbers."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "trials")
        order_trials(spark, sf_dir).write.format(fmt).save(folder)
        return objective_range(valid_trials(read_trials(spark, folder, fmt)))

    return query


def _best(minimize: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(best_trial(valid_trials(order_trials(spark, sf_dir)), minimize))

    return query


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(order_trials(spark, sf_dir))


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completed_count(order_trials(spark, sf_dir))


def part_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as trials; their numbers are the tuned parameters."""
    parts = table(spark, sf_dir, "part")
    return parts.select(
        F.concat(F.lit("job-"), "p_partkey").alias("TrainingJobName"),
        F.create_map(
            F.lit("size"), F.col("p_size").cast("double"), F.lit("price"), F.col("p_retailprice")
        ).alias("params"),
    )


def params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trial_params(part_trials(spark, sf_dir))


def param_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params_as_columns(part_trials(spark, sf_dir), ["size", "price", "layers"])


QUERIES = {
    "trial_report": report,
    "trial_range": _stored_range("json"),
    "trial_range_parquet": _stored_range("parquet"),
    "best_trial": _best(True),
    "best_trial_highest": _best(False),
    "status_counts": statuses,
    "completed_count": completed,
    "trial_params": params,
    "trial_param_columns": param_columns,
}

TRIALS = """
WITH trials AS (
    SELECT 'job-' || o_orderkey AS "TrainingJobName",
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Failed' ELSE 'InProgress' END
            AS "TrainingJobStatus",
        CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'NaN'::DOUBLE
            WHEN '5-LOW' THEN '-inf'::DOUBLE ELSE o_totalprice END AS "FinalObjectiveValue",
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "TrainingStartTime"
    FROM orders),
valid AS (
    SELECT * FROM trials
    WHERE NOT isnan("FinalObjectiveValue") AND "FinalObjectiveValue" > '-inf'::DOUBLE)
"""

_RANGE = f"""
{TRIALS}
SELECT count(*) AS n_valid, min("FinalObjectiveValue") AS lowest,
    max("FinalObjectiveValue") AS highest
FROM valid"""

ORACLES = {
    "trial_report": f"""
        {TRIALS}
        SELECT *, count(*) OVER () AS n_valid, min("FinalObjectiveValue") OVER () AS lowest,
            max("FinalObjectiveValue") OVER () AS highest
        FROM valid""",
    "trial_range": _RANGE,
    "trial_range_parquet": _RANGE,
    "best_trial": f"""
        {TRIALS}
        SELECT * FROM valid ORDER BY "FinalObjectiveValue", "TrainingJobName" LIMIT 1""",
    "best_trial_highest": f"""
        {TRIALS}
        SELECT * FROM valid ORDER BY "FinalObjectiveValue" DESC, "TrainingJobName" LIMIT 1""",
    "status_counts": f"""
        {TRIALS} SELECT "TrainingJobStatus", count(*) AS n FROM trials GROUP BY 1""",
    "completed_count": f"""
        {TRIALS}
        SELECT count(*) FILTER ("TrainingJobStatus" = 'Completed') AS n_completed,
            bool_and("TrainingJobStatus" = 'Completed') AS all_completed
        FROM trials""",
    "trial_params": """
        SELECT 'job-' || p_partkey AS "TrainingJobName", 'size' AS param,
            CAST(p_size AS DOUBLE) AS value
        FROM part
        UNION ALL SELECT 'job-' || p_partkey, 'price', p_retailprice FROM part""",
    "trial_param_columns": """
        SELECT 'job-' || p_partkey AS "TrainingJobName", CAST(p_size AS DOUBLE) AS size,
            p_retailprice AS price, CAST(NULL AS DOUBLE) AS layers
        FROM part""",
}
