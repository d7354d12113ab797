"""Requests, responses, forecasts and their loss, over line items."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.standins import (
    BACKOFF_CONFIG,
    BACKOFF_CONTEXT,
    BACKOFF_SERIES,
    CONTEXT_LEN,
    LINE_CONFIG,
    LINE_SERIES,
    QUANTILES,
    line_bars,
    order_bars,
    spread,
    tidy,
)
from tickloom.operators.baseline import fit_changes
from tickloom.operators.evaluate import weighted_quantile_loss
from tickloom.operators.forecasts import context_split, forecast_frame, parse_responses, request_payloads
from tickloom.operators.scoring import batch_score, last_value_scorer
from tickloom.plans.features import ROW_KEY, build_features
from tickloom.plans.forecasting import (
    answered_requests,
    backoff_forecasts,
    baseline_forecasts,
    compare_forecasts,
    holdout_requests,
    series_requests,
    stored_requests,
    training_windows,
    with_request_id,
)
from tickloom.plans.jobs import score_job
from tickloom.session import new_folder
from tickloom.sinks.write import write_features, write_predictions
from tickloom.sources.files import FEATURE_SCHEMA
from tickloom.sources.lines import FILE, aligned_lines, numbered_lines, placed_lines

# An instrument that was never fitted, and a kind of another one.
NEVER = ("5-LOW", "1-URGENT", "close")
HORIZON = LINE_CONFIG.length - CONTEXT_LEN
BATCH = 30
SCORED = "request_id string, quantiles map<string,array<double>>"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return holdout_requests(line_bars(spark, sf_dir), LINE_CONFIG, CONTEXT_LEN)


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests(spark, sf_dir)
    return tidy(
        rows.select(
            "request_id",
            F.posexplode("actual").alias("pos", "value"),
            F.size("context").alias("_n"),
        ).select("request_id", "pos", "value", (F.col("pos") < F.col("_n")).alias("in_context"))
    )


def first_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = context_split(requests(spark, sf_dir), CONTEXT_LEN, limit=5)
    return tidy(spread(rows, "request_id", values="context"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout rows written, read back from their folder and scored there."""
    folder = new_folder(spark, "holdout")
    features = build_features(line_bars(spark, sf_dir), LINE_CONFIG)
    write_features(features, folder, ROW_KEY, LINE_CONFIG.seed)
    found = stored_requests(spark, f"{folder}/split=holdout", CONTEXT_LEN)
    return _lines(
        batch_score(
            found.select("request_id", "context"), last_value_scorer(HORIZON, QUANTILES), SCORED
        )
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies read back field by field."""
    made = request_payloads(requests(spark, sf_dir), quantiles=QUANTILES, batch_size=BATCH, digits=None)
    schema = (
        "instances array<struct<cat:array<int>,start:string,target:array<double>>>, "
        "configuration struct<num_samples:int,output_types:array<string>,quantiles:array<string>>"
    )
    read = made.select("batch", "request_ids", F.from_json("body", schema).alias("b"))
    rows = read.select(
        "batch",
        F.col("b.configuration").alias("c"),
        F.inline(F.arrays_zip("request_ids", F.col("b.instances").alias("instance"))),
    )
    return tidy(
        rows.select(
            "batch",
            F.col("request_ids").alias("request_id"),
            F.col("instance.cat")[0].alias("cat_column"),
            F.col("instance.cat")[1].alias("cat_instrument"),
            F.col("instance.start").alias("start"),
            F.element_at("instance.target", -1).alias("last"),
            F.col("c.num_samples").alias("num_samples"),
            F.concat_ws(",", "c.output_types").alias("output_types"),
            F.concat_ws(",", "c.quantiles").alias("quantiles"),
        )
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests(spark, sf_dir).select("request_id", "context")
    return batch_score(rows, last_value_scorer(HORIZON, QUANTILES), SCORED)


def _lines(predictions: DataFrame) -> DataFrame:
    lines = predictions.select("request_id", F.explode("quantiles").alias("quantile", "values"))
    return tidy(spread(lines, "request_id", "quantile", values="values"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written and read back."""
    folder = new_folder(spark, "predictions")
    write_predictions(_scored(spark, sf_dir), folder)
    return _lines(spark.read.schema(SCORED).json(folder))


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout rows in several files, and line by line what answers them in the written predictions."""
    folder, out = new_folder(spark, "holdout"), new_folder(spark, "predictions")
    features = build_features(line_bars(spark, sf_dir), LINE_CONFIG, splits=("holdout",)).repartition(3, "start")
    write_features(features, folder, ROW_KEY, LINE_CONFIG.seed)
    score_job(spark, folder, out, last_value_scorer(HORIZON, QUANTILES), SCORED, CONTEXT_LEN)
    asked = with_request_id(
        numbered_lines(placed_lines(spark, folder)).withColumn("_r", F.from_json("value", FEATURE_SCHEMA)).select(*FILE, "line", "_r.*")
    )
    answered = aligned_lines(spark, out).withColumn("_a", F.from_json("value", SCORED)).select(
        *FILE, "line", F.col("_a.request_id").alias("answers"), F.col("_a.quantiles").alias("quantiles")
    )
    both = asked.join(answered, [*FILE, "line"], "full")
    return both.select("request_id", "answers", F.get(F.col("quantiles")["0.5"], F.lit(0)).alias("value"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as the JSON bodies a model would answer with, then decoded."""
    rows = requests(spark, sf_dir)
    bodies = (
        rows.groupBy("instrument", "column", "week_key")
        .agg(F.sort_array(F.collect_list(F.struct("request_id", "context"))).alias("r"))
    )

    def answer(request):
        last = F.element_at(request["context"], -1)
        lines = [(F.lit(q), F.array(*[last * float(q)] * HORIZON)) for q in QUANTILES]
        return F.struct(F.create_map(*[part for line in lines for part in line]).alias("quantiles"))

    made = bodies.select(
        F.col("r.request_id").alias("request_ids"),
        F.to_json(F.struct(F.transform("r", answer).alias("predictions"))).alias("body"),
    )
    return _lines(parse_responses(made))


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = baseline_forecasts(line_bars(spark, sf_dir), LINE_CONFIG, CONTEXT_LEN, QUANTILES)
    return _lines(made.select("request_id", "quantiles")).withColumn("value", F.round("value", 4))


def fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = fit_changes(training_windows(line_bars(spark, sf_dir), LINE_CONFIG), CONTEXT_LEN)
    return tidy(fit).withColumn("mu", F.round("mu", 4)).withColumn("sigma", F.round("sigma", 4))


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored in place."""
    made = baseline_forecasts(line_bars(spark, sf_dir), LINE_CONFIG, CONTEXT_LEN, QUANTILES)
    return tidy(forecast_frame(made)).withColumn("value", F.round("value", 4))


def stored_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests beside predictions that were written earlier."""
    folder = new_folder(spark, "predictions")
    write_predictions(_scored(spark, sf_dir), folder)
    stored = spark.read.schema(SCORED).json(folder)
    return tidy(compare_forecasts(requests(spark, sf_dir), stored, CONTEXT_LEN))


def _rounded(losses: DataFrame) -> DataFrame:
    return losses.withColumn("wql", F.round("wql", 6)).withColumn("mean_wql", F.round("mean_wql", 6))


def loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = baseline_forecasts(line_bars(spark, sf_dir), LINE_CONFIG, CONTEXT_LEN, QUANTILES)
    return _rounded(weighted_quantile_loss(made, quantiles=QUANTILES))


def _backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts when one instrument and one more kind were never fitted."""
    known = (F.col("instrument") != NEVER[0]) & ~((F.col("instrument") == NEVER[1]) & (F.col("column") == NEVER[2]))
    return backoff_forecasts(order_bars(spark, sf_dir), BACKOFF_CONFIG, BACKOFF_CONTEXT, QUANTILES, known)


def backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _backoff(spark, sf_dir).select("request_id", "level", F.explode_outer("quantiles").alias("quantile", "values"))
    return tidy(spread(lines, "request_id", "level", "quantile", values="values")).withColumn("value", F.round("value", 4))


def loss_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts one step shorter than what happened, so that a step of each request is not covered."""
    cut = _backoff(spark, sf_dir).withColumn("quantiles", F.transform_values("quantiles", lambda _, v: F.slice(v, 1, 1)))
    return _rounded(weighted_quantile_loss(cut, quantiles=QUANTILES, by="level"))


def _faulty_responses(asked: DataFrame) -> DataFrame:
    """Responses by week: some cut off, some without their last answer, some weeks without any; the
    lows are answered with nothing."""
    batches = asked.groupBy("week_key").agg(F.sort_array(F.collect_list(F.struct("request_id", "column", "context"))).alias("r"))

    def answer(request):
        values = F.array(*[F.element_at(request["context"], -1)] * 2)
        full = F.create_map(*[part for q in QUANTILES for part in (F.lit(q), values)])
        return F.struct(F.map_filter(full, lambda q, v: request["column"] != "low").alias("quantiles"))

    kept = F.when(F.col("week_key") % 4 == 1, F.slice("r", 1, F.size("r") - 1)).otherwise(F.col("r"))
    body = F.to_json(F.struct(F.transform(kept, answer).alias("predictions")))
    cut = F.when(F.col("week_key") % 4 == 0, F.substr(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    return batches.where("week_key % 4 <> 3").select(F.col("r.request_id").alias("request_ids"), cut.alias("body"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each holdout series asked for, with what became of it."""
    bars = order_bars(spark, sf_dir)
    asked = series_requests(bars, BACKOFF_CONFIG, BACKOFF_CONTEXT)
    kinds = training_windows(bars, BACKOFF_CONFIG).where(F.col("instrument") != NEVER[0]).select("column_id", "instrument_id")
    found = answered_requests(asked, _faulty_responses(asked), BACKOFF_CONTEXT, kinds)
    return tidy(
        found.select("request_id", "outcome", "n_answers", F.size(F.coalesce(F.map_keys("quantiles"), F.array())).alias("n_quantiles"))
    )


QUERIES = {
    "context_split": contexts,
    "first_requests": first_requests,
    "stored_requests": stored,
    "request_payload": payloads,
    "response_parse": responses,
    "batch_score": scored,
    "predictions_aligned": aligned,
    "baseline_fit": fitted,
    "baseline_quantiles": baseline,
    "forecast_frame": comparison,
    "forecast_frame_stored": stored_comparison,
    "wql": loss,
    "baseline_backoff": backoff,
    "wql_by_level": loss_by_level,
    "request_outcomes": outcomes,
}

_Z = ", ".join(f"('{q}', {NormalDist().inv_cdf(float(q))!r})" for q in QUANTILES)
_QS = ", ".join(f"('{q}')" for q in QUANTILES)

REQUESTS = f"""
{LINE_SERIES},
req AS (
    SELECT '{LINE_CONFIG.seed}:' || w.instrument || ':' || value_column || ':' || week_key || ':'
            || start_index AS request_id,
        column_id, instrument_id, start_ts, pos, delta
    FROM win w JOIN names n ON n.instrument = w.instrument WHERE split = 'holdout'),
last AS (SELECT * FROM req WHERE pos = {CONTEXT_LEN - 1}),
steps AS (SELECT unnest(range(1, {HORIZON + 1})) AS step),
changes AS (
    SELECT t.column_id, n.instrument_id, t.pos - {CONTEXT_LEN - 1} AS step, t.delta - c.delta AS d
    FROM win t
    JOIN win c ON c.instrument = t.instrument AND c.week_key = t.week_key
        AND c.column_id = t.column_id AND c.start_index = t.start_index
        AND c.pos = {CONTEXT_LEN - 1}
    JOIN names n ON n.instrument = t.instrument
    WHERE t.split = 'train' AND t.pos >= {CONTEXT_LEN}),
fit AS (
    SELECT column_id, instrument_id, step, avg(d) AS mu, coalesce(stddev_samp(d), 0) AS sigma
    FROM changes GROUP BY 1, 2, 3),
pred AS (
    SELECT l.request_id, q.quantile, f.step - 1 AS pos, l.delta + f.mu + f.sigma * q.z AS value
    FROM last l JOIN fit f ON f.column_id = l.column_id AND f.instrument_id = l.instrument_id
    CROSS JOIN (VALUES {_Z}) q(quantile, z))
"""

_LOSSES = """
            SELECT quantile, 2 * sum(CASE WHEN q IS NOT NULL THEN t * greatest(z - q, 0) + (1 - t) * greatest(q - z, 0) END)
                    / sum(CASE WHEN q IS NOT NULL THEN abs(z) END) AS raw,
                count(*) AS n_steps, count(*) - count(q) AS n_uncovered
            FROM misses GROUP BY 1"""

_BACKOFF = f"""
{BACKOFF_SERIES},
req AS (
    SELECT '{BACKOFF_CONFIG.seed}:' || w.instrument || ':' || value_column || ':' || week_key || ':' || start_index AS request_id,
        column_id, instrument_id, pos, delta
    FROM win w JOIN names n ON n.instrument = w.instrument WHERE split = 'holdout'),
changes AS (
    SELECT t.column_id, n.instrument_id, t.pos - {BACKOFF_CONTEXT - 1} AS step, t.delta - c.delta AS d
    FROM win t
    JOIN win c ON c.instrument = t.instrument AND c.week_key = t.week_key AND c.column_id = t.column_id
        AND c.start_index = t.start_index AND c.pos = {BACKOFF_CONTEXT - 1}
    JOIN names n ON n.instrument = t.instrument
    WHERE t.split = 'train' AND t.pos >= {BACKOFF_CONTEXT} AND t.instrument <> '{NEVER[0]}'
        AND NOT (t.instrument = '{NEVER[1]}' AND t.value_column = '{NEVER[2]}')),
fits AS (
    SELECT column_id, instrument_id, step, avg(d) AS mu, coalesce(stddev_samp(d), 0) AS sigma
    FROM changes GROUP BY GROUPING SETS ((column_id, instrument_id, step), (instrument_id, step), (step))),
chosen AS (
    SELECT r.request_id, r.delta, s.step,
        CASE WHEN a.mu IS NOT NULL THEN 'kind' WHEN b.mu IS NOT NULL THEN 'instrument' ELSE 'all' END AS level,
        coalesce(a.mu, b.mu, c.mu) AS mu, coalesce(a.sigma, b.sigma, c.sigma) AS sigma
    FROM (SELECT * FROM req WHERE pos = {BACKOFF_CONTEXT - 1}) r CROSS JOIN (SELECT DISTINCT step FROM fits) s
    LEFT JOIN fits a ON a.column_id = r.column_id AND a.instrument_id = r.instrument_id AND a.step = s.step
    LEFT JOIN fits b ON b.column_id IS NULL AND b.instrument_id = r.instrument_id AND b.step = s.step
    LEFT JOIN fits c ON c.column_id IS NULL AND c.instrument_id IS NULL AND c.step = s.step),
pred AS (
    SELECT request_id, level, quantile, step - 1 AS pos, delta + mu + sigma * z AS value
    FROM chosen CROSS JOIN (VALUES {_Z}) q(quantile, z))
"""

ORACLES = {
    "context_split": f"""
        {REQUESTS}
        SELECT request_id, pos, delta AS value, pos < {CONTEXT_LEN} AS in_context FROM req""",
    "first_requests": f"""
        {REQUESTS}
        SELECT request_id, pos, delta AS value FROM req
        WHERE pos < {CONTEXT_LEN} AND request_id IN (
            SELECT DISTINCT request_id FROM req ORDER BY request_id LIMIT 5)""",
    "stored_requests": f"""
        {REQUESTS}
        SELECT column_id || ':' || instrument_id || ':' || strftime(start_ts, '%Y-%m-%d %H:%M:%S')
                AS request_id,
            quantile, step - 1 AS pos, delta AS value
        FROM last CROSS JOIN steps CROSS JOIN (VALUES {_QS}) q(quantile)""",
    "request_payload": f"""
        {REQUESTS}
        SELECT (row_number() OVER (ORDER BY md5('42:' || request_id), request_id) - 1) // {BATCH} AS batch,
            request_id, column_id AS cat_column, instrument_id AS cat_instrument,
            strftime(o.start_ts, '%Y-%m-%d %H:%M:%S') AS start, delta AS "last",
            CAST(100 AS BIGINT) AS num_samples, 'quantiles' AS output_types,
            '{",".join(QUANTILES)}' AS quantiles
        FROM last o""",
    "response_parse": f"""
        {REQUESTS}
        SELECT request_id, quantile, step - 1 AS pos, delta * CAST(quantile AS DOUBLE) AS value
        FROM last CROSS JOIN steps CROSS JOIN (VALUES {_QS}) q(quantile)""",
    "batch_score": f"""
        {REQUESTS}
        SELECT request_id, quantile, step - 1 AS pos, delta AS value
        FROM last CROSS JOIN steps CROSS JOIN (VALUES {_QS}) q(quantile)""",
    "predictions_aligned": f"""
        {REQUESTS}
        SELECT column_id || ':' || instrument_id || ':' || strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS request_id,
            column_id || ':' || instrument_id || ':' || strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS answers, delta AS value
        FROM last""",
    "baseline_fit": f"""
        {REQUESTS}
        SELECT column_id, instrument_id, step, round(mu, 4) AS mu, round(sigma, 4) AS sigma FROM fit""",
    "baseline_quantiles": f"""
        {REQUESTS}
        SELECT request_id, quantile, pos, round(value, 4) AS value FROM pred""",
    "forecast_frame": f"""
        {REQUESTS}
        SELECT request_id, quantile || ' quantile' AS series, pos + {CONTEXT_LEN} AS position,
            round(value, 4) AS value
        FROM pred
        UNION ALL
        SELECT request_id, 'actual', pos, round(delta, 4) FROM req
        WHERE request_id IN (SELECT request_id FROM pred)""",
    "forecast_frame_stored": f"""
        {REQUESTS}
        SELECT request_id, quantile || ' quantile' AS series, step - 1 + {CONTEXT_LEN} AS position,
            delta AS value
        FROM last CROSS JOIN steps CROSS JOIN (VALUES {_QS}) q(quantile)
        UNION ALL SELECT request_id, 'actual', pos, delta FROM req""",
    "wql": f"""
        {REQUESTS},
        misses AS (
            SELECT o.quantile, CAST(o.quantile AS DOUBLE) AS t, r.delta AS z, p.value AS q
            FROM req r CROSS JOIN (VALUES {_QS}) o(quantile)
            LEFT JOIN pred p ON p.quantile = o.quantile AND p.request_id = r.request_id AND p.pos = r.pos - {CONTEXT_LEN}
            WHERE r.pos >= {CONTEXT_LEN}),
        losses AS ({_LOSSES})
        SELECT * EXCLUDE (raw), round(raw, 6) AS wql, round(avg(raw) OVER (), 6) AS mean_wql FROM losses""",
    "baseline_backoff": f"""
        {_BACKOFF}
        SELECT request_id, level, quantile, pos, round(value, 4) AS value FROM pred""",
    "wql_by_level": f"""
        {_BACKOFF},
        misses AS (
            SELECT r.level, o.quantile, CAST(o.quantile AS DOUBLE) AS t, r.delta AS z, p.value AS q
            FROM (SELECT a.*, l.level FROM req a JOIN (SELECT DISTINCT request_id, level FROM pred) l USING (request_id)) r
            CROSS JOIN (VALUES {_QS}) o(quantile)
            LEFT JOIN pred p ON p.quantile = o.quantile AND p.request_id = r.request_id AND p.pos = r.pos - {BACKOFF_CONTEXT} AND p.pos < 1
            WHERE r.pos >= {BACKOFF_CONTEXT}),
        losses AS ({_LOSSES.replace("quantile,", "level, quantile,").replace("GROUP BY 1", "GROUP BY 1, 2")})
        SELECT * EXCLUDE (raw), round(raw, 6) AS wql, round(avg(raw) OVER (PARTITION BY level), 6) AS mean_wql FROM losses""",
    "request_outcomes": f"""
        {BACKOFF_SERIES},
        asked AS (
            SELECT '{BACKOFF_CONFIG.seed}:' || w.instrument || ':' || value_column || ':' || week_key AS request_id, w.instrument,
                value_column, week_key, count(*) AS n
            FROM whole w WHERE split = 'holdout' GROUP BY ALL),
        kinds AS (
            SELECT DISTINCT instrument, value_column FROM win WHERE split = 'train' AND instrument <> '{NEVER[0]}'),
        placed AS (
            SELECT a.*, k.instrument IS NOT NULL AS fitted,
                row_number() OVER (PARTITION BY week_key ORDER BY request_id DESC) = 1 AS is_last
            FROM asked a LEFT JOIN kinds k USING (instrument, value_column)),
        named AS (
            SELECT *, CASE WHEN week_key % 4 = 3 THEN 'never sent' WHEN week_key % 4 = 0 THEN 'bad body'
                WHEN value_column = 'low' OR week_key % 4 = 1 AND is_last THEN 'answer missing' ELSE 'answered' END AS answer
            FROM placed),
        judged AS (
            SELECT *, CASE WHEN n <= {BACKOFF_CONTEXT} THEN 'too short' WHEN answer = 'answered' THEN answer
                WHEN NOT fitted THEN 'never fitted' ELSE answer END AS outcome
            FROM named)
        SELECT request_id, outcome, CAST(answer = 'answered' AS BIGINT) AS n_answers,
            CASE WHEN outcome = 'answered' THEN CAST({len(QUANTILES)} AS BIGINT) ELSE 0 END AS n_quantiles
        FROM judged""",
}
