"""Requests, responses, scoring, baseline and loss."""

from __future__ import annotations

import json
import math
from collections import Counter
from hashlib import md5
from statistics import NormalDist, mean, stdev

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.baseline import fit_changes, predict_quantiles
from tickloom.operators.evaluate import weighted_quantile_loss
from tickloom.operators.forecasts import (
    context_split,
    forecast_frame,
    parse_responses,
    request_payloads,
)
from tickloom.operators.scoring import batch_score, last_value_scorer
from tickloom.plans.forecasting import compare_forecasts
from tickloom.sinks.write import write_predictions

SCORED = "request_id string, quantiles map<string,array<double>>"


@pytest.fixture
def holdout(spark):
    rows = [(f"r{i:02d}", [0, i % 2], "2018-01-01 00:00:00", [float(i + k) for k in range(5)]) for i in range(12)]
    return spark.createDataFrame(rows, "request_id string, cat array<int>, start string, target array<double>")


def test_context_and_actual(holdout):
    row = context_split(holdout, 3).where("request_id = 'r02'").first()
    assert row["context"] == [2.0, 3.0, 4.0] and row["actual"] == [2.0, 3.0, 4.0, 5.0, 6.0]
    assert context_split(holdout, 9).where("request_id = 'r00'").first()["context"] == [0, 1, 2, 3, 4]


def test_first_requests_by_key(holdout):
    got = [r["request_id"] for r in context_split(holdout, 3, limit=2).collect()]
    assert got == ["r00", "r01"]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_payloads_hold_every_request_once(holdout, digits):
    made = request_payloads(context_split(holdout, 2), quantiles=["0.5"], num_samples=7, batch_size=5, digits=digits)
    rows = made.collect()
    buckets = Counter(md5(f"42:r{i:02d}".encode()).hexdigest()[:digits] for i in range(12))
    want = sorted(n for k in buckets.values() for n in [5] * (k // 5) + [k % 5] * (k % 5 > 0))
    assert sorted(len(r["request_ids"]) for r in rows) == want
    assert sorted(x for r in rows for x in r["request_ids"]) == [f"r{i:02d}" for i in range(12)]
    assert len({(r.bucket, r.batch) for r in rows}) == len(rows)
    for r in rows:
        body = json.loads(r["body"])
        assert body["configuration"] == {"num_samples": 7, "output_types": ["quantiles"], "quantiles": ["0.5"]}
        for key, instance in zip(r["request_ids"], body["instances"]):
            i = int(key[1:])
            assert instance == {"cat": [0, i % 2], "start": "2018-01-01 00:00:00", "target": [float(i), i + 1.0]}


def test_payloads_in_one_order_fill_all_batches_but_the_last(holdout):
    made = request_payloads(context_split(holdout, 2), batch_size=5, digits=None).orderBy("batch").collect()
    order = sorted((f"r{i:02d}" for i in range(12)), key=lambda r: md5(f"42:{r}".encode()).hexdigest())
    assert [r["request_ids"] for r in made] == [order[:5], order[5:10], order[10:]]
    assert [len(json.loads(r["body"])["instances"]) for r in made] == [5, 5, 2]


def test_payloads_need_one_shuffle(holdout):
    plan = request_payloads(context_split(holdout, 2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange SinglePartition" not in plan


def test_responses_pair_by_position(spark):
    body = json.dumps({"predictions": [{"quantiles": {"0.1": [1.0], "0.9": [2.0, 3.5]}}, {"quantiles": {}}]})
    df = spark.createDataFrame([(["x", "y"], body)], "request_ids array<string>, body string")
    got = {r["request_id"]: r["quantiles"] for r in parse_responses(df).collect()}
    assert got == {"x": {"0.1": [1.0], "0.9": [2.0, 3.5]}, "y": {}}


def test_frame_puts_quantiles_after_the_context(spark, holdout):
    predictions = spark.createDataFrame([("r01", {"0.5": [9.0, 8.0]}), ("r99", {"0.5": [0.0]})], SCORED)
    rows = compare_forecasts(holdout, predictions, 3).collect()
    assert {r["request_id"] for r in rows} == {"r01"}
    lines = {}
    for r in rows:
        lines.setdefault(r["series"], []).append((r["position"], r["value"]))
    assert sorted(lines["0.5 quantile"]) == [(3, 9.0), (4, 8.0)]
    assert sorted(lines["actual"]) == [(k, 1.0 + k) for k in range(5)]


def test_scored_in_place_gives_the_same_frame(holdout):
    requests = context_split(holdout, 3)
    scored = batch_score(requests, last_value_scorer(2, ("0.1", "0.9")), SCORED)
    joined = forecast_frame(requests, scored)
    in_place = forecast_frame(requests.join(scored, "request_id"))
    assert sorted(joined.collect()) == sorted(in_place.collect())


def test_model_is_loaded_once_per_task(spark, tmp_path):
    def load():
        with open(tmp_path / "loads", "a") as log:
            log.write("x")

        def score(batch: pd.DataFrame) -> pd.DataFrame:
            return batch.assign(size=len(batch))

        return score

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 100, 1, 2)
        rows = batch_score(df, load, "id long, size long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["id"] for r in rows] == list(range(100)) and {r["size"] for r in rows} == {10}
    assert (tmp_path / "loads").read_text() == "xx"


def test_predictions_stay_in_line_order(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).select(
        F.format_string("%03d", "id").alias("request_id"), F.array(F.col("id").cast("double")).alias("context")
    )
    write_predictions(batch_score(df, last_value_scorer(1, ("0.5",)), SCORED), str(tmp_path / "p"))
    ids = [
        json.loads(line)["request_id"]
        for part in sorted((tmp_path / "p").glob("*.json"))
        for line in part.read_text().splitlines()
    ]
    assert ids == [f"{i:03d}" for i in range(100)]


def test_baseline_is_a_normal_fit_of_changes(spark):
    targets = [[0.0, 1.0, 2.0, 5.0], [0.0, 2.0, 5.0, 4.0], [0.0, 1.0, 1.5, 9.0]]
    windows = spark.createDataFrame(
        [(0, 1, t) for t in targets] + [(1, 1, [0.0, 1.0, 4.0, 4.0])],
        "column_id int, instrument_id int, target array<double>",
    )
    fit = fit_changes(windows, 2)
    rows = {(r["column_id"], r["step"]): (r["mu"], r["sigma"]) for r in fit.collect()}
    for step in (1, 2):
        changes = [t[1 + step] - t[1] for t in targets]
        assert rows[(0, step)] == pytest.approx((mean(changes), stdev(changes)))
    assert rows[(1, 1)] == (3.0, 0.0)
    requests = spark.createDataFrame(
        [("a", 0, 1, [7.0, 10.0]), ("b", 5, 5, [1.0, 1.0])],
        "request_id string, column_id int, instrument_id int, context array<double>",
    )
    got = predict_quantiles(requests, fit, ["0.1", "0.5"]).collect()
    assert [r["request_id"] for r in got] == ["a"]
    for q, line in got[0]["quantiles"].items():
        z = NormalDist().inv_cdf(float(q))
        expected = [10 + rows[(0, s)][0] + z * rows[(0, s)][1] for s in (1, 2)]
        assert line == pytest.approx(expected)


def test_loss_by_hand(spark):
    requests = spark.createDataFrame(
        [("a", [0.0], [0.0, 2.0, -4.0])], "request_id string, context array<double>, actual array<double>"
    )
    predictions = spark.createDataFrame([("a", {"0.1": [1.0, -3.0], "0.9": [3.0, -5.0]})], SCORED)
    got = {r["quantile"]: r for r in weighted_quantile_loss(requests, predictions).collect()}
    low = 2 * (0.1 * 1 + 0.9 * 1) / 6
    high = 2 * (0.1 * 1 + 0.9 * 1) / 6
    assert math.isclose(got["0.1"]["wql"], low) and math.isclose(got["0.9"]["wql"], high)
    assert math.isclose(got["0.1"]["mean_wql"], (low + high) / 2)
    perfect = spark.createDataFrame([("a", {"0.5": [2.0, -4.0]})], SCORED)
    assert weighted_quantile_loss(requests, perfect).first()["wql"] == 0.0
