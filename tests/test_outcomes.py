"""No request is lost: outcomes, back-off and coverage."""

from __future__ import annotations

import json
import random
from statistics import NormalDist, mean, stdev

import pytest
from pyspark.sql import functions as F

from tickloom.operators.baseline import fit_levels, predict_with_backoff
from tickloom.operators.evaluate import weighted_quantile_loss
from tickloom.operators.outcomes import outcome_counts, read_answers, request_outcomes

RESPONSE = "request_ids array<string>, body string"
ASKED = "request_id string, column_id int, instrument_id int, actual array<double>"


def good(*values):
    return {"quantiles": {"0.1": list(values), "0.9": list(values)}}


def body(*predictions):
    return json.dumps({"predictions": list(predictions)})


def test_every_kind_of_fault_is_told_apart(spark):
    responses = [
        (["a", "b", "c"], body(good(1.0), good(2.0))),
        (["d"], body(good(1.0))[:-3]),
        (["e"], "no json"),
        (["f"], None),
        (["g"], json.dumps({"error": "x"})),
        (["h"], json.dumps({"predictions": [{"quantiles": 5}]})),
        (["i", "j", "k"], body({"quantiles": {}}, {"other": 1}, {"quantiles": {"0.1": [1.0], "0.9": []}})),
        (["l"], body(good(3.0), good(4.0))),
        (None, body(good(5.0))),
        ([], body()),
        (None, None),
    ]
    got = read_answers(spark.createDataFrame(responses, RESPONSE)).collect()
    assert sorted((r.request_id or "-", r.outcome) for r in got) == [
        ("-", "not asked"), ("-", "not asked"), ("a", "answered"), ("b", "answered"), ("c", "answer missing"), ("d", "bad body"),
        ("e", "bad body"), ("f", "bad body"), ("g", "bad body"), ("h", "bad body"), ("i", "answer missing"), ("j", "answer missing"),
        ("k", "answer missing"), ("l", "answered"),
    ]
    assert {r.request_id for r in got if r.quantiles is not None} == {"a", "b", "l", None}


def test_outcomes_add_up_to_the_requests(spark):
    rng = random.Random(8)
    asked = [(f"r{i}", i % 3, i % 2, [float(k) for k in range(rng.choice([0, 2, 3, 5]))]) for i in range(200)] + [("none", 0, 0, None)]
    responses, answer = [], {}
    for at in range(0, 180, 6):
        ids = [f"r{i}" for i in range(at, at + 6)]
        kind = at // 6 % 5
        if kind == 0:
            text, states = body(*[good(1.0)] * 6), ["answered"] * 6
        elif kind == 1:
            text, states = body(*[good(1.0)] * 4), ["answered"] * 4 + ["answer missing"] * 2
        elif kind == 2:
            text, states = "{", ["bad body"] * 6
        elif kind == 3:
            text, states = body(*[good(1.0)] * 8), ["answered"] * 6
        else:
            continue
        responses.append((ids, text))
        answer.update(zip(ids, states))
    # A second try for some, and an answer nobody asked for.
    responses += [([f"r{i}" for i in range(12, 18)], body(*[good(2.0)] * 3)), (["strange"], body(good(1.0)))]
    answer.update({f"r{i}": "answered" if i < 15 else "answer missing" for i in range(12, 18)})
    fitted = [(0, 0), (1, 1), (2, 0), (0, 0)]
    got = request_outcomes(
        spark.createDataFrame(asked, ASKED), read_answers(spark.createDataFrame(responses, RESPONSE)), 2,
        spark.createDataFrame(fitted, "column_id int, instrument_id int"),
    )
    want = {}
    for r, column, instrument, course in asked:
        state = answer.get(r, "never sent")
        if len(course or []) <= 2:
            state = "too short"
        elif state != "answered" and (column, instrument) not in fitted:
            state = "never fitted"
        want[r] = state
    rows = got.collect()
    assert len(rows) == len(asked) and {r.request_id: r.outcome for r in rows} == want
    assert all((r.quantiles is not None) == (r.outcome == "answered") for r in rows)
    assert sum(r.n for r in outcome_counts(got).collect()) == len(asked)


def test_no_responses_at_all(spark):
    asked = spark.createDataFrame([("a", 0, 0, [1.0, 2.0, 3.0])], ASKED)
    none = read_answers(spark.createDataFrame([], RESPONSE))
    assert [r.outcome for r in request_outcomes(asked, none, 2).collect()] == ["never sent"]
    assert request_outcomes(asked.limit(0), none, 2).collect() == []


@pytest.fixture
def windows(spark):
    rng = random.Random(2)
    rows = [(c, i, [rng.uniform(0, 9) for _ in range(5)]) for c, i in [(0, 0), (0, 0), (0, 0), (1, 0), (1, 0), (0, 1)]]
    return rows, spark.createDataFrame(rows, "column_id int, instrument_id int, target array<double>")


def test_back_off_goes_from_kind_to_instrument_to_all(spark, windows):
    rows, df = windows
    asked = [("kind", 1, 0), ("instrument", 2, 0), ("all", 0, 9), ("one", 0, 1)]
    requests = spark.createDataFrame([(*r, [1.0, 4.0]) for r in asked], "request_id string, column_id int, instrument_id int, context array<double>")
    got = {r.request_id: r for r in predict_with_backoff(requests, fit_levels(df, 2), ["0.5", "0.9"]).collect()}
    assert {k: r.level for k, r in got.items()} == {"kind": "kind", "instrument": "instrument", "all": "all", "one": "kind"}
    used = {
        "kind": [t for c, i, t in rows if (c, i) == (1, 0)], "instrument": [t for c, i, t in rows if i == 0],
        "all": [t for _, _, t in rows], "one": [t for c, i, t in rows if (c, i) == (0, 1)],
    }
    for name, targets in used.items():
        for step in range(3):
            d = [t[2 + step] - t[1] for t in targets]
            spread = stdev(d) if len(d) > 1 else 0.0
            assert got[name].quantiles["0.5"][step] == pytest.approx(4.0 + mean(d))
            assert got[name].quantiles["0.9"][step] == pytest.approx(4.0 + mean(d) + spread * NormalDist().inv_cdf(0.9))


def test_without_any_fit_requests_stay_without_forecast(spark, windows):
    _, df = windows
    requests = spark.createDataFrame([("a", 0, 0, [1.0])], "request_id string, column_id int, instrument_id int, context array<double>")
    row = predict_with_backoff(requests, fit_levels(df.limit(0), 2), ["0.5"]).first()
    assert (row.level, row.quantiles) == ("none", None)


def test_loss_counts_steps_it_cannot_see(spark):
    rows = [
        ("a", [1.0, 2.0, 4.0, None], [1.0], {"0.5": [1.0], "0.9": [3.0, 3.0, 3.0, 9.0]}, "kind"),
        ("b", [1.0, 5.0], [1.0], None, "none"),
        ("c", [1.0], [1.0], {"0.5": [7.0]}, "kind"),
    ]
    kinds = "request_id string, actual array<double>, context array<double>, quantiles map<string,array<double>>, level string"
    df = spark.createDataFrame(rows, kinds)
    got = {r["quantile"]: r for r in weighted_quantile_loss(df, quantiles=["0.5", "0.9"]).collect()}
    assert {q: (r.n_steps, r.n_uncovered) for q, r in got.items()} == {"0.5": (3, 2), "0.9": (3, 1)}
    assert got["0.5"].wql == pytest.approx(2 * 0.5 * 1.0 / 2.0)
    assert got["0.9"].wql == pytest.approx(2 * (0.1 * 1.0 + 0.9 * 1.0) / 6.0)
    apart = {(r["level"], r["quantile"]): r for r in weighted_quantile_loss(df, quantiles=["0.5", "0.9"], by="level").collect()}
    assert apart["none", "0.5"].wql is None and apart["none", "0.5"].n_uncovered == 1
    assert apart["kind", "0.9"].wql == got["0.9"].wql
    # Predictions in a frame of their own: a request that has none stays.
    plain = df.drop("quantiles")
    joined = weighted_quantile_loss(plain, df.where("request_id = 'a'").select("request_id", "quantiles"), quantiles=["0.9"], by="level")
    assert {(r.level, r.n_steps, r.n_uncovered) for r in joined.collect()} == {("kind", 2, 0), ("none", 1, 1)}
    assert weighted_quantile_loss(df.limit(0)).collect() == []
