"""Tuning trials."""

from __future__ import annotations

import json

import pytest

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
from tickloom.sources.files import read_trials

INF = float("inf")
VALUES = {"a": float("nan"), "b": -INF, "c": INF, "d": 2.0, "e": 1.0, "f": 1.0, "g": None}


@pytest.fixture
def trials(spark):
    return spark.createDataFrame(
        [(k, "Completed" if k < "d" else "Failed", v, {"lr": 0.1}) for k, v in VALUES.items()],
        "TrainingJobName string, TrainingJobStatus string, FinalObjectiveValue double, params map<string,double>",
    )


def names(df):
    return [r["TrainingJobName"] for r in df.collect()]


def test_only_reported_objectives_are_valid(trials):
    assert sorted(names(valid_trials(trials))) == ["c", "d", "e", "f"]


@pytest.mark.parametrize("minimize, order", [(True, "efdc"), (False, "cdef")])
def test_report_and_best_follow_the_direction(trials, minimize, order):
    report = trial_report(trials, minimize)
    assert names(report) == list(order)
    assert {(r["n_valid"], r["lowest"], r["highest"]) for r in report.collect()} == {(4, 1.0, INF)}
    assert names(best_trial(valid_trials(trials), minimize)) == [order[0]]


def test_nothing_in_nothing_out(trials):
    none = valid_trials(trials.where("TrainingJobName = 'a'"))
    assert trial_report(trials.limit(0)).count() == 0 and best_trial(none, True).count() == 0
    assert tuple(objective_range(none).first()) == (0, None, None)


def test_counts(trials):
    counts = {r["TrainingJobStatus"]: r["n"] for r in status_counts(trials).collect()}
    assert counts == {"Completed": 3, "Failed": 4}
    assert tuple(completed_count(trials).first()) == (3, False)


def test_parameters(trials):
    assert trial_params(trials).where("param = 'lr' AND value = 0.1").count() == 7
    row = params_as_columns(trials, ["lr", "cells"]).first()
    assert row["lr"] == 0.1 and row["cells"] is None


def test_exported_trials_keep_odd_objectives(spark, tmp_path):
    rows = [
        {"TrainingJobName": n, "FinalObjectiveValue": v, "TrainingStartTime": "2019-05-19T03:02:49", "params": {"lr": 1.5}}
        for n, v in (("a", "NaN"), ("b", "-Infinity"), ("c", 3.5))
    ]
    (tmp_path / "t.json").write_text("\n".join(json.dumps(r) for r in rows))
    trials = read_trials(spark, str(tmp_path))
    assert trials.count() == 3 and names(valid_trials(trials)) == ["c"]
    assert trials.where("params['lr'] = 1.5 AND TrainingStartTime > '2019-05-19'").count() == 3
