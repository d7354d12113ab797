"""Answers in the order of the lines they answer."""

from __future__ import annotations

import json

import pytest

from tickloom.operators.scoring import batch_score, last_value_scorer
from tickloom.plans.jobs import score_job
from tickloom.sources.lines import FILE, aligned_lines, numbered_lines, placed_lines

SCORED = "request_id string, quantiles map<string,array<double>>"


def feature(i):
    return json.dumps({"cat": [0, 1], "start": f"s{i}", "target": [float(i), float(i) / 2]})


@pytest.fixture
def holdout(tmp_path):
    """Two files of one name in two folders, one with a strange name, and lines that are no rows."""
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "b").mkdir()
    files = {
        "a/part 1+2.json": [feature(i) for i in range(500)],
        "b/part 1+2.json": [feature(i) for i in range(1000, 1007)],
        "c.json": [feature(1), "", "{broken", feature(2), '{"cat":[1,2]}', feature(2), "[]", feature(3)],
        "empty.json": [],
        "ignored.txt": [feature(9)],
    }
    for name, lines in files.items():
        (tmp_path / "in" / name).write_text("".join(line + "\n" for line in lines))
    return tmp_path / "in", files


@pytest.mark.parametrize("block", [200, 128 << 20])
def test_line_k_answers_line_k(spark, tmp_path, holdout, block):
    folder, files = holdout
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    out = str(tmp_path / "out")
    for _ in range(2):
        score_job(session, str(folder), out, last_value_scorer(1, ("0.5",)), SCORED, 1)
    placed = placed_lines(session, str(folder))
    if block == 200:
        assert placed.where("file = 'part 1+2.json'").select("origin", "piece").distinct().count() > 50
    asked = {(r.file, r.origin, r.line): r.value for r in numbered_lines(placed).collect()}
    answers = {(r.file, r.origin, r.line): json.loads(r.value) for r in aligned_lines(session, out).collect()}
    assert asked.keys() == answers.keys() and len(asked) == 515
    by_file = {}
    for (name, origin, line), value in sorted(asked.items()):
        by_file.setdefault((name, origin), []).append(value)
    assert sorted(by_file.values()) == sorted(lines for name, lines in files.items() if lines and name.endswith(".json"))
    for place, value in asked.items():
        try:
            row = json.loads(value)
            want = {"request_id": f"0:1:{row['start']}", "quantiles": {"0.5": [row["target"][0]]}}
        except (ValueError, KeyError, TypeError):
            want = {}
        assert answers[place] == want


def test_a_scorer_that_loses_rows_is_refused(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "request_id string, k int").coalesce(1)
    lossy = lambda: lambda batch: batch[["request_id"]].iloc[:-1]
    with pytest.raises(Exception, match="1 answers to 2 rows"):
        batch_score(df, lossy, "request_id string", ("k",)).collect()


def test_an_empty_folder_gives_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text("")
    out = str(tmp_path / "out")
    score_job(spark, str(tmp_path / "in"), out, last_value_scorer(1, ("0.5",)), SCORED, 1)
    assert aligned_lines(spark, out).count() == 0
    assert set(FILE) <= set(aligned_lines(spark, out).columns)
