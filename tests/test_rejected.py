"""Rows that are no bars are kept apart, with a reason, and counted."""

from __future__ import annotations

from tickloom.config import FeatureConfig
from tickloom.plans.jobs import RowCounts, feature_job
from tickloom.sources.bars import bad_rows, good_rows, judged, read_bar_files
from tickloom.sources.files import read_split

HEAD = "Gmt time,Open,High,Low,Close,Volume"


def line(minute, *values):
    return f"07.01.2019 00:{minute:02d}:00.000," + ",".join(values)


LINES = [
    line(0, "1", "2", "3", "4", "5"),
    line(1, "oops", "2", "3", "4", "5"),
    line(2, "", "2", "3", "4", "5"),
    "yesterday,1,2,3,4,5",
    ",1,2,3,4,5",
    line(3, "1", "2", "3", "4"),
    line(4, "1", "2", "3", "4", "5", "6"),
    "yesterday,oops,2,3,4,5",
    line(5, "1e3", "-2", "NaN", "4", "5"),
]


def test_reasons(spark, tmp_path):
    (tmp_path / "eurusd_1m.csv").write_text("\n".join([HEAD, *LINES]) + "\n")
    rows = judged(read_bar_files(spark, str(tmp_path / "*_1m.csv"), keep_corrupt=True))
    bad = bad_rows(rows).collect()
    assert sorted((r.reason, r.Time or "") for r in bad) == sorted(
        [("number", "07.01.2019 00:01:00.000"), ("time", "yesterday"), ("time", ""), ("columns", "07.01.2019 00:03:00.000"),
         ("columns", "07.01.2019 00:04:00.000"), ("time", "yesterday")]
    )
    assert {r.instrument for r in bad} == {"eurusd"}
    assert {r.line for r in bad} == {LINES[k] for k in (1, 3, 4, 5, 6, 7)}
    bars = good_rows(rows).orderBy("ts").collect()
    assert [(r.ts.minute, r.open) for r in bars] == [(0, 1.0), (2, None), (5, 1000.0)]
    assert rows.count() == len(LINES) == len(bad) + len(bars)


def test_the_job_writes_and_counts_them(spark, tmp_path):
    bars = tmp_path / "bars"
    bars.mkdir()
    good = [f"{d:02d}.01.2019 00:{m:02d}:00.000,1,1,1,{m},1" for d in (7, 14, 21) for m in range(30)]
    (bars / "eurusd_1m.csv").write_text("\n".join([HEAD, *good, *LINES[1:2], "never,1,1,1,1,1"]) + "\n")
    (bars / "usdjpy_1m.csv").write_text("\n".join([HEAD, *good, "short,1"]) + "\n")
    cfg = FeatureConfig(test_weeks=1, holdout_weeks=1, n_tests=2, length=10)
    out = str(tmp_path / "features")
    for _ in range(2):
        counts = feature_job(spark, str(bars / "*_1m.csv"), out, cfg)
    assert counts == RowCounts(183, 180, {"time": 1, "number": 1, "columns": 1})
    stored = spark.read.json(f"{out}-rejected").collect()
    assert sorted((r.instrument, r.reason) for r in stored) == [("eurusd", "number"), ("eurusd", "time"), ("usdjpy", "columns")]
    assert read_split(spark, out, "train").count() > 0
    other = str(tmp_path / "bad")
    feature_job(spark, str(bars / "*_1m.csv"), out, cfg, rejected=other)
    assert spark.read.json(other).count() == 3


def test_files_without_a_fault(spark, tmp_path):
    (tmp_path / "eurusd_1m.csv").write_text("\n".join([HEAD, LINES[0]]) + "\n")
    cfg = FeatureConfig(test_weeks=1, holdout_weeks=1, n_tests=1, length=1)
    counts = feature_job(spark, str(tmp_path / "eurusd_1m.csv"), str(tmp_path / "out"), cfg)
    assert counts == RowCounts(1, 1, {"time": 0, "number": 0, "columns": 0})
