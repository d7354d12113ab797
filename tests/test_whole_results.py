"""Results stay whole off the beaten track: ties, reruns, short files, odd names, images without boxes."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest

from tickloom.operators.lookups import id_lookup
from tickloom.operators.matching import match_detections, precision_recall
from tickloom.operators.ordering import exact_split
from tickloom.plans.features import walk_through_config
from tickloom.plans.forecasting import stored_requests
from tickloom.plans.jobs import manifest_job
from tickloom.sources.bars import read_bar_files


def test_rows_that_differ_below_a_millisecond_stay_apart(spark):
    start = datetime(2024, 1, 1)
    rows = [("k", start + timedelta(microseconds=i), None, 0.0, b"\x00" * i) for i in range(10)]
    rows += [("k", start, None, -0.0, b"")] * 3
    df = spark.createDataFrame(rows, "id string, ts timestamp, n int, x double, b binary")
    got = exact_split(df, ["id"], 0.5, 1).collect()
    assert Counter((r.id, r.ts, r.n, str(r.x), bytes(r.b)) for r in got) == Counter((i, t, n, str(x), b) for i, t, n, x, b in rows)


def _lines(folder, n):
    (folder / "lines").mkdir()
    text = "".join(f'{{"source-ref":"s3://b/images/{i}.jpg","k":{i}}}\n' for i in range(n))
    (folder / "lines" / "a.manifest").write_text(text)
    return str(folder / "lines")


def test_a_second_run_leaves_no_rows_of_the_first(spark, tmp_path):
    source, out = _lines(tmp_path, 40), str(tmp_path / "out")
    first = {r["split"]: r["n"] for r in manifest_job(spark, source, "s3://new", out, 0.8).collect()}
    assert sum(first.values()) == 40 and len(first) == 2
    second = {r["split"]: r["n"] for r in manifest_job(spark, source, "s3://new", out, 1.0).collect()}
    assert list(second.values()) == [40]


def test_written_lines_are_shuffled(spark, tmp_path):
    source, out = _lines(tmp_path, 60), str(tmp_path / "out")
    manifest_job(spark, source, "s3://new", out, 1.0)
    lines = [line for p in sorted((tmp_path / "out").glob("split=*/*.txt")) for line in p.read_text().splitlines()]
    assert len(lines) == 60 and lines != sorted(lines, key=lambda x: json.loads(x)["k"])


def test_short_files_are_read(spark, tmp_path):
    for i in range(4):
        (tmp_path / f"p{i}.json").write_text('{"cat":[0,%d],"start":"2024-01-01 00:00:00","target":[1,2,3]}\n' % i)
    assert stored_requests(spark, str(tmp_path), 2).count() == 4


def test_no_cap_unless_asked_for():
    assert walk_through_config("a").series_limit is None


def test_names_of_files_are_decoded(spark, tmp_path):
    header = "Gmt time,Open,High,Low,Close,Volume\n"
    for name in ("eur usd", "a+b", "ü%20"):
        (tmp_path / f"{name}_1m.csv").write_text(header + "01.01.2024 00:00:00.000,1,1,1,1,1\n")
    got = {r.instrument for r in read_bar_files(spark, str(tmp_path)).collect()}
    assert got == {"eur usd", "a+b", "ü%20"}


def test_images_without_boxes_are_no_truths(spark):
    box = "image_id string, {0}_index int, {1} left int, top int, width int, height int"
    truths = spark.createDataFrame(
        [("a", 0, 1, 1, 10, 10), ("b", None, None, None, None, None), ("c", None, None, None, None, None)], box.format("truth", "")
    )
    found = spark.createDataFrame([("a", 0, 0.9, 1, 1, 10, 10)], box.format("det", "score double,"))
    row = precision_recall(truths, found, match_detections(truths, found, 0.5)).first()
    assert (row.n_truths, row.n_detections, row.n_matches, row.precision, row.recall) == (1, 1, 1, 1.0, 1.0)


@pytest.mark.parametrize("threshold", [0, -1, 1.01])
def test_thresholds_that_mean_nothing_are_refused(spark, threshold):
    none = spark.createDataFrame([], "image_id string, truth_index int, det_index int, score double, left int, top int, width int, height int")
    with pytest.raises(ValueError):
        match_detections(none, none, threshold)


def test_long_lists_of_names(spark):
    names = [f"name {i} \"'\\" for i in range(20_000)]
    got = id_lookup(spark, names, "column").collect()
    assert [(r.column_id, r.column) for r in sorted(got)] == list(enumerate(names))
