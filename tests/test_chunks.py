"""Series in chunks, and windows across them, against series in one row."""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from tickloom.config import FeatureConfig
from tickloom.operators.chunks import chunked_index, chunked_series, numbered_points, sampled_starts, windows_over_chunks
from tickloom.operators.series import weekly_index, weekly_series
from tickloom.operators.windows import sample_windows

BARS = "instrument string, ts timestamp_ntz, open double, close double"
CFG = FeatureConfig(instruments=("a", "b"), columns=("open", "close"), n_tests=6, length=7)


def bars(spark, seed=3, n=220, repeats=0):
    rng = random.Random(seed)
    rows = []
    for name in ("a", "b"):
        at = datetime(2020, 1, 1)
        for k in range(n):
            at += timedelta(minutes=rng.choice([1, 1, 7, 400]))
            rows.append((name, at, float(k), None if rng.random() < 0.2 else k / 4))
    rows += [("b", datetime(2021, 5, 5), 1.0, 2.0), ("a", None, 1.0, 1.0)]
    rows += [rows[5]] * repeats
    return spark.createDataFrame(rows, BARS).repartition(5)


@pytest.mark.parametrize("size,slot", [(3, 60), (5, 3600), (4096, 600)])
@pytest.mark.parametrize("changes", [{}, {"nulls": "keep"}, {"window_start": "fixed_step", "include_last_window": True}])
def test_windows_are_those_of_whole_series(spark, size, slot, changes):
    cfg = replace(CFG, **changes)
    df = bars(spark)
    chunks = chunked_series(numbered_points(df, cfg, slot), size)
    want = sample_windows(weekly_series(df, cfg.week_mode, cfg.columns), cfg)
    names = want.columns
    got = windows_over_chunks(chunks, cfg, size).select(*names)
    assert Counter(map(str, (tuple(r) for r in got.collect()))) == Counter(map(str, (tuple(r) for r in want.collect())))


def test_no_row_is_over_the_size_however_often_a_time_repeats(spark):
    df = bars(spark, repeats=500)
    cfg = replace(CFG, nulls="keep")
    chunks = chunked_series(numbered_points(df, cfg), 16)
    rows = chunks.collect()
    assert max(len(r["values"]) for r in rows) == 16 and all(len(r["values"]) == len(r["times"]) for r in rows)
    index = {(r.instrument, r.week_key): r for r in chunked_index(chunks).where("column_id = 0").collect()}
    whole = {(r.instrument, r.week_key): r for r in weekly_index(df).collect()}
    assert {k: (r.ts_start, r.n_points) for k, r in index.items()} == {k: (r.ts_start, r.n_points) for k, r in whole.items()}
    assert sum(r.n_repeats for r in index.values()) == 500
    series = {}
    for r in sorted((r for r in rows if r.column_id == 0), key=lambda r: r.chunk):
        assert r["offset"] == 16 * r.chunk == len(series.setdefault((r.instrument, r.week_key), []))
        series[r.instrument, r.week_key] += list(zip(r["times"], r["values"]))
    assert all(v == sorted(v) for v in series.values())


def test_series_too_short_for_a_window_give_none(spark):
    df = bars(spark, n=2)
    chunks = chunked_series(numbered_points(df, CFG), 4)
    assert sampled_starts(chunks, CFG).collect() == [] == windows_over_chunks(chunks, CFG, 4).collect()
    assert chunked_series(numbered_points(df.limit(0), CFG), 4).collect() == []
