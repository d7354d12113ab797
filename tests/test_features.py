"""Cut-offs, windows, feature rows and their storage."""

from __future__ import annotations

import glob
import hashlib
import json
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig, FixedCutoffs
from tickloom.functions.arrays import to_delta
from tickloom.functions.sql import register_sql_functions
from tickloom.operators.lookups import with_titles
from tickloom.operators.series import features_table, long_series, weekly_index, weekly_series
from tickloom.operators.splits import cutoff_frame, find_cutoffs
from tickloom.operators.windows import sample_windows, too_short
from tickloom.plans.features import ROW_KEY, build_features, model_rows, walk_through_config
from tickloom.sinks.write import write_features
from tickloom.sources.files import read_feature_rows

CFG = FeatureConfig(
    instruments=("a", "usdjpy"),
    columns=("open", "close"),
    test_weeks=2,
    holdout_weeks=2,
    n_tests=4,
    length=5,
)


def week_of_minutes(n, start="2018-01-01T00:00:00", step=1):
    first = datetime.fromisoformat(start)
    return [(first + timedelta(minutes=step * i)).isoformat() for i in range(n)]


@pytest.fixture
def six_weeks(make_bars):
    rows = []
    for week in range(6):
        start = (datetime(2018, 1, 1) + timedelta(weeks=week)).isoformat()
        for name in ("a", "usdjpy"):
            rows += [(name, t, 1.0 + week + i / 8) for i, t in enumerate(week_of_minutes(20, start))]
    return make_bars(rows)


@pytest.mark.parametrize(
    "include_last, sizes", [(False, {4: 0, 5: 0, 6: 1, 7: 2}), (True, {4: 0, 5: 1, 6: 2, 7: 3})]
)
def test_number_of_candidates(make_bars, include_last, sizes):
    cfg = replace(CFG, columns=("close",), n_tests=10, include_last_window=include_last)
    for n, expected in sizes.items():
        series = weekly_series(make_bars([("a", t, 1.0) for t in week_of_minutes(n)]))
        assert sample_windows(series, cfg).count() == expected


def test_too_short_series_can_be_counted(make_bars):
    index = weekly_index(make_bars([("a", t, 1.0) for t in week_of_minutes(5)]))
    assert too_short(index, 5).count() == 1 and too_short(index, 5, include_last=True).count() == 0


def test_windows_lie_inside_and_start_apart(make_bars):
    series = weekly_series(make_bars([("a", t, float(i)) for i, t in enumerate(week_of_minutes(50))]))
    rows = sample_windows(series, CFG).where("column = 'close'").collect()
    starts = [r["start_index"] for r in rows]
    assert len(starts) == len(set(starts)) == CFG.n_tests
    for r in rows:
        s = r["start_index"]
        assert 0 <= s < 50 - CFG.length
        assert r["target"] == [float(s + k) for k in range(CFG.length)]
        assert r["start_ts"] == datetime(2018, 1, 1) + timedelta(minutes=s)


def test_sample_follows_the_hash_order(make_bars):
    series = weekly_series(make_bars([("a", t, 1.0) for t in week_of_minutes(30)]))
    got = [r["start_index"] for r in sample_windows(series, CFG).where("column = 'open'").collect()]
    key = f"{CFG.seed}:a:open:201801"
    order = sorted(range(25), key=lambda i: hashlib.md5(f"{key}:{i}".encode()).hexdigest())
    assert got == order[: CFG.n_tests]


def test_start_is_the_time_of_the_point_or_counts_steps(make_bars):
    series = weekly_series(make_bars([("a", t, 1.0) for t in week_of_minutes(20, step=3)]))
    base = datetime(2018, 1, 1)
    for mode, step in (("point", 3), ("fixed_step", 1)):
        for r in sample_windows(series, replace(CFG, window_start=mode)).collect():
            assert r["start_ts"] == base + timedelta(minutes=step * r["start_index"])


def test_windows_skip_missing_values(make_bars):
    bars = make_bars([("a", t, float(i)) for i, t in enumerate(week_of_minutes(20))])
    gaps = bars.withColumn("close", F.when(F.col("close") % 2 == 0, F.col("close")))
    rows = sample_windows(weekly_series(gaps), replace(CFG, columns=("close",))).collect()
    assert rows
    for r in rows:
        assert r["target"] == [2.0 * (r["start_index"] + k) for k in range(5)]
        assert r["start_ts"] == datetime(2018, 1, 1) + timedelta(minutes=2 * r["start_index"])


@pytest.mark.parametrize(
    "values, expected", [([2.0, 3.0, 1.5], [0.0, 10.0, -5.0]), ([], []), ([4.0], [0.0])]
)
def test_delta(spark, values, expected):
    df = spark.createDataFrame([(values,)], "v array<double>")
    assert df.select(to_delta(F.col("v"), 10.0)).first()[0] == expected


def test_cutoffs(six_weeks):
    row = cutoff_frame(weekly_index(six_weeks), CFG).first()
    assert row["max_date"] == datetime(2018, 2, 5) == row["holdout_end"]
    assert row["holdout_start"] == datetime(2018, 1, 29)
    assert row["test_start"] == datetime(2018, 1, 15)


def test_cutoffs_can_follow_one_instrument(make_bars):
    bars = make_bars([("a", "2018-01-01", 1.0), ("b", "2018-03-05", 1.0)])
    row = cutoff_frame(weekly_index(bars), replace(CFG, cutoff_from="a")).first()
    assert row["max_date"] == datetime(2018, 1, 1)


def test_cutoffs_fall_on_midnight(make_bars):
    bars = make_bars([("a", "2018-01-01T10:30:00", 1.0)])
    row = cutoff_frame(weekly_index(bars), CFG).first()
    assert row["holdout_end"] == datetime(2018, 1, 1) and row["max_date"].hour == 10


@pytest.mark.parametrize("mode", ["iso", "year_major", "week_major"])
@pytest.mark.parametrize("source", [None, "a", "b"])
def test_found_dates_are_those_of_the_summary_row(make_bars, mode, source):
    days = ["2018-01-01", "2018-12-24T05:00:00", "2018-12-27", "2018-12-31T07:00:00"]
    bars = make_bars([("a", d, 1.0) for d in days] + [("b", d, 1.0) for d in days[:3]])
    cfg = replace(CFG, week_mode=mode, cutoff_from=source)
    row = cutoff_frame(weekly_index(bars, mode), cfg).first()
    found = find_cutoffs(bars, cfg).cutoffs
    assert found == FixedCutoffs(row["test_start"], row["holdout_start"], row["holdout_end"])


def test_no_bars_no_rows(make_bars):
    none = make_bars([("other", "2018-01-01", 1.0)])
    assert find_cutoffs(none.limit(0), CFG) == CFG
    assert build_features(none, CFG).count() == 0
    assert build_features(none, CFG, splits=("test",)).count() == 0


def weeks_of(df, split):
    return {r["week_key"] for r in df.where(F.col("split") == split).collect()}


def test_periods_are_apart_and_the_newest_week_is_in_none(six_weeks):
    df = build_features(six_weeks, CFG)
    assert weeks_of(df, "train") == {201801, 201802}
    assert weeks_of(df, "test") == {201803, 201804}
    assert weeks_of(df, "holdout") == {201805}
    last = build_features(six_weeks, replace(CFG, include_last_week=True))
    assert weeks_of(last, "holdout") == {201805, 201806}


def test_rows_per_split(six_weeks):
    df = build_features(six_weeks, CFG)
    n = {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}
    assert n == {"train": 2 * 2 * 2, "test": 2 * 2 * 2 * 4, "holdout": 2 * 2 * 1 * 4}


@pytest.mark.parametrize("split", ["train", "test", "holdout"])
def test_one_split_alone_is_the_same(six_weeks, split):
    whole = build_features(six_weeks, CFG).where(F.col("split") == split)
    alone = build_features(six_weeks, CFG, splits=(split,))
    assert sorted(map(str, whole.collect())) == sorted(map(str, alone.collect()))


def test_ids_scale_and_text(six_weeks):
    rows = build_features(six_weeks, CFG).collect()
    for r in rows:
        assert r["cat"] == [CFG.columns.index(r["column"]), CFG.instruments.index(r["instrument"])]
        assert r["target"][0] == 0.0
        assert r["target"][1] == (10.0 if r["instrument"] == "usdjpy" else 1000.0) / 8
        datetime.strptime(r["start"], "%Y-%m-%d %H:%M:%S")


def test_scale_of_a_column_wins(six_weeks):
    cfg = replace(CFG, scale_overrides={("close", "usdjpy"): 1.0, "usdjpy": 10.0})
    seconds = {
        (r["instrument"], r["column"]): r["target"][1] for r in build_features(six_weeks, cfg).collect()
    }
    assert seconds[("usdjpy", "close")] == 0.125 and seconds[("usdjpy", "open")] == 1.25
    assert seconds[("a", "close")] == 125.0


def test_given_dates_replace_found_ones(six_weeks):
    given = FixedCutoffs(datetime(2018, 1, 8), datetime(2018, 1, 15), datetime(2018, 1, 22))
    df = build_features(six_weeks, replace(CFG, cutoffs=given))
    assert [weeks_of(df, s) for s in ("train", "test", "holdout")] == [{201801}, {201802}, {201803}]


def test_same_rows_with_other_partitions(spark, six_weeks):
    expected = sorted(map(str, build_features(six_weeks, CFG).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = build_features(six_weeks.repartition(5), CFG)
        assert sorted(map(str, again.collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_bars_with_zoned_times_give_the_same_rows_in_gmt(six_weeks):
    zoned = six_weeks.withColumn("ts", F.col("ts").cast("timestamp"))
    for splits in (("train", "test", "holdout"), ("holdout",)):
        expected = build_features(six_weeks, CFG, splits).collect()
        assert sorted(map(str, build_features(zoned, CFG, splits).collect())) == sorted(map(str, expected))


def test_dates_of_one_split_reach_the_scan(spark, six_weeks, tmp_path):
    six_weeks.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    frame = build_features(stored, CFG, ("holdout",))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = frame._jdf.queryExecution().explainString(mode)
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert len(pushed) == len(read) == 1
    assert "GreaterThanOrEqual(ts,2018-01-29T00:00)" in pushed[0] and "LessThan(ts," in pushed[0]
    assert "volume" not in read[0] and "high" not in read[0]


def test_series_are_built_with_one_shuffle(spark, six_weeks, tmp_path):
    six_weeks.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    plan = weekly_series(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_another_seed_samples_other_windows(six_weeks):
    a = build_features(six_weeks, CFG, ("test",)).select("start_index").collect()
    b = build_features(six_weeks, replace(CFG, seed=7), ("test",)).select("start_index").collect()
    assert a != b


def test_walk_through_keeps_raw_prices_of_one_column(six_weeks):
    cfg = walk_through_config("a", length=5, n_tests=3, holdout_weeks=2, test_weeks=2, series_limit=1)
    rows = build_features(six_weeks, cfg).collect()
    train = [r for r in rows if r["split"] == "train"]
    assert len(train) == 1 and train[0]["target"][0] == 1.0 and train[0]["cat"] == [0, 0]
    assert len([r for r in rows if r["split"] == "test"]) == 3


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_a_second_run_doubles_nothing(spark, six_weeks, tmp_path, fmt):
    df = build_features(six_weeks, CFG)
    for _ in range(2):
        write_features(df, str(tmp_path), ROW_KEY, CFG.seed, fmt=fmt)
    assert spark.read.format(fmt).load(str(tmp_path)).count() == df.count()
    only = df.where("split = 'test'")
    write_features(only, str(tmp_path), ROW_KEY, CFG.seed, fmt=fmt)
    assert spark.read.format(fmt).load(str(tmp_path)).count() == df.count()
    write_features(only, str(tmp_path), ROW_KEY, CFG.seed, fmt=fmt, mode="append")
    assert spark.read.format(fmt).load(str(tmp_path)).count() == df.count() + only.count()


def test_files_hold_rows_in_hash_order(spark, six_weeks, tmp_path):
    df = build_features(six_weeks, CFG)
    write_features(df, str(tmp_path), ROW_KEY, CFG.seed)
    hashes = {
        json.dumps([r["cat"], r["start"], r["target"]]): hashlib.md5(
            ":".join(str(v) for v in [CFG.seed, *[r[k] for k in ROW_KEY]]).encode()
        ).hexdigest()
        for r in df.collect()
    }
    files = glob.glob(f"{tmp_path}/split=*/*.json")
    assert files
    for name in files:
        lines = [json.loads(line) for line in open(name)]
        order = [hashes[json.dumps([x["cat"], x["start"], x["target"]])] for x in lines]
        assert order == sorted(order)


def test_stored_rows_read_back(spark, six_weeks, tmp_path):
    df = build_features(six_weeks, CFG)
    write_features(df, str(tmp_path), ROW_KEY, CFG.seed)
    rows = read_feature_rows(spark, f"{tmp_path}/split=holdout")
    expected = model_rows(df).where("split = 'holdout'").drop("split")
    assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))


def test_sql_functions(spark, six_weeks):
    register_sql_functions(spark, seed=1)
    features_table(weekly_series(six_weeks)).createOrReplaceTempView("features")
    rows = spark.sql(
        """
        SELECT size(tests) AS n, test.ts_start AS at, ts_start,
            to_delta(test.target, 'usdjpy') AS d, to_delta(array(), 'x') AS e,
            to_delta(array(CAST(NULL AS DOUBLE), 2D, 3D), 'x') AS g
        FROM (SELECT ts_start, create_tests(instrument, ts_start, close, 5, 100) AS tests FROM features)
        LATERAL VIEW explode(tests) t AS test
        """
    ).collect()
    assert len(rows) == 12 * 15 and {r["n"] for r in rows} == {15}
    assert all(r["d"][:2] == [0.0, 1.25] and r["e"] == [] and r["g"] == [None, 0.0, 1000.0] for r in rows)
    assert {(r["at"] - r["ts_start"]).seconds // 60 for r in rows} == set(range(15))


def test_table_function_samples_as_the_feature_job_does(spark, six_weeks):
    cfg = FeatureConfig(instruments=CFG.instruments, n_tests=4, length=5, seed=7, window_start="fixed_step")
    register_sql_functions(spark, seed=7)
    long_series(weekly_series(six_weeks), cfg.columns).drop("times").createOrReplaceTempView("series")
    found = spark.sql(
        """
        SELECT s.instrument, s.week_key, s.column_id, s.column, w.start_index, w.ts_start AS start_ts, w.target
        FROM series s, LATERAL test_windows(concat_ws(':', s.instrument, s.column, s.week_key), s.ts_start, s.values, 5, 4) w
        """
    ).collect()
    want = sample_windows(weekly_series(six_weeks), cfg).collect()
    assert Counter(map(str, (tuple(r) for r in found))) == Counter(map(str, (tuple(r) for r in want)))
    picked = {}
    for r in found:
        picked.setdefault((r.instrument, r.week_key, r.column), set()).add(r.start_index)
    # Series of one week, which all start at the same time, are sampled at different places.
    assert len({frozenset(v) for v in picked.values()}) > len(picked) // 2


def test_titles_keep_rows_with_unknown_ids(spark):
    df = spark.createDataFrame([([3, 2], "t"), ([9, 0], "u")], "cat array<int>, start string")
    got = {r["start"]: r["title"] for r in with_titles(df).collect()}
    assert got == {"t": "usdjpy low t", "u": "audusd u"}


@pytest.mark.parametrize(
    "bad", [{"week_mode": "x"}, {"nulls": "x"}, {"window_start": "x"}, {"length": 0}, {"n_tests": -1}]
)
def test_bad_settings_are_refused(bad):
    with pytest.raises(ValueError):
        FeatureConfig(**bad)
