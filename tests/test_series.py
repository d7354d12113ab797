"""Time parsing, week keys and weekly series."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions.timekeys import parse_bar_time, week_key, week_start
from tickloom.operators.series import (
    features_table,
    first_series,
    long_series,
    series_stats,
    weekly_index,
    weekly_series,
)
from tickloom.sources.bars import read_bar_files, read_bars, rejected, standardize, to_bars

YEAR_ENDS = ["2017-01-01", "2018-01-01", "2018-12-31", "2019-01-01"]


@pytest.mark.parametrize(
    "mode, keys",
    [
        ("iso", [201652, 201801, 201901, 201901]),
        ("year_major", [201752, 201801, 201801, 201901]),
        ("week_major", [522017, 12018, 12018, 12019]),
    ],
)
def test_week_keys_at_year_ends(spark, mode, keys):
    days = spark.createDataFrame([(d,) for d in YEAR_ENDS], "d string")
    rows = days.select("d", week_key(F.col("d").cast("timestamp_ntz"), mode).alias("k")).collect()
    assert [r["k"] for r in sorted(rows)] == keys


def test_unknown_week_mode_is_refused(spark):
    with pytest.raises(ValueError):
        week_key(F.col("t"), "lunar")


def test_week_start_is_monday(spark):
    row = spark.sql("SELECT timestamp_ntz'2019-01-06 23:59:59' AS t").select(week_start(F.col("t")))
    assert row.first()[0] == datetime(2018, 12, 31)


@pytest.mark.parametrize("with_zone", [True, False])
def test_bar_times(spark, with_zone):
    texts = ["03.11.2019 01:30:00.123", "31.02.2019 00:00:00.000", "2019-11-03", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "Time string")
    got = [r[0] for r in df.select(parse_bar_time(F.col("Time"), with_zone)).collect()]
    assert got == [datetime(2019, 11, 3, 1, 30, 0, 123000), None, None, None, None]


def test_hours_the_session_zone_lacks_are_kept(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = other.createDataFrame([("10.03.2019 02:30:00.000",)], "Time string")
    both = df.select(parse_bar_time(F.col("Time")), parse_bar_time(F.col("Time"), False)).first()
    assert list(both) == [datetime(2019, 3, 10, 2, 30)] * 2


def test_bar_files_name_their_instrument(spark, tmp_path):
    header = "Gmt time,Open,High,Low,Close,Volume\n"
    (tmp_path / "audusd_1m.csv").write_text(header + "01.01.2018 00:00:00.000,1,2,0.5,1.5,10\n")
    (tmp_path / "usdjpy_1m_partial.csv").write_text(
        header + "01.01.2018 00:01:00.000,3,4,2.5,3.5,20\nnonsense,1,1,1,1,1\n"
    )
    raw = read_bar_files(spark, str(tmp_path / "*_1m*.csv"))
    assert raw.columns == ["Time", "Open", "High", "Low", "Close", "Volume", "instrument"]
    bad = rejected(standardize(raw)).collect()
    assert [r["Time"] for r in bad] == ["nonsense"]
    bars = {r["instrument"]: r for r in read_bars(spark, str(tmp_path)).collect()}
    assert set(bars) == {"audusd", "usdjpy"}
    assert bars["usdjpy"]["ts"] == datetime(2018, 1, 1, 0, 1) and bars["usdjpy"]["low"] == 2.5
    assert to_bars(standardize(raw)).count() == 2


def test_lists_are_in_time_order_however_rows_are_spread(spark, make_bars):
    rows = [("a", f"2018-01-0{1 + i % 5}T{i % 24:02d}:00:00", float(i)) for i in range(120)]
    bars = make_bars(rows).repartition(8, F.rand(1))
    points = weekly_series(bars).first()["points"]
    assert [p["ts"] for p in points] == sorted(p["ts"] for p in points)
    assert len(points) == 120


def test_equal_times_are_all_kept_in_a_fixed_order(spark, make_bars):
    bars = make_bars([("a", "2018-01-01", 2.0), ("a", "2018-01-01", 1.0), ("a", "2018-01-01", 1.0)])
    assert [p["close"] for p in weekly_series(bars).first()["points"]] == [1.0, 1.0, 2.0]


def test_a_missing_value_moves_no_other_column(spark, make_bars):
    bars = make_bars([("a", f"2018-01-0{d}", float(d)) for d in (1, 2, 3)])
    gap = bars.withColumn("volume", F.when(F.col("ts") != "2018-01-02", F.col("volume")))
    dropped = features_table(weekly_series(gap)).first()
    assert dropped["close"] == [1.0, 2.0, 3.0] and dropped["volume"] == [1.0, 3.0]
    kept = features_table(weekly_series(gap), nulls="keep").first()
    assert kept["volume"] == [1.0, None, 3.0]
    long = {r["column"]: r for r in long_series(weekly_series(gap)).collect()}
    assert long["volume"]["times"] == [datetime(2018, 1, 1), datetime(2018, 1, 3)]
    assert long["open"]["values"] == [1.0, 2.0, 3.0]


def test_rows_without_a_time_make_no_series(spark, make_bars):
    bars = make_bars([("a", "2018-01-01", 1.0)])
    lost = bars.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert weekly_series(lost).count() == 0 and weekly_index(bars.union(lost)).count() == 1


def test_stats_and_index_agree_with_the_series(spark, make_bars):
    rows = [("a", f"2018-01-{d:02d}", 1.0) for d in range(1, 20)] + [("b", "2018-01-09", 1.0)]
    bars = make_bars(rows)
    stats = series_stats(weekly_index(bars)).first()
    sizes = [len(r["points"]) for r in weekly_series(bars).collect()]
    assert (stats["min_cnt"], stats["max_cnt"]) == (min(sizes), max(sizes)) == (1, 7)
    assert stats["min_date"] == datetime(2018, 1, 1) and stats["max_date"] == datetime(2018, 1, 15)


def test_oldest_series_first(spark, make_bars):
    bars = make_bars([(i, f"2018-0{m}-01", 1.0) for i in "ba" for m in (3, 1, 2)])
    got = [(r["instrument"], r["ts_start"].month) for r in first_series(weekly_index(bars), 3).collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2)]
