"""Series, splits, windows and feature rows, over orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.standins import (
    EVENT_CONFIG,
    EVENT_SERIES,
    EVENT_TYPES,
    INCLUSIVE_CONFIG,
    LINE_CONFIG,
    LINE_SERIES,
    MINUTE_BARS,
    ORDER_BARS,
    ORDER_CONFIG,
    ORDER_SERIES,
    PARITY_CONFIG,
    TS_TEXT,
    line_bars,
    minute_bars,
    order_bars,
    series_sql,
    spread,
    table,
    tidy,
)
from tickloom.config import FeatureConfig
from tickloom.functions.arrays import to_delta
from tickloom.functions.sql import register_sql_functions
from tickloom.functions.timekeys import WEEK_MODES, week_key
from tickloom.operators.chunks import chunked_series, numbered_points, windows_over_chunks
from tickloom.operators.lookups import with_titles
from tickloom.operators.ordering import union_sets
from tickloom.operators.series import (
    features_table,
    first_series,
    long_series,
    series_stats,
    weekly_index,
    weekly_series,
)
from tickloom.operators.splits import Cutoffs, assign_split, bars_of_split, cutoff_frame
from tickloom.operators.windows import sample_windows, too_short
from tickloom.plans.features import ROW_KEY, build_features, walk_through_config
from tickloom.session import new_folder
from tickloom.sinks.write import write_features, write_shuffled
from tickloom.sources.files import read_split

COLS = ("open", "close", "high", "low", "volume")


def week_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    keys = [week_key(F.col("o_orderdate"), m).alias(m) for m in WEEK_MODES]
    return tidy(orders.select("o_orderkey", *keys))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = weekly_series(order_bars(spark, sf_dir))
    points = series.select(
        "instrument", "week_key", "ts_start", F.posexplode("points").alias("pos", "p")
    )
    return tidy(points.select("instrument", "week_key", "ts_start", "pos", "p.*"))


def long_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = long_series(weekly_series(order_bars(spark, sf_dir)))
    points = series.select(
        "instrument",
        "week_key",
        "column_id",
        F.col("column").alias("value_column"),
        F.posexplode(F.arrays_zip(F.col("times").alias("ts"), F.col("values").alias("v"))).alias("pos", "p"),
    )
    return tidy(
        points.select("instrument", "week_key", "column_id", "value_column", "pos", "p.*")
    )


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(series_stats(weekly_index(order_bars(spark, sf_dir))))


def cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = cutoff_frame(weekly_index(order_bars(spark, sf_dir)), ORDER_CONFIG)
    days = [
        F.to_date(c).alias(f"{c}_day")
        for c in ("min_date", "test_start", "holdout_start", "holdout_end")
    ]
    return tidy(frame.select("*", *days))


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = order_bars(spark, sf_dir)
    index = weekly_index(bars)
    return tidy(assign_split(index, Cutoffs.of(bars, ORDER_CONFIG)))


def delta_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = weekly_series(order_bars(spark, sf_dir), columns=("close",))
    factor = F.when(F.col("instrument") == "2-HIGH", 10.0).otherwise(1000.0)
    deltas = to_delta(F.col("points").getField("close"), factor)
    rows = series.select("instrument", "week_key", deltas.alias("target"))
    return tidy(spread(rows, "instrument", "week_key"))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = weekly_series(order_bars(spark, sf_dir), columns=ORDER_CONFIG.columns)
    found = sample_windows(series, ORDER_CONFIG).withColumnRenamed("column", "value_column")
    return tidy(
        spread(found, "instrument", "week_key", "column_id", "value_column", "start_index", "start_ts")
    )


def short_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = weekly_index(order_bars(spark, sf_dir))
    return tidy(too_short(index, ORDER_CONFIG.length))


_FEATURE_KEYS = ("split", "instrument", "value_column", "week_key", "start_index", "start")


def _feature_values(features: DataFrame) -> DataFrame:
    named = features.withColumnRenamed("column", "value_column")
    cats = named.withColumn("cat_column", F.col("cat")[0]).withColumn("cat_instrument", F.col("cat")[1])
    return tidy(spread(cats, *_FEATURE_KEYS, "cat_column", "cat_instrument"))


def one_split(split: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _feature_values(
            build_features(order_bars(spark, sf_dir), ORDER_CONFIG, splits=(split,))
        )

    return query


def split_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = order_bars(spark, sf_dir)
    return tidy(bars_of_split(bars, Cutoffs.of(bars, ORDER_CONFIG), "holdout"))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_values(build_features(order_bars(spark, sf_dir), ORDER_CONFIG))


def line_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_values(build_features(line_bars(spark, sf_dir), LINE_CONFIG))


def minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(minute_bars(spark, sf_dir))


def minute_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feature_values(build_features(minute_bars(spark, sf_dir), EVENT_CONFIG))


def with_config(cfg: FeatureConfig):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _feature_values(build_features(order_bars(spark, sf_dir), cfg))

    return query


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order bars without a volume on days with a single order."""
    bars = order_bars(spark, sf_dir)
    return bars.withColumn("volume", F.when(F.col("volume") > 1, F.col("volume")))


def _gap_lists(nulls: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lists = features_table(weekly_series(_gaps(spark, sf_dir)), ("close", "volume"), nulls)
        sized = lists.withColumn("n_close", F.size("close"))
        return tidy(spread(sized, "instrument", "week_key", "n_close", values="volume"))

    return query


SMALL_CHUNK = 2


def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of length 5 from chunks of 2 points."""
    chunks = chunked_series(numbered_points(line_bars(spark, sf_dir), LINE_CONFIG, 3 * 86_400), SMALL_CHUNK)
    found = windows_over_chunks(chunks, LINE_CONFIG, SMALL_CHUNK)
    return tidy(spread(found, "instrument", "column", "week_key", "start_index", "start_ts"))


def tick_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks, delivered twice, in chunks of 100: size, repeats and a checksum of each chunk."""
    events = table(spark, sf_dir, "events")
    ticks = events.unionByName(events).select(F.col("event_type").alias("instrument"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), F.col("value").alias("close"))
    cfg = FeatureConfig(instruments=EVENT_TYPES, columns=("close",))
    chunks = chunked_series(numbered_points(ticks, cfg), 100)
    return tidy(
        chunks.select(
            "instrument", "week_key", "chunk", F.size("values").alias("n_points"), "n_repeats",
            F.get("times", F.lit(0)).alias("first"), F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 3).alias("total"),
        )
    )


def walk_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = walk_through_config("3-MEDIUM", length=3, n_tests=2)
    return _feature_values(build_features(order_bars(spark, sf_dir), cfg))


def united(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = order_bars(spark, sf_dir)
    index = weekly_index(bars)
    cut = Cutoffs.of(bars, ORDER_CONFIG)
    sets = [assign_split(index, cut).where(F.col("split") == s) for s in ("train", "test", "holdout")]
    return tidy(union_sets(None, *sets))


SHUFFLE_PARTS = 8


def shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole orders written in random order and read back, with their file and place in it."""
    folder = new_folder(spark, "shuffled")
    write_shuffled(table(spark, sf_dir, "orders"), folder, 42, SHUFFLE_PARTS, ["o_orderkey"])
    rows = spark.read.parquet(folder).select(
        F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int").alias("file"),
        F.col("_metadata.row_index").alias("place"),
        "*",
    )
    return tidy(rows)


def oldest_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(first_series(weekly_index(order_bars(spark, sf_dir)), 100))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = build_features(order_bars(spark, sf_dir), ORDER_CONFIG)
    named = with_titles(
        rows.select("split", "cat", "start", "week_key", "start_index"),
        ORDER_CONFIG.instruments,
        ORDER_CONFIG.columns,
    )
    return tidy(named.select("split", "title", "column_id", "instrument_id", "week_key", "start_index"))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of all series and columns, by table function and by list, raw and as changes."""
    register_sql_functions(spark)
    long = long_series(weekly_series(order_bars(spark, sf_dir)), ORDER_CONFIG.columns)
    long.drop("times", "column_id").createOrReplaceTempView("series")
    return tidy(
        spark.sql(
            """
            SELECT instrument, value_column, week_key, start_index, start_ts, pos, value, listed
            FROM (
                SELECT s.instrument, s.column AS value_column, s.week_key, w.start_index, w.ts_start AS start_ts,
                    to_delta(w.target, 'usdjpy') AS delta,
                    exists(
                        create_tests(concat_ws(':', s.instrument, s.column, s.week_key), s.ts_start, s.values, 3, 2),
                        t -> t = struct(w.start_index, w.ts_start, w.target)) AS listed
                FROM series s,
                    LATERAL test_windows(concat_ws(':', s.instrument, s.column, s.week_key), s.ts_start, s.values, 3, 2) w)
            LATERAL VIEW posexplode(delta) v AS pos, value
            """
        )
    )


def _round_trip(fmt: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, f"features-{fmt}")
        features = build_features(order_bars(spark, sf_dir), ORDER_CONFIG)
        for _ in range(2):
            write_features(features, folder, ROW_KEY, ORDER_CONFIG.seed, fmt=fmt)
        rows = union_sets(*[read_split(spark, folder, split, fmt) for split in ("train", "test", "holdout")])
        cats = rows.withColumn("cat_column", F.col("cat")[0]).withColumn(
            "cat_instrument", F.col("cat")[1]
        )
        return tidy(spread(cats, "split", "start", "cat_column", "cat_instrument"))

    return query


QUERIES = {
    "week_key": week_keys,
    "weekly_series": weekly,
    "long_series": long_points,
    "series_stats": stats,
    "cutoffs": cutoffs,
    "split_assign": split_assign,
    "split_bars": split_bars,
    "delta_scale": delta_scale,
    "window_sample": windows,
    "short_series": short_series,
    "train_set": one_split("train"),
    "test_set": one_split("test"),
    "holdout_set": one_split("holdout"),
    "feature_rows": feature_rows,
    "line_feature_rows": line_feature_rows,
    "minute_bars": minutes,
    "minute_features": minute_features,
    "parity_features": with_config(PARITY_CONFIG),
    "inclusive_features": with_config(INCLUSIVE_CONFIG),
    "lists_without_gaps": _gap_lists("drop"),
    "lists_with_gaps": _gap_lists("keep"),
    "walk_through_features": walk_through,
    "chunk_windows": chunk_windows,
    "tick_series": tick_series,
    "union_sets": united,
    "shuffle_rows": shuffled,
    "top_n_series": oldest_series,
    "title_lookup": titles,
    "sql_functions": sql_functions,
    "parquet_roundtrip": _round_trip("parquet"),
    "json_roundtrip": _round_trip("json"),
}


def _text(c: str, name: str | None = None) -> str:
    return f"strftime({c}, '{TS_TEXT}') AS {name or c}"


_ALL_COLS = ", ".join(f"({i}, '{c}')" for i, c in enumerate(COLS))

_FEATURES = """
SELECT f.split, f.instrument, f.value_column, f.week_key, f.start_index,
    strftime(f.start_ts, '%Y-%m-%d %H:%M:%S') AS start,
    f.column_id AS cat_column, n.instrument_id AS cat_instrument, f.pos, f.delta AS value
FROM (
    SELECT * FROM whole WHERE split = 'train'
    UNION ALL SELECT * FROM win WHERE split IN ('test', 'holdout')) f
JOIN names n ON n.instrument = f.instrument
"""

_GAPS = f"""
WITH {ORDER_BARS.strip()},
gaps AS (
    SELECT instrument, isoyear(ts) * 100 + week(ts) AS week_key, ts,
        CASE WHEN volume > 1 THEN volume END AS volume,
        count(*) OVER (PARTITION BY instrument, isoyear(ts) * 100 + week(ts)) AS n_close
    FROM bars)
"""

_STORED = f"""
{ORDER_SERIES}
SELECT f.split, strftime(f.start_ts, '{TS_TEXT}') AS start, f.column_id AS cat_column,
    n.instrument_id AS cat_instrument, f.pos, f.delta AS value
FROM (
    SELECT * FROM whole WHERE split = 'train'
    UNION ALL SELECT * FROM win WHERE split IN ('test', 'holdout')) f
JOIN names n ON n.instrument = f.instrument
"""

ORACLES = {
    "week_key": """
        SELECT o_orderkey, isoyear(o_orderdate) * 100 + week(o_orderdate) AS iso,
            year(o_orderdate) * 100 + week(o_orderdate) AS year_major,
            week(o_orderdate) * 10000 + year(o_orderdate) AS week_major
        FROM orders""",
    "weekly_series": f"""
        {ORDER_SERIES}
        SELECT k.instrument, k.week_key, {_text('i.ts_start', 'ts_start')},
            row_number() OVER (PARTITION BY k.instrument, k.week_key ORDER BY k.ts) - 1 AS pos,
            {_text('k.ts', 'ts')}, k.open, k.close, k.high, k.low, k.volume
        FROM keyed k JOIN idx i ON i.instrument = k.instrument AND i.week_key = k.week_key""",
    "long_series": f"""
        WITH {ORDER_BARS.strip()}
        SELECT instrument, week_key, column_id, value_column,
            row_number() OVER (PARTITION BY instrument, week_key, column_id ORDER BY b.ts) - 1 AS pos,
            {_text('b.ts', 'ts')},
            CASE value_column WHEN 'open' THEN open WHEN 'close' THEN close WHEN 'high' THEN high
                WHEN 'low' THEN low ELSE volume END AS v
        FROM (SELECT *, isoyear(ts) * 100 + week(ts) AS week_key FROM bars) b
        CROSS JOIN (
            SELECT CAST(i AS BIGINT) AS column_id, c AS value_column
            FROM (VALUES {_ALL_COLS}) t(i, c))""",
    "series_stats": f"""
        {ORDER_SERIES}
        SELECT min(n) AS min_cnt, max(n) AS max_cnt, strftime(min(ts_start), '{TS_TEXT}') AS min_date,
            strftime(max(ts_start), '{TS_TEXT}') AS max_date FROM idx""",
    "cutoffs": f"""
        {ORDER_SERIES}
        SELECT {_text('min_date')}, {_text('max_date')}, {_text('test_start')},
            {_text('holdout_start')}, {_text('holdout_end')},
            strftime(min_date, '%Y-%m-%d') AS min_date_day,
            strftime(test_start, '%Y-%m-%d') AS test_start_day,
            strftime(holdout_start, '%Y-%m-%d') AS holdout_start_day,
            strftime(holdout_end, '%Y-%m-%d') AS holdout_end_day
        FROM cut""",
    "split_assign": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, {_text('ts_start')}, n AS n_points, split FROM ser""",
    "split_bars": f"""
        {ORDER_SERIES}
        SELECT instrument, {_text('ts')}, open, high, low, close, volume FROM bars CROSS JOIN cut
        WHERE ts >= date_trunc('week', holdout_start)
            AND ts < date_trunc('week', holdout_end) + INTERVAL 7 DAY""",
    "delta_scale": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, pos, delta AS value FROM whole WHERE value_column = 'close'""",
    "window_sample": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, column_id, value_column, start_index,
            {_text('start_ts')}, pos, v AS value FROM win""",
    "short_series": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, {_text('ts_start')}, n AS n_points
        FROM idx WHERE n <= {ORDER_CONFIG.length}""",
    "train_set": f"{ORDER_SERIES} SELECT * FROM ({_FEATURES}) WHERE split = 'train'",
    "test_set": f"{ORDER_SERIES} SELECT * FROM ({_FEATURES}) WHERE split = 'test'",
    "holdout_set": f"{ORDER_SERIES} SELECT * FROM ({_FEATURES}) WHERE split = 'holdout'",
    "feature_rows": f"{ORDER_SERIES} {_FEATURES}",
    "line_feature_rows": f"{LINE_SERIES} {_FEATURES}",
    "minute_bars": f"""
        WITH {MINUTE_BARS.strip()}
        SELECT instrument, {_text('ts')}, open, high, low, close, volume FROM bars""",
    "minute_features": f"{EVENT_SERIES} {_FEATURES}",
    "parity_features": f"{series_sql(ORDER_BARS, PARITY_CONFIG)} {_FEATURES}",
    "inclusive_features": f"{series_sql(ORDER_BARS, INCLUSIVE_CONFIG)} {_FEATURES}",
    "lists_without_gaps": f"""
        {_GAPS}
        SELECT instrument, week_key, n_close,
            row_number() OVER (PARTITION BY instrument, week_key ORDER BY ts) - 1 AS pos, volume AS value
        FROM gaps WHERE volume IS NOT NULL""",
    "lists_with_gaps": f"""
        {_GAPS}
        SELECT instrument, week_key, n_close,
            row_number() OVER (PARTITION BY instrument, week_key ORDER BY ts) - 1 AS pos, volume AS value
        FROM gaps""",
    "chunk_windows": f"""
        {LINE_SERIES}
        SELECT instrument, value_column AS "column", week_key, start_index, {_text('start_ts')}, pos, v AS value FROM win""",
    "tick_series": f"""
        WITH ticks AS (
            SELECT event_type AS instrument, date_trunc('second', ts) AS ts, value FROM events
            UNION ALL SELECT event_type, date_trunc('second', ts), value FROM events),
        numbered AS (
            SELECT *, isoyear(ts) * 100 + week(ts) AS week_key,
                row_number() OVER (PARTITION BY instrument, isoyear(ts) * 100 + week(ts) ORDER BY ts, value) - 1 AS pos,
                row_number() OVER (PARTITION BY instrument, ts ORDER BY value) > 1 AS again
            FROM ticks)
        SELECT instrument, week_key, pos // 100 AS chunk, count(*) AS n_points, count(*) FILTER (again) AS n_repeats,
            {_text('min(ts)', '"first"')}, round(sum(value ORDER BY pos), 3) AS total
        FROM numbered GROUP BY 1, 2, 3""",
    "walk_through_features": f"""
        WITH {ORDER_BARS.strip()},
        keyed AS (
            SELECT *, year(ts) * 100 + week(ts) AS week_key FROM bars WHERE instrument = '3-MEDIUM'),
        pts AS (
            SELECT *, row_number() OVER (PARTITION BY week_key ORDER BY ts) - 1 AS pos FROM keyed),
        idx AS (SELECT week_key, min(ts) AS ts_start, count(*) AS n FROM keyed GROUP BY 1),
        cut AS (SELECT date_trunc('day', max(ts_start)) AS e FROM idx),
        ser AS (
            SELECT *, CASE WHEN ts_start < e - INTERVAL 98 DAY THEN 'train'
                WHEN ts_start < e - INTERVAL 42 DAY THEN 'test'
                WHEN ts_start < e THEN 'holdout' END AS split
            FROM idx CROSS JOIN cut),
        kept AS (SELECT * FROM ser WHERE split IS NOT NULL),
        starts AS (
            SELECT split, week_key, ts_start, CAST(0 AS BIGINT) AS s, n AS size FROM kept
            WHERE split = 'train'
            UNION ALL
            SELECT split, week_key, ts_start, s, 3 FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY week_key ORDER BY md5('42:3-MEDIUM:close:' || week_key || ':' || s)) AS r
                FROM (SELECT *, unnest(range(0, n - 3)) AS s FROM kept WHERE split <> 'train'))
            WHERE r <= 2)
        SELECT x.split, '3-MEDIUM' AS instrument, 'close' AS value_column, x.week_key,
            x.s AS start_index,
            strftime(x.ts_start + to_minutes(x.s), '{TS_TEXT}') AS start,
            CAST(0 AS BIGINT) AS cat_column, CAST(0 AS BIGINT) AS cat_instrument,
            p.pos - x.s AS pos, p.close AS value
        FROM starts x JOIN pts p ON p.week_key = x.week_key
            AND p.pos >= x.s AND p.pos < x.s + x.size""",
    "union_sets": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, {_text('ts_start')}, n AS n_points, split
        FROM ser WHERE split IS NOT NULL""",
    "shuffle_rows": f"""
        WITH h AS (
            SELECT *, md5('42:' || o_orderkey || ':{{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
                || ',"o_orderstatus":"' || o_orderstatus || '","o_totalprice":' || o_totalprice
                || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') || '","o_orderpriority":"' || o_orderpriority || '"}}') AS h
            FROM orders),
        f AS (SELECT *, CAST(('0x' || substr(h, 1, 8)) AS BIGINT) * {SHUFFLE_PARTS} // 4294967296 AS file FROM h)
        SELECT * EXCLUDE (h) REPLACE (strftime(o_orderdate, '{TS_TEXT}') AS o_orderdate),
            row_number() OVER (PARTITION BY file ORDER BY h) - 1 AS place
        FROM f""",
    "top_n_series": f"""
        {ORDER_SERIES}
        SELECT instrument, week_key, {_text('s.ts_start', 'ts_start')}, n AS n_points
        FROM (SELECT * FROM idx ORDER BY ts_start, instrument, week_key LIMIT 100) s""",
    "title_lookup": f"""
        {ORDER_SERIES}
        SELECT w.split, w.instrument || ' ' || value_column || ' '
                || strftime(start_ts, '{TS_TEXT}') AS title,
            column_id, instrument_id, week_key, start_index
        FROM (
            SELECT DISTINCT split, instrument, value_column, column_id, week_key, start_index, start_ts
            FROM (SELECT * FROM whole WHERE split = 'train' UNION ALL SELECT * FROM win WHERE split IN ('test', 'holdout'))) w
        JOIN names n ON n.instrument = w.instrument""",
    "sql_functions": f"""
        {ORDER_SERIES}
        SELECT w.instrument, w.value_column, w.week_key, w.start_index,
            strftime(s.ts_start + to_minutes(w.start_index), '{TS_TEXT}') AS start_ts, w.pos, (w.v - o.v) * 10.0 AS value, true AS listed
        FROM win w
        JOIN idx s ON s.instrument = w.instrument AND s.week_key = w.week_key
        JOIN pts o ON o.instrument = w.instrument AND o.week_key = w.week_key AND o.column_id = w.column_id
            AND o.pos = w.start_index""",
    "parquet_roundtrip": _STORED,
    "json_roundtrip": _STORED,
}
