"""The given tables in the shapes the jobs read, as DataFrames and as SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.config import FeatureConfig
from tickloom.functions.timekeys import start_text

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LINE_KINDS = ("AF", "AO", "NF", "NO", "RF", "RO")

ORDER_CONFIG = FeatureConfig(
    instruments=PRIORITIES,
    n_tests=2,
    length=3,
    scale=1000.0,
    scale_overrides={"2-HIGH": 10.0},
)
# Prices in thousands keep sums exact far beyond the digits that are compared.
LINE_CONFIG = FeatureConfig(
    instruments=LINE_KINDS,
    columns=("open", "close"),
    n_tests=2,
    length=5,
    scale=0.001,
    scale_overrides={},
)
# Windows of order bars whose kinds are partly never fitted.
BACKOFF_CONFIG = replace(ORDER_CONFIG, n_tests=2, length=4, scale=0.001, scale_overrides={})
BACKOFF_CONTEXT = 2
CONTEXT_LEN = 3
QUANTILES = ("0.1", "0.5", "0.9")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of order prices; the priority is the instrument."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("instrument"), F.col("o_orderdate").alias("ts"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


ORDER_BARS = """
bars AS (
    SELECT o_orderpriority AS instrument, o_orderdate AS ts,
        arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
        min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
        CAST(count(*) AS DOUBLE) AS volume
    FROM orders GROUP BY 1, 2)"""


def line_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of line prices; return flag and status are the instrument."""
    price = F.col("l_extendedprice")
    net = price * (1 - F.col("l_discount"))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat("l_returnflag", "l_linestatus").alias("instrument"),
            F.col("l_shipdate").alias("ts"),
        )
        .agg(
            F.min(net).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(net).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
    )


LINE_BARS = """
bars AS (
    SELECT l_returnflag || l_linestatus AS instrument, l_shipdate AS ts,
        min(l_extendedprice * (1 - l_discount)) AS open, max(l_extendedprice) AS high,
        min(l_extendedprice) AS low, max(l_extendedprice * (1 - l_discount)) AS close,
        sum(l_quantity) AS volume
    FROM lineitem GROUP BY 1, 2)"""


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-minute bars of event values; the event type is the instrument.

    However many events there are, a week of one type has at most 10,080 such bars.
    """
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("instrument"), F.window("ts", "1 minute").alias("w"))
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
        .select("instrument", F.col("w.start").alias("ts"), "open", "high", "low", "close", "volume")
    )


MINUTE_BARS = """
bars AS (
    SELECT event_type AS instrument, date_trunc('minute', ts) AS ts,
        arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
        arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
    FROM events GROUP BY 1, 2)"""


WEEK_SQL = {
    "iso": "isoyear(ts) * 100 + week(ts)",
    "year_major": "year(ts) * 100 + week(ts)",
    "week_major": "week(ts) * 10000 + year(ts)",
}


def series_sql(bars: str, cfg: FeatureConfig) -> str:
    """Common table expressions from bars to sampled windows, written with joins and windows.

    keyed: bars with week; idx: series with start and size; cut: one row of dates; ser: series with
    split; cols: value columns; pts: one row per series, column and position; win: one row per
    sampled window and position.
    """
    cols = ", ".join(f"({i}, '{c}')" for i, c in enumerate(cfg.columns))
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(cfg.instruments))
    pick = " ".join(f"WHEN '{c}' THEN {c}" for c in cfg.columns)
    back = 7 * (cfg.holdout_weeks - 1)
    scale = " ".join(f"WHEN '{k}' THEN {v}" for k, v in cfg.scale_overrides.items())
    newest = f"WHERE instrument = '{cfg.cutoff_from}'" if cfg.cutoff_from else ""
    after = 1 if cfg.include_last_week else 0
    spare = 1 if cfg.include_last_window else 0
    begin = "o.ts" if cfg.window_start == "point" else "s.ts_start + to_minutes(s.start_index)"
    factor = f"CASE p.instrument {scale} ELSE {cfg.scale} END" if scale else f"{cfg.scale}"
    return f"""
WITH {bars.strip()},
keyed AS (SELECT *, {WEEK_SQL[cfg.week_mode]} AS week_key FROM bars),
idx AS (
    SELECT instrument, week_key, min(ts) AS ts_start, count(*) AS n FROM keyed GROUP BY 1, 2),
cut AS (
    SELECT date_trunc('day', max(ts_start)) + INTERVAL {after} DAY AS holdout_end,
        date_trunc('day', max(ts_start)) - INTERVAL {back} DAY AS holdout_start,
        date_trunc('day', max(ts_start)) - INTERVAL {back + 7 * cfg.test_weeks} DAY AS test_start,
        min(ts_start) AS min_date, max(ts_start) AS max_date
    FROM idx {newest}),
ser AS (
    SELECT idx.*, CASE WHEN ts_start < test_start THEN 'train'
        WHEN ts_start < holdout_start THEN 'test'
        WHEN ts_start < holdout_end THEN 'holdout' END AS split
    FROM idx CROSS JOIN cut),
cols AS (
    SELECT CAST(i AS BIGINT) AS column_id, c AS value_column FROM (VALUES {cols}) t(i, c)),
names AS (
    SELECT CAST(i AS BIGINT) AS instrument_id, c AS instrument FROM (VALUES {names}) t(i, c)),
pts AS (
    SELECT instrument, week_key, column_id, value_column, ts,
        row_number() OVER (
            PARTITION BY instrument, week_key, column_id ORDER BY ts) - 1 AS pos,
        CAST(CASE value_column {pick} END AS DOUBLE) AS v
    FROM keyed CROSS JOIN cols),
cand AS (
    SELECT instrument, week_key, split, ts_start, column_id, value_column,
        unnest(range(0, n - {cfg.length} + {spare})) AS start_index
    FROM ser CROSS JOIN cols),
starts AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY instrument, week_key, column_id
            ORDER BY md5('{cfg.seed}:' || instrument || ':' || value_column || ':' || week_key
                || ':' || start_index)) AS r
        FROM cand)
    WHERE r <= {cfg.n_tests}),
win AS (
    SELECT s.split, s.instrument, s.week_key, s.column_id, s.value_column, s.start_index,
        {begin} AS start_ts, p.pos - s.start_index AS pos, p.v,
        (p.v - o.v) * {factor} AS delta
    FROM starts s
    JOIN pts o ON o.instrument = s.instrument AND o.week_key = s.week_key
        AND o.column_id = s.column_id AND o.pos = s.start_index
    JOIN pts p ON p.instrument = s.instrument AND p.week_key = s.week_key
        AND p.column_id = s.column_id
        AND p.pos BETWEEN s.start_index AND s.start_index + {cfg.length - 1}),
whole AS (
    SELECT s.split, s.instrument, s.week_key, p.column_id, p.value_column,
        CAST(0 AS BIGINT) AS start_index, s.ts_start AS start_ts, p.pos, p.v,
        (p.v - o.v) * {factor} AS delta
    FROM ser s
    JOIN pts p ON p.instrument = s.instrument AND p.week_key = s.week_key
    JOIN pts o ON o.instrument = p.instrument AND o.week_key = p.week_key
        AND o.column_id = p.column_id AND o.pos = 0)
"""


ORDER_SERIES = series_sql(ORDER_BARS, ORDER_CONFIG)
PARITY_CONFIG = replace(
    ORDER_CONFIG, week_mode="week_major", cutoff_from=PRIORITIES[0], window_start="fixed_step"
)
INCLUSIVE_CONFIG = replace(ORDER_CONFIG, include_last_week=True, include_last_window=True, scale=1.0)
EVENT_CONFIG = FeatureConfig(
    instruments=EVENT_TYPES, test_weeks=1, holdout_weeks=2, n_tests=20, length=60
)
EVENT_SERIES = series_sql(MINUTE_BARS, EVENT_CONFIG)
BACKOFF_SERIES = series_sql(ORDER_BARS, BACKOFF_CONFIG)
LINE_SERIES = series_sql(LINE_BARS, LINE_CONFIG)

TS_TEXT = "%Y-%m-%d %H:%M:%S"


def ts_text(c: str | Column) -> Column:
    return start_text(F.col(c) if isinstance(c, str) else c)


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and times as text, the types the SQL side returns."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = ts_text(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def spread(df: DataFrame, *keys: str, values: str = "target", value: str = "value") -> DataFrame:
    """One row per element of an array, with its position."""
    return df.select(*keys, F.posexplode(values).alias("pos", value))
