"""Readers and writers, over orders, events and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog.standins import EVENT_TYPES, ORDER_BARS, TS_TEXT, order_bars, table, tidy
from tickloom.functions import fixed
from tickloom.functions.timekeys import parse_bar_time
from tickloom.operators.series import features_table, weekly_series
from tickloom.session import new_folder
from tickloom.sinks.write import deal_out
from tickloom.sources.bars import bad_rows, good_rows, judged, read_bar_files, read_bars, rejected, standardize
from tickloom.sources.files import (
    first_usable_file,
    list_files,
    preview,
    read_images,
    register_view,
    small_enough,
)

# Pages stand in for images; their largest ones are left out at this size.
PAGE_BYTES = 8_000


def _bar_folder(spark: SparkSession, sf_dir: str) -> str:
    """Order bars as files named after their instrument."""
    folder = new_folder(spark, "bars")
    code = F.lower(F.regexp_replace("instrument", "[^A-Za-z0-9]+", "_"))
    rows = order_bars(spark, sf_dir).select(
        F.concat(code, F.lit("_1m.csv")).alias("file"),
        F.date_format("ts", fixed.BAR_TIME_PATTERN).alias("Gmt time"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
    )
    deal_out(rows, "file").write.partitionBy("file").option("header", True).csv(folder)
    return f"{folder}/file=*_1m.csv"


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(read_bar_files(spark, _bar_folder(spark, sf_dir)))


def csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(read_bars(spark, _bar_folder(spark, sf_dir)))


def _faulty_folder(spark: SparkSession, sf_dir: str) -> str:
    """Events as bar files, some with no time, no number, a column too many or one too few."""
    folder = new_folder(spark, "bars")
    kind = F.col("event_id") % 10
    number = F.col("value").cast("string")
    time = F.when(kind == 1, F.concat(F.lit("at "), "event_id")).otherwise(F.date_format("ts", fixed.BAR_TIME_PATTERN))
    open_ = F.when(kind.isin(1, 2), F.lit("oops")).when(kind == 3, F.lit("")).otherwise(number)
    volume = F.when(kind == 4, F.concat(number, F.lit(",7"))).when(kind != 5, number)
    line = F.concat_ws(",", time, open_, number, number, number, volume)
    events = table(spark, sf_dir, "events").select(F.concat("event_type", F.lit("_1m.csv")).alias("file"), line.alias("line"))
    head = spark.sql("SELECT explode(array('click', 'error', 'purchase', 'signup', 'view')) AS t").select(
        F.concat("t", F.lit("_1m.csv")).alias("file"), F.lit(",".join(fixed.BAR_COLUMNS)).alias("line")
    )
    lines = head.withColumn("k", F.lit(0)).unionByName(events.withColumn("k", F.lit(1)))
    lines.repartition("file").sortWithinPartitions("file", "k").drop("k").write.partitionBy("file").text(folder)
    return f"{folder}/file=*_1m.csv"


def rejected_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both outputs by instrument: bars, and rejected rows by reason."""
    rows = judged(read_bar_files(spark, _faulty_folder(spark, sf_dir), keep_corrupt=True))
    kept = good_rows(rows).groupBy("instrument").agg(
        F.count(F.lit(1)).alias("n"), F.count("open").alias("n_open"), F.round(F.sum("volume"), 3).alias("volume")
    )
    lost = bad_rows(rows).groupBy("instrument", "reason").agg(F.count(F.lit(1)).alias("n"), F.count("line").alias("n_lines"))
    return kept.withColumn("n_lines", F.lit(None).cast("long")).withColumn("reason", F.lit("")).unionByName(
        lost.withColumn("n_open", F.lit(None).cast("long")).withColumn("volume", F.lit(None).cast("double"))
    )


def named_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = weekly_series(order_bars(spark, sf_dir))
    register_view(features_table(series), "features")
    return tidy(
        spark.sql(
            "SELECT instrument, week_key, size(volume) AS n_points, ts_start, "
            "element_at(close, -1) AS last_close FROM features"
        )
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tidy(preview(table(spark, sf_dir, "orders"), 5, "o_orderdate", "o_orderkey"))


def first_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed times in ascending order."""
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", fixed.BAR_TIME_PATTERN).alias("Time")
    )
    return tidy(preview(standardize(raw), 5, "start", "event_id"))


def first_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series by week."""
    series = features_table(weekly_series(order_bars(spark, sf_dir)))
    sized = series.select("week_key", "instrument", "ts_start", F.size("close").alias("n_points"))
    return tidy(preview(sized, 5, "week_key", "instrument"))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.date_format("ts", fixed.BAR_TIME_PATTERN).alias("Time"),
    )
    both = standardize(raw).withColumn("plain", parse_bar_time(F.col("Time"), with_zone=False))
    micros = [
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c).alias(c)
        for c in ("start", "plain")
    ]
    return both.select("event_id", "event_type", "Time", *micros)


def image_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    images = pages.select("page_id", "url", F.octet_length("html").alias("length"))
    return tidy(small_enough(images, PAGE_BYTES))


def first_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    images = pages.select("page_id", "url", F.octet_length("html").alias("length"))
    return tidy(small_enough(images, PAGE_BYTES, limit=21, key="url"))


def binary_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as files in a folder per source, read back as bytes."""
    folder = new_folder(spark, "texts")
    texts = table(spark, sf_dir, "documents").select("source", "text")
    texts.write.partitionBy("source").text(folder)
    files = read_images(spark, folder, "*.txt")
    return files.groupBy(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source")).agg(
        F.sum("length").alias("length"),
        F.sum(F.octet_length("content").cast("long")).alias("n_bytes"),
    )


def unreadable_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose time text is none: those of one type carry their properties instead."""
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.date_format("ts", fixed.BAR_TIME_PATTERN)
    )
    raw = table(spark, sf_dir, "events").select("event_id", text.alias("Time"))
    return rejected(standardize(raw)).select("event_id", "Time")


def _event_folder(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON files, beside files of another kind and a file that holds next to nothing."""
    folder = new_folder(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    events.write.json(folder)
    events.write.mode("append").csv(folder)
    newest = events.agg(F.max("event_id").cast("string"))
    newest.write.mode("append").format("text").save(folder)
    newest.selectExpr("CAST(NULL AS STRING) AS nothing").write.mode("append").json(folder)
    return folder


def file_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all JSON files, however short; the empty record of the last one is no event."""
    folder = _event_folder(spark, sf_dir)
    rows = spark.read.schema("event_id long, event_type string, value double")
    return rows.option("pathGlobFilter", "*.json").json(folder).where("event_id IS NOT NULL")


def file_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the file that is chosen: a file for each event type in the order of the types, after one
    that holds next to nothing."""
    folder = new_folder(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    little = spark.sql("SELECT CAST(NULL AS LONG) AS event_id, 'none' AS event_type, CAST(NULL AS DOUBLE) AS value")
    rows = little.unionByName(events).withColumn("_file", F.array_position(types, F.col("event_type")).cast("int"))
    rows.repartitionById(len(EVENT_TYPES) + 1, F.col("_file")).drop("_file").write.json(folder)
    chosen = first_usable_file(list_files(spark, folder)).select("path").first()
    none = spark.createDataFrame([], events.schema)
    return none if chosen is None else spark.read.schema(events.schema).json(chosen["path"])


QUERIES = {
    "csv_scan": csv_scan,
    "csv_bars": csv_bars,
    "rejected_bars": rejected_bars,
    "named_view": named_view,
    "preview": first_orders,
    "preview_by_time": first_bars,
    "preview_by_week": first_weeks,
    "standardize_time": standardized,
    "image_filter": image_filter,
    "first_images": first_images,
    "binary_lengths": binary_lengths,
    "rejected_rows": unreadable_times,
    "file_select": file_select,
    "file_choice": file_choice,
}

_CODE = "lower(regexp_replace(instrument, '[^A-Za-z0-9]+', '_', 'g'))"

ORACLES = {
    "csv_scan": f"""
        WITH {ORDER_BARS.strip()}
        SELECT strftime(ts, '%d.%m.%Y %H:%M:%S.%g') AS "Time", open AS "Open", high AS "High",
            low AS "Low", close AS "Close", volume AS "Volume", {_CODE} AS instrument
        FROM bars""",
    "csv_bars": f"""
        WITH {ORDER_BARS.strip()}
        SELECT {_CODE} AS instrument, strftime(ts, '{TS_TEXT}') AS ts, open, high, low, close, volume
        FROM bars""",
    "rejected_bars": """
        WITH r AS (
            SELECT *, event_id % 10 AS k, CASE event_id % 10 WHEN 1 THEN 'time' WHEN 2 THEN 'number' WHEN 4 THEN 'columns'
                WHEN 5 THEN 'columns' ELSE '' END AS reason
            FROM events)
        SELECT event_type AS instrument, reason, count(*) AS n,
            CASE WHEN reason = '' THEN count(*) FILTER (k <> 3) END AS n_open,
            CASE WHEN reason = '' THEN round(sum(value), 3) END AS volume,
            CASE WHEN reason <> '' THEN count(*) END AS n_lines
        FROM r GROUP BY event_type, reason""",
    "named_view": f"""
        WITH {ORDER_BARS.strip()}
        SELECT instrument, isoyear(ts) * 100 + week(ts) AS week_key, count(*) AS n_points,
            strftime(min(ts), '{TS_TEXT}') AS ts_start, arg_max(close, ts) AS last_close
        FROM bars GROUP BY 1, 2""",
    "preview": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
            strftime(o_orderdate, '{TS_TEXT}') AS o_orderdate, o_orderpriority
        FROM (SELECT * FROM orders ORDER BY orders.o_orderdate, o_orderkey LIMIT 5)""",
    "preview_by_time": f"""
        SELECT strftime(date_trunc('milliseconds', ts), '{TS_TEXT}') AS start, event_id,
            strftime(ts, '%d.%m.%Y %H:%M:%S.%g') AS "Time"
        FROM events ORDER BY date_trunc('milliseconds', ts), event_id LIMIT 5""",
    "preview_by_week": f"""
        WITH {ORDER_BARS.strip()}
        SELECT week_key, instrument, strftime(min(ts), '{TS_TEXT}') AS ts_start, count(*) AS n_points
        FROM (SELECT *, isoyear(ts) * 100 + week(ts) AS week_key FROM bars)
        GROUP BY 1, 2 ORDER BY week_key, instrument LIMIT 5""",
    "standardize_time": """
        SELECT event_id, event_type, strftime(ts, '%d.%m.%Y %H:%M:%S.%g') AS "Time",
            epoch_us(date_trunc('milliseconds', ts)) AS start,
            epoch_us(date_trunc('milliseconds', ts)) AS plain
        FROM events""",
    "image_filter": f"""
        SELECT page_id, url, CAST(octet_length(encode(html)) AS BIGINT) AS length FROM pages
        WHERE octet_length(encode(html)) <= {PAGE_BYTES}""",
    "first_images": f"""
        SELECT page_id, url, CAST(octet_length(encode(html)) AS BIGINT) AS length FROM pages
        WHERE octet_length(encode(html)) <= {PAGE_BYTES} ORDER BY url LIMIT 21""",
    "binary_lengths": """
        SELECT source, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS length,
            CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS n_bytes
        FROM documents GROUP BY 1""",
    "rejected_rows": """
        SELECT event_id, props AS "Time" FROM events WHERE event_type = 'error'""",
    "file_select": "SELECT event_id, event_type, value FROM events",
    "file_choice": f"""
        SELECT event_id, event_type, value FROM events WHERE event_type = '{EVENT_TYPES[0]}'""",
}
