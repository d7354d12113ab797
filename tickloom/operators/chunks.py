"""Weekly series of any length, as chunks of bounded size, and windows that may cross them.

`series.weekly_series` holds a week in one row, which is right where the calendar bounds it. Ticks,
or a file delivered many times, have no such bound: here the points of a series are numbered where
they lie, a chunk holds the values of `size` consecutive numbers, and no row is larger than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import FeatureConfig
from tickloom.functions.hashing import key_text
from tickloom.functions.timekeys import plus_steps
from tickloom.operators.series import with_week

SERIES = ("instrument", "week_key", "column_id", "column")
#: Points of a chunk.
CHUNK = 4096
#: Seconds whose points are numbered together.
SLOT_SECONDS = 600


def numbered_points(bars: DataFrame, cfg: FeatureConfig, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """PRJ4: one row per series, column and point: SERIES, ts, value, pos, repeats.

    `pos` is the point's number in its series, in the order of time and value; `repeats` tells how
    many points before it in the series have the same time. Points are numbered inside slots of
    time and moved up by the sizes of the slots before, so a series is spread over its slots; the
    points of one slot are sorted in one task, which spills.
    """
    value = lambda c: F.struct(F.lit(cfg.columns.index(c)).alias("column_id"), F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
    rows = with_week(bars.where(F.col("ts").isNotNull()), cfg.week_mode).select(
        "instrument", "week_key", "ts", F.inline(F.array(*[value(c) for c in cfg.columns]))
    )
    if cfg.nulls == "drop":
        rows = rows.where(F.col("value").isNotNull())
    start = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    rows = rows.withColumn("slot", F.floor(start / slot_seconds))
    sizes = rows.groupBy(*SERIES, "slot").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*SERIES).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*SERIES, "slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*SERIES, "slot").orderBy("ts", "value")
    numbered = rows.withColumn("_i", F.row_number().over(inside) - 1).withColumn("_rank", F.rank().over(
        Window.partitionBy(*SERIES, "slot").orderBy("ts")
    ) - 1)
    joined = numbered.join(before, [*SERIES, "slot"])
    return joined.select(
        *SERIES, "ts", "value", (F.col("_before") + F.col("_i")).alias("pos"), (F.col("_i") - F.col("_rank")).cast("long").alias("repeats")
    )


def chunked_series(points: DataFrame, size: int = CHUNK) -> DataFrame:
    """AGG1-AGG3: SERIES, chunk, offset, times, values, n_repeats; at most `size` points a row.

    `offset` is the number of the chunk's first point; `n_repeats` counts points whose time another
    point of the series before them has.
    """
    point = F.struct("pos", "ts", "value")
    chunks = points.groupBy(*SERIES, F.floor(F.col("pos") / size).alias("chunk")).agg(
        F.sort_array(F.collect_list(point)).alias("_p"), F.count_if(F.col("repeats") > 0).alias("n_repeats")
    )
    return chunks.select(
        *SERIES, "chunk", (F.col("chunk") * size).alias("offset"), F.col("_p.ts").alias("times"), F.col("_p.value").alias("values"), "n_repeats"
    )


def chunked_index(chunks: DataFrame) -> DataFrame:
    """SERIES, ts_start, n_points, n_repeats of every series, from its chunks."""
    return chunks.groupBy(*SERIES).agg(
        F.min(F.get("times", F.lit(0))).alias("ts_start"), F.sum(F.size("values")).alias("n_points"), F.sum("n_repeats").alias("n_repeats")
    )


def sampled_starts(chunks: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """GEN1: SERIES, ts_start, start_index: the start positions `windows_of` would pick.

    Every chunk proposes the positions of its own points; each task keeps the best of a series
    before they move, so a series of any length costs `n_tests` rows a task.
    """
    spare = 0 if cfg.include_last_window else 1
    index = chunked_index(chunks).drop("n_repeats")
    # A chunk's last positions may leave no room for a window; the whole series' size decides.
    own = chunks.select(*SERIES, F.col("offset"), F.size("values").alias("_size")).join(index, list(SERIES))
    last = F.least(F.col("offset") + F.col("_size") - 1, F.col("n_points") - cfg.length - spare)
    places = F.when(last >= F.col("offset"), F.sequence(F.col("offset"), last))
    key = key_text(cfg.seed, F.col("instrument"), F.col("column"), F.col("week_key"))
    proposed = own.select(*SERIES, "ts_start", F.explode(places).alias("start_index"))
    hashed = proposed.withColumn("_h", F.md5(F.concat_ws(":", key, F.col("start_index").cast("string"))))
    best = Window.partitionBy(*SERIES).orderBy("_h", "start_index")
    return hashed.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= cfg.n_tests).drop("_h", "_r")


def windows_over_chunks(chunks: DataFrame, cfg: FeatureConfig, size: int = CHUNK) -> DataFrame:
    """GEN1, GEN2, ARR2: the rows of `windows.sample_windows` for series in chunks: instrument,
    week_key, column_id, column, start_index, start_ts, target.

    A window meets the chunks it lies in and takes its part of each; the parts are put together by
    their place.
    """
    starts = sampled_starts(chunks, cfg)
    end = F.col("start_index") + (cfg.length - 1)
    reach = F.sequence(F.floor(F.col("start_index") / size), F.floor(end / size))
    wanted = starts.withColumn("chunk", F.explode(reach))
    parts = wanted.join(chunks.select(*SERIES, "chunk", "offset", "times", "values"), [*SERIES, "chunk"])
    first = F.greatest(F.col("start_index") - F.col("offset"), F.lit(0)).cast("int")
    length = (F.least(F.col("start_index") + cfg.length, F.col("offset") + F.size("values")) - F.col("offset")).cast("int") - first
    part = F.struct("chunk", F.slice("values", first + 1, length).alias("values"))
    here: Column = F.when(F.floor(F.col("start_index") / size) == F.col("chunk"), F.get("times", first))
    made = parts.groupBy(*SERIES, "ts_start", "start_index").agg(
        F.flatten(F.sort_array(F.collect_list(part)).getField("values")).alias("target"), F.max(here).alias("_at")
    )
    start_ts = (
        plus_steps(F.col("ts_start"), F.col("start_index").cast("int"), cfg.step_seconds) if cfg.window_start == "fixed_step" else F.col("_at")
    )
    return made.select(*SERIES, F.col("start_index").cast("int").alias("start_index"), start_ts.alias("start_ts"), "target")
