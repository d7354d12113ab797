"""Time parsing, week keys and day arithmetic on zone-free timestamps.

Bar times are GMT. They are kept as TIMESTAMP_NTZ from the first step on, so no result depends on
the zone of the session that runs the plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions import fixed

WEEK_MODES = ("iso", "year_major", "week_major")


def parse_bar_time(text: Column, with_zone: bool = True) -> Column:
    """STR1, DAT1, DAT2: text time to TIMESTAMP_NTZ; text that is no such time gives NULL.

    `with_zone` appends the GMT offset before parsing; without it the wall-clock text is read as it
    stands. Both give GMT wall-clock time here.
    """
    pattern = fixed.BAR_TIME_PATTERN + fixed.BAR_ZONE_PATTERN
    instant = F.try_to_timestamp(F.concat(text, F.lit(fixed.BAR_ZONE_SUFFIX)), F.lit(pattern))
    if not with_zone:
        # Only the check for well-formed text needs the instant.
        return F.when(
            instant.isNotNull(), F.to_timestamp_ntz(text, F.lit(fixed.BAR_TIME_PATTERN))
        )
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def week_key(ts: Column, mode: str = "iso") -> Column:
    """DAT3, DAT4: integer that names the week of a bar.

    `iso` pairs the ISO week with the ISO year. `year_major` and `week_major` pair it with the
    calendar year, which puts 31 December into week 1 of the year that is ending.
    """
    week = F.weekofyear(ts)
    if mode == "iso":
        return (F.extract(F.lit("YEAROFWEEK"), ts) * 100 + week).cast("int")
    if mode == "year_major":
        return (F.year(ts) * 100 + week).cast("int")
    if mode == "week_major":
        return (week * 10000 + F.year(ts)).cast("int")
    raise ValueError(f"unknown week mode {mode!r}, expected one of {WEEK_MODES}")


def day_start(ts: Column) -> Column:
    """DAT6: midnight of the day."""
    return F.to_date(ts).cast("timestamp_ntz")


def week_start(ts: Column) -> Column:
    """Midnight of the Monday that opens the ISO week."""
    return F.trunc(F.to_date(ts), "week").cast("timestamp_ntz")


def minus_weeks(ts: Column, weeks: int) -> Column:
    """DAT7: whole weeks back."""
    return ts - F.make_dt_interval(F.lit(7 * weeks))


def plus_steps(ts: Column, steps: Column, step_seconds: int = 60) -> Column:
    """DAT8: a fixed step times a count forward."""
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), steps * F.lit(step_seconds))


def start_text(ts: Column) -> Column:
    """DAT5: start time as the model reads it, `yyyy-MM-dd HH:mm:ss`.

    Formatting functions go through the zone of the session, which has hours that do not exist;
    the text of a zone-free timestamp does not.
    """
    return F.substring(ts.cast("string"), 1, len(fixed.START_PATTERN))
