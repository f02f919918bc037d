"""Local time without a zone: buckets, periods, file-name times and frame times.

Buckets must start at local midnight, so they are cut on wall-clock time
(TIMESTAMP_NTZ); on instants Spark would align them to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewalk.schemas import LOCAL_TZ, MEALS, NO_REMINDER, WEEKDAYS


def wall_clock(instant: Column, zone: str = LOCAL_TZ) -> Column:
    """Wall-clock time of an instant in a zone, whatever the session's own zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def instant(clock: Column, zone: str = LOCAL_TZ) -> Column:
    """The instant that a zone's wall clock shows."""
    return F.convert_timezone(F.lit(zone), F.current_timezone(), clock).cast("timestamp")


def bucket(clock: Column, minutes: int) -> Column:
    """Start of the bucket of so many minutes, counted from 1970-01-01 00:00 on the wall clock."""
    return F.window(clock, f"{int(minutes)} minutes")["start"]


def segment_start(path: Column, day: Column) -> Column:
    """Local start of a segment from its name ``HHmmss.SSSZ.ext`` (UTC) and its folder's day; null if the name is of another form."""
    stem = F.regexp_extract(path, r"([^/]*)\.[^./]*$", 1)
    utc = F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.regexp_extract(stem, r"^(\d{6}\.\d{1,6})Z$", 1)), F.lit("yyyy-MM-dd HHmmss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"))
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_TZ), utc.cast("timestamp_ntz"))


def frame_time(start: Column, frame_index: Column, fps: Column) -> Column:
    """``start`` plus the frame's seconds, to the microsecond."""
    seconds = (frame_index / fps).cast("decimal(18,6)")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def date_text(clock: Column) -> Column:
    return F.date_format(clock, "yyyy-MM-dd")


def clock_text(clock: Column) -> Column:
    return F.date_format(clock, "HH:mm")


def weekday_name(date: Column) -> Column:
    """The weekday of a date (or its text) as reports write it."""
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.weekday(F.to_date(date)) + 1)


def meal_reminder(period: Column) -> Column:
    """What to remind of at a period's start, ``HH:mm``."""
    hour = F.split(period, ":")[0].cast("int")
    out = F.lit(NO_REMINDER)
    for first, beyond, text in reversed(MEALS):
        out = F.when((hour >= first) & (hour < beyond), text).otherwise(out)
    return out
