"""Report periods: sums of buckets, daily peaks, calendar and reminders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.functions import times


def with_local_time(counts: DataFrame, column: str = "time_bucket") -> DataFrame:
    """``local_time``: the wall-clock value of ``column``, without a shift for what has none."""
    kind = dict(counts.dtypes)[column]
    return counts.withColumn("local_time", F.col(column) if kind == "timestamp_ntz" else times.wall_clock(F.col(column)))


def _dated(summed: DataFrame) -> DataFrame:
    return summed.withColumns({"date": times.date_text(F.col("start")), "period": times.clock_text(F.col("start"))}).withColumn("weekday", times.weekday_name(F.col("date")))


def zone_periods(counts: DataFrame, period_minutes: int, metric: str = "entries") -> DataFrame:
    """``date, weekday, period, zone, value``: the metric summed over periods, whatever the camera.

    ``unique_visitors`` of several buckets are added up as they are, so somebody seen in
    two buckets counts twice.
    """
    if metric not in ("entries", "unique_visitors"):
        raise ValueError(f"no such metric: {metric}")
    summed = counts.groupBy("zone", times.bucket(F.col("local_time"), period_minutes).alias("start")).agg(F.sum(metric).alias("value"))
    return _dated(summed).select("date", "weekday", "period", "zone", "value")


def line_periods(counts: DataFrame, period_minutes: int) -> DataFrame:
    """``date, weekday, period, line_group, line, in_count, out_count, net``; groups are not totalled."""
    summed = counts.groupBy("line_group", "line", times.bucket(F.col("local_time"), period_minutes).alias("start")).agg(F.sum("in_count").alias("in_count"), F.sum("out_count").alias("out_count"))
    return _dated(summed).select("date", "weekday", "period", "line_group", "line", "in_count", "out_count", (F.col("in_count") - F.col("out_count")).alias("net"))


def _peak(periods: DataFrame, name: str, metric: str) -> DataFrame:
    """Each day's period of the greatest metric, the earlier of equals."""
    best = F.row_number().over(Window.partitionBy("date", name).orderBy(F.col(metric).desc(), F.col("period")))
    return periods.withColumn("best", best).where("best = 1").withColumn("reminder", times.meal_reminder(F.col("period")))


def zone_peaks(periods: DataFrame) -> DataFrame:
    """``date, weekday, zone, peak_period, peak_value, reminder``."""
    return _peak(periods, "zone", "value").select("date", "weekday", "zone", F.col("period").alias("peak_period"), F.col("value").alias("peak_value"), "reminder")


def line_peaks(periods: DataFrame, metric: str) -> DataFrame:
    """``date, weekday, line_group, line, peak_period, peak_in, peak_out, reminder`` by ``in_count`` or ``out_count``."""
    if metric not in ("in_count", "out_count"):
        raise ValueError(f"no such metric: {metric}")
    return _peak(periods, "line", metric).select(
        "date", "weekday", "line_group", "line", F.col("period").alias("peak_period"), F.col("in_count").alias("peak_in"), F.col("out_count").alias("peak_out"), "reminder"
    )
