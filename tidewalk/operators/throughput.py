"""Frames and rates of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rates(counts: DataFrame, elapsed_seconds: float) -> DataFrame:
    """``fps`` beside ``frames``, over the run's own time; no time gives 0."""
    rate = F.coalesce(F.try_divide(F.col("frames").cast("double"), F.lit(float(max(elapsed_seconds, 0.0)))), F.lit(0.0))
    return counts.withColumn("fps", rate)


def camera_throughput(frames: DataFrame, elapsed_seconds: float) -> DataFrame:
    """``camera_id, frames, fps`` over the run's own time."""
    return rates(frames.groupBy("camera_id").agg(F.count("*").alias("frames")), elapsed_seconds)


def overall_throughput(frames: DataFrame, elapsed_seconds: float, detect_seconds: float, track_seconds: float) -> DataFrame:
    """One row: all frames, and their rates over the run, the detection and the tracking."""
    total = frames.agg(F.count("*").alias("total_frames"))

    def rate(seconds: float):
        return F.coalesce(F.try_divide(F.col("total_frames").cast("double"), F.lit(float(max(seconds, 0.0)))), F.lit(0.0))

    return total.select("total_frames", rate(elapsed_seconds).alias("overall_fps"), rate(detect_seconds).alias("detection_fps"), rate(track_seconds).alias("tracking_fps"), F.lit(float(elapsed_seconds)).alias("elapsed_seconds"))
