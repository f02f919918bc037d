"""Recorded segments: ``<bucket>/<stream>/YYYY/MM/DD/HHmmss.SSSZ.<ext>``, named in UTC, used in local time."""

from __future__ import annotations

import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.functions import times
from tidewalk.schemas import LOCAL_TZ


def segment_paths(bucket_dir: str | Path, stream: str, day: datetime.date, file_ext: str) -> list[Path]:
    """The day's files of a stream; none if its folder isn't there."""
    return sorted((Path(bucket_dir) / stream / f"{day:%Y/%m/%d}").glob(f"*.{file_ext}"))


def located(paths: DataFrame) -> DataFrame:
    """``start`` on the local wall clock beside ``path`` and ``day``; null where the name is malformed."""
    return paths.withColumn("start", times.segment_start(F.col("path"), F.col("day")))


def misplaced(segments: DataFrame) -> DataFrame:
    """Segments without a readable start, or whose local day isn't their folder's."""
    return segments.where(F.col("start").isNull() | (F.to_date("start") != F.col("day")))


def discover_segments(spark: SparkSession, bucket_dir: str | Path, streams: list[str], day: datetime.date, file_ext: str) -> DataFrame:
    """``camera_id, path, relpath, day, start`` by camera and start; malformed names and files of another local day are errors."""
    root = Path(bucket_dir)
    rows = [(s, str(p), str(p.relative_to(root)), day) for s in streams for p in segment_paths(root, s, day, file_ext)]
    found = located(spark.createDataFrame(rows, "camera_id string, path string, relpath string, day date"))
    if bad := misplaced(found).select("path", "start").limit(20).collect():
        raise ValueError(f"segments must be named HHmmss.SSSZ (UTC) and lie in {LOCAL_TZ}'s day {day}: {[(r['path'], str(r['start'])) for r in bad]}")
    return found.orderBy("camera_id", "start")


def mirrored_path(output_root: str | Path, relpath: str | Path) -> Path:
    """Where a segment's annotated copy goes: the same place below another root."""
    return Path(output_root) / relpath


def frames_of(segments: DataFrame) -> DataFrame:
    """Frame times of segments with ``frames`` and ``fps``: one row per frame, counted anew in each segment."""
    each = segments.withColumn("frame_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("frames").cast("long") - 1)))
    return each.where("frames > 0").withColumn("timestamp", times.frame_time(F.col("start"), F.col("frame_id"), F.col("fps")))
