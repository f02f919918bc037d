"""The daily stages: tracks to zone counts and line counts, frames to tracks."""

from __future__ import annotations

import datetime
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewalk.config import TrackerSettings
from tidewalk.functions import times
from tidewalk.log import JsonLog
from tidewalk.operators import checks, lines, throughput, tracks, zones
from tidewalk.operators.tracker import track_detections
from tidewalk.registry import load_registry, parse_lines, parse_zones
from tidewalk.schemas import BASE_WIDTH, DEFAULT_BAND, LINE_COUNTS, LINE_FILE, TRACKING, TRACKING_FILE, ZONE_COUNTS, ZONE_FILE
from tidewalk.sources import annotate, store
from tidewalk.sources import frames as frame_source
from tidewalk.sources.segments import discover_segments, mirrored_path

log = JsonLog("daily")


def day_folder(output_root: str | Path, bucket_dir: str | Path, date: datetime.date) -> str:
    return f"{output_root}/{Path(bucket_dir).name}/{date.isoformat()}"


def _tracking(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/{TRACKING_FILE}"
    tracking = store.read(spark, path, f"no tracking data at {path}; analyse the day first")
    tracks.require_columns(tracking)
    return tracking


def _publish(counts: DataFrame, path: str, schema, order: list[str]) -> str:
    local = counts.withColumn("time_bucket", times.instant(F.col("time_bucket")))
    store.publish(local.orderBy(*order), path, schema)
    log.info("counts written", path=path)
    return path


def map_zones_daily(spark: SparkSession, date: datetime.date, bucket_dir: str, bucket_minutes: int, boundary_band_px_1080p: float = DEFAULT_BAND, output_root: str | Path = "outputs") -> str:
    """Zone counts of a day, written beside its tracking data; returns their path."""
    folder = day_folder(output_root, bucket_dir, date)
    if not store.exists(spark, f"{folder}/{TRACKING_FILE}"):
        raise FileNotFoundError(f"no tracking data at {folder}/{TRACKING_FILE}; analyse the day first")
    cameras = load_registry(bucket_dir).zone_cameras()
    tracking = _tracking(spark, folder)
    widths = checks.frame_widths(tracking)
    # Cameras without data are told before any polygon is looked at.
    checks.reject_missing_cameras([s for s, c in cameras.items() if c.zones], list(widths), "zones")
    shapes = {c: own for c, own in parse_zones(cameras).items() if own}
    bands = checks.bands_of(widths, list(shapes), boundary_band_px_1080p)
    for camera, own in shapes.items():
        for zone in own:
            checks.reject_narrow_zone(camera, zone, bands[camera], widths[camera][0] / BASE_WIDTH)
    if shapes:
        counts = zones.count_zones(tracks.foot_points(tracking, bucket_minutes), shapes, bands)
    else:
        counts = spark.createDataFrame([], "camera_id string, zone string, time_bucket timestamp_ntz, unique_visitors long, entries long")
    return _publish(counts, f"{folder}/{ZONE_FILE}", ZONE_COUNTS, ["camera_id", "zone", "time_bucket"])


def count_lines_daily(spark: SparkSession, date: datetime.date, bucket_dir: str, bucket_minutes: int, crossing_band_px_1080p: float = DEFAULT_BAND, output_root: str | Path = "outputs") -> str:
    """Line counts of a day, written beside its tracking data; returns their path."""
    folder = day_folder(output_root, bucket_dir, date)
    if not store.exists(spark, f"{folder}/{TRACKING_FILE}"):
        raise FileNotFoundError(f"no tracking data at {folder}/{TRACKING_FILE}; analyse the day first")
    cameras = load_registry(bucket_dir).line_cameras()
    tracking = _tracking(spark, folder)
    widths = checks.frame_widths(tracking)
    checks.reject_missing_cameras(list(cameras), list(widths), "lines")
    shapes = parse_lines(cameras)
    bands = checks.bands_of(widths, list(shapes), crossing_band_px_1080p)
    if shapes:
        counts = lines.count_lines(tracks.foot_points(tracking, bucket_minutes), shapes, bands)
    else:
        counts = spark.createDataFrame([], "line_group string, camera_id string, line string, time_bucket timestamp_ntz, in_count long, out_count long")
    return _publish(counts, f"{folder}/{LINE_FILE}", LINE_COUNTS, ["line_group", "camera_id", "line", "time_bucket"])


@dataclass
class AnalysisResult:
    tracking_path: str
    camera_ids: list[str]
    throughput: DataFrame
    video_paths: list[str] = field(default_factory=list)


def analyze_daily(
    spark: SparkSession,
    date: datetime.date,
    bucket_dir: str,
    detector: Callable[[DataFrame], DataFrame],
    camera_ids: list[str] | None = None,
    tracker: TrackerSettings | None = None,
    decoder: str | None = None,
    output_root: str | Path = "outputs",
    video_writer: str | None = None,
) -> AnalysisResult:
    """Frames to tracks: segments are found and decoded, ``detector`` turns frames into boxes, each camera's boxes are tracked.

    With a ``video_writer`` the segments are then written again with the tracks drawn in,
    below ``output_root`` and the bucket's name, at their own relative paths.

    ``detector`` gets the frames and returns camera_id, frame_id, timestamp, x1, y1, x2,
    y2, score, cls, frame_width and frame_height.
    """
    registry = load_registry(bucket_dir)
    cameras = registry.resolve_cameras(camera_ids)
    if not cameras:
        raise ValueError("the registry has no cameras")
    streams = [c.stream for c in cameras]
    found = discover_segments(spark, bucket_dir, streams, date, registry.storage.file_ext).collect()  # a row per file of one day
    if lacking := [s for s in streams if s not in {r["camera_id"] for r in found}]:
        raise ValueError(f"no segments on {date} for {lacking}")
    days = [{"camera_id": s, "segments": [(r["path"], r["relpath"], r["start"].isoformat()) for r in found if r["camera_id"] == s]} for s in streams]
    frame_source.register(spark)
    reader = spark.read.format(frame_source.FrameSource.name()).option("days", json.dumps(days))
    frames = (reader.option("decoder", decoder) if decoder else reader).load()
    # Frames without a box age tracks too; they are read apart, without pixels, since detectors give boxes only.
    every = reader.option("pixels", "false").load().select("camera_id", "frame_id", "timestamp")
    # Counted as they are read, by camera: a number per camera of the registry.
    seen = Observation("frames")
    every = every.observe(seen, *[F.count_if(F.col("camera_id") == s).alias(f"frames_{k}") for k, s in enumerate(streams)])
    tracked = track_detections(detector(frames), tracker or TrackerSettings(), frames=every)
    path = f"{day_folder(output_root, bucket_dir, date)}/{TRACKING_FILE}"
    rows = tracked.withColumn("timestamp", times.instant(F.col("timestamp"))) if dict(tracked.dtypes)["timestamp"] == "timestamp_ntz" else tracked
    began = time.monotonic()
    store.publish(rows, path, TRACKING)
    seconds = time.monotonic() - began
    counted = seen.get
    counts = [(s, int(counted[f"frames_{k}"])) for k, s in enumerate(streams)]
    rates = throughput.rates(spark.createDataFrame(counts, "camera_id string, frames long"), seconds)
    total = sum(n for _, n in counts)
    log.info("frames analysed", path=path, frames=total, seconds=round(seconds, 3), fps=round(total / seconds, 3) if seconds > 0 else 0.0, by_camera=dict(counts))
    for stream, n in counts:
        log.info("frames of a camera", camera_id=stream, frames=n, fps=round(n / seconds, 3) if seconds > 0 else 0.0)
    videos: list[str] = []
    if video_writer:
        root = f"{output_root}/{Path(bucket_dir).name}"
        segments = spark.createDataFrame([(r["camera_id"], r["path"], r["relpath"], r["start"]) for r in found], "camera_id string, path string, relpath string, start timestamp_ntz")
        boxes = store.read(spark, path, f"no tracking data at {path}").withColumn("timestamp", times.wall_clock(F.col("timestamp")))
        annotate.draw_segments(segments, boxes, root, decoder or frame_source.DEFAULT_DECODER, video_writer)
        videos = [str(mirrored_path(root, r["relpath"])) for r in found]
        log.info("videos written", paths=videos)
    return AnalysisResult(path, streams, rates, videos)
