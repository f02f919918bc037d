"""Zone entries and line crossings from a stream of tracking rows.

State is kept by (camera, track): for each shape the committed side and, for lines, the
hits since it was confirmed, and the last foot point.  It goes when a track has been
silent for ``idle`` of event time.  The counts are an ordinary windowed aggregation with
a watermark over the events.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewalk.functions import geometry as G
from tidewalk.registry import Line, Zone

EVENTS = "camera_id string, track_id long, shape string, clock timestamp, kind string"
_STATE = "sides array<int>, hits array<int>, x double, y double"


def _side(distance: float, band: float) -> int:
    return 1 if distance > band else -1 if distance < -band else 0


def shape_events(points: DataFrame, zones: dict[str, list[Zone]], lines: dict[str, list[Line]], zone_bands: dict[str, float], line_bands: dict[str, float], idle: str = "10 minutes") -> DataFrame:
    """Events of a stream of ``camera_id, track_id, clock, foot_x, foot_y`` with a watermark on ``clock``.

    Kinds: ``seen`` (inside a zone), ``entry``, ``in`` and ``out``.  Rows of one track in
    one micro-batch are put in order; a row older than its track's last batch is late
    and counts as if it came now.
    """
    seconds = int(pd.Timedelta(idle).total_seconds() * 1000)

    def update(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        camera, track = key
        if state.hasTimedOut:
            state.remove()
            return
        own_zones, own_lines = zones.get(camera, []), lines.get(camera, [])
        count = len(own_zones) + len(own_lines)
        sides, hits, x0, y0 = [list(v) if isinstance(v, list | tuple) else v for v in state.get] if state.exists else ([0] * count, [0] * count, float("nan"), float("nan"))
        out = []
        rows = pd.concat(list(parts)).sort_values("clock", kind="stable")
        for clock, x, y in zip(rows["clock"], rows["foot_x"], rows["foot_y"], strict=True):
            here = np.array([x]), np.array([y])
            for k, zone in enumerate(own_zones):
                d = float(G.np_signed_polygon_distance(*here, zone)[0])
                if bool(G.np_in_polygon(*here, zone)[0]):
                    out.append((camera, track, zone.name, clock, "seen"))
                side = _side(d, zone_bands[camera])
                if side == 1 and sides[k] != 1:
                    out.append((camera, track, zone.name, clock, "entry"))
                sides[k] = side or sides[k]
            for k, line in enumerate(own_lines, len(own_zones)):
                if bool(G.np_crosses_line(np.array([x0]), np.array([y0]), *here, line)[0]):
                    hits[k] += 1
                side = _side(float(G.np_signed_line_distance(*here, line)[0]), line_bands[camera])
                if side:
                    if sides[k] and side != sides[k] and hits[k]:
                        out.append((camera, track, line.name, clock, "in" if side == 1 else "out"))
                    sides[k], hits[k] = side, 0
            x0, y0 = x, y
        state.update((sides, hits, float(x0), float(y0)))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(rows["clock"].max().timestamp() * 1000)) + seconds)
        yield pd.DataFrame(out, columns=["camera_id", "track_id", "shape", "clock", "kind"])

    grouped = points.groupBy("camera_id", "track_id")
    return grouped.applyInPandasWithState(update, EVENTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def zone_counts_of(events: DataFrame, bucket_minutes: int) -> DataFrame:
    """Visitors (approximately, as streams can't keep every track) and entries by zone and bucket."""
    shown = events.where(F.col("kind").isin("seen", "entry"))
    by = shown.groupBy("camera_id", F.col("shape").alias("zone"), F.window("clock", f"{bucket_minutes} minutes").alias("w"))
    counts = by.agg(F.approx_count_distinct(F.when(F.col("kind") == "seen", F.col("track_id")), 0.01).alias("unique_visitors"), F.count_if(F.col("kind") == "entry").alias("entries"))
    return counts.select("camera_id", "zone", F.col("w.start").alias("time_bucket"), "unique_visitors", "entries")


def line_counts_of(events: DataFrame, bucket_minutes: int) -> DataFrame:
    """Crossings by line and bucket."""
    by = events.where(F.col("kind").isin("in", "out")).groupBy("camera_id", F.col("shape").alias("line"), F.window("clock", f"{bucket_minutes} minutes").alias("w"))
    counts = by.agg(F.count_if(F.col("kind") == "in").alias("in_count"), F.count_if(F.col("kind") == "out").alias("out_count"))
    return counts.select("camera_id", "line", F.col("w.start").alias("time_bucket"), "in_count", "out_count")
