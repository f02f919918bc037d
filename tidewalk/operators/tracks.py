"""Tracking rows, and the windows over each track.

A track is followed in pieces, one per time bucket: rows are hashed by (camera_id,
track_id, time_bucket), each piece is summed up to one row per shape where it lies, and
only these rows are then put in order along the whole track.  So one track with a large
part of all rows is many tasks' work, shapes cost no further shuffle of rows, and
distinct tracks need no distinct aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidewalk.functions import geometry as G
from tidewalk.functions import times
from tidewalk.schemas import REQUIRED_TRACKING

TRACK = ("camera_id", "track_id")
#: Equal timestamps of a track are ordered by these.
ORDER = ("clock", "frame_id")


def require_columns(tracking: DataFrame, columns: tuple[str, ...] = REQUIRED_TRACKING) -> None:
    if missing := [c for c in columns if c not in tracking.columns]:
        raise ValueError(f"tracking data lacks {missing}; analyse the day again to get them")


def _number(x: Column) -> Column:
    """The number, or NaN for null: a column that can't be null needs no null checks in generated code."""
    return F.coalesce(x, F.lit(float("nan")))


def foot_points(tracking: DataFrame, bucket_minutes: int) -> DataFrame:
    """Foot points on the wall clock: camera_id, track_id, clock, frame_id, foot_x, foot_y, time_bucket.

    ``timestamp`` may be an instant or already wall-clock time; ``frame_id`` may be missing.
    """
    kind = dict(tracking.dtypes)["timestamp"]
    clock = F.col("timestamp") if kind == "timestamp_ntz" else times.wall_clock(F.col("timestamp"))
    frame = F.col("frame_id") if "frame_id" in tracking.columns else F.lit(0).cast("long")
    placed = tracking.select("camera_id", "track_id", clock.alias("clock"), frame.alias("frame_id"), _number((F.col("x1") + F.col("x2")) / 2).alias("foot_x"), _number(F.col("y2")).alias("foot_y"))
    return placed.withColumn("time_bucket", times.bucket(F.col("clock"), bucket_minutes))


#: What rows are hashed by: a track's piece.
PIECE = (*TRACK, "time_bucket")


def by_track(*more: str) -> WindowSpec:
    return Window.partitionBy(*TRACK, *more).orderBy(*ORDER)


def by_piece(*more: str) -> WindowSpec:
    return Window.partitionBy(*PIECE, *more).orderBy(*ORDER)


def along_pieces(*more: str) -> WindowSpec:
    """The pieces of a track in order."""
    return Window.partitionBy(*TRACK, *more).orderBy("time_bucket")


def committed(side: Column, window: WindowSpec) -> Column:
    """The last side that was beyond the band, this row's included."""
    return F.last(side, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def committed_before(side: Column, window: WindowSpec) -> Column:
    """The same before this row; null if there was none."""
    return F.last(side, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


#: Bytes of shapes that are sent to every executor; more are joined as Spark sees fit.
MOST_BROADCAST = 64 << 20


def shape_rows(spark: SparkSession, shapes: list[tuple], about: str, numbers: tuple[str, ...]) -> tuple[DataFrame, int, bool]:
    """Shapes as a dimension table: a row per shape with the columns of ``about`` and its edges' numbers.

    ``shapes`` are rows whose last value is the list of edges.  Returns the table, how many
    edges are columns of their own, and whether some are in the array ``more``.  Shapes
    with fewer edges repeat their last one, which changes neither parity (an edge is
    closed to a point), distance nor hits.
    """
    count = max(1, min(G.UNROLLED, max((len(s[-1]) for s in shapes), default=1)))
    further = any(len(s[-1]) > count for s in shapes)
    rows = []
    for *told, edges in shapes:
        own = edges[:count]
        own = own + [_closed(own[-1], numbers)] * (count - len(own))
        rows.append((*told, *(v for e in own for v in e), *([[tuple(e) for e in edges[count:]]] if further else [])))
    schema = ", ".join([about, *(f"{n}_{k} double" for k in range(count) for n in numbers)])
    schema += f", more array<struct<{','.join(f'{n}:double' for n in numbers)}>>" * further
    table = spark.createDataFrame(rows, schema)
    size = 8 * sum(len(numbers) * max(count, len(s[-1])) + 16 for s in shapes)
    return F.broadcast(table) if size <= MOST_BROADCAST else table, count, further


def _closed(last: tuple[float, ...], numbers: tuple[str, ...]) -> tuple[float, ...]:
    """The last edge again: a polygon's as its end point, so that it is crossed by nothing."""
    if numbers != G.EDGE:
        return last
    _, _, bx, by, _, _ = last
    return bx, by, bx, by, 1.0, 1.0


def once(*columns: Column) -> Column:
    """A struct of columns that later filters use as it is: Spark puts a filter below a plain projection and would compute them twice."""
    return F.explode_outer(F.array(F.struct(*columns)))
