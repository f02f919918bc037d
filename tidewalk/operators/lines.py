"""Crossings of counting lines, by direction and time bucket."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidewalk.functions import geometry as G
from tidewalk.operators import tracks as K
from tidewalk.registry import Line


@lru_cache(maxsize=16)
def _tests(application: str, count: int, further: bool) -> tuple[Column, Column]:
    """Signed distance and hit over a dimension row's segments; kept, since building large expressions takes a driver seconds."""
    x0, y0, x, y = (F.col(c) for c in ("from_x", "from_y", "foot_x", "foot_y"))
    segments, more = G.beside(G.SEGMENT, count), F.col("more") if further else None
    return G.segments_distance(x, y, segments, more), G.meets_segments(x0, y0, x, y, segments, more)


def _shapes(spark: SparkSession, lines: dict[str, list[Line]], bands: dict[str, float]) -> tuple[DataFrame, Column, Column]:
    """The lines as a dimension table, the distance to them and whether a step hits them."""
    named = [(c, g) for c, own in lines.items() for g in own]
    rows = [(c, at, g.line_group, g.name, float(bands[c]), G.line_segments(g)) for at, (c, g) in enumerate(named)]
    table, count, further = K.shape_rows(spark, rows, "camera_id string, at int, line_group string, line string, band double", G.SEGMENT)
    return table, *_tests(spark.sparkContext.applicationId, count, further)


def with_steps(points: DataFrame, window: WindowSpec | None = None) -> DataFrame:
    """``from_x`` and ``from_y``: the track's point before, NaN for its first (or the window's)."""
    w, nan = window or K.by_track(), float("nan")
    return points.withColumns({"from_x": F.lag("foot_x", 1, nan).over(w), "from_y": F.lag("foot_y", 1, nan).over(w)})


def beside_lines(stepped: DataFrame, lines: dict[str, list[Line]], bands: dict[str, float]) -> DataFrame:
    """Each row with each line of its camera: ``line_group, line, distance`` (signed), ``hit`` and ``band``; rows of other cameras go."""
    shapes, distance, hit = _shapes(stepped.sparkSession, lines, bands)
    return stepped.join(shapes, "camera_id").select(*stepped.columns, "line_group", "line", distance.alias("distance"), hit.alias("hit"), "band")


def sided_lines(stepped: DataFrame, lines: dict[str, list[Line]], bands: dict[str, float], more_rows: str = "false") -> DataFrame:
    """Rows by line (``at``) with ``hit`` and ``side``; those within the band that don't hit the line change nothing and are left out, but for ``more_rows``."""
    shapes, distance, hit = _shapes(stepped.sparkSession, lines, bands)
    found = K.once(distance.alias("distance"), hit.alias("hit")).alias("_one")
    placed = stepped.join(shapes, "camera_id").select(*stepped.columns, "at", "line_group", "line", "band", found)
    told = placed.select(*stepped.columns, "at", "line_group", "line", "_one.hit", G.side(F.col("_one.distance"), F.col("band")).alias("side"))
    return told.where(f"hit or side is not null or {more_rows}")


def _with_history(sided: DataFrame, window: WindowSpec) -> DataFrame:
    """``hits`` up to each row, and the committed side and the hits at its last confirmation before it."""
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = sided.withColumn("hits", F.sum(F.col("hit").cast("long")).over(upto))
    beyond = F.when(F.col("side").isNotNull(), F.col("hits"))
    return hits.withColumns({"before": K.committed_before(F.col("side"), window), "hits_before": K.committed_before(beyond, window)})


def is_crossing() -> Column:
    """The committed side turns here, and since it was last confirmed some step met the line itself.

    A track's first side never counts.
    """
    return F.col("side").isNotNull() & F.col("before").isNotNull() & (F.col("side") != F.col("before")) & (F.col("hits") > F.col("hits_before"))


def crossings(points: DataFrame, lines: dict[str, list[Line]], bands: dict[str, float]) -> DataFrame:
    """One row per crossing: ``direction`` 1 is towards the inside point."""
    stepped = with_steps(points.where(F.col("camera_id").isin([c for c, own in lines.items() if own])))
    told = sided_lines(stepped, lines, bands).drop("foot_x", "foot_y", "from_x", "from_y")
    states = _with_history(told, K.by_track("line"))
    return states.where(is_crossing()).select("line_group", "camera_id", "line", "track_id", "clock", "time_bucket", F.col("side").alias("direction"))


def count_lines(points: DataFrame, lines: dict[str, list[Line]], bands: dict[str, float]) -> DataFrame:
    """``line_group, camera_id, line, time_bucket, in_count, out_count``; only buckets with a crossing.

    Each piece of a track knows its crossings but for one: its first committed side may
    cross, by the last side of the pieces before and the hits since, the step from piece
    to piece among them.
    """
    cameras = [c for c, own in lines.items() if own]
    together = points.where(F.col("camera_id").isin(cameras)).repartition(*K.PIECE)
    stepped = with_steps(together, K.by_piece()).withColumn("ends", F.lead(F.lit(False), 1, True).over(K.by_piece()))
    # A piece's first and last rows stay even if they say nothing: the steps into and out of the piece end there.
    told = sided_lines(stepped, lines, bands, "isnan(from_x) or ends").drop("line_group", "line", "from_x", "from_y")
    rows = _with_history(told, K.by_piece("at"))
    turn = F.when(is_crossing(), F.col("side"))
    at = F.struct(*K.ORDER)
    when = F.when(F.col("side").isNotNull(), at)
    pieces = rows.groupBy(*K.PIECE, "at").agg(
        F.count_if(turn == 1).alias("turns_in"),
        F.count_if(turn == -1).alias("turns_out"),
        F.min_by(F.struct("side", "hits"), when).alias("first"),
        F.max_by(F.struct("side", "hits"), when).alias("last"),
        F.max("hits").alias("total"),
        F.min_by(F.struct("foot_x", "foot_y"), at).alias("enter"),
        F.max_by(F.struct("foot_x", "foot_y"), at).alias("leave"),
    )
    # The step into a piece: from the last point of the piece before to its own first.
    along, nan = K.along_pieces("at"), F.lit(float("nan"))
    left = F.lag("leave").over(along)
    joined = pieces.withColumns({"left": left}).select(
        *K.PIECE, "at", "turns_in", "turns_out", "first", "last", "total",
        F.coalesce("left.foot_x", nan).alias("from_x"), F.coalesce("left.foot_y", nan).alias("from_y"), F.col("enter.foot_x").alias("foot_x"), F.col("enter.foot_y").alias("foot_y"),
    )
    shapes, _, hit = _shapes(points.sparkSession, lines, bands)
    stepped = joined.join(shapes.drop("camera_id", "band"), "at").select(*K.PIECE, "at", "line_group", "line", "turns_in", "turns_out", "first", "last", "total", hit.cast("long").alias("step"))
    gone = along.rowsBetween(Window.unboundedPreceding, -1)
    # Hits along the whole track: those of all pieces before, the step in, then the piece's own.
    own = stepped.withColumn("base", F.coalesce(F.sum(F.col("step") + F.col("total")).over(gone), F.lit(0)) + F.col("step"))
    own = own.withColumns({"side": F.col("first.side"), "hits": F.col("base") + F.col("first.hits"), "confirmed": F.when(F.col("last").isNotNull(), F.struct(F.col("last.side").alias("side"), (F.col("base") + F.col("last.hits")).alias("hits")))})
    own = own.withColumn("then", F.last("confirmed", ignorenulls=True).over(gone))
    own = own.withColumns({"before": F.col("then.side"), "hits_before": F.col("then.hits")})
    first = F.when(F.coalesce(is_crossing(), F.lit(False)), F.col("side"))
    counts = own.groupBy("line_group", "camera_id", "line", "time_bucket").agg(
        F.sum(F.col("turns_in") + F.when(first == 1, 1).otherwise(0)).cast("long").alias("in_count"),
        F.sum(F.col("turns_out") + F.when(first == -1, 1).otherwise(0)).cast("long").alias("out_count"),
    )
    return counts.where("in_count > 0 or out_count > 0")
