"""Visitors and entries of zones, by time bucket."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewalk.functions import geometry as G
from tidewalk.operators import tracks as K
from tidewalk.registry import Zone

#: What a row is to a zone, in one byte: 1 inside, 2 beyond the band, 3 both.
INSIDE, BEYOND = 1, 2


@lru_cache(maxsize=16)
def _tests(application: str, count: int, further: bool) -> tuple[Column, Column]:
    """Inside and distance over a dimension row's edges; kept, since building large expressions takes a driver seconds."""
    x, y, edges, more = F.col("foot_x"), F.col("foot_y"), G.beside(G.EDGE, count), F.col("more") if further else None
    return G.inside_edges(x, y, edges, more), G.edges_distance(x, y, edges, more)


def _placed(points: DataFrame, zones: dict[str, list[Zone]], bands: dict[str, float]) -> tuple[DataFrame, Column, Column]:
    """Each row with each zone of its camera (``at``, ``zone``, ``band``); whether it is inside, and its distance to the outline."""
    named = [(c, z) for c, own in zones.items() for z in own]
    rows = [(c, at, z.name, float(bands[c]), G.zone_edges(z)) for at, (c, z) in enumerate(named)]
    shapes, count, further = K.shape_rows(points.sparkSession, rows, "camera_id string, at int, zone string, band double", G.EDGE)
    return points.join(shapes, "camera_id"), *_tests(points.sparkSession.sparkContext.applicationId, count, further)


def beside_zones(points: DataFrame, zones: dict[str, list[Zone]], bands: dict[str, float]) -> DataFrame:
    """Each row with each zone of its camera: ``zone, inside, distance`` (to the outline) and ``band``; rows of other cameras go."""
    placed, inside, distance = _placed(points, zones, bands)
    return placed.select(*points.columns, "zone", inside.alias("inside"), distance.alias("distance"), "band")


def with_codes(points: DataFrame, zones: dict[str, list[Zone]], bands: dict[str, float]) -> DataFrame:
    """Rows by zone with ``code``, what they are to it; rows within the band and outside the zone change nothing and are left out.

    This is computed where rows are read; foot points go, so that they aren't shuffled.
    """
    placed, inside, distance = _placed(points, zones, bands)
    code = inside.cast("int") * INSIDE + (distance > F.col("band")).cast("int") * BEYOND
    coded = placed.select(*K.TRACK, *K.ORDER, "time_bucket", "at", "zone", K.once(code.cast("tinyint").alias("code")).alias("_one"))
    return coded.where("_one.code <> 0").select(*K.TRACK, *K.ORDER, "time_bucket", "at", "zone", "_one.code")


def side_of_code() -> Column:
    return F.when(F.col("code") == INSIDE + BEYOND, 1).when(F.col("code") == BEYOND, -1)


def is_entry(before: Column | None = None) -> Column:
    """The committed side turns to inside here; a track's first sight inside counts.

    A row within the band leaves the committed side as it was, so only rows beyond the
    band can turn it.
    """
    before = F.col("before") if before is None else before
    return (F.col("side") == 1) & (before.isNull() | (before == -1))


def zone_entries(points: DataFrame, zones: dict[str, list[Zone]], bands: dict[str, float]) -> DataFrame:
    """One row per entry, with its track, frame and time."""
    sided = with_codes(points, zones, bands).withColumn("side", side_of_code()).where("side is not null")
    states = sided.withColumn("before", K.committed_before(F.col("side"), K.by_track("zone")))
    return states.where(is_entry()).select("camera_id", "zone", "track_id", "frame_id", "clock", "time_bucket")


def count_zones(points: DataFrame, zones: dict[str, list[Zone]], bands: dict[str, float]) -> DataFrame:
    """``camera_id, zone, time_bucket, unique_visitors, entries``; a bucket without either has no row.

    ``points`` are ``foot_points``; ``bands`` are actual pixels by camera.  Each piece of
    a track knows its entries but for one: whether its first committed side is one
    depends on the last of the pieces before.
    """
    spark = points.sparkSession
    coded = with_codes(points, zones, bands).drop("zone").repartition(*K.PIECE)
    rows = coded.withColumn("side", side_of_code())
    rows = rows.withColumn("before", K.committed_before(F.col("side"), K.by_piece("at")))
    sided = F.when(F.col("side").isNotNull(), F.struct(*K.ORDER))
    pieces = rows.groupBy(*K.PIECE, "at").agg(
        F.max(F.col("code").bitwiseAND(F.lit(INSIDE).cast("tinyint"))).alias("seen"),
        F.count_if((F.col("side") == 1) & (F.col("before") == -1)).alias("turns"),
        F.min_by("side", sided).alias("side"),
        F.max_by("side", sided).alias("last"),
    )
    along = K.along_pieces("at").rowsBetween(Window.unboundedPreceding, -1)
    own = pieces.withColumn("before", F.last("last", ignorenulls=True).over(along)).withColumn("entries", F.col("turns") + F.coalesce(is_entry(), F.lit(False)).cast("long"))
    out = own.groupBy("camera_id", "at", "time_bucket").agg(F.sum("seen").cast("long").alias("unique_visitors"), F.sum("entries").cast("long").alias("entries"))
    names = spark.createDataFrame([(at, z.name) for at, z in enumerate(z for own in zones.values() for z in own)], "at int, zone string")
    return out.where("unique_visitors > 0 or entries > 0").join(names, "at").select("camera_id", "zone", "time_bucket", "unique_visitors", "entries")
