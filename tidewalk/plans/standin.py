"""The people-flow queries' inputs on the driver's tables: ``events`` stand in for tracking rows.

Coordinates are integer arithmetic on ``event_id``, so every engine gets the same
numbers; event types are cameras, users are tracks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.operators import checks, tracks
from tidewalk.registry import Line, Zone
from tidewalk.session import read_table

ZONES = {
    "loc_click": [Zone(name="za", polygon=[(200, 200), (1400, 150), (1300, 900), (250, 950)]), Zone(name="zd", polygon=[(1000, 100), (1900, 100), (1900, 1000), (1450, 1000), (1450, 500), (1000, 500)])],
    "loc_view": [Zone(name="zb", polygon=[(0, 0), (1000, 0), (1000, 400), (400, 400), (400, 1000), (0, 1000)])],
    "loc_error": [Zone(name="zc", polygon=[(960, 100), (1800, 1000), (120, 1000)])],
    "loc_purchase": [Zone(name="ze", polygon=[(300, 100), (1700, 200), (1500, 600), (1750, 980), (900, 700), (200, 1000)])],
    "loc_signup": [Zone(name="zf", polygon=[(100, 100), (960, 300), (1820, 100), (1820, 980), (960, 800), (100, 980)])],
}
LINES = {
    "loc_click": [
        Line(name="la", points=[(0, 500), (960, 540), (1920, 500)], inside_point=(960, 900), line_group="mall"),
        Line(name="ld", points=[(480, 0), (480, 1080)], inside_point=(1500, 540), line_group="mall"),
    ],
    "loc_view": [Line(name="lb", points=[(960, 0), (960, 1080)], inside_point=(1500, 540), line_group="mall")],
    "loc_error": [Line(name="lc", points=[(300, 200), (900, 800), (1500, 200)], inside_point=(900, 300), line_group="office")],
    "loc_purchase": [Line(name="le", points=[(200, 300), (1700, 700)], inside_point=(960, 1000), line_group="office")],
    "loc_signup": [Line(name="lf", points=[(100, 900), (700, 400), (1300, 800), (1900, 300)], inside_point=(960, 1070), line_group="office")],
}
BUCKET_MINUTES = 60


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking rows with wall-clock timestamps."""
    foot_x = ((F.col("event_id") * 7919) % 1920).cast("double")
    foot_y = ((F.col("event_id") * 104729) % 1080).cast("double")
    wide = F.col("event_type").isin("click", "error")
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("loc_"), F.col("event_type")).alias("camera_id"),
        F.col("event_id").alias("frame_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("track_id"),
        (foot_x - 20).alias("x1"),
        (foot_y - 80).alias("y1"),
        (foot_x + 20).alias("x2"),
        foot_y.alias("y2"),
        F.when(wide, 3840).otherwise(1920).cast("long").alias("frame_width"),
        F.when(wide, 2160).otherwise(1080).cast("long").alias("frame_height"),
    )


def points(spark: SparkSession, sf_dir: str, minutes: int = BUCKET_MINUTES) -> DataFrame:
    return tracks.foot_points(tracking(spark, sf_dir), minutes)


def bands(spark: SparkSession, sf_dir: str, cameras: list[str], band: float) -> dict[str, float]:
    return checks.bands_of(checks.frame_widths(tracking(spark, sf_dir)), cameras, band)


def sql(body: str, band: float = 25.0, minutes: int = BUCKET_MINUTES) -> str:
    """An oracle's SQL: the stand-in and all shapes as tables ``trk``, ``edges`` and ``segs``, then ``body``."""
    edges = [(c, z.name, k, *a, *b) for c, own in ZONES.items() for z in own for k, (a, b) in enumerate(z.edges())]
    segs = [(c, g.line_group, g.name, k, *a, *b, *g.inside_point) for c, own in LINES.items() for g in own for k, (a, b) in enumerate(g.segments())]

    def values(rows: list[tuple], names: str) -> str:
        text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::double" if isinstance(v, float) else str(v) for v in r) + ")" for r in rows)
        return f"(values {text}) t({names})"

    return f"""
with trk as (
  select 'loc_' || event_type as camera_id, event_id as frame_id, ts as clock, user_id as track_id,
    ((event_id * 7919) % 1920)::double as foot_x, ((event_id * 104729) % 1080)::double as foot_y,
    time_bucket(interval '{minutes} minutes', ts, timestamp '1970-01-01 00:00:00') as time_bucket,
    case when event_type in ('click', 'error') then 3840 else 1920 end as frame_width,
    {band}::double * (case when event_type in ('click', 'error') then 2.0 else 1.0 end)::double as band
  from events
),
edges as (select * from {values(edges, "camera_id, zone, k, ax, ay, bx, by_")}),
segs as (select * from {values(segs, "camera_id, line_group, line, k, ax, ay, bx, by_, px, py")}),
zs0 as (
    select camera_id, frame_id, clock, track_id, foot_x, foot_y, time_bucket, band, zone,
      sum(case when ((by_ > foot_y) <> (ay > foot_y)) and foot_x < (ax - bx) * (foot_y - by_) / nullif(ay - by_, 0) + bx then 1 else 0 end) % 2 = 1 as inside,
      min(sqrt(pow(foot_x - ax - t * (bx - ax), 2) + pow(foot_y - ay - t * (by_ - ay), 2))) as d
    from (select trk.*, edges.* exclude (camera_id),
          greatest(0, least(1, ((foot_x - ax) * (bx - ax) + (foot_y - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) as t
        from trk join edges using (camera_id)) e
    group by all),
zs as (select *, case when inside then d else -d end as signed_d from zs0),
zside as (select *, case when signed_d > band then 1 when signed_d < -band then -1 end as side from zs),
zstate as (select *,
    last_value(side ignore nulls) over (partition by camera_id, zone, track_id order by clock, frame_id rows between unbounded preceding and current row) as committed,
    last_value(side ignore nulls) over (partition by camera_id, zone, track_id order by clock, frame_id rows between unbounded preceding and 1 preceding) as before
  from zside),
zone_counts as (
  select camera_id, zone, time_bucket, count(distinct case when inside then track_id end)::bigint as unique_visitors,
    sum(case when committed = 1 and (before is null or before = -1) then 1 else 0 end)::bigint as entries
  from zstate group by all having unique_visitors > 0 or entries > 0),
stepped as (select *, lag(foot_x) over w as from_x, lag(foot_y) over w as from_y from trk window w as (partition by camera_id, track_id order by clock, frame_id)),
ls0 as (
  select s.*, g.* exclude (camera_id),
    greatest(0, least(1, ((foot_x - ax) * (bx - ax) + (foot_y - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) as t,
    (bx - ax) * (from_y - ay) - (by_ - ay) * (from_x - ax) as d1, (bx - ax) * (foot_y - ay) - (by_ - ay) * (foot_x - ax) as d2,
    (foot_x - from_x) * (ay - from_y) - (foot_y - from_y) * (ax - from_x) as d3, (foot_x - from_x) * (by_ - from_y) - (foot_y - from_y) * (bx - from_x) as d4
  from stepped s join segs g using (camera_id)),
ls1 as (select *, pow(foot_x - (ax + t * (bx - ax)), 2) + pow(foot_y - (ay + t * (by_ - ay)), 2) as dd,
    ((bx - ax) * (foot_y - ay) - (by_ - ay) * (foot_x - ax)) / sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2)) * sign((bx - ax) * (py - ay) - (by_ - ay) * (px - ax)) as height,
    coalesce((d1 * d2 < 0 and d3 * d4 < 0)
      or (d1 = 0 and from_x between least(ax, bx) and greatest(ax, bx) and from_y between least(ay, by_) and greatest(ay, by_))
      or (d2 = 0 and foot_x between least(ax, bx) and greatest(ax, bx) and foot_y between least(ay, by_) and greatest(ay, by_))
      or (d3 = 0 and ax between least(from_x, foot_x) and greatest(from_x, foot_x) and ay between least(from_y, foot_y) and greatest(from_y, foot_y))
      or (d4 = 0 and bx between least(from_x, foot_x) and greatest(from_x, foot_x) and by_ between least(from_y, foot_y) and greatest(from_y, foot_y)), false) as meets
  from ls0),
ls as (select camera_id, line_group, line, frame_id, clock, track_id, time_bucket, band, arg_min(height, (dd, k)) as signed_d, bool_or(meets) as hit from ls1 group by all),
lside as (select *, case when signed_d > band then 1 when signed_d < -band then -1 end as side,
    sum(case when hit then 1 else 0 end) over (partition by camera_id, line, track_id order by clock, frame_id rows between unbounded preceding and current row) as hits from ls),
lstate as (select *,
    last_value(side ignore nulls) over w as before,
    last_value(case when side is not null then hits end ignore nulls) over w as hits_before
  from lside window w as (partition by camera_id, line, track_id order by clock, frame_id rows between unbounded preceding and 1 preceding)),
crossings as (select * from lstate where side is not null and before is not null and side <> before and hits > hits_before),
line_counts as (
  select line_group, camera_id, line, time_bucket, sum(case when side = 1 then 1 else 0 end)::bigint as in_count, sum(case when side = -1 then 1 else 0 end)::bigint as out_count
  from crossings group by all)
{body}
"""
