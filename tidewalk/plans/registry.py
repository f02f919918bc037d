"""Named queries over the driver's tables, with the SQL each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.config import TrackerSettings
from tidewalk.functions import geometry as G
from tidewalk.functions import times
from tidewalk.operators import checks, lines, rollup, throughput, tracks, upsert, zones
from tidewalk.operators.tracker import track_detections
from tidewalk.plans import standin as S
from tidewalk.registry import line_table, zone_table
from tidewalk.session import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "zone_counts"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _zone_bands(spark: SparkSession, sf: str, band: float = 25.0) -> dict[str, float]:
    return S.bands(spark, sf, list(S.ZONES), band)


def _line_bands(spark: SparkSession, sf: str, band: float = 25.0) -> dict[str, float]:
    return S.bands(spark, sf, list(S.LINES), band)


def _beside_zones(spark: SparkSession, sf: str) -> DataFrame:
    beside = zones.beside_zones(S.points(spark, sf), S.ZONES, _zone_bands(spark, sf))
    return beside.withColumns({"signed_d": F.when(F.col("inside"), F.col("distance")).otherwise(-F.col("distance")), "side": G.side_of(F.col("inside"), F.col("distance"), F.col("band"))})


def _beside_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines.beside_lines(lines.with_steps(S.points(spark, sf)), S.LINES, _line_bands(spark, sf))


@query(S.sql("select camera_id, track_id, frame_id, clock, foot_x, foot_y, time_bucket from trk"))
def tracking_projection(spark: SparkSession, sf: str) -> DataFrame:
    return S.points(spark, sf).select("camera_id", "track_id", "frame_id", "clock", "foot_x", "foot_y", "time_bucket")


@query(S.sql("select camera_id, frame_id, zone, inside from zs"))
def point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    return _beside_zones(spark, sf).select("camera_id", "frame_id", "zone", "inside")


@query(S.sql("select camera_id, frame_id, zone, round(signed_d, 6) + 0.0 as signed_d from zs"))
def signed_distance_polygon(spark: SparkSession, sf: str) -> DataFrame:
    return _beside_zones(spark, sf).select("camera_id", "frame_id", "zone", (F.round("signed_d", 6) + 0.0).alias("signed_d"))


@query(S.sql("select camera_id, frame_id, zone, coalesce(side, 0)::integer as side from zside"))
def side_classification(spark: SparkSession, sf: str) -> DataFrame:
    return _beside_zones(spark, sf).select("camera_id", "frame_id", "zone", F.coalesce("side", F.lit(0)).alias("side"))


@query(S.sql("select distinct camera_id, frame_width::bigint as frame_width, band as band_px from trk"))
def band_scaling(spark: SparkSession, sf: str) -> DataFrame:
    widths = checks.frame_widths(S.tracking(spark, sf))
    found = checks.bands_of(widths, list(S.ZONES), 25.0)
    return spark.createDataFrame([(c, widths[c][0], b) for c, b in found.items()], "camera_id string, frame_width long, band_px double")


@query(S.sql("select camera_id, frame_id, zone, coalesce(committed, 0)::integer as committed from zstate"))
def committed_state(spark: SparkSession, sf: str) -> DataFrame:
    state = tracks.committed(F.col("side"), tracks.by_track("zone"))
    return _beside_zones(spark, sf).withColumn("state", state).select("camera_id", "frame_id", "zone", F.coalesce("state", F.lit(0)).alias("committed"))


@query(S.sql("select camera_id, frame_id, zone, coalesce(before, 0)::integer as before from zstate"))
def previous_state(spark: SparkSession, sf: str) -> DataFrame:
    state = tracks.committed_before(F.col("side"), tracks.by_track("zone"))
    return _beside_zones(spark, sf).withColumn("state", state).select("camera_id", "frame_id", "zone", F.coalesce("state", F.lit(0)).alias("before"))


def _zone_counts(spark: SparkSession, sf: str, band: float = 25.0, minutes: int = S.BUCKET_MINUTES) -> DataFrame:
    return zones.count_zones(S.points(spark, sf, minutes), S.ZONES, _zone_bands(spark, sf, band))


def _line_counts(spark: SparkSession, sf: str, band: float = 25.0) -> DataFrame:
    return lines.count_lines(S.points(spark, sf), S.LINES, _line_bands(spark, sf, band))


@query(S.sql("select * from zone_counts"))
def zone_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_counts(spark, sf)


@query(S.sql("select * from zone_counts", band=0.0))
def zone_counts_band0(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_counts(spark, sf, 0.0)


@query(S.sql("select camera_id, zone, time_bucket, unique_visitors from zone_counts where unique_visitors > 0"))
def zone_unique_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_counts(spark, sf).where("unique_visitors > 0").select("camera_id", "zone", "time_bucket", "unique_visitors")


@query(S.sql("select camera_id, zone, track_id, frame_id, clock from zstate where committed = 1 and (before is null or before = -1)"))
def zone_entries(spark: SparkSession, sf: str) -> DataFrame:
    return zones.zone_entries(S.points(spark, sf), S.ZONES, _zone_bands(spark, sf)).drop("time_bucket")


@query(S.sql("select camera_id, frame_id, line, round(signed_d, 6) + 0.0 as signed_d from ls"))
def signed_distance_polyline(spark: SparkSession, sf: str) -> DataFrame:
    return _beside_lines(spark, sf).select("camera_id", "frame_id", "line", (F.round("distance", 6) + 0.0).alias("signed_d"))


@query(S.sql("select camera_id, frame_id, line, hit from ls"))
def segment_hits(spark: SparkSession, sf: str) -> DataFrame:
    return _beside_lines(spark, sf).select("camera_id", "frame_id", "line", "hit")


@query(S.sql("select line_group, camera_id, line, track_id, clock, side as direction from crossings"))
def line_crossing_events(spark: SparkSession, sf: str) -> DataFrame:
    return lines.crossings(S.points(spark, sf), S.LINES, _line_bands(spark, sf)).drop("time_bucket")


@query(S.sql("select * from line_counts"))
def line_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _line_counts(spark, sf)


@query(S.sql("select * from line_counts", band=0.0))
def line_counts_band0(spark: SparkSession, sf: str) -> DataFrame:
    return _line_counts(spark, sf, 0.0)


@query(S.sql("select * from line_counts where camera_id = 'loc_click'"))
def line_counts_multi_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Two lines on one camera: neither may disturb the other."""
    own = {"loc_click": S.LINES["loc_click"]}
    return lines.count_lines(S.points(spark, sf), own, _line_bands(spark, sf))


_WEEKDAYS = "['星期一','星期二','星期三','星期四','星期五','星期六','星期日'][isodow({d})]"
_MEAL = "case when hour({t}) >= 11 and hour({t}) < 14 then '加強午餐動線' when hour({t}) >= 17 and hour({t}) < 20 then '加強晚餐動線' else '無' end"


def _periods(name: str, keys: str, sums: str, minutes: int) -> str:
    return f"""select strftime(start, '%Y-%m-%d') as date, {_WEEKDAYS.format(d="start")} as weekday, strftime(start, '%H:%M') as period, start, {keys}, {sums}
      from (select *, time_bucket(interval '{minutes} minutes', time_bucket, timestamp '1970-01-01 00:00:00') as start from {name}) group by all"""


_ZONE_PERIODS = _periods("zone_counts", "zone", "sum(entries)::bigint as value", 120)
_LINE_PERIODS = _periods("line_counts", "line_group, line", "sum(in_count)::bigint as in_count, sum(out_count)::bigint as out_count, (sum(in_count) - sum(out_count))::bigint as net", 120)


def _zone_rollup(spark: SparkSession, sf: str, metric: str = "entries") -> DataFrame:
    return rollup.zone_periods(rollup.with_local_time(_zone_counts(spark, sf)), 120, metric)


def _line_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.line_periods(rollup.with_local_time(_line_counts(spark, sf)), 120)


@query(S.sql(f"select * exclude (start) from ({_ZONE_PERIODS})"))
def zone_rollup_entries(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_rollup(spark, sf)


@query(S.sql(f"select * exclude (start) from ({_ZONE_PERIODS.replace('sum(entries)', 'sum(unique_visitors)')})"))
def zone_rollup_visitors(spark: SparkSession, sf: str) -> DataFrame:
    return _zone_rollup(spark, sf, "unique_visitors")


@query(S.sql(f"select * exclude (start) from ({_LINE_PERIODS})"))
def line_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _line_rollup(spark, sf)


@query(S.sql(f"select date, weekday, zone, period as peak_period, value as peak_value, {_MEAL.format(t='start')} as reminder from ({_ZONE_PERIODS}) qualify row_number() over (partition by date, zone order by value desc, period) = 1"))
def zone_peak(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.zone_peaks(_zone_rollup(spark, sf))


def _line_peak_sql(metric: str) -> str:
    return S.sql(f"select date, weekday, line_group, line, period as peak_period, in_count as peak_in, out_count as peak_out, {_MEAL.format(t='start')} as reminder from ({_LINE_PERIODS}) qualify row_number() over (partition by date, line order by {metric} desc, period) = 1")


@query(_line_peak_sql("in_count"))
def line_peak_in(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.line_peaks(_line_rollup(spark, sf), "in_count")


@query(_line_peak_sql("out_count"))
def line_peak_out(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.line_peaks(_line_rollup(spark, sf), "out_count")


@query(f"select distinct strftime(ts, '%Y-%m-%d') as date, {_WEEKDAYS.format(d='ts')} as weekday from events")
def weekday_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    dates = read_table(spark, sf, "events").select(times.date_text(F.col("ts")).alias("date")).distinct()
    return dates.withColumn("weekday", times.weekday_name(F.col("date")))


@query(f"select event_id, strftime(ts, '%H:%M') as period, {_MEAL.format(t='ts')} as reminder from events")
def meal_reminder(spark: SparkSession, sf: str) -> DataFrame:
    timed = read_table(spark, sf, "events").select("event_id", times.clock_text(F.col("ts")).alias("period"))
    return timed.withColumn("reminder", times.meal_reminder(F.col("period")))


@query("select event_id, ts + interval 8 hours as local_time from events")
def local_time(spark: SparkSession, sf: str) -> DataFrame:
    """Instants of a UTC clock, shown on the local wall clock."""
    instants = read_table(spark, sf, "events").select("event_id", times.instant(F.col("ts"), "UTC").alias("time_bucket"))
    return rollup.with_local_time(instants).select("event_id", "local_time")


def _bucket(minutes: int) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return read_table(spark, sf, "events").select("event_id", times.bucket(F.col("ts"), minutes).alias("time_bucket"))

    run.__name__ = f"bucket_{minutes}m"
    return run


for _m in (7, 360, 1440):
    query(f"select event_id, time_bucket(interval '{_m} minutes', ts, timestamp '1970-01-01 00:00:00') as time_bucket from events")(_bucket(_m))


@query(S.sql("select distinct camera_id, zone from zone_counts where zone <> 'za'").replace("where zone <> 'za'", "where zone = 'za'"))
def unknown_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of the counts that a registry without zone za doesn't know."""
    known = zone_table(spark, {c: [z for z in own if z.name != "za"] for c, own in S.ZONES.items()})
    return checks.unknown_pairs(_zone_counts(spark, sf), known, "zone")


@query("select * from (values ('loc_closed'), ('loc_attic')) t(camera_id) where camera_id not in (select 'loc_' || event_type from events)")
def missing_cameras(spark: SparkSession, sf: str) -> DataFrame:
    cameras = spark.createDataFrame([(c,) for c in [*S.ZONES, "loc_closed", "loc_attic"]], "camera_id string")
    return checks.missing_cameras(cameras, S.tracking(spark, sf))


@query(S.sql("select count(*) > 0 as has_rows from line_counts"))
def orphan_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Whether counts have rows that a registry without lines would orphan."""
    return _line_counts(spark, sf).limit(1).agg((F.count("*") > 0).alias("has_rows"))


@query("select 'gate' as line, 2::bigint as shapes")
def duplicate_names(spark: SparkSession, sf: str) -> DataFrame:
    twice = {c: [g.model_copy(update={"name": "gate" if g.name in ("la", "lb") else g.name}) for g in own] for c, own in S.LINES.items()}
    return checks.duplicate_names(line_table(spark, twice), "line")


_OLD = "old_rows as (select date, zone, value from p where date <= '2024-01-05'), new_rows as (select date, zone, value + 1 as value from p where date >= '2024-01-04' and date <= '2024-01-07')"


def _day_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = _zone_rollup(spark, sf).select("date", "zone", "value")
    return rows.where("date <= '2024-01-05'"), rows.where("date between '2024-01-04' and '2024-01-07'").withColumn("value", F.col("value") + 1)


def _upsert_sql(body: str) -> str:
    return S.sql(f", p as ({_ZONE_PERIODS}), {_OLD} {body}")


@query(_upsert_sql("select * from old_rows where date not in (select date from new_rows) union all select * from new_rows"))
def report_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _day_rows(spark, sf)
    return upsert.overwritten(old, new, upsert.touched_dates([new], "2024-01-04"))


@query(_upsert_sql("select * from old_rows union all select * from new_rows"))
def report_append(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.appended(*_day_rows(spark, sf))


@query(_upsert_sql("select distinct date from old_rows where date in (select date from new_rows)"))
def date_conflict(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _day_rows(spark, sf)
    return upsert.date_conflicts([old], upsert.touched_dates([new], "2024-01-04"))


@query(S.sql("select camera_id, count(*)::bigint as frames, count(*)::double / 3600.0 as fps from trk group by all"))
def camera_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return throughput.camera_throughput(S.tracking(spark, sf), 3600.0)


@query("select count(*)::bigint as total_frames, count(*)::double / 3600.0 as overall_fps, count(*)::double / 1800.0 as detection_fps, 0.0::double as tracking_fps, 3600.0::double as elapsed_seconds from events")
def overall_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return throughput.overall_throughput(S.tracking(spark, sf), 3600.0, 1800.0, 0.0)


@query("""select event_id, timestamp '2026-07-08 08:00:00' + to_milliseconds((event_id * 37123) % 57600000) as start,
    timestamp '2026-07-08 08:00:00' + to_milliseconds((event_id * 37123) % 57600000) + to_microseconds((event_id % 1000) * 40000) as frame_time from events""")
def segment_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Names in UTC read as local starts, and a frame's time in its segment at 25 frames a second."""
    ms = (F.col("event_id") * 37123) % 57600000
    name = F.format_string("%02d%02d%02d.%03dZ.mkv", (ms / 3600000).cast("int"), ((ms % 3600000) / 60000).cast("int"), ((ms % 60000) / 1000).cast("int"), (ms % 1000).cast("int"))
    files = read_table(spark, sf, "events").select("event_id", F.concat(F.lit("loc_cam/2026/07/08/"), name).alias("path"), F.lit("2026-07-08").cast("date").alias("day"))
    located = files.withColumn("start", times.segment_start(F.col("path"), F.col("day")))
    return located.select("event_id", "start", times.frame_time(F.col("start"), F.col("event_id") % 1000, F.lit(25.0)).alias("frame_time"))


_GRID = """
with e as (select * from (values {edges}) t(zone, k, ax, ay, bx, by_)),
box as (select zone, min(ax)::double as x0, max(ax)::double as x1, min(ay)::double as y0, max(ay)::double as y1 from e group by zone),
steps as (select *, greatest(32, ceil((x1 - x0) / 40.0) + 1) as nx, greatest(32, ceil((y1 - y0) / 40.0) + 1) as ny from box),
grid as (select zone, x0 + (x1 - x0) * i / (nx - 1) as x, y0 + (y1 - y0) * j / (ny - 1) as y from steps, generate_series(0, nx::bigint - 1) a(i), generate_series(0, ny::bigint - 1) b(j)),
far as (
  select zone, x, y, sum(case when ((by_ > y) <> (ay > y)) and x < (ax - bx) * (y - by_) / nullif(ay - by_, 0) + bx then 1 else 0 end) % 2 = 1 as inside,
    min(sqrt(pow(x - ax - t * (bx - ax), 2) + pow(y - ay - t * (by_ - ay), 2))) as d
  from (select *, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) as t from grid join e using (zone)) group by all)
select zone, round(max(case when inside then d else -d end), 6) as inradius from far group by zone
"""


@query(_GRID.replace("{edges}", ", ".join(f"('{z.name}', {k}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for own in S.ZONES.values() for z in own for k, (a, b) in enumerate(z.edges()))))
def zone_inradius_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Every zone's inradius over a grid of 40 pixels."""
    return spark.createDataFrame([(z.name, round(G.inradius(z, 40.0), 6)) for own in S.ZONES.values() for z in own], "zone string, inradius double")


@query()
def byte_track(spark: SparkSession, sf: str) -> DataFrame:
    """Tracks from boxes: each user is a walker that steps right, two walkers of a camera in two lanes.

    Every 50 steps the camera sees nobody for 40 frames, longer than a track lasts, and
    every seventh box is faint.
    """
    boxes = S.tracking(spark, sf).select("camera_id", "frame_id", "track_id")
    step = F.row_number().over(tracks.Window.partitionBy("camera_id", F.col("track_id") % 2).orderBy("frame_id"))
    frame = (F.col("k") + F.floor(F.col("k") / 50) * 40).cast("long")

    def clock(number: Column) -> Column:
        return (F.lit("2026-07-08 08:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(number * 0.04).cast("decimal(18,6)"))).alias("timestamp")

    stepped = boxes.withColumn("k", step)
    placed = stepped.select(
        "camera_id",
        frame.alias("frame_id"),
        clock(frame),
        ((F.col("k") % 400) * 4.0).alias("x1"),
        (F.col("track_id") % 2 * 300.0).alias("y1"),
        ((F.col("k") % 400) * 4.0 + 50.0).alias("x2"),
        (F.col("track_id") % 2 * 300.0 + 120.0).alias("y2"),
        F.when(F.col("k") % 7 == 3, 0.3).otherwise(0.9).alias("score"),
        F.lit(1920).cast("long").alias("frame_width"),
        F.lit(1080).cast("long").alias("frame_height"),
    )
    empty = stepped.where("k % 50 = 0").select("camera_id", F.explode(F.sequence(frame - 40, frame - 1)).alias("frame_id"))
    tracked = track_detections(placed, TrackerSettings(), frames=empty.select("camera_id", "frame_id", clock(F.col("frame_id"))))
    return tracked.groupBy("camera_id", "track_id").agg(F.count("*").alias("frames"), F.min("y1").alias("lane"))
