"""Zone entries and line crossings, case by case."""

from __future__ import annotations

import datetime

import pytest

from tidewalk.functions import geometry
from tidewalk.operators import lines, tracks, zones
from tidewalk.registry import Line, Zone

SQUARE = Zone(name="square", polygon=[(0, 0), (10, 0), (10, 10), (0, 10)])
BIG = Zone(name="square", polygon=[(0, 0), (100, 0), (100, 100), (0, 100)])
POINT = {"I": (50, 50), "O": (-50, 50), "i": (0.5, 50), "o": (-0.5, 50)}
START = datetime.datetime(2026, 5, 1, 9, 0)


def rows(spark, paths: dict[int, list[tuple[float, float]]], step_seconds: int = 1, camera: str = "cam", minutes: int = 60):
    data = [(camera, track, START + datetime.timedelta(seconds=step_seconds * k), float(x), float(y)) for track, path in paths.items() for k, (x, y) in enumerate(path)]
    made = spark.createDataFrame(data, "camera_id string, track_id long, timestamp timestamp_ntz, x double, y2 double")
    return tracks.foot_points(made.selectExpr("camera_id", "track_id", "timestamp", "x - 1 as x1", "x + 1 as x2", "y2"), minutes)


def entries(spark, text: str, band: float, **cut) -> int:
    points = rows(spark, {1: [POINT[c] for c in text]}, **cut)
    return sum(r["entries"] for r in zones.count_zones(points, {"cam": [BIG]}, {"cam": band}).collect())


@pytest.mark.parametrize(
    ("path", "band", "want"),
    [("III", 2, 1), ("OioioIoiI", 2, 1), ("OioioI", 0, 3), ("IOI", 2, 2), ("OIIOI", 0, 2), ("O", 2, 0), ("iii", 2, 0), ("OiI", 2, 1)],
)
@pytest.mark.parametrize("step_seconds", [1, 25, 60])
def test_entries(spark, path, band, want, step_seconds):
    """The same however a track is cut into pieces: one piece, some rows in each, a piece per row."""
    assert entries(spark, path, band, step_seconds=step_seconds, minutes=1 if step_seconds > 1 else 60) == want
    points = rows(spark, {1: [POINT[c] for c in path]}, step_seconds=step_seconds)
    assert zones.zone_entries(points, {"cam": [BIG]}, {"cam": float(band)}).count() == want


def test_visitors_look_at_the_zone_alone(spark):
    points = rows(spark, {1: [POINT["I"], POINT["o"]]}, step_seconds=3600)
    got = zones.count_zones(points, {"cam": [BIG]}, {"cam": 2.0}).collect()
    assert [(r["unique_visitors"], r["entries"]) for r in got] == [(1, 1)]


def test_tracks_do_not_leak_into_each_other(spark):
    paths = {1: [POINT["I"], POINT["I"]], 2: [POINT["I"]], 3: [POINT["i"], POINT["o"], POINT["O"]]}
    got = zones.count_zones(rows(spark, paths), {"cam": [BIG]}, {"cam": 2.0}).collect()
    assert [(r["unique_visitors"], r["entries"]) for r in got] == [(3, 2)]


def test_zones_of_one_camera_do_not_disturb_each_other(spark):
    far = Zone(name="far", polygon=[(-100, 0), (-10, 0), (-10, 100), (-100, 100)])
    got = zones.count_zones(rows(spark, {1: [POINT[c] for c in "OIOI"]}), {"cam": [BIG, far]}, {"cam": 0.0}).collect()
    assert {(r["zone"], r["entries"]) for r in got} == {("square", 2), ("far", 2)}


def test_edges_in_an_array_give_the_same_as_columns(spark, monkeypatch):
    points = rows(spark, {t: [POINT[c] for c in "OioioIoiIO"[t:]] for t in range(5)})
    shapes = {"cam": [BIG, SQUARE.model_copy(update={"name": "b"}), Zone(name="c", polygon=[(0, 0), (50, 0), (100, 40), (100, 100), (40, 100)])]}
    one = sorted(map(tuple, zones.count_zones(points, shapes, {"cam": 2.0}).collect()))
    monkeypatch.setattr(geometry, "UNROLLED", 2)
    two = sorted(map(tuple, zones.count_zones(points, shapes, {"cam": 2.0}).collect()))
    assert one == two and one


def test_fifty_cameras_need_no_python_and_no_larger_plan(spark):
    many = {f"cam{k}": [Zone(name=f"z{k}", polygon=[(0, 0), (100, 0), (100, 100), (50, 120 + k), (0, 100)])] for k in range(50)}
    doors = {f"cam{k}": [Line(name=f"l{k}", points=[(0, 10), (20, 10), (30, 15), (40 + k, 10)], inside_point=(10, 0), line_group="g")] for k in range(50)}
    points, bands = rows(spark, {1: [POINT["I"]]}, camera="cam7"), {f"cam{k}": 1.0 for k in range(50)}
    for many_of, count, few in ((many, zones.count_zones, {"cam7": many["cam7"]}), (doors, lines.count_lines, {"cam7": doors["cam7"]})):
        plans = [count(points, shapes, bands)._jdf.queryExecution().executedPlan().toString() for shapes in (many_of, few)]
        assert "Pandas" not in plans[0] and "Arrow" not in plans[0]
        assert len(plans[0]) < 1.2 * len(plans[1])
    assert [tuple(r)[:2] for r in zones.count_zones(points, many, bands).collect()] == [("cam7", "z7")]


def test_no_rows_give_no_counts(spark):
    assert zones.count_zones(rows(spark, {1: [POINT["I"]]}, camera="other"), {"cam": [BIG]}, {"cam": 2.0}).collect() == []


DOOR = dict(name="door", points=[(0, 10), (20, 10)], inside_point=(10, 0), line_group="g")
VEE = dict(name="door", points=[(0, 10), (10, 20), (20, 10)], inside_point=(10, 0), line_group="g")
CUP = dict(name="door", points=[(0, 0), (0, 20), (30, 20), (30, 0)], inside_point=(15, 10), line_group="g")


@pytest.mark.parametrize(
    ("line", "path", "band", "want"),
    [
        (DOOR, [(10, 20), (10, 20), (10, 0)], 0, (1, 0)),
        (DOOR, [(10, 0), (10, 0), (10, 20)], 0, (0, 1)),
        (DOOR, [(10, 20), (10, 15), (10, 20)], 0, (0, 0)),
        (DOOR, [(10, 0), (10, 20)], 0, (0, 1)),
        (VEE, [(10, 30), (10, 15), (10, 5)], 0, (1, 0)),
        (DOOR, [(10, 20), (10, 9), (10, 20), (10, 20)], 3, (0, 0)),
        (DOOR, [(10, 20), (10, 9), (10, 20), (10, 20)], 0, (1, 1)),
        (DOOR, [(10, 20), (10, 0)], 3, (1, 0)),
        (DOOR, [(10, 20), (10, 7)], 3, (0, 0)),
        (DOOR, [(10, 20), (10, 9), (10, 9), (10, 0)], 3, (1, 0)),
        (DOOR, [(25, 20), (25, 0)], 0, (0, 0)),
        (DOOR, [(5000, 20), (5000, 0)], 3, (0, 0)),
        (DOOR, [(25, 20), (10, 0)], 3, (1, 0)),
        (DOOR, [(10, 20), (10, 11), (10, 9), (10, 9), (10, 0)], 3, (1, 0)),
        (CUP, [(-10, 30), (10, 5)], 0, (1, 0)),
        (DOOR, [(10, 20), (10, 10), (10, 0)], 0, (1, 0)),
        # Round the end, then through; through, then round the end.
        (DOOR, [(25, 20), (25, 0), (10, 0), (10, 20), (10, 0)], 0, (1, 1)),
    ],
)
@pytest.mark.parametrize(("unrolled", "step_seconds"), [(1, 1), (16, 1), (16, 25), (16, 60)])
def test_crossings(spark, monkeypatch, line, path, band, want, unrolled, step_seconds):
    monkeypatch.setattr(geometry, "UNROLLED", unrolled)
    shape = {"cam": [Line(**line)]}, {"cam": float(band)}
    got = lines.count_lines(rows(spark, {1: path}, step_seconds=step_seconds, minutes=1 if step_seconds > 1 else 60), *shape).collect()
    assert lines.crossings(rows(spark, {1: path}), *shape).count() == sum(want)
    assert (sum(r["in_count"] for r in got), sum(r["out_count"] for r in got)) == want
    assert all(r["line_group"] == "g" for r in got)


def test_rows_are_shuffled_once_for_all_zones(spark):
    plan = zones.count_zones(rows(spark, {1: [POINT["I"]]}), {"cam": [BIG]}, {"cam": 2.0})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(camera_id") == 3  # rows to pieces, pieces to tracks, sums to buckets
