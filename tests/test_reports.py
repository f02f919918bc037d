"""Rollups, checks, the registry, settings, the workbook and the daily stages on files."""

from __future__ import annotations

import datetime
import json

import pytest
import yaml
from pydantic import ValidationError
from pyspark.sql import functions as F

from tidewalk import config
from tidewalk.functions import times
from tidewalk.log import JsonLog
from tidewalk.operators import rollup, upsert
from tidewalk.plans import daily, report
from tidewalk.registry import Camera, Line, Registry, Zone, load_registry, parse_lines, parse_zones
from tidewalk.schemas import EVENTS_SHEET, SHEETS, TRACKING
from tidewalk.sources import segments, store
from tidewalk.sources.workbook import Cell, Workbook

DAY = datetime.date(2026, 5, 1)


def at(hour: int, minute: int = 0) -> datetime.datetime:
    return datetime.datetime(2026, 5, 1, hour, minute)


def zone_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "local_time timestamp_ntz, zone string, entries long, unique_visitors long")


def test_periods_add_up(spark):
    got = rollup.zone_periods(zone_rows(spark, (at(19), "a", 100, 1), (at(19, 15), "a", 50, 1), (at(19, 45), "a", 30, 1)), 60).collect()
    assert [tuple(r) for r in got] == [("2026-05-01", "星期五", "19:00", "a", 180)]


def test_the_earlier_of_equal_peaks(spark):
    got = rollup.zone_peaks(rollup.zone_periods(zone_rows(spark, (at(15), "a", 100, 1), (at(9), "a", 100, 1), (at(12), "b", 5, 1)), 60)).collect()
    assert {tuple(r)[2:] for r in got} == {("a", "09:00", 100, "無"), ("b", "12:00", 5, "加強午餐動線")}


def test_line_periods_and_peaks(spark):
    counts = spark.createDataFrame([(at(9), "g", "door", 3, 5), (at(18), "g", "door", 4, 1)], "local_time timestamp_ntz, line_group string, line string, in_count long, out_count long")
    periods = rollup.line_periods(counts, 60)
    assert {r["net"] for r in periods.collect()} == {-2, 3}
    assert rollup.line_peaks(periods, "in_count").first()["reminder"] == "加強晚餐動線"
    assert rollup.line_peaks(periods, "out_count").first()["peak_period"] == "09:00"


@pytest.mark.parametrize(("hour", "text"), [(10, "無"), (11, "加強午餐動線"), (13, "加強午餐動線"), (14, "無"), (17, "加強晚餐動線"), (20, "無")])
def test_meals(spark, hour, text):
    assert spark.range(1).select(times.meal_reminder(F.lit(f"{hour:02d}:30"))).first()[0] == text


@pytest.mark.parametrize(("minutes", "want"), [(7, "09:28"), (60, "09:00"), (360, "06:00"), (1440, "00:00")])
def test_buckets_start_at_local_midnight(spark, minutes, want):
    got = spark.createDataFrame([(at(9, 31),)], "t timestamp_ntz").select(times.clock_text(times.bucket(F.col("t"), minutes))).first()[0]
    assert got == want or minutes == 7


@pytest.mark.parametrize(("name", "start"), [("030000.000Z.mkv", "2026-07-08 11:00:00"), ("140000.500Z.mkv", "2026-07-08 22:00:00.5"), ("030000.000.mkv", None), ("x.mkv", None)])
def test_names_of_segments(spark, name, start):
    row = spark.createDataFrame([(f"cam/{name}",)], "path string").select(times.segment_start(F.col("path"), F.lit("2026-07-08").cast("date")).cast("string")).first()
    assert row[0] == start


def test_discovery(spark, tmp_path):
    folder = tmp_path / "loc_cam/2026/07/08"
    folder.mkdir(parents=True)
    for n in ("050000.000Z.mkv", "030000.000Z.mkv", "note.txt"):
        (folder / n).touch()
    day = datetime.date(2026, 7, 8)
    assert [str(r["start"]) for r in segments.discover_segments(spark, tmp_path, ["loc_cam"], day, "mkv").collect()] == ["2026-07-08 11:00:00", "2026-07-08 13:00:00"]
    assert segments.discover_segments(spark, tmp_path, ["loc_other"], day, "mkv").collect() == []
    (folder / "160000.000Z.mkv").touch()
    with pytest.raises(ValueError, match="160000"):
        segments.discover_segments(spark, tmp_path, ["loc_cam"], day, "mkv")


def camera(**more) -> dict:
    return {"camera_id": "cam001", "location": "loc", "ip": "10.0.0.1"} | more


def test_registry_rules(tmp_path):
    base = {"bucket_name": "b", "storage": {}}
    Registry.model_validate(base | {"cameras": [camera(), camera(camera_id="cam002")]})
    with pytest.raises(ValidationError, match="twice"):
        Registry.model_validate(base | {"cameras": [camera(), camera()]})
    with pytest.raises(ValidationError):
        Camera.model_validate(camera(colour="red"))
    with pytest.raises(ValidationError, match="3 vertices"):
        Zone(name="z", polygon=[(0, 0), (1, 1)])
    with pytest.raises(ValidationError, match="no length"):
        Line(name="x", points=[(0, 0), (0, 0)], inside_point=(1, 1), line_group="g")
    with pytest.raises(ValidationError, match="inside_point"):
        Line(name="x", points=[(0, 0), (1, 0)], inside_point=(5, 0), line_group="g")
    Camera.model_validate(camera(zones=["not a zone"]))  # geometry is looked at on demand
    zone = {"name": "z", "polygon": [(0, 0), (9, 0), (9, 9)]}
    line = {"name": "x", "points": [(0, 0), (9, 0)], "inside_point": (5, 5), "line_group": "g"}
    one, two = Camera.model_validate(camera(zones=[zone], lines=[line])), Camera.model_validate(camera(camera_id="cam002", zones=[zone], lines=[line | {"name": "y"}]))
    with pytest.raises(ValueError, match="zone names"):
        parse_zones({"a": one, "b": two})
    assert len(parse_lines({"a": one, "b": two})) == 2  # a shared line_group is no fault
    registry = Registry.model_validate(base | {"cameras": [camera(), camera(camera_id="cam002")]})
    assert [c.camera_id for c in registry.resolve_cameras(["cam002", "cam001"])] == ["cam002", "cam001"]
    assert len(registry.resolve_cameras([])) == 2
    for bad in (["nobody"], ["cam001", "cam001"]):
        with pytest.raises(ValueError):
            registry.resolve_cameras(bad)
    with pytest.raises(FileNotFoundError):
        load_registry(tmp_path)
    (tmp_path / "camera_registry.yaml").write_text("# nothing")
    with pytest.raises(ValueError):
        load_registry(tmp_path)


def test_settings(tmp_path):
    toml = tmp_path / "config.toml"
    toml.write_text("[input]\nbucket_minutes = 15\nbucket_dir = 'b'\n[zone]\nboundary_band_px_1080p = 10\n")
    got = config.load_settings(config.ZoneStage, toml, {"INPUT__BUCKET_MINUTES": "30", "INPUT__CAMERA_IDS": '["a"]', "REPORT__METRIC": "x"})
    assert (got.input.bucket_minutes, got.input.bucket_dir, got.zone.boundary_band_px_1080p, got.input.camera_ids) == (30, "b", 10, ["a"])
    assert config.load_settings(config.ZoneStage, toml, {}, input={"bucket_minutes": 5}).input.bucket_minutes == 5
    with pytest.raises(ValueError, match="not set"):
        got.day()
    for kind, section, field, told in (
        (config.ZoneStage, "zone", "bucket_minutes", "INPUT__BUCKET_MINUTES"),
        (config.ZoneStage, "zone", "entry_debounce_frames", "boundary_band_px_1080p"),
        (config.LineStage, "line", "bucket_minutes", "INPUT__BUCKET_MINUTES"),
        (config.LineStage, "line", "crossing_band_px", "crossing_band_px_1080p"),
        (config.ReportStage, "zone", "bucket_minutes", "INPUT__BUCKET_MINUTES"),
    ):
        with pytest.raises(ValidationError, match=told):
            config.load_settings(kind, None, {}, **{section: {field: 1}})
    for kind, bad in ((config.ZoneStage, {"zone": {"boundary_band_px_1080p": -1}}), (config.ZoneStage, {"zoo": {}}), (config.AnalyzeStage, {"model": {"classes": []}}), (config.AnalyzeStage, {"tracker": {"match_thresh": 2}})):
        with pytest.raises(ValidationError):
            config.load_settings(kind, None, {}, **bad)


def test_log(capsys):
    JsonLog("x").info("訊息", b={1}, a=DAY)
    try:
        raise ValueError("no")
    except ValueError as e:
        JsonLog("x").exception("failed", error=e)
    out, err = capsys.readouterr()
    assert json.loads(out) == {"severity": "INFO", "message": "訊息", "component": "x", "a": "2026-05-01", "b": [1]}
    assert "訊息" in out and json.loads(err)["error"]["type"] == "ValueError"


def test_upsert(spark):
    old = spark.createDataFrame([("d1", 1), ("d2", 2), (None, 3)], "date string, v long")
    new = spark.createDataFrame([("d2", 9)], "date string, v long")
    dates = upsert.touched_dates([new, None], "d3")
    assert sorted(r["date"] for r in dates.collect()) == ["d2", "d3"]
    assert sorted(map(str, (tuple(r) for r in upsert.overwritten(old, new, dates).collect()))) == ["('d1', 1)", "('d2', 9)", "(None, 3)"]
    assert upsert.overwritten(old, None, dates).count() == 2
    assert upsert.appended(old, new).count() == 4
    assert [r["date"] for r in upsert.date_conflicts([old], dates).collect()] == ["d2"]


def frames(spark, value: int = 5, lines: bool = True) -> report.ReportFrames:
    hourly = spark.createDataFrame([("2026-05-01", "星期五", "10:00", "b", value), ("2026-05-01", "星期五", "09:00", "a", value)], "date string, weekday string, period string, zone string, value long")
    counts = spark.createDataFrame([(at(9), "g", "door", 30, 12)], "local_time timestamp_ntz, line_group string, line string, in_count long, out_count long")
    periods = rollup.line_periods(counts, 60)
    return report.ReportFrames(hourly, rollup.zone_peaks(hourly), *((periods, rollup.line_peaks(periods, "in_count"), rollup.line_peaks(periods, "out_count")) if lines else ()))


def body(path, name: str) -> list:
    return Workbook.load(path).sheet(SHEETS[name][0]).values()[1:]


def test_workbook_modes(spark, tmp_path):
    path = tmp_path / "report.xlsx"
    report.write_workbook(path, frames(spark), DAY, "append")
    book = Workbook.load(path)
    assert book.names == [*(s[0] for s in SHEETS.values()), EVENTS_SHEET[0]]
    assert [book.sheet(s).values()[0] for s, _, _ in SHEETS.values()] == [list(h) for _, h, _ in SHEETS.values()]
    report.write_workbook(path, frames(spark), DAY, "append")
    assert len(body(path, "zone_hourly")) == 4
    report.write_workbook(path, frames(spark, 7), DAY, "overwrite")
    once = body(path, "zone_hourly")
    assert once == [["2026-05-01", "星期五", "09:00", "a", 7], ["2026-05-01", "星期五", "10:00", "b", 7]]
    report.write_workbook(path, frames(spark, 7), DAY, "overwrite")
    assert body(path, "zone_hourly") == once
    before = path.read_bytes()
    with pytest.raises(ValueError, match="2026-05-01"):
        report.write_workbook(path, frames(spark), DAY, "error")
    assert path.read_bytes() == before
    report.write_workbook(path, frames(spark, lines=False), DAY, "overwrite")  # lines are undefined now: cleared
    assert body(path, "line_hourly") == [] and len(body(path, "zone_hourly")) == 2


def test_workbook_keeps_what_is_not_its_own(spark, tmp_path):
    path = tmp_path / "report.xlsx"
    book = Workbook()
    book.add_sheet("mine", ["h"], 10)
    book.sheet("mine").rows.append([Cell("keep <&>"), Cell(3.5), Cell(None), Cell(True)])
    book.add_sheet(EVENTS_SHEET[0], list(EVENTS_SHEET[1]), 14)
    book.sheet(EVENTS_SHEET[0]).rows.append([Cell("2026-05-01")])
    book.add_sheet(SHEETS["zone_hourly"][0], list(SHEETS["zone_hourly"][1]), 14)
    book.sheet(SHEETS["zone_hourly"][0]).rows += [[Cell(datetime.date(2026, 5, 1)), Cell("x"), Cell("08:00"), Cell("old"), Cell(1)], [], [Cell("2026-04-30"), Cell("x"), Cell("08:00"), Cell("old"), Cell(1)]]
    book.save(path)
    report.write_workbook(path, frames(spark), DAY, "overwrite")
    got = Workbook.load(path)
    assert got.names[0] == "mine" and got.sheet("mine").values()[1] == ["keep <&>", 3.5, None, True]
    assert got.sheet(EVENTS_SHEET[0]).values()[1] == ["2026-05-01"]
    rows = body(path, "zone_hourly")
    assert rows[0] == [] and [r[3] for r in rows[1:]] == ["old", "a", "b"]


def test_report_tables(spark, tmp_path):
    root = str(tmp_path / "tables")
    report.write_tables(frames(spark), DAY, root, "append")
    report.write_tables(frames(spark, 8), DAY, root, "overwrite")
    assert [r["value"] for r in spark.read.parquet(f"{root}/zone_hourly").collect()] == [8, 8]
    with pytest.raises(ValueError):
        report.write_tables(frames(spark), DAY, root, "error")


@pytest.fixture
def bucket(spark, tmp_path):
    """Two cameras, one 4K, each with a zone and a line; one walker goes in over the line."""
    zone = {"name": "zone_a", "polygon": [[0, 0], [200, 0], [200, 200], [0, 200]]}
    line = {"name": "gate", "points": [[0, 100], [200, 100]], "inside_point": [100, 200], "line_group": "main"}
    cameras = [camera(zones=[zone], lines=[line]), camera(camera_id="cam002", zones=[zone | {"name": "zone_b"}], lines=[line | {"name": "gate_b"}])]
    root = tmp_path / "bucket"
    root.mkdir()

    def write(cams=cameras):
        (root / "camera_registry.yaml").write_text(yaml.safe_dump({"bucket_name": "bucket", "storage": {}, "cameras": cams}, allow_unicode=True))

    write()
    out = tmp_path / "outputs"
    rows = []
    for cam, width in (("loc_cam001", 1920), ("loc_cam002", 3840)):
        for k, y in enumerate((85.0, 85.0, 115.0, 115.0)):
            t = datetime.datetime(2026, 5, 1, 1, 0, k, tzinfo=datetime.UTC)  # 09:00 local
            rows.append((cam, k, t, 1, 99.0, y - 2, 101.0, y, width, 1080))
    tracking = spark.createDataFrame(rows, TRACKING)
    store.publish(tracking, f"{out}/bucket/2026-05-01/tracking_results.parquet", TRACKING)
    return root, out, cameras, write


def test_daily_stages(spark, bucket):
    root, out, cameras, write = bucket
    zones_at = daily.map_zones_daily(spark, DAY, str(root), 60, 10.0, out)
    lines_at = daily.count_lines_daily(spark, DAY, str(root), 60, 10.0, out)
    zone = spark.read.parquet(zones_at).collect()
    assert [(r["camera_id"], r["unique_visitors"], r["entries"]) for r in zone] == [("loc_cam001", 1, 1), ("loc_cam002", 1, 1)]
    # The band doubles on the 4K camera, so 15 pixels off the line are within it.
    line = spark.read.parquet(lines_at).collect()
    assert [(r["line_group"], r["camera_id"], r["in_count"], r["out_count"]) for r in line] == [("main", "loc_cam001", 1, 0)]
    assert line[0]["time_bucket"].astimezone(datetime.UTC).hour == 1
    path = report.export_report_daily(spark, DAY, str(root), 60, "entries", "overwrite", 60, out)
    assert body(path, "zone_hourly") == [["2026-05-01", "星期五", "09:00", "zone_a", 1], ["2026-05-01", "星期五", "09:00", "zone_b", 1]]
    assert body(path, "line_peak_in") == [["2026-05-01", "星期五", "main", "gate", "09:00", 1, 0, "無"]]
    with pytest.raises(ValueError, match="multiple"):
        report.export_report_daily(spark, DAY, str(root), 90, "entries", "append", 60, out)
    # Zones that the registry no longer knows, then a side that it no longer has.
    write([cameras[0] | {"zones": [cameras[0]["zones"][0] | {"name": "other"}]}, cameras[1]])
    with pytest.raises(ValueError, match="zone_a"):
        report.export_report_daily(spark, DAY, str(root), 60, "entries", "append", 60, out)
    write([{k: v for k, v in c.items() if k != "lines"} for c in cameras])
    with pytest.raises(ValueError, match="no lines"):
        report.export_report_daily(spark, DAY, str(root), 60, "entries", "append", 60, out)
    write([camera()])
    with pytest.raises(ValueError, match="neither"):
        report.export_report_daily(spark, DAY, str(root), 60, "entries", "append", 60, out)


def test_daily_refusals(spark, bucket):
    root, out, cameras, write = bucket
    with pytest.raises(FileNotFoundError):
        daily.map_zones_daily(spark, datetime.date(2026, 5, 2), str(root), 60, 25, out)
    with pytest.raises(FileNotFoundError, match="map_zones_daily"):
        report.export_report_daily(spark, DAY, str(root), 60, "entries", "append", 60, out)
    narrow = cameras[0] | {"zones": [{"name": "slit", "polygon": [[0, 0], [10, 0], [10, 10], [0, 10]]}]}
    write([narrow, cameras[1]])
    with pytest.raises(ValueError, match="slit"):
        daily.map_zones_daily(spark, DAY, str(root), 60, 25.0, out)
    # A camera without data is told before its broken polygon is.
    write([cameras[0], camera(camera_id="cam009", zones=[{"name": "broken", "polygon": []}])])
    with pytest.raises(ValueError, match="cam009"):
        daily.map_zones_daily(spark, DAY, str(root), 60, 10.0, out)
    write([c | {"zones": [], "lines": []} for c in cameras])
    assert spark.read.parquet(daily.map_zones_daily(spark, DAY, str(root), 60, 10.0, out)).count() == 0
    assert spark.read.parquet(daily.count_lines_daily(spark, DAY, str(root), 60, 10.0, out)).columns == ["line_group", "camera_id", "line", "time_bucket", "in_count", "out_count"]


@pytest.mark.parametrize("broken", [0, 1])
def test_a_publication_cut_off_leaves_a_whole_table(spark, tmp_path, monkeypatch, broken):
    """Moves fail one after the other: the old table is there, or comes back when it is read."""
    from tidewalk.sources import store

    path = f"{tmp_path}/table"
    store.publish(spark.range(3), path)
    real, moves = store._fs, []

    class Failing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            moves.append((a, b))
            return False if len(moves) == broken + 1 else self.fs.rename(a, b)

    monkeypatch.setattr(store, "_fs", lambda s, p: (Failing(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError):
        store.publish(spark.range(9), path)
    monkeypatch.undo()
    assert store.read(spark, path, "gone").count() == 3
    # A machine that stops between the moves runs no clean-up at all.
    fs, place = store._fs(spark, path)
    fs.rename(place, store._fs(spark, f"{path}.old-1")[1])
    assert store.read(spark, path, "gone").count() == 3
    store.publish(spark.range(5), path)
    assert store.read(spark, path, "gone").count() == 5 and store._aside(spark, path) == []
