"""A day's report: what the registry asks for, rolled up, and laid into the cumulative workbook or tables."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidewalk.log import JsonLog
from tidewalk.operators import checks, rollup
from tidewalk.operators.upsert import date_conflicts, touched_dates
from tidewalk.registry import Camera, line_table, load_registry, parse_lines, parse_zones, registry_path, zone_table
from tidewalk.schemas import COLUMN_WIDTH, EVENTS_SHEET, LINE_FILE, REPORT_FILE, SHEETS, ZONE_FILE
from tidewalk.sources import store
from tidewalk.sources.workbook import Cell, Workbook

log = JsonLog("report")
MODES = ("overwrite", "append", "error")


@dataclass
class ReportFrames:
    """The report's tables; None: the registry defines nothing of this kind, which isn't the same as no rows."""

    zone_hourly: DataFrame | None = None
    zone_peak: DataFrame | None = None
    line_hourly: DataFrame | None = None
    line_peak_in: DataFrame | None = None
    line_peak_out: DataFrame | None = None

    def items(self) -> list[tuple[str, DataFrame | None]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


def zone_frames(counts: DataFrame, period_minutes: int, metric: str) -> tuple[DataFrame, DataFrame]:
    periods = rollup.zone_periods(rollup.with_local_time(counts), period_minutes, metric)
    return periods.orderBy("date", "period", "zone"), rollup.zone_peaks(periods).orderBy("date", "zone")


def line_frames(counts: DataFrame, period_minutes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    periods = rollup.line_periods(rollup.with_local_time(counts), period_minutes)
    peaks = [rollup.line_peaks(periods, m).orderBy("date", "line") for m in ("in_count", "out_count")]
    return periods.orderBy("date", "period", "line"), *peaks


def _counts(spark: SparkSession, path: str, kind: str, stage: str, registry_file: Path) -> DataFrame:
    return store.read(spark, path, f"{registry_file} defines {kind}, but {path} isn't there; run {stage} for that day first")


def _reject_orphans(spark: SparkSession, path: str, kind: str, cause: str, registry_file: Path) -> None:
    """Counts with rows whose side the registry no longer defines would vanish from the report without a word."""
    if store.exists(spark, path) and not spark.read.parquet(path).isEmpty():
        raise ValueError(f"{registry_file} defines no {kind} any more ({cause}), but {path} has rows: restore the definition, or remove that table if {kind} are no longer wanted")


def build_frames(spark: SparkSession, date: datetime.date, bucket_dir: str, period_minutes: int, metric: str, bucket_minutes: int, output_root: str | Path) -> ReportFrames:
    """The registry, not what files there are, decides what must be reported."""
    if period_minutes % bucket_minutes:
        raise ValueError(f"report.period_minutes ({period_minutes}) must be a multiple of input.bucket_minutes ({bucket_minutes})")
    bucket = Path(bucket_dir)
    folder, file = f"{output_root}/{bucket.name}/{date.isoformat()}", registry_path(bucket)
    registry = load_registry(bucket)
    zoned: dict[str, Camera] = registry.zone_cameras()
    lined: dict[str, Camera] = registry.line_cameras()
    has_zones = any(c.zones for c in zoned.values())
    if not has_zones and not lined:
        raise ValueError(f"{file} defines neither zones nor lines; there is nothing to report")
    out = ReportFrames()
    zone_path, line_path = f"{folder}/{ZONE_FILE}", f"{folder}/{LINE_FILE}"
    if has_zones:
        counts = _counts(spark, zone_path, "zones", "map_zones_daily", file)
        checks.reject_unknown_pairs(counts, zone_table(spark, parse_zones(zoned)), "zone", zone_path)
        out.zone_hourly, out.zone_peak = zone_frames(counts, period_minutes, metric)
    else:
        _reject_orphans(spark, zone_path, "zones", "zones are empty, or no camera takes part in zone mapping", file)
    if lined:
        counts = _counts(spark, line_path, "lines", "count_lines_daily", file)
        checks.reject_unknown_pairs(counts, line_table(spark, parse_lines(lined)), "line", line_path)
        out.line_hourly, out.line_peak_in, out.line_peak_out = line_frames(counts, period_minutes)
    else:
        _reject_orphans(spark, line_path, "lines", "no camera has lines", file)
    return out


def _date_of(value: object) -> str | None:
    """A date cell as text, whatever a spreadsheet program has made of it."""
    if value is None:
        return None
    return value.strftime("%Y-%m-%d") if isinstance(value, datetime.date) else str(value)


def write_workbook(path: str | Path, frames: ReportFrames, date: datetime.date, mode: str) -> dict[str, int | None]:
    """Lay the tables into the workbook's sheets; returns rows by sheet, None for what isn't defined.

    ``overwrite`` clears the run's dates from every sheet, adds the rows and sorts;
    ``append`` adds them at the end; ``error`` refuses, before anything is written, if
    any sheet has one of the dates.  Other sheets are left alone.
    """
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    rows = {name: None if f is None else [tuple(r) for r in f.toLocalIterator()] for name, f in frames.items()}
    dates = {date.isoformat()} | {r[0] for found in rows.values() for r in found or ()}
    book = Workbook.load(path) if Path(path).exists() else Workbook()
    for sheet, headers, _ in SHEETS.values():
        book.add_sheet(sheet, list(headers), COLUMN_WIDTH)
    book.add_sheet(EVENTS_SHEET[0], list(EVENTS_SHEET[1]), COLUMN_WIDTH)
    sheets = {name: book.sheet(SHEETS[name][0]) for name in rows}
    if mode == "error":
        there = {_date_of(r[0].value) for s in sheets.values() for r in s.rows[1:] if r}
        if clash := sorted(dates & there):
            raise ValueError(f"the report already has {clash}; nothing was written (use 'overwrite' or 'append')")
    for name, sheet in sheets.items():
        head, body = sheet.rows[:1], sheet.rows[1:]
        if mode == "overwrite":
            body = [r for r in body if not (r and _date_of(r[0].value) in dates)]
        body = body + [[Cell(v) for v in r] for r in rows[name] or ()]
        if mode == "overwrite":
            _, headers, keys = SHEETS[name]
            at = [headers.index(k) for k in keys]

            def key(r: list[Cell], at=at) -> tuple[str, ...]:
                return tuple("" if len(r) <= k or r[k].value is None else str(_date_of(r[k].value)) for k in at)

            body.sort(key=key)
        sheet.rows = head + body
    book.save(path)
    return {SHEETS[name][0]: None if found is None else len(found) for name, found in rows.items()}


def write_tables(frames: ReportFrames, date: datetime.date, root: str, mode: str) -> None:
    """The same report as Parquet tables partitioned by date, for histories that outgrow a workbook.

    ``overwrite`` replaces the partitions of the run's dates in every table: new rows are
    staged by Spark and take their partitions' places when all are written; only then go
    the partitions of dates without new rows.
    """
    if mode not in MODES:
        raise ValueError(f"no such mode: {mode}")
    given = [(n, f) for n, f in frames.items()]
    spark = next(f.sparkSession for _, f in given if f is not None)
    dates = [r["date"] for r in touched_dates([f for _, f in given], date.isoformat()).collect()]
    old = {n: f"{root}/{n}" for n, _ in given}
    if mode == "error":
        tables = [spark.read.option("basePath", p).parquet(p).selectExpr("cast(date as string) as date") for p in old.values() if store.exists(spark, p)]
        wanted = spark.createDataFrame([(d,) for d in dates], "date string")
        if tables and (clash := [r["date"] for r in date_conflicts(tables, wanted).collect()]):
            raise ValueError(f"the report already has {sorted(clash)}; nothing was written")
    for name, frame in given:
        own: set[str] = set()
        if frame is not None and mode == "overwrite":
            own = {r["date"] for r in frame.select("date").distinct().collect()}
            frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(old[name])
        elif frame is not None:
            frame.write.mode("append").partitionBy("date").parquet(old[name])
        if mode == "overwrite":
            for d in sorted({*dates} - own):
                store.remove(spark, f"{old[name]}/date={d}")


def export_report_daily(spark: SparkSession, date: datetime.date, bucket_dir: str, period_minutes: int, metric: str, on_duplicate_date: str, bucket_minutes: int, output_root: str | Path = "outputs") -> Path:
    """Roll a day up and lay it into ``report.xlsx``; returns its path."""
    frames = build_frames(spark, date, bucket_dir, period_minutes, metric, bucket_minutes, output_root)
    path = Path(output_root) / Path(bucket_dir).name / REPORT_FILE
    counts = write_workbook(path, frames, date, on_duplicate_date)
    log.info("report written", path=str(path), rows_by_sheet=counts)
    return path
