"""``python -m tidewalk.cli analyze|zones|lines|report [config.toml]``: the daily stages with settings from TOML and environment."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tidewalk import config
from tidewalk.operators.detector import detect
from tidewalk.plans import daily, report


def run(spark: SparkSession, stage: str, toml: str | None = None, output_root: str = "outputs", **told) -> str:
    """Run one stage, its files below ``output_root``; returns where its result is. A day must be set."""
    if stage == "analyze":
        s = config.load_settings(config.AnalyzeStage, toml, **told)
        day, p = s.day(), s.plugins
        if not p.loader:
            raise ValueError("[plugins].loader is not set; name the function that loads the detection model")
        done = daily.analyze_daily(
            spark,
            day,
            s.input.bucket_dir,
            lambda frames: detect(frames, s.model, p.loader),
            s.input.camera_ids,
            s.tracker,
            p.decoder,
            output_root,
            p.writer if s.output.save_video else None,
        )
        return done.tracking_path
    if stage == "zones":
        s = config.load_settings(config.ZoneStage, toml, **told)
        return daily.map_zones_daily(spark, s.day(), s.input.bucket_dir, s.input.bucket_minutes, s.zone.boundary_band_px_1080p, output_root)
    if stage == "lines":
        s = config.load_settings(config.LineStage, toml, **told)
        return daily.count_lines_daily(spark, s.day(), s.input.bucket_dir, s.input.bucket_minutes, s.line.crossing_band_px_1080p, output_root)
    if stage == "report":
        s = config.load_settings(config.ReportStage, toml, **told)
        r = s.report
        return str(report.export_report_daily(spark, s.day(), s.input.bucket_dir, r.period_minutes, r.metric, r.on_duplicate_date, s.input.bucket_minutes, output_root))
    raise ValueError(f"no such stage: {stage} (analyze, zones, lines or report)")


def main() -> None:
    args = sys.argv[1:]
    if not args:
        sys.exit(__doc__)
    spark = SparkSession.builder.appName(f"tidewalk-{args[0]}").getOrCreate()
    print(run(spark, args[0], args[1] if len(args) > 1 else config.find_toml(__file__)))


if __name__ == "__main__":
    main()
