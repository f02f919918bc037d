"""Checks that stop a run: they find what doesn't fit and say what it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewalk.functions.geometry import band_pixels, inradius
from tidewalk.registry import Zone
from tidewalk.schemas import BASE_WIDTH

#: How many offenders a message names.
NAMED = 50


def unknown_pairs(counts: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Distinct (camera_id, name) of ``counts`` that ``known`` lacks; ``known`` is as small as a registry."""
    return counts.select("camera_id", name).distinct().join(F.broadcast(known.select("camera_id", name)), ["camera_id", name], "left_anti")


def reject_unknown_pairs(counts: DataFrame, known: DataFrame, name: str, source: str) -> None:
    if found := unknown_pairs(counts, known, name).limit(NAMED).collect():
        raise ValueError(f"{source} has (camera_id, {name}) that the registry lacks: {sorted(map(tuple, found), key=str)}")


def missing_cameras(cameras: DataFrame, tracking: DataFrame) -> DataFrame:
    """Cameras of a registry without any tracking row."""
    return cameras.select("camera_id").join(tracking.select("camera_id").distinct(), "camera_id", "left_anti")


def reject_missing_cameras(streams: list[str], present: list[str | None], kind: str) -> None:
    if missing := sorted({*streams} - {*present}):
        raise ValueError(f"the registry gives {kind} to cameras without data that day (renamed?): {missing}; the data has {sorted(map(str, present))}")


def frame_widths(tracking: DataFrame) -> dict[str | None, list[int | None]]:
    """Distinct frame widths by camera: a row per camera and width."""
    found: dict[str | None, list[int | None]] = {}
    for camera, width in tracking.select("camera_id", "frame_width").distinct().collect():
        found.setdefault(camera, []).append(width)
    return found


def bands_of(widths: dict[str | None, list[int | None]], cameras: list[str], band_1080p: float) -> dict[str, float]:
    """Band in each camera's own pixels; a camera must have one positive width all day."""
    out = {}
    for camera in cameras:
        own = widths.get(camera, [])
        if len(own) != 1 or own[0] is None or own[0] <= 0:
            raise ValueError(f"camera {camera} must have one positive frame_width, has {sorted(own, key=str)}")
        out[camera] = band_pixels(band_1080p, own[0], BASE_WIDTH)
    return out


def reject_narrow_zone(camera: str, zone: Zone, band: float, scale: float) -> None:
    """A zone without a point deeper than the band could never be entered."""
    if band <= 0:
        return
    radius = inradius(zone, max(1.0, band / 8))
    if radius >= band:
        return
    most = round(radius / scale, 1)
    remedy = f"set [zone].boundary_band_px_1080p to {most} at most or widen the polygon" if most > 0 else "the zone is too narrow for any band; widen the polygon"
    raise ValueError(f"camera {camera}: zone {zone.name!r} can't hold the band: inscribed radius about {radius:.1f} px (a lower bound from a grid), band {band:.1f} px (frame_width/{BASE_WIDTH} = {scale:.4g}); {remedy}")


def duplicate_names(shapes: DataFrame, name: str) -> DataFrame:
    """Names that more than one shape has."""
    return shapes.groupBy(name).agg(F.count("*").alias("shapes")).where("shapes > 1")
