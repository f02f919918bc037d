"""Plane geometry as native columns, with twins on arrays.

A shape's edges are numbers that are known before the rows: literals, columns of a
dimension row beside the point, or fields in a lambda.  The formulas are written once
over such numbers (``EDGE``, ``SEGMENT``) and unrolled per edge, so tests run inside
generated code; their size depends on the edges of one shape, not on how many shapes or
cameras there are.  Edges beyond ``UNROLLED`` are folded from an array column.
The twins serve grids, streams and tests.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewalk.registry import Line, Zone

#: Edges or segments of one shape that are columns of their own; the others stand in an array.
UNROLLED = 24

#: A polygon's edge: its ends, ``ay - by`` and its squared length (1 where these are 0, so that they divide).
EDGE = ("ax", "ay", "bx", "by", "dy", "square")
#: A line's segment: its ends, its box, its squared and plain length, which side is inside (1 or -1), its number.
SEGMENT = ("ax", "ay", "bx", "by", "lx", "hx", "ly", "hy", "square", "root", "side", "k")

Numbers = dict[str, Column]


def _lit(x: float) -> Column:
    return F.lit(float(x))


def zone_edges(zone: Zone) -> list[tuple[float, ...]]:
    """The numbers of ``EDGE`` for each edge."""
    return [tuple(map(float, (ax, ay, bx, by, (ay - by) or 1, ((bx - ax) ** 2 + (by - ay) ** 2) or 1))) for (ax, ay), (bx, by) in zone.edges()]


def line_segments(line: Line) -> list[tuple[float, ...]]:
    """The numbers of ``SEGMENT`` for each segment."""
    px, py = line.inside_point
    out = []
    for k, ((ax, ay), (bx, by)) in enumerate(line.segments()):
        ux, uy = bx - ax, by - ay
        square = ux * ux + uy * uy
        inside = math.copysign(1.0, ux * (py - ay) - uy * (px - ax))
        out.append(tuple(map(float, (ax, ay, bx, by, min(ax, bx), max(ax, bx), min(ay, by), max(ay, by), square, math.sqrt(square), inside, k))))
    return out


def _literals(names: tuple[str, ...], rows: list[tuple[float, ...]]) -> list[Numbers]:
    return [dict(zip(names, map(_lit, r), strict=True)) for r in rows]


def beside(names: tuple[str, ...], count: int) -> list[Numbers]:
    """The numbers of ``count`` edges as columns of a dimension row."""
    return [{n: F.col(f"{n}_{k}") for n in names} for k in range(count)]


def _fields(names: tuple[str, ...], row: Column) -> Numbers:
    return {n: row[n] for n in names}


# Polygons.


def _crossed(x: Column, y: Column, e: Numbers) -> Column:
    """Whether a ray from the point towards greater x crosses the edge; half open in y."""
    return (e["by"] > y).__ne__(e["ay"] > y) & (x < (e["ax"] - e["bx"]) * (y - e["by"]) / e["dy"] + e["bx"])


def _edge_distance(x: Column, y: Column, e: Numbers) -> Column:
    ux, uy, along, across = e["bx"] - e["ax"], e["by"] - e["ay"], x - e["ax"], y - e["ay"]
    t = F.greatest(_lit(0), F.least(_lit(1), (along * ux + across * uy) / e["square"]))
    return F.hypot(along - t * ux, across - t * uy)


def inside_edges(x: Column, y: Column, edges: list[Numbers], more: Column | None = None) -> Column:
    """Even-odd rule over the edges, those of the array ``more`` included."""
    parity = reduce(lambda a, b: a != b, [_crossed(x, y, e) for e in edges], F.lit(False))
    return parity if more is None else F.aggregate(more, parity, lambda acc, e: acc != _crossed(x, y, _fields(EDGE, e)))


def edges_distance(x: Column, y: Column, edges: list[Numbers], more: Column | None = None) -> Column:
    """Distance to the nearest edge."""
    least = F.least(_lit(math.inf), *[_edge_distance(x, y, e) for e in edges])
    return least if more is None else F.aggregate(more, least, lambda acc, e: F.least(acc, _edge_distance(x, y, _fields(EDGE, e))))


def in_polygon(x: Column, y: Column, zone: Zone) -> Column:
    """Even-odd rule, half open in y; the last vertex joins the first."""
    return inside_edges(x, y, _literals(EDGE, zone_edges(zone)))


def polygon_distance(x: Column, y: Column, zone: Zone) -> Column:
    """Distance to the polygon's outline, from either side."""
    return edges_distance(x, y, _literals(EDGE, zone_edges(zone)))


def signed_polygon_distance(x: Column, y: Column, zone: Zone) -> Column:
    """Distance to the outline, positive inside."""
    d = polygon_distance(x, y, zone)
    return F.when(in_polygon(x, y, zone), d).otherwise(-d)


# Lines.


def _height(x: Column, y: Column, s: Numbers) -> Column:
    """(squared distance to the segment, its number, signed distance to its infinite line)."""
    ux, uy, along, across = s["bx"] - s["ax"], s["by"] - s["ay"], x - s["ax"], y - s["ay"]
    t = F.greatest(_lit(0), F.least(_lit(1), (along * ux + across * uy) / s["square"]))
    # The foot of the perpendicular is taken off the point as one number: rounding decides between segments at a bend.
    dx, dy = x - (s["ax"] + t * ux), y - (s["ay"] + t * uy)
    return F.struct((dx * dx + dy * dy).alias("d2"), s["k"].alias("k"), ((ux * across - uy * along) / s["root"] * s["side"]).alias("height"))


def _meets(x0: Column, y0: Column, x1: Column, y1: Column, s: Numbers) -> Column:
    """Whether the step meets the segment: either pair of ends lies on both sides of the other, or an end lies on the other."""
    ux, uy, sx, sy = s["bx"] - s["ax"], s["by"] - s["ay"], x1 - x0, y1 - y0
    before, after = ux * (y0 - s["ay"]) - uy * (x0 - s["ax"]), ux * (y1 - s["ay"]) - uy * (x1 - s["ax"])
    to_a, to_b = sx * (s["ay"] - y0) - sy * (s["ax"] - x0), sx * (s["by"] - y0) - sy * (s["bx"] - x0)

    def in_box(x: Column, y: Column) -> Column:
        return x.between(s["lx"], s["hx"]) & y.between(s["ly"], s["hy"])

    def on_step(x: Column, y: Column) -> Column:
        return x.between(F.least(x0, x1), F.greatest(x0, x1)) & y.between(F.least(y0, y1), F.greatest(y0, y1))

    through = (before * after < 0) & (to_a * to_b < 0)
    return through | ((before == 0) & in_box(x0, y0)) | ((after == 0) & in_box(x1, y1)) | ((to_a == 0) & on_step(s["ax"], s["ay"])) | ((to_b == 0) & on_step(s["bx"], s["by"]))


def segments_distance(x: Column, y: Column, segments: list[Numbers], more: Column | None = None) -> Column:
    """Distance to the infinite line of the nearest segment (the first of equals), positive on the inside point's side."""
    each = [_height(x, y, s) for s in segments]
    least = F.least(*each) if len(each) > 1 else each[0]
    if more is not None:
        least = F.aggregate(more, least, lambda acc, s: F.least(acc, _height(x, y, _fields(SEGMENT, s))))
    return least["height"]


def meets_segments(x0: Column, y0: Column, x1: Column, y1: Column, segments: list[Numbers], more: Column | None = None) -> Column:
    """Whether the step from (x0, y0) to (x1, y1) meets a segment; false without a previous point (null or NaN)."""
    hit = reduce(lambda a, b: a | b, [_meets(x0, y0, x1, y1, s) for s in segments])
    if more is not None:
        hit = hit | F.exists(more, lambda s: _meets(x0, y0, x1, y1, _fields(SEGMENT, s)))
    return F.coalesce(hit & ~F.isnan(x0) & ~F.isnan(y0), F.lit(False))


def signed_line_distance(x: Column, y: Column, line: Line) -> Column:
    """``segments_distance`` of one line."""
    return segments_distance(x, y, _literals(SEGMENT, line_segments(line)))


def crosses_line(x0: Column, y0: Column, x1: Column, y1: Column, line: Line) -> Column:
    """``meets_segments`` of one line."""
    return meets_segments(x0, y0, x1, y1, _literals(SEGMENT, line_segments(line)))


def side_of(inside: Column, distance: Column, band: Column | float) -> Column:
    """``side`` of a point ``distance`` away from an outline, positive inside."""
    band = band if isinstance(band, Column) else _lit(band)
    return F.when(distance > band, F.when(inside, 1).otherwise(-1))


def side(distance: Column, band: Column | float) -> Column:
    """1 beyond the band on the positive side, -1 beyond it on the other, null within."""
    band = band if isinstance(band, Column) else _lit(band)
    return F.when(distance > band, 1).when(distance < -band, -1)


def band_pixels(band_1080p: float, frame_width: int, base: int) -> float:
    return band_1080p * (frame_width / base)


# Twins on arrays: one matrix of points by edges each.


def _by_edge(rows: list[tuple[float, ...]], *points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The points' coordinates as columns of a matrix, and the edges' numbers as its rows' values."""
    return [np.asarray(v, float).reshape(-1, 1) for v in points], np.array(rows, float).T


def np_in_polygon(x: np.ndarray, y: np.ndarray, zone: Zone) -> np.ndarray:
    (px, py), (ax, ay, bx, by, dy, _) = _by_edge(zone_edges(zone), x, y)
    crossed = ((by > py) != (ay > py)) & (px < (ax - bx) * (py - by) / dy + bx)
    return (crossed.sum(axis=1) % 2 == 1).reshape(np.shape(x))


def np_signed_polygon_distance(x: np.ndarray, y: np.ndarray, zone: Zone) -> np.ndarray:
    (px, py), (ax, ay, bx, by, _, square) = _by_edge(zone_edges(zone), x, y)
    t = np.clip(((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / square, 0, 1)
    far = np.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay)).min(axis=1).reshape(np.shape(x))
    return np.where(np_in_polygon(x, y, zone), far, -far)


def np_signed_line_distance(x: np.ndarray, y: np.ndarray, line: Line) -> np.ndarray:
    (px, py), (ax, ay, bx, by, _, _, _, _, square, root, side, _) = _by_edge(line_segments(line), x, y)
    t = np.clip(((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / square, 0, 1)
    nearest = np.argmin((px - (ax + t * (bx - ax))) ** 2 + (py - (ay + t * (by - ay))) ** 2, axis=1)
    height = ((bx - ax) * (py - ay) - (by - ay) * (px - ax)) / root * side
    return np.take_along_axis(height, nearest[:, None], axis=1).reshape(np.shape(x))


def np_crosses_line(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, line: Line) -> np.ndarray:
    """False where the previous point is NaN."""
    (ox, oy, px, py), (ax, ay, bx, by, lx, hx, ly, hy, *_) = _by_edge(line_segments(line), x0, y0, x1, y1)
    start, end = ((bx - ax) * (v - ay) - (by - ay) * (u - ax) for u, v in ((ox, oy), (px, py)))
    to_a, to_b = ((px - ox) * (v - oy) - (py - oy) * (u - ox) for u, v in ((ax, ay), (bx, by)))
    left, right, low, high = np.minimum(ox, px), np.maximum(ox, px), np.minimum(oy, py), np.maximum(oy, py)
    hit = (start * end < 0) & (to_a * to_b < 0)
    for zero, u, v in ((start, ox, oy), (end, px, py)):
        hit |= (zero == 0) & (lx <= u) & (u <= hx) & (ly <= v) & (v <= hy)
    for zero, u, v in ((to_a, ax, ay), (to_b, bx, by)):
        hit |= (zero == 0) & (left <= u) & (u <= right) & (low <= v) & (v <= high)
    return (hit.any(axis=1) & np.isfinite(ox[:, 0]) & np.isfinite(oy[:, 0])).reshape(np.shape(x1))


def inradius(zone: Zone, step: float, least: int = 32) -> float:
    """The greatest distance to the outline over a grid: a lower bound of the inscribed circle's radius."""
    corners = np.array(zone.polygon, dtype=float)
    axes = []
    for low, high in zip(corners.min(axis=0), corners.max(axis=0), strict=True):
        axes.append(np.linspace(low, high, max(least, math.ceil((high - low) / step) + 1)))
    gx, gy = (g.ravel() for g in np.meshgrid(*axes))
    return float(np_signed_polygon_distance(gx, gy, zone).max())
