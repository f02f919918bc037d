"""Geometry: the columns against hand-made cases and against their twins on arrays."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewalk.functions import geometry as G
from tidewalk.registry import Line, Zone

SQUARE = Zone(name="square", polygon=[(0, 0), (10, 0), (10, 10), (0, 10)])
ELL = Zone(name="ell", polygon=[(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)])
WEDGE = Line(name="wedge", points=[(-100, 0), (0, 0), (0, -100)], inside_point=(50, -50), line_group="g")
DOOR = Line(name="door", points=[(0, 10), (20, 10)], inside_point=(10, 0), line_group="g")


def frame(spark, xs, ys):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(xs, ys, strict=True)], "x double, y double")


@pytest.mark.parametrize(("x", "y", "inside"), [(5, 5, True), (-1, 5, False), (5, 9.99, True), (0.01, 0.01, True), (11, 5, False), (5, 10.5, False)])
def test_square(spark, x, y, inside):
    assert frame(spark, [x], [y]).select(G.in_polygon(F.col("x"), F.col("y"), SQUARE)).first()[0] is inside


def test_concave_notch_is_outside(spark):
    got = frame(spark, [7, 2, 7], [7, 7, 2]).select(G.in_polygon(F.col("x"), F.col("y"), ELL)).collect()
    assert [r[0] for r in got] == [False, True, True]


@pytest.mark.parametrize("zone", [SQUARE, ELL])
def test_columns_equal_arrays_edges_and_vertices_included(spark, zone):
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.uniform(-5, 15, 300), [0, 10, 10, 4, 4, 5, 0, 5, 10], rng.integers(-2, 13, 200)])
    ys = np.concatenate([rng.uniform(-5, 15, 300), [0, 0, 10, 4, 10, 0, 5, 10, 4], rng.integers(-2, 13, 200)])
    got = frame(spark, xs, ys).select("x", "y", G.in_polygon(F.col("x"), F.col("y"), zone).alias("i"), G.signed_polygon_distance(F.col("x"), F.col("y"), zone).alias("d")).toPandas()
    assert (got.i.to_numpy() == G.np_in_polygon(got.x.to_numpy(), got.y.to_numpy(), zone)).all()
    np.testing.assert_allclose(got.d, G.np_signed_polygon_distance(got.x.to_numpy(), got.y.to_numpy(), zone), atol=1e-12)


def test_repeated_vertex_has_a_distance():
    zone = Zone(name="z", polygon=[(0, 0), (0, 0), (4, 0), (4, 4), (0, 4)])
    assert G.np_signed_polygon_distance(np.array([2.0]), np.array([1.0]), zone)[0] == 1


def test_wedge_keeps_one_side(spark):
    """Points beyond the bend are as near to both segments; the first must win, so no sign flips."""
    rng = np.random.default_rng(1)
    xs, ys = rng.uniform(1e-3, 100, 2000), rng.uniform(1e-3, 100, 2000)
    got = frame(spark, -xs, ys).select("x", "y", G.signed_line_distance(F.col("x"), F.col("y"), WEDGE).alias("d")).toPandas()
    assert (got.d < 0).all()
    np.testing.assert_allclose(-got.d, got.y)
    assert (got.d.to_numpy() == G.np_signed_line_distance(got.x.to_numpy(), got.y.to_numpy(), WEDGE)).all()


@pytest.mark.parametrize(
    ("step", "hit"),
    [
        ((10, 20, 10, 0), True),
        ((25, 20, 25, 0), False),
        ((25, 10, 30, 10), False),
        ((25, 10, 25, 10), False),
        ((10, 10, 10, 10), True),
        ((20, 10, 25, 15), True),
        ((10, 20, 10, 11), False),
        ((float("nan"), float("nan"), 10, 10), False),
    ],
)
def test_steps_meet_the_finite_line(spark, step, hit):
    row = spark.createDataFrame([tuple(map(float, step))], "a double, b double, c double, d double")
    assert row.select(G.crosses_line(*(F.col(c) for c in "abcd"), DOOR)).first()[0] is hit
    assert bool(G.np_crosses_line(*(np.array([float(v)]) for v in step), DOOR)[0]) is hit


def test_band_is_open_at_both_ends(spark):
    got = spark.createDataFrame([(2.0,), (2.1,), (-2.0,), (-2.1,), (0.0,)], "d double").select(G.side(F.col("d"), 2.0)).collect()
    assert [r[0] for r in got] == [None, 1, None, -1, None]


def test_inradius_of_a_square():
    assert G.inradius(SQUARE, 0.5) == pytest.approx(5, abs=0.2)
