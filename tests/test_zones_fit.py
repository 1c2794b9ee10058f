"""Covers of zones against brute force, and fits against those of all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.operators import geo
from roadtally.operators import models as mo

RINGS = "gid int, rings array<array<struct<x: double, y: double>>>, ring string"


def crosses(rings, x, y):
    n = 0
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay):
                n += 1
    return n % 2 == 1


def star(x, y, r, n, seed):
    rng = random.Random(seed)
    return [(x + r * rng.uniform(0.4, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def box(a, b, c, d):
    return [(float(a), float(b)), (float(c), float(b)), (float(c), float(d)), (float(a), float(d))]


def within(spark, zones, points, **options):
    z = spark.createDataFrame([(i, rings, "other") for i, rings in zones], RINGS)
    p = spark.createDataFrame(points, "id int, x double, y double").repartition(3)
    return {(r.id, r.gid) for r in geo.within_zone(p, z, **options).collect()}


@pytest.mark.parametrize("depth", [0, 3, 7])
def test_points_in_zones_with_holes_and_parts(spark, depth):
    zones = [
        (1, [star(0, 0, 100, 40, 1), star(5, 5, 20, 9, 2)]), (2, [box(-50, -50, 50, 50), box(-20, -20, 20, 20), box(-5, -5, 5, 5)]),  # an island in a hole
        (3, [box(200, 0, 300, 10), box(200, 90, 300, 100)]), (4, [star(1e4, 1e4, 3e4, 300, 3)]), (5, [[]]), (6, []), (7, None),
        (8, [[(0.0, 0.0), (64.0, 0.0), (0.0, 64.0)]]), (9, [[(3.0, 3.0)]]), (10, [box(-1e-9, -1e-9, 1e-9, 1e-9)]),
    ]
    rng = random.Random(depth)
    points = [(k, rng.uniform(-110, 320), rng.uniform(-110, 110)) for k in range(1500)] + [(2000 + k, rng.uniform(-3e4, 5e4), rng.uniform(-3e4, 5e4)) for k in range(500)]
    points += [(3000 + k, float(x), float(y)) for k, (x, y) in enumerate((x, y) for x in range(-64, 65, 16) for y in range(-64, 65, 16))]  # corners, edges and cell borders
    points += [(4000, None, 1.0), (4001, float("nan"), 0.0)]
    expected = {(i, g) for i, x, y in points if x is not None and x == x for g, rings in zones if crosses(rings or [], x, y)}
    assert within(spark, zones, points, depth=depth) == expected


def test_a_cover_grows_with_the_outline(spark):
    """A zone of 10,000 metres across, with a hole, in some thousand cells; most of its area needs no ray."""
    lobed = [(r * math.cos(a), r * math.sin(a)) for a in (2 * math.pi * k / 500 for k in range(500)) for r in [5000 * (1 + 0.1 * math.sin(5 * a))]]
    z = spark.createDataFrame([(1, [lobed, box(-500, -500, 500, 500)], "r")], RINGS)
    cells = geo.zone_cover(z, depth=8).collect()
    assert len(cells) < 6000
    area = sum(4.0 ** r.k for r in cells if r.plein), sum(4.0 ** r.k for r in cells if not r.plein)
    assert area[0] > 5 * area[1] and max(len(r.aretes) for r in cells if not r.plein) < 60


def test_no_zones_and_no_points(spark):
    assert within(spark, [], [(1, 0.0, 0.0)]) == set() and within(spark, [(1, [box(0, 0, 1, 1)])], []) == set()


@pytest.mark.parametrize("low, high", [(0.0, 9999.0), (9000.0, 9999.0)])
def test_fit_is_that_of_all_rows(spark, low, high):
    """Noise, and powers that hardly differ: the normal equations' condition is the square of this one."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.uniform(low, high, 3000), rng.uniform(10_000, 50_000, 500)])
    y = np.where(x < 10_000, 1 + 2 * x / 1e4 + 5 * (x / 1e4) ** 4, 3 * x / 1e4) + rng.normal(0, 0.1, len(x))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(5.0, None), (None, 5.0)], "raw double, true double").repartition(7)
    found = mo.fit(df, "raw", "true", fan=2)
    for name, part, degree in mo.PARTS:
        rows = part(x)
        expected = np.linalg.lstsq(np.vander(x[rows] / 1e4, degree + 1, increasing=True), y[rows], rcond=None)[0]
        assert np.allclose(found[name], expected, rtol=1e-6, atol=1e-6)


def test_fit_of_few_rows(spark):
    none = spark.createDataFrame([], "raw double, true double")
    assert mo.fit(none, "raw", "true") == {"bas": [0.0] * 5, "haut": [0.0] * 2}
    two = spark.createDataFrame([(20_000.0, 4.0), (30_000.0, 6.0), (5_000.0, 1.0)], "raw double, true double")
    found = mo.fit(two, "raw", "true")
    assert np.allclose(found["haut"], [0, 2]) and np.isclose(np.polyval(found["bas"][::-1], 0.5), 1.0)
    assert two.select(F.lit(1)).count() == 3
