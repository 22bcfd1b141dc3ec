import math
import random

import pytest
from pyspark.sql import functions as F

from creelgrid.functions import geometry as G
from creelgrid.operators import spatial

FLATTENING = 1 / G.INVERSE_FLATTENING
E2 = FLATTENING * (2 - FLATTENING)
SCHEMA = "NM_INDEX string, rings array<array<struct<x: double, y: double>>>"


def brute(rings, px, py):
    """Even-odd rule with the outline inside, over integers."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py) and (cross > 0) == (y2 > y1) and cross != 0:
                odd = not odd
    return odd


def test_against_brute_force(spark):
    rnd = random.Random(7)
    shapes = []
    for i in range(40):
        x, y = rnd.randint(-20, 20), rnd.randint(-20, 20)
        corners = [(x + rnd.randint(-8, 8), y + rnd.randint(-8, 8)) for _ in range(rnd.randint(3, 7))]
        cx, cy = sum(c[0] for c in corners) / len(corners), sum(c[1] for c in corners) / len(corners)
        corners.sort(key=lambda c: math.atan2(c[1] - cy, c[0] - cx))
        rings = [corners]
        if i % 4 == 0:
            rings.append([(x - 1, y - 1), (x + 1, y - 1), (x + 1, y + 1), (x - 1, y + 1)])
        if i % 5 == 0:
            rings.append([(x + 30, y), (x + 33, y), (x + 33, y + 3), (x + 30, y + 3), (x + 30, y)])
        shapes.append((f"P{i}", rings))
    points = [(x, y) for x in range(-30, 55, 2) for y in range(-30, 31, 3)]
    expected = set()
    for n, (x, y) in enumerate(points):
        hits = [name for name, rings in shapes if brute(rings, x, y)]
        expected |= {(n, h) for h in hits} or {(n, None)}
    layer = spark.createDataFrame([(n, [[tuple(map(float, p)) for p in r] for r in rings]) for n, rings in shapes], SCHEMA)
    frame = spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in enumerate(points)], "n int, lon double, lat double")
    for cell in (None, (3.0, 3.0), (100.0, 1.0)):
        located = spatial.locate_points(frame, layer, cell=cell).select("n", "NM_INDEX").collect()
        assert len(located) == len(expected)
        assert {tuple(r) for r in located} == expected


def test_one_large_polygon_among_small_ones(spark):
    rnd = random.Random(3)
    square = lambda x, y, d: [[(x, y), (x + d, y), (x + d, y + d), (x, y + d)]]
    shapes = [(f"s{i}", square(round(rnd.uniform(-10, 10), 2), round(rnd.uniform(-10, 10), 2), 0.02)) for i in range(2000)]
    shapes.append(("large", square(-10.0, -10.0, 20.0)))
    layer = spark.createDataFrame(shapes, SCHEMA)
    edges = spatial.with_edges(layer)
    base, cells = spatial.grid_cells(edges)
    assert len(cells) > 1 and spatial.cover(edges, cells, spatial.grid_level(base)).count() < 5 * len(shapes) + 25
    points = [(n, x + 0.01, y + 0.01) for n, (_, ((x, y), *_),) in enumerate((s, r[0]) for s, r in shapes[:40])] + [(99, 50.0, 50.0)]
    frame = spark.createDataFrame(points, "n int, lon double, lat double")
    got = {tuple(r) for r in spatial.locate_points(frame, layer).select("n", "NM_INDEX").collect()}
    want = set()
    for n, px, py in points:
        hits = [s for s, ((a, _, c, _),) in shapes if a[0] <= px <= c[0] and a[1] <= py <= c[1]]
        want |= {(n, h) for h in hits} or {(n, None)}
    assert got == want and (99, None) in got


def test_nested_polygons_on_many_grids(spark):
    """A coast of 600 corners with a lake, counties in it, blocks in these: insides need no test, and one join serves all grids."""
    rnd = random.Random(11)

    def star(x, y, size, n):
        reach = [size * rnd.uniform(0.5, 1) for _ in range(n)]
        return [(round(x + r * math.cos(2 * math.pi * i / n)), round(y + r * math.sin(2 * math.pi * i / n))) for i, r in enumerate(reach)]

    shapes = [("coast", [star(0, 0, 4000, 600), star(100, 100, 300, 40)])]
    shapes += [(f"county{i}", [star(rnd.randint(-2500, 2500), rnd.randint(-2500, 2500), 400, 40)]) for i in range(12)]
    corners = [(rnd.randint(-3000, 3000), rnd.randint(-3000, 3000)) for _ in range(80)]
    shapes += [(f"town{i}", [[(x, y), (x + 60, y), (x + 60, y + 60), (x, y + 60)]]) for i, (x, y) in enumerate(corners[:20])]
    shapes += [(f"block{i}", [[(x, y), (x + 16, y), (x + 16, y + 16), (x, y + 16)]]) for i, (x, y) in enumerate(corners)]
    points = [(x + rnd.choice([0, 8, 16]), y + rnd.choice([0, 8, 16])) for x, y in corners]
    points += [(rnd.randint(-4200, 4200), rnd.randint(-4200, 4200)) for _ in range(400)] + points[:5]
    points += [tuple(shapes[0][1][0][i]) for i in range(0, 600, 60)]
    expected = []
    for n, (x, y) in enumerate(points):
        expected += [(n, h) for h in [name for name, rings in shapes if brute(rings, x, y)] or [None]]
    layer = spark.createDataFrame([(n, [[tuple(map(float, p)) for p in r] for r in rings]) for n, rings in shapes], SCHEMA)
    frame = spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in enumerate(points)], "n int, lon double, lat double")
    located = spatial.locate_points(frame, layer).select("n", "NM_INDEX")
    assert sorted(map(tuple, located.collect()), key=repr) == sorted(expected, key=repr)
    edges = spatial.with_edges(layer)
    base, cells = spatial.grid_cells(edges)
    assert len(cells) >= 3
    plan = located._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2
    coast = spatial.cover(edges, cells, spatial.grid_level(base)).filter("NM_INDEX = 'coast'").selectExpr("inside", "size(edges) as n").collect()
    assert sum(r.inside for r in coast) > 50 and all(r.n == 0 for r in coast if r.inside)
    assert sum(r.n for r in coast) / len(coast) < 60  # of 640 edges


def test_published_control_point():
    """Snyder, USGS PP 1395, p. 292: Albers on Clarke 1866, parallels 29.5 and 45.5."""
    k = G.cone(6378206.4, 0.00676866, 29.5, 45.5, 23.0)
    assert k["n"] == pytest.approx(0.6029035, abs=1e-7)
    assert k["c"] == pytest.approx(1.3491594, abs=1e-7)
    assert k["rho0"] == pytest.approx(9929079.6, abs=0.2)


def test_point_without_coordinate_stays(spark):
    layer = spark.createDataFrame([("A", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])], SCHEMA)
    frame = spark.createDataFrame([(1, None, 0.5)], "n int, lon double, lat double")
    assert spatial.locate_points(frame, layer).select("NM_INDEX").collect() == [(None,)]


def forward(lon, lat):
    """Forward projection, only to check the inverse."""
    k = G.albers_constants()
    theta = k["n"] * math.radians(lon - G.MERIDIAN)
    rho = G.SEMI_MAJOR * math.sqrt(k["c"] - k["n"] * G._q(math.radians(lat), E2)) / k["n"]
    return rho * math.sin(theta), k["rho0"] - rho * math.cos(theta) + G.FALSE_NORTHING


@pytest.mark.parametrize("lon, lat", [(-122.4, 37.8), (-117.2, 32.7), (-124.2, 41.7), (-120.0, 34.0)])
def test_projection_round_trip(spark, lon, lat):
    x, y = forward(lon, lat)
    back = spark.range(1).select(*G.albers_to_lonlat(F.lit(x), F.lit(y))).first()
    assert back[0] == pytest.approx(lon, abs=1e-7) and back[1] == pytest.approx(lat, abs=1e-7)


def test_reproject_keeps_rings(spark):
    corners = [forward(*c) for c in [(-122, 36), (-121, 36), (-121, 37)]]
    layer = spark.createDataFrame([("A", [corners, corners[:2]])], SCHEMA)
    rings = spatial.reproject(layer).first()["rings"]
    assert [len(r) for r in rings] == [3, 2]
    assert rings[0][2]["x"] == pytest.approx(-121) and rings[0][2]["y"] == pytest.approx(37)
