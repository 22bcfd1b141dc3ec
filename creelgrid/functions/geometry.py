"""Planar geometry and the one map projection the polygons need, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parameters of the polygon layer's projection (Albers equal area,
# NAD83 / GRS80; the shift to WGS84 is taken as zero).
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1 = 34.0
PARALLEL_2 = 40.5
MERIDIAN = -120.0
FALSE_EASTING = 0.0
FALSE_NORTHING = -4000000.0


def _m(phi: float, e2: float) -> float:
    return math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)


def _q(phi: float, e2: float) -> float:
    e, s = math.sqrt(e2), math.sin(phi)
    return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))


def cone(semi_major: float, e2: float, parallel_1: float, parallel_2: float, origin: float) -> dict[str, float]:
    """Constants of an Albers cone (Snyder, USGS PP 1395, 1987); ``e2`` is the squared eccentricity."""
    p1, p2 = math.radians(parallel_1), math.radians(parallel_2)
    n = (_m(p1, e2) ** 2 - _m(p2, e2) ** 2) / (_q(p2, e2) - _q(p1, e2))
    c = _m(p1, e2) ** 2 + n * _q(p1, e2)
    return {
        "n": n,
        "c": c,
        "rho0": semi_major * math.sqrt(c - n * _q(math.radians(origin), e2)) / n,
        "qp": _q(math.pi / 2, e2),
        "k2": e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040,
        "k4": 23 * e2**2 / 360 + 251 * e2**3 / 3780,
        "k6": 761 * e2**3 / 45360,
    }


def albers_constants() -> dict[str, float]:
    """The cone constants of the layer's projection, whose origin lies on the equator."""
    f = 1 / INVERSE_FLATTENING
    return cone(SEMI_MAJOR, f * (2 - f), PARALLEL_1, PARALLEL_2, 0.0)


def albers_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Inverse projection of one vertex to degrees."""
    k = albers_constants()
    dx = x - F.lit(FALSE_EASTING)
    dy = F.lit(k["rho0"]) - (y - F.lit(FALSE_NORTHING))
    rho2 = dx * dx + dy * dy
    lon = F.lit(MERIDIAN) + F.degrees(F.atan2(dx, dy) / k["n"])
    q = (F.lit(k["c"]) - rho2 * (k["n"] / SEMI_MAJOR) ** 2) / k["n"]
    beta = F.asin(q / k["qp"])
    lat = beta + k["k2"] * F.sin(2 * beta) + k["k4"] * F.sin(4 * beta) + k["k6"] * F.sin(6 * beta)
    return lon, F.degrees(lat)


def ring_edges(ring: Column) -> Column:
    """Edges of one ring, closing it when the last vertex is not the first."""

    def edge(point, i):
        after = F.get(ring, (i + 1) % F.size(ring))
        return F.struct(
            point["x"].alias("x1"), point["y"].alias("y1"),
            after["x"].alias("x2"), after["y"].alias("y2"),
        )

    return F.transform(ring, edge)


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def touches(edges: Column, px: Column, py: Column) -> Column:
    """True when the point lies on the outline."""

    def on_edge(e):
        collinear = (e["x2"] - e["x1"]) * (py - e["y1"]) == (e["y2"] - e["y1"]) * (px - e["x1"])
        return (
            collinear
            & px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    return F.exists(edges, on_edge)


def encloses(edges: Column, px: Column, py: Column) -> Column:
    """Even-odd rule over all rings, so holes and several parts need no care."""

    def crosses(e):
        straddles = (e["y1"] > py) != (e["y2"] > py)
        side = (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])
        return straddles & (side * F.signum(e["y2"] - e["y1"]) > 0)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def intersects(edges: Column, px: Column, py: Column) -> Column:
    return touches(edges, px, py) | encloses(edges, px, py)
