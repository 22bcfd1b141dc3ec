"""Polygons, and points to polygons through a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import albers_to_lonlat, encloses, intersects, polygon_edges
from .joins import skew_join
from .rejects import REASON


def reproject(polygons: DataFrame) -> DataFrame:
    """Ring vertices from the layer's projection to longitude and latitude."""

    def vertex(p):
        lon, lat = albers_to_lonlat(p["x"], p["y"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return polygons.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, vertex)))


def with_edges(polygons: DataFrame, block: str = "NM_INDEX") -> DataFrame:
    """(block, edges, bounding box) per polygon."""
    edges = polygons.select(block, polygon_edges(F.col("rings")).alias("edges"))

    def side(f, a, b):
        return f(F.transform("edges", lambda e: e[a])) if a == b else f(
            F.concat(F.transform("edges", lambda e: e[a]), F.transform("edges", lambda e: e[b]))
        )

    return edges.select(
        block,
        "edges",
        side(F.array_min, "x1", "x2").alias("xmin"),
        side(F.array_max, "x1", "x2").alias("xmax"),
        side(F.array_min, "y1", "y2").alias("ymin"),
        side(F.array_max, "y1", "y2").alias("ymax"),
    )


# A grid has cells four times as wide as the next finer one.
GRID_STEP = 4

# How many steps finer than the median polygon the finest grid of simple polygons is.
FINEST = 8

# Edges from which a polygon is cut into cells one step finer, and two steps.
MANY_EDGES, MORE_EDGES = 16, 256

# Part of a cell by which it is widened when edges near it are looked for: rounding never hides one.
MARGIN = 1e-9


def grid_level(base: float):
    """The grid of a polygon: its bounding box is half a cell to two cells wide there, or smaller on the finest.

    Polygons of many edges lie one or two grids finer, so that most of their cells hold few edges or none.
    """
    extent = F.greatest(F.expr("xmax - xmin"), F.expr("ymax - ymin"))
    steps = F.ceil(F.log(float(GRID_STEP), F.greatest(extent, F.lit(1e-12)) / (2 * base)))
    n = F.size("edges")
    detail = F.when(n > MORE_EDGES, 2).when(n > MANY_EDGES, 1).otherwise(0)
    return (F.greatest(steps, F.lit(-FINEST)) - detail).cast("int")


def grid_cells(edges: DataFrame) -> tuple[float, dict[int, tuple[float, float]]]:
    """The base, and cell width and height of every grid that a polygon needs, from two aggregate rows."""
    extent = F.greatest(F.expr("xmax - xmin"), F.expr("ymax - ymin"))
    base = edges.agg(F.percentile_approx(extent, 0.5).alias("base")).first()["base"] or 1.0
    levels = edges.filter("xmin is not null").agg(F.collect_set(grid_level(base)).alias("levels")).first()["levels"]
    return base, {level: (base * float(GRID_STEP) ** level,) * 2 for level in sorted(levels)}


def cover(edges: DataFrame, cells: dict[int, tuple[float, float]], level=None) -> DataFrame:
    """One row per polygon and grid cell it may hold a point of: level, cx, cy, inside, edges.

    A cell that no edge comes near is inside, and needs no test, or outside, and is left out. The others
    carry what the test of a point in them looks at: the edges in their row of cells that do not end left
    of them. ``level`` is the grid of a polygon; without it all lie on the only one.
    """
    level = F.lit(next(iter(cells), 0)) if level is None else level

    def size(axis):
        return F.coalesce(*[F.when(F.col("level") == l, F.lit(c[axis])) for l, c in cells.items()], F.lit(1.0))

    def numbers(low, high, width):
        return F.explode(F.sequence(F.floor(F.col(low) / F.col(width)), F.floor(F.col(high) / F.col(width))))

    def bounds(number, width):
        return (F.col(number) - MARGIN) * F.col(width), (F.col(number) + 1 + MARGIN) * F.col(width)

    def reaches(e, axis, low, high):
        return (F.greatest(e[axis + "1"], e[axis + "2"]) >= low) & (F.least(e[axis + "1"], e[axis + "2"]) <= high)

    placed = edges.withColumn("level", level).withColumns({"__w": size(0), "__h": size(1)})
    rows = placed.withColumn("cy", numbers("ymin", "ymax", "__h"))
    low, high = bounds("cy", "__h")
    rows = rows.withColumn("edges", F.filter("edges", lambda e: reaches(e, "y", low, high)))
    boxes = rows.withColumn("cx", numbers("xmin", "xmax", "__w"))
    left, right = bounds("cx", "__w")
    near = F.exists("edges", lambda e: reaches(e, "x", left, right))
    middle = encloses(F.col("edges"), (F.col("cx") + 0.5) * F.col("__w"), (F.col("cy") + 0.5) * F.col("__h"))
    marked = boxes.withColumns({"inside": ~near, "__middle": near | middle}).filter("__middle")
    to_test = F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= left)
    return marked.withColumn("edges", F.when(F.col("inside"), F.slice("edges", 1, 0)).otherwise(to_test)).drop("__w", "__h", "__middle")


def locate_points(
    points: DataFrame,
    polygons: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    block: str = "NM_INDEX",
    cell: tuple[float, float] | None = None,
) -> DataFrame:
    """Left join of points to every polygon they touch; the outline counts.

    Polygons lie on grids by their size, so one large polygon does not cut a layer
    of small ones into small cells, and each is listed once per cell of its grid
    (`cover`). A point lies in one cell of a grid, so each pair is met at most once,
    and only cells with edges are tested. With a single grid the test is part of the
    outer join. With several, one equi-join on (grid, cell) takes the different
    positions to their polygons, whatever the number of grids, and the rows are then
    joined to these by position, once. Points without a polygon stay, with a NULL
    block. Crowded cells and positions are skewed keys, which AQE splits; small
    layers are broadcast by Spark's size check. ``cell`` asks for one grid of that size.
    """
    edges = with_edges(polygons, block)
    base, cells = (1.0, {0: cell}) if cell else grid_cells(edges)
    if len(cells) < 2:
        covered, (width, height) = cover(edges, cells), next(iter(cells.values()), (1.0, 1.0))
        located = points.withColumns({"__cx": F.floor(F.col(lon) / width), "__cy": F.floor(F.col(lat) / height)})
        condition = (located["__cx"] == covered["cx"]) & (located["__cy"] == covered["cy"]) & _holds(covered, located[lon], located[lat])
        return located.join(covered, condition, "left").drop("__cx", "__cy", *[c for c in covered.columns if c != block])
    covered = cover(edges, cells, grid_level(base))
    x, y = F.col("__x"), F.col("__y")
    keys = [F.struct(F.lit(l).alias("l"), F.floor(x / w).alias("cx"), F.floor(y / h).alias("cy")) for l, (w, h) in cells.items()]
    positions = points.select(F.col(lon).alias("__x"), F.col(lat).alias("__y")).filter("__x is not null and __y is not null").distinct()
    tried = positions.withColumn("__k", F.explode(F.array(*keys)))
    same = (tried["__k.l"] == covered["level"]) & (tried["__k.cx"] == covered["cx"]) & (tried["__k.cy"] == covered["cy"])
    found = tried.join(covered, same & _holds(covered, tried["__x"], tried["__y"])).select("__x", "__y", block)
    return skew_join(points, found, [(lon, "__x"), (lat, "__y")], "left")


def _holds(cell, px, py):
    in_box = px.between(cell["xmin"], cell["xmax"]) & py.between(cell["ymin"], cell["ymax"])
    return cell["inside"] | (in_box & intersects(cell["edges"], px, py))


def attach_blocks(results: DataFrame, polygons: DataFrame, block: str = "Block") -> DataFrame:
    """Results with their polygon; results off the map and blocks without results drop out."""
    layer = polygons.select(F.col("NM_INDEX").alias(block), "rings")
    return results.join(layer, block)


def rows_off_map(table: DataFrame, polygons: DataFrame, reason: str) -> DataFrame:
    """The rows whose block is not on the map."""
    known = polygons.select("NM_INDEX").distinct()
    return skew_join(table, known, [("Block", "NM_INDEX")], "left_anti", null_safe=True).withColumn(REASON, F.lit(reason))


def unmatched_blocks(table: DataFrame, polygons: DataFrame, reason: str) -> DataFrame:
    """Blocks that are not on the map, with their number of rows.

    Rows are counted per block first, so the anti join sees one row per block.
    """
    counts = table.groupBy("Block").agg(F.count(F.lit(1)).alias("n"))
    known = polygons.select("NM_INDEX").distinct()
    missing = skew_join(counts, known, [("Block", "NM_INDEX")], "left_anti", null_safe=True)
    return missing.withColumn(REASON, F.lit(reason))
