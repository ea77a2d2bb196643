"""Zonal statistics: polygons to pixel sets by scanlines, then an equi-join with the pixel table.

A polygon is an array of rings, a ring an array of struct<x, y>; holes and multipolygons need no order (even-odd rule). Pixel
(row, col) has its centre at ((col + 0.5) * size, (row + 0.5) * size) from the origin. Edges are half open, so neighbours
that share an edge never share a pixel.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .features import statistics
from .raster import scene_counts

RULES = ("centre", "centre_2x", "coverage")


def _shuffled(df: DataFrame) -> DataFrame:
    """The side of a join that is as large as the parcels' edges or pixels: never broadcast.

    Sizes are estimated from the files that the parcels are read from, and exploded rows don't count there: without the hint
    a table of millions of edges passes for a small one and goes through the driver.
    """
    return df.hint("merge")


def directed(parcels: DataFrame, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, ring, edge, ax, ay, bx, by) in the order of the rings; a ring closes itself."""
    rings = parcels.select(id_col, F.posexplode(geometry).alias("ring", "_points")).where(F.size("_points") >= 3)
    pairs = F.transform("_points", lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), F.element_at(F.col("_points"), F.pmod(i + 1, F.size("_points")) + 1).alias("b")))
    e = rings.select(id_col, "ring", F.posexplode(pairs).alias("edge", "e"))
    return e.select(id_col, "ring", "edge", F.col("e.ax").alias("ax"), F.col("e.ay").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by"))


def edges(parcels: DataFrame, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, x0, y0, x1, y1) with y0 <= y1."""
    up = F.col("ay") <= F.col("by")
    pick = lambda a, b, n: F.when(up, F.col(a)).otherwise(F.col(b)).alias(n)
    return directed(parcels, id_col, geometry).select(id_col, pick("ax", "bx", "x0"), pick("ay", "by", "y0"), pick("bx", "ax", "x1"), pick("by", "ay", "y1"))


def bounds(parcels: DataFrame, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """Bounding box of each polygon."""
    points = F.flatten(geometry)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return parcels.select(id_col, F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def total_bounds(boxes: DataFrame) -> DataFrame:
    return boxes.agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def in_box(boxes: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Boxes that touch a given one."""
    x0, y0, x1, y1 = box
    return boxes.where((F.col("minx") <= x1) & (F.col("maxx") >= x0) & (F.col("miny") <= y1) & (F.col("maxy") >= y0))


def check_inside(boxes: DataFrame, roi: tuple[float, float, float, float]) -> None:
    """An error if a parcel reaches out of the region."""
    b = total_bounds(boxes).first()
    if b["minx"] is not None and (b["minx"] < roi[0] or b["miny"] < roi[1] or b["maxx"] > roi[2] or b["maxy"] > roi[3]):
        raise ValueError(f"parcels reach from {b['minx']}, {b['miny']} to {b['maxx']}, {b['maxy']}, out of {roi}")


def rasterised(parcels: DataFrame, size: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, row, col) of all pixels whose centre is inside."""
    first = F.ceil(F.col("y0") / size - 0.5).cast("long")
    last = F.ceil(F.col("y1") / size - 0.5).cast("long") - 1
    e = edges(parcels, id_col, geometry).where("y0 < y1").withColumns({"r0": first, "r1": last}).where("r0 <= r1")
    hits = e.select(id_col, F.explode(F.sequence("r0", "r1")).alias("row"), "x0", "y0", "x1", "y1")
    y = (F.col("row") + 0.5) * size
    x = F.col("x0") + (y - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    lines = hits.select(id_col, "row", x.alias("x")).groupBy(id_col, "row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    # crossings of one polygon with one row, in pairs: a span from each even one to the next
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(F.element_at("xs", 2 * i + 1).alias("a"), F.element_at("xs", 2 * i + 2).alias("b")))
    s = lines.where(F.size("xs") >= 2).select(id_col, "row", F.explode(spans).alias("s"))
    c0, c1 = F.ceil(F.col("s.a") / size - 0.5).cast("long"), F.ceil(F.col("s.b") / size - 0.5).cast("long") - 1
    return s.select(id_col, "row", c0.alias("c0"), c1.alias("c1")).where("c0 <= c1").select(id_col, "row", F.explode(F.sequence("c0", "c1")).alias("col"))


def _ring_sides(e: DataFrame, id_col: str) -> DataFrame:
    """(uid, ring, side): 1 or -1, so that the edges' areas add up to what the polygon covers, whatever the rings' directions.

    A ring that lies in an odd number of the polygon's other rings is a hole.
    """
    x, y = F.col("ax"), F.col("ay")
    origin = F.struct(F.min_by("ax", "edge").alias("x"), F.min_by("ay", "edge").alias("y"), F.min_by("bx", "edge").alias("bx"), F.min_by("by", "edge").alias("by"))
    first = e.groupBy(id_col, "ring").agg(origin.alias("o"))
    # areas around the first corner, which keeps digits far from the origin
    near = e.join(_shuffled(first), [id_col, "ring"])
    area = F.sum((x - F.col("o.x")) * (F.col("by") - F.col("o.y")) - (F.col("bx") - F.col("o.x")) * (y - F.col("o.y")))
    rings = near.groupBy(id_col, "ring").agg(area.alias("area"), ((F.first("o.x") + F.first("o.bx")) / 2).alias("px"), ((F.first("o.y") + F.first("o.by")) / 2).alias("py"))
    several = rings.join(_shuffled(rings.groupBy(id_col).agg(F.count("*").alias("_n")).where("_n > 1").select(id_col)), id_col, "left_semi").select(id_col, F.col("ring").alias("own"), "px", "py")
    crossing = several.join(_shuffled(e), id_col).where("own <> ring and (ay <= py) <> (by <= py)").where(F.col("px") < x + (F.col("py") - y) / (F.col("by") - y) * (F.col("bx") - x))
    inside = crossing.groupBy(id_col, "own", "ring").agg((F.count("*") % 2).alias("odd")).groupBy(id_col, F.col("own").alias("ring")).agg((F.sum("odd") % 2).alias("hole"))
    side = F.signum("area") * F.when(F.coalesce("hole", F.lit(0)) == 1, -1).otherwise(1)
    return rings.join(_shuffled(inside), [id_col, "ring"], "left").select(id_col, "ring", side.alias("side"))


def coverage_fractions(parcels: DataFrame, size: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, row, col, fraction): the exact share of each pixel that a polygon covers, where there is any.

    Each edge adds, in every row that it crosses, the area right of it to the pixels that it crosses and its height to all
    further ones; a running sum along the row gives the share. Rings may have any direction; holes lie within rings. The
    work grows with edges times the rows and columns that they cross, and with the pixels covered.
    """
    e = directed(parcels, id_col, geometry)
    e = e.join(_shuffled(_ring_sides(e, id_col)), [id_col, "ring"]).withColumns({c: F.col(c) / size for c in ("ax", "ay", "bx", "by")}).where("ay <> by")
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = e.withColumn("row", F.explode(F.sequence(F.floor(low).cast("long"), (F.ceil(high) - 1).cast("long"))))
    at = lambda y: F.col("ax") + (y - F.col("ay")) / (F.col("by") - F.col("ay")) * (F.col("bx") - F.col("ax"))
    y0, y1 = F.greatest(low, F.col("row")), F.least(high, F.col("row") + 1)
    rows = rows.select(id_col, "row", at(y0).alias("p"), at(y1).alias("q"), (F.when(F.col("by") > F.col("ay"), -1).otherwise(1) * F.col("side") * (y1 - y0)).alias("h"))
    first, last = F.floor(F.least("p", "q")).cast("long"), F.floor(F.greatest("p", "q")).cast("long")
    # u: how much of the pixel's width lies right of a point; its mean along the edge is a difference of antiderivatives
    gone = lambda u: F.when(u <= 0, 0.0).when(u < 1, u * u / 2).otherwise(u - 0.5)

    def mean(c: Column) -> Column:
        u, v = c + 1 - F.col("p"), c + 1 - F.col("q")
        flat = F.least(F.greatest((u + v) / 2, F.lit(0.0)), F.lit(1.0))
        return F.when(F.abs(u - v) < 1e-9, flat).otherwise((gone(u) - gone(v)) / (u - v))

    parts = F.transform(F.sequence(first, last), lambda c: F.struct(c.alias("col"), (F.col("h") * mean(c)).alias("area"), F.lit(0.0).alias("cover")))
    beyond = F.array(F.struct((last + 1).alias("col"), F.lit(0.0).alias("area"), F.col("h").alias("cover")))
    sums = rows.select(id_col, "row", F.inline(F.concat(parts, beyond))).groupBy(id_col, "row", "col").agg(F.sum("area").alias("area"), F.sum("cover").alias("cover"))
    line = Window.partitionBy(id_col, "row").orderBy("col")
    run = sums.select(id_col, "row", "col", "area", F.sum("cover").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("run"), F.lead("col").over(line).alias("next"))
    own = F.array(F.struct("col", (F.col("area") + F.col("run")).alias("fraction")))
    gap = F.when((F.col("next") > F.col("col") + 1) & (F.col("run") > 1e-9), F.transform(F.sequence(F.col("col") + 1, F.col("next") - 1), lambda c: F.struct(c.alias("col"), F.col("run").alias("fraction"))))
    out = run.select(id_col, "row", F.inline(F.concat(own, F.coalesce(gap, F.slice(own, 1, 0)))))
    return out.where("fraction > 1e-9").withColumn("fraction", F.least("fraction", F.lit(1.0)))


def covered(parcels: DataFrame, size: float = 1.0, share: float = 0.5, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """Pixels of which at least `share` (to nine digits) is covered."""
    return coverage_fractions(parcels, size, id_col, geometry).where(F.col("fraction") >= share - 1e-9).select(id_col, "row", "col")


#: Columns of pixels that share a block when pixels meet the edges near them.
BLOCK = 16


def near_edges(cells: DataFrame, parcels: DataFrame, distance: float, size: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, row, col, d): the pixels with the distance of their centre from each edge nearby; null without one.

    Edges are dealt to the rows, and the blocks of BLOCK columns in them, that they come within `distance` of; pixels meet
    only the edges of their own row and block.
    """
    e = edges(parcels, id_col, geometry)
    row_of = lambda y: F.floor(y / size - 0.5).cast("long")
    e = e.withColumn("row", F.explode(F.sequence(row_of(F.col("y0") - distance), row_of(F.col("y1") + distance) + 1)))
    px, py = (F.col("col") + 0.5) * size, (F.col("row") + 0.5) * size
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    # the part of the edge whose height differs by `distance` at most
    clip = lambda y: F.least(F.greatest(F.try_divide(y - F.col("y0"), dy), F.lit(0.0)), F.lit(1.0))
    flat = dy <= 0
    p = F.when(flat, F.col("x0")).otherwise(F.col("x0") + clip(py - distance) * dx)
    q = F.when(flat, F.col("x1")).otherwise(F.col("x0") + clip(py + distance) * dx)
    block = lambda x: F.floor(F.floor(x / size - 0.5) / BLOCK).cast("long")
    near_rows = e.withColumn("_block", F.explode(F.sequence(block(F.least(p, q) - distance), block(F.greatest(p, q) + distance + size))))
    keyed = cells.withColumn("_block", F.floor(F.col("col") / BLOCK).cast("long"))
    t = F.coalesce(F.try_divide((px - F.col("x0")) * dx + (py - F.col("y0")) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    d = F.sqrt(F.pow(px - F.col("x0") - t * dx, 2.0) + F.pow(py - F.col("y0") - t * dy, 2.0))
    return keyed.join(_shuffled(near_rows), [id_col, "row", "_block"], "left").select(id_col, "row", "col", d.alias("d"))


def eroded(cells: DataFrame, parcels: DataFrame, distance: float, size: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """Pixels whose centre keeps at least `distance` from every edge of their own polygon (a negative buffer)."""
    near = near_edges(cells, parcels, distance, size, id_col, geometry).groupBy(id_col, "row", "col").agg(F.min("d").alias("_d"))
    return near.where(F.col("_d").isNull() | (F.col("_d") >= distance)).drop("_d")


def emptied(parcels: DataFrame, rule: str = "centre", size: float = 1.0, share: float = 0.5, buffer: float = 0.0, id_col: str = "uid") -> DataFrame:
    """Parcels that have pixels, and none any more after the negative buffer."""
    before = cells_of(parcels, rule, size, share).select(id_col).distinct()
    after = cells_of(parcels, rule, size, share, buffer).select(id_col).distinct()
    return parcels.join(_shuffled(before), id_col, "left_semi").join(_shuffled(after), id_col, "left_anti")


def lost(parcels: DataFrame, cells: DataFrame, id_col: str = "uid") -> DataFrame:
    """Parcels without any pixel left."""
    return parcels.join(_shuffled(cells.select(id_col).distinct()), id_col, "left_anti")


def _side(ax: str, ay: str, bx: str, by: str, x: str, y: str, c: Callable[[str], Column] = F.col) -> Column:
    """Positive if (x, y) lies left of the line from a to b, 0 on it."""
    return (c(bx) - c(ax)) * (c(y) - c(ay)) - (c(by) - c(ay)) * (c(x) - c(ax))


def _meet(c: Callable[[str], Column] = F.col) -> Column:
    """Whether the edges (ax, ay)-(bx, by) and (cx, cy)-(dx, dy) have a point in common."""
    names = ("ax", "ay", "bx", "by"), ("cx", "cy", "dx", "dy")
    s1, s2 = _side(*names[0], "cx", "cy", c=c), _side(*names[0], "dx", "dy", c=c)
    s3, s4 = _side(*names[1], "ax", "ay", c=c), _side(*names[1], "bx", "by", c=c)
    boxes = F.lit(True)
    for i in "xy":
        boxes = boxes & (F.greatest(c(f"a{i}"), c(f"b{i}")) >= F.least(c(f"c{i}"), c(f"d{i}"))) & (F.greatest(c(f"c{i}"), c(f"d{i}")) >= F.least(c(f"a{i}"), c(f"b{i}")))
    return boxes & (s1 * s2 <= 0) & (s3 * s4 <= 0)


def _bad_pair(c: Callable[[str], Column] = F.col) -> Column:
    """Whether two edges (ring, edge, n and ring2, edge2) that meet are a fault of their polygon."""
    # neighbours share a corner: they cross if they run back on each other; other pairs of one ring may not meet at all
    ahead, around = (c("ring") == c("ring2")) & (c("edge2") == c("edge") + 1), (c("ring") == c("ring2")) & (c("edge") == 0) & (c("edge2") == c("n") - 1)
    side = lambda *names: _side(*names, c=c)
    back = lambda dot, side: (side == 0) & (dot > 0)
    folded_ahead = back((c("ax") - c("bx")) * (c("dx") - c("cx")) + (c("ay") - c("by")) * (c("dy") - c("cy")), side("ax", "ay", "bx", "by", "dx", "dy"))
    folded_around = back((c("bx") - c("ax")) * (c("cx") - c("dx")) + (c("by") - c("ay")) * (c("cy") - c("dy")), side("ax", "ay", "bx", "by", "cx", "cy"))
    corner = F.lit(False)
    for x, y in (("ax", "ay"), ("bx", "by")):
        for u, v in (("cx", "cy"), ("dx", "dy")):
            corner = corner | ((c(x) == c(u)) & (c(y) == c(v)))
    proper = (side("ax", "ay", "bx", "by", "cx", "cy") * side("ax", "ay", "bx", "by", "dx", "dy") < 0) & (side("cx", "cy", "dx", "dy", "ax", "ay") * side("cx", "cy", "dx", "dy", "bx", "by") < 0)
    return F.when(ahead, folded_ahead).when(around, folded_around).when(c("ring") != c("ring2"), proper | ~corner & (side("ax", "ay", "bx", "by", "cx", "cy") == 0) & (side("ax", "ay", "bx", "by", "dx", "dy") == 0)).otherwise(True)


def _in_bands(e: DataFrame, band: float, low: str, high: str, name: str = "_band") -> DataFrame:
    return e.withColumn(name, F.explode(F.sequence(F.floor(F.least(low, high) / band).cast("long"), F.floor(F.greatest(low, high) / band).cast("long"))))


def _without_repeats(geometry: str) -> Column:
    """The rings, of consecutive equal points the first one."""
    points = F.filter(geometry, lambda r: F.size(r) >= 1)
    return F.transform(points, lambda r: F.filter(r, lambda p, i: ~((p["x"] == F.element_at(r, F.pmod(i - 1, F.size(r)) + 1)["x"]) & (p["y"] == F.element_at(r, F.pmod(i - 1, F.size(r)) + 1)["y"]))))


def polygon_faults(parcels: DataFrame, band: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """(uid, fault) of polygons that aren't valid: `no ring`, `no area`, `repeated point`, `crossing`, the first that holds.

    Consecutive equal points count once. A ring may not visit a point twice, nor may edges of a polygon meet except at
    their common corner; rings may touch in single corners. Edges are compared within bands of height `band` only.
    """
    c = F.col
    rows = parcels.select(id_col, F.coalesce(_without_repeats(geometry), F.expr("array()")).alias("_clean"))
    rings = F.exists("_clean", lambda r: F.size(r) >= 3)
    none = rows.where(~F.coalesce(rings, F.lit(False))).select(id_col, F.lit(0).alias("_f"))
    e = directed(rows.where(rings), id_col, "_clean")
    origin = e.groupBy(id_col, "ring").agg(F.min_by("ax", "edge").alias("ox"), F.min_by("ay", "edge").alias("oy"), F.count("*").alias("n"), F.count_distinct("ax", "ay").alias("points"))
    area = e.join(_shuffled(origin), [id_col, "ring"]).groupBy(id_col, "ring", "n", "points").agg(F.abs(F.sum((c("ax") - c("ox")) * (c("by") - c("oy")) - (c("bx") - c("ox")) * (c("ay") - c("oy")))).alias("area"), F.max((c("ax") - c("ox")) ** 2 + (c("ay") - c("oy")) ** 2).alias("wide"))
    flat = area.where(c("area") <= 1e-12 * c("wide")).select(id_col, F.lit(1).alias("_f"))
    twice = area.where("points < n").select(id_col, F.lit(2).alias("_f"))
    left = _in_bands(e.join(_shuffled(origin.select(id_col, "ring", "n")), [id_col, "ring"]), band, "ay", "by")
    right = left.select(id_col, "_band", c("ring").alias("ring2"), c("edge").alias("edge2"), c("ax").alias("cx"), c("ay").alias("cy"), c("bx").alias("dx"), c("by").alias("dy"))
    pairs = left.join(_shuffled(right), [id_col, "_band"]).where("(ring < ring2 or (ring = ring2 and edge < edge2))").where(_meet())
    crossing = pairs.where(_bad_pair()).select(id_col, F.lit(3).alias("_f")).distinct()
    every = none.unionByName(flat).unionByName(twice).unionByName(crossing).groupBy(id_col).agg(F.min("_f").alias("_f"))
    return every.select(id_col, F.get(F.array(*map(F.lit, ("no ring", "no area", "repeated point", "crossing"))), c("_f")).alias("fault"))


#: Points, and pixels of the box's sides, of a polygon that is dealt with in its own row; its pixels come to it, not it to them.
FEW, WIDE = 64, 256


def few(geometry: str = "geom", size: float = 1.0) -> Column:
    """Whether a polygon has few points, all known, and a small box; never null."""
    points = F.flatten(geometry)
    known = F.forall(geometry, lambda r: F.coalesce(F.forall(r, lambda p: F.coalesce(p["x"].isNotNull() & p["y"].isNotNull(), F.lit(False))), F.lit(False)))
    wide = lambda i: F.array_max(F.transform(points, lambda p: p[i])) - F.array_min(F.transform(points, lambda p: p[i]))
    return F.coalesce(known & (F.size(points) <= FEW) & (wide("x") < WIDE * size) & (wide("y") < WIDE * size), F.lit(False))


def _faultless(parcels: DataFrame, geometry: str) -> DataFrame:
    """The valid ones of polygons with few points, by the rules of `polygon_faults` within each row."""
    step = lambda r, i: F.element_at(r, F.pmod(i + 1, F.size(r)) + 1)
    rings = F.filter(_without_repeats(geometry), lambda r: F.size(r) >= 3)
    edge = lambda r, k: F.transform(r, lambda p, i: F.struct(k.alias("ring"), i.alias("edge"), F.size(r).alias("n"), p["x"].alias("ax"), p["y"].alias("ay"), step(r, i)["x"].alias("bx"), step(r, i)["y"].alias("by")))

    def flat(r: Column) -> Column:
        o = F.element_at(r, 1)
        parts = F.transform(r, lambda p, i: (p["x"] - o["x"]) * (step(r, i)["y"] - o["y"]) - (step(r, i)["x"] - o["x"]) * (p["y"] - o["y"]))
        wide = F.array_max(F.transform(r, lambda p: (p["x"] - o["x"]) ** 2 + (p["y"] - o["y"]) ** 2))
        return F.abs(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)) <= 1e-12 * wide

    def faulty(e: Column, f: Column) -> Column:
        second = {"ring2": "ring", "edge2": "edge", "cx": "ax", "cy": "ay", "dx": "bx", "dy": "by"}
        c = lambda name: f[second[name]] if name in second else e[name]
        later = (c("ring") < c("ring2")) | ((c("ring") == c("ring2")) & (c("edge") < c("edge2")))
        return later & _meet(c) & _bad_pair(c)

    # one row each from explode: rings and edges are made once, since no later filter moves below it
    rows = parcels.withColumn("_rings", F.explode(F.array(rings))).where(F.size("_rings") > 0).where(~F.exists("_rings", lambda r: flat(r) | (F.size(F.array_distinct(r)) < F.size(r))))
    rows = rows.withColumn("_edges", F.explode(F.array(F.flatten(F.transform("_rings", edge)))))
    return rows.where(~F.exists("_edges", lambda e: F.exists("_edges", lambda f: faulty(e, f)))).drop("_rings", "_edges")


def valid_polygons(parcels: DataFrame, geometry: str = "geom", id_col: str = "uid") -> tuple[DataFrame, DataFrame]:
    """(rows of valid polygons, the rejected rest with their `fault`)."""
    faults = polygon_faults(parcels, id_col=id_col, geometry=geometry)
    return parcels.join(_shuffled(faults), id_col, "left_anti"), parcels.join(_shuffled(faults), id_col)


def cells_of(parcels: DataFrame, rule: str = "centre", size: float = 1.0, share: float = 0.5, buffer: float = 0.0) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    if rule == "coverage":
        cells = covered(parcels, size, share)
    else:
        cells = rasterised(parcels, size / 2 if rule == "centre_2x" else size)
    return eroded(cells, parcels, buffer, size / 2 if rule == "centre_2x" else size) if buffer > 0 else cells


def overlay(pixels: DataFrame, parcels: DataFrame, rule: str = "centre", size: float = 1.0, share: float = 0.5, buffer: float = 0.0, id_col: str = "uid") -> DataFrame:
    """Pixel rows joined to the parcels they lie in: an equi-join on (row, col)."""
    cells = cells_of(parcels, rule, size, share, buffer)
    if rule == "centre_2x":
        cells = cells.select(id_col, F.floor(F.col("row") / 2).alias("row"), F.floor(F.col("col") / 2).alias("col"))
    return pixels.join(_shuffled(cells), ["row", "col"])


def zonal_stats(pixels: DataFrame, parcels: DataFrame, keys: list[str], value: str = "value", rule: str = "centre", size: float = 1.0, share: float = 0.5, buffer: float = 0.0, drop_nulls: bool | None = None, scl: str | None = None) -> DataFrame:
    """Statistics of `value` for each parcel and slice (`keys`).

    With `scl` parcels with a bad pixel in a slice are left out of it. The half-pixel rule counts quarters and drops
    rows without statistics unless told otherwise.
    """
    inside = overlay(pixels, parcels, rule, size, share, buffer)
    if scl is not None:
        bad = scene_counts(inside, ["uid", *keys], scl).where("nb_bad_pixels > 0")
        inside = inside.join(_shuffled(bad.select("uid", *keys)), ["uid", *keys], "left_anti")
    out = statistics(inside, ["uid", *keys], value)
    if rule == "centre_2x":
        out = out.withColumn("count", F.col("count") / 4)
    return out.na.drop() if (rule == "centre_2x" if drop_nulls is None else drop_nulls) else out


#: Sides of the squares that polygons with few points are grouped by, and of those that pixels are sent by; pixels of all boxes of
#: a group at most (beyond, a square's polygons are dealt to several groups); values that are sorted at once.
HOME, SENT, MOST_BOXES, MOST_VALUES = 128, 32, 1 << 20, 1 << 21


def _own_spans(size: float) -> Column:
    """The spans of pixels whose centre is inside, from `_edges`, as one list of row, first and last column."""
    first, last = (lambda y: F.ceil(y / size - 0.5).cast("long")), (lambda y: F.ceil(y / size - 0.5).cast("long") - 1)
    low, high = F.array_min(F.transform("_edges", lambda e: first(e["y0"]))), F.array_max(F.transform("_edges", lambda e: last(e["y1"])))

    def line(row: Column) -> Column:
        y = (row + 0.5) * size
        met = F.filter("_edges", lambda e: (e["y0"] < e["y1"]) & (first(e["y0"]) <= row) & (row <= last(e["y1"])))
        # in pairs: a span from each even crossing to the next
        xs = F.array_sort(F.transform(met, lambda e: e["x0"] + (y - e["y0"]) / (e["y1"] - e["y0"]) * (e["x1"] - e["x0"])))
        ends = F.transform(xs, lambda x, i: F.ceil(x / size - 0.5).cast("long") - F.pmod(i, F.lit(2)))
        pairs = lambda c: F.transform(F.sequence(F.lit(0), F.floor(F.size(c) / 2).cast("int") - 1), lambda i: F.array(row, F.get(c, 2 * i), F.get(c, 2 * i + 1)))
        # a list of one keeps the ends from being made again for each pair
        return F.flatten(F.transform(F.filter(F.array(ends), lambda c: F.size(c) >= 2), lambda c: F.filter(pairs(c), lambda p: F.get(p, F.lit(1)) <= F.get(p, F.lit(2)))))

    return F.flatten(F.flatten(F.when(low <= high, F.transform(F.sequence(low, high), line))))


def _runs(n: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n, in one array."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _statistics_of(g: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(groups, `features.statistics` of their values): sorted once, equal values are runs."""
    order = np.lexsort((v, g))
    g, v = g[order], v[order]
    starts = lambda *changed: np.flatnonzero(np.concatenate([[True], np.logical_or.reduce(changed)])) if len(g) else np.zeros(0, int)
    at = starts(g[1:] != g[:-1])
    n = np.diff(np.append(at, len(g)))
    low, high, total = v[at], v[at + n - 1], np.add.reduceat(v, at) if len(at) else v
    mean = total / n
    squares = np.add.reduceat((v - np.repeat(mean, n)) ** 2, at) if len(at) else v
    variance = np.where((low == high) | np.isnan(low), 0.0, squares / n)
    run = starts(g[1:] != g[:-1], (v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1])))
    m, first = np.diff(np.append(run, len(g))), np.searchsorted(run, at)
    per = np.diff(np.append(first, len(run)))

    def picked(best: np.ufunc, last: bool) -> np.ndarray:
        there = np.flatnonzero(m == np.repeat(best.reduceat(m, first), per))
        ends = np.searchsorted(there, first + per) - 1 if last else np.searchsorted(there, first)
        return v[run[there[ends]]]

    most, least, end = (picked(np.maximum, False), picked(np.minimum, False), picked(np.maximum, True)) if len(at) else (v, v, v)
    median = 0.5 * v[at + (n - 1) // 2] + 0.5 * v[at + n // 2]
    out = {"count": n, "sum": total, "mean": mean, "median": median, "std": np.sqrt(variance), "min": low, "max": high, "range": high - low, "variance": variance, "majority": np.where(np.isnan(end), end, most), "minority": least}
    return g[at], out


def _of_group(id_col: str, keys: list[str], value: str, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """Statistics of a group's parcels from the pixels of the squares around; pixels lie in the order of their cells."""
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        code = np.zeros(right.num_rows, np.int64)
        for k in keys:
            one = right[k].combine_chunks().dictionary_encode("encode")
            code = np.unique(code * len(one.dictionary) + one.indices.to_numpy(zero_copy_only=False), return_inverse=True)[1].reshape(-1)
        example, code = np.unique(code, return_index=True, return_inverse=True)[1:]
        lists = left["_spans"].combine_chunks()
        spans = lists.flatten().to_numpy().reshape(-1, 3)
        owner = np.repeat(np.arange(left.num_rows), pc.list_value_length(lists).to_numpy() // 3)
        top, start, wide = spans[:, 0].min(), spans[:, 1].min(), spans[:, 2].max() - spans[:, 1].min() + 1
        row, col = (right[c].to_numpy() for c in ("row", "col"))
        near = np.flatnonzero((row >= top) & (row <= spans[:, 0].max()) & (col >= start) & (col < start + wide))
        cell = (row[near] - top) * wide + col[near] - start
        order = near[np.argsort(cell, kind="stable")]
        before = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=(spans[:, 0].max() - top + 1) * wide))])
        v, known, code = (pc.fill_null(right[value], 0.0).to_numpy() + 0.0)[order], right[value].is_valid().to_numpy()[order], code.reshape(-1)[order]
        a = before[(spans[:, 0] - top) * wide + spans[:, 1] - start]
        n = before[(spans[:, 0] - top) * wide + spans[:, 2] - start + 1] - a
        out, part = [], np.cumsum(np.bincount(owner, n, left.num_rows)).astype(np.int64) // MOST_VALUES
        for p in np.unique(part):
            own = np.flatnonzero(part[owner] == p)
            at = np.repeat(a[own], n[own]) + _runs(n[own])
            g, ok = np.repeat(owner[own], n[own]) * len(example) + code[at], known[at]
            groups, (found, stats) = np.unique(g), _statistics_of(g[ok], v[at[ok]])
            place, none = np.searchsorted(groups, found), np.ones(len(groups), bool)
            none[place] = False
            columns = [left[id_col].take(pa.array(groups // len(example))), *(right[k].take(pa.array(example[groups % len(example)])) for k in keys)]
            for name in schema.names[len(columns):]:
                full = np.zeros(len(groups), stats[name].dtype)
                full[place] = stats[name]
                columns.append(pa.array(full, mask=none if name != "count" else None))
            out.append(pa.table(columns, names=schema.names).cast(schema))
        return pa.concat_tables(out)

    return run


def _own_statistics(pixels: DataFrame, parcels: DataFrame, keys: list[str], value: str, size: float, id_col: str = "uid") -> DataFrame:
    """`zonal_stats` of the valid ones of polygons with few points, one row each: groups of near ones meet the pixels around.

    A parcel is shuffled once, a pixel once for each group near it; nothing that is shuffled grows with the pairs of both.
    """
    c = F.col
    points = F.flatten("geom")
    coordinate = lambda i: F.transform(points, lambda p: p[i])
    cell = lambda x: F.floor(x / size).cast("long")
    boxes = parcels.where(F.size(points) > 0).withColumns({"_r0": cell(F.array_min(coordinate("y"))), "_r1": cell(F.array_max(coordinate("y"))), "_c0": cell(F.array_min(coordinate("x"))), "_c1": cell(F.array_max(coordinate("x")))})
    boxes = boxes.withColumns({"_hr": F.floor(c("_r0") / HOME), "_hc": F.floor(c("_c0") / HOME)})
    loads = boxes.groupBy("_hr", "_hc").agg(F.sum((c("_r1") - c("_r0") + 1) * (c("_c1") - c("_c0") + 1)).alias("n")).where(c("n") > MOST_BOXES).collect()  # a row for MOST_BOXES pixels of boxes at most
    home = F.concat_ws(":", "_hr", "_hc")
    parts = F.create_map(*(F.lit(x) for r in loads for x in (f"{r['_hr']}:{r['_hc']}", -(-r["n"] // MOST_BOXES))))[home] if loads else F.lit(1)
    boxes = boxes.withColumn("_part", F.pmod(F.xxhash64(id_col), F.coalesce(parts, F.lit(1)).cast("long")))
    group = ["_hr", "_hc", "_part"]
    square = lambda x: F.floor(x / SENT)
    wanted = boxes.select(*group, F.sequence(square(c("_r0")), square(c("_r1"))).alias("_rs"), F.sequence(square(c("_c0")), square(c("_c1"))).alias("_cs")).distinct()
    wanted = wanted.select(*group, F.explode("_rs").alias("_sr"), "_cs").select(*group, "_sr", F.explode("_cs").alias("_sc")).distinct()
    placed = pixels.select(*keys, c("row").cast("long").alias("row"), c("col").cast("long").alias("col"), value).withColumns({"_sr": square(c("row")), "_sc": square(c("col"))})
    sent = placed.join(_shuffled(wanted), ["_sr", "_sc"]).select(*(c(g).alias(g) for g in group), *keys, "row", "col", value)
    up = lambda p, q: F.when(p["y"] <= q["y"], F.struct(p["x"].alias("x0"), p["y"].alias("y0"), q["x"].alias("x1"), q["y"].alias("y1"))).otherwise(F.struct(q["x"].alias("x0"), q["y"].alias("y0"), p["x"].alias("x1"), p["y"].alias("y1")))
    of_ring = lambda r: F.transform(r, lambda p, i: up(p, F.element_at(r, F.pmod(i + 1, F.size(r)) + 1)))
    # tested and cut into spans where the groups are
    own = _faultless(boxes.select(id_col, "geom", *group).repartition(*group), "geom")
    own = own.select(id_col, *group, F.explode(F.array(F.flatten(F.transform(F.filter("geom", lambda r: F.size(r) >= 3), of_ring)))).alias("_edges"))
    own = own.select(id_col, *group, F.explode(F.array(_own_spans(size))).alias("_spans")).where(F.size("_spans") > 0)
    # the columns and types of the general way
    stats = statistics(pixels.withColumn(id_col, F.lit(None).cast(parcels.schema[id_col].dataType)), [id_col, *keys], value).schema
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stats])
    return own.groupBy(*group).cogroup(sent.groupBy(*group)).applyInArrow(_of_group(id_col, keys, value, to_arrow_schema(schema)), schema)


def valid_stats(pixels: DataFrame, parcels: DataFrame, keys: list[str], value: str = "value", rule: str = "centre", size: float = 1.0, buffer: float = 0.0, scl: str | None = None, drop_nulls: bool | None = None, id_col: str = "uid", **zonal) -> DataFrame:
    """`zonal_stats` of the valid polygons.

    By the plain rule pixels come to the polygons with few points, if no id has several rows; all others are dealt out as pixels.
    """
    most, large = parcels.groupBy(id_col).agg(F.count("*").alias("n"), F.bool_or(~few(size=size)).alias("large")).agg(F.max("n"), F.bool_or("large")).first()
    whole = all(isinstance(pixels.schema[c].dataType, T.LongType | T.IntegerType) for c in ("row", "col")) and isinstance(pixels.schema[value].dataType, T.DoubleType)
    if most != 1 or rule != "centre" or buffer > 0 or scl is not None or not whole:
        return zonal_stats(pixels, valid_polygons(parcels)[0], keys, value, rule, size, buffer=buffer, drop_nulls=drop_nulls, scl=scl, **zonal)
    out = _own_statistics(pixels, parcels.where(few(size=size)), keys, value, size, id_col)
    if large:
        out = out.unionByName(zonal_stats(pixels, valid_polygons(parcels.where(~few(size=size)))[0], keys, value, size=size))
    return out.na.drop() if drop_nulls else out


def touched_tiles(cells: DataFrame, tile_size: int, id_col: str = "uid") -> DataFrame:
    """Tiles that hold a parcel's pixel: a semi-join on them spares reading the others."""
    return cells.select(F.floor(F.col("row") / tile_size).alias("tile_row"), F.floor(F.col("col") / tile_size).alias("tile_col")).distinct()


def clustered(df: DataFrame, *by: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt out by ranges of the keys and sorted within, so that neighbours are read together."""
    cols = [F.col(c) for c in by]
    return (df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)).sortWithinPartitions(*cols)


def _points_in(points: DataFrame, e: DataFrame, band: float, keys: list[str], on: list[str]) -> DataFrame:
    """`points` (keys, x, y) with `_in`: 1 inside, 0 on the boundary of, -1 outside the polygon of `e`, by the edges of their band.

    With no columns `on` all points meet one polygon, whose edges are broadcast.
    """
    c = F.col
    banded = _in_bands(e.select(*on, "ax", "ay", "bx", "by"), band, "ay", "by")
    met = points.withColumn("_band", F.floor(c("y") / band).cast("long")).join(_shuffled(banded) if on else F.broadcast(banded), [*on, "_band"], "left")
    side = _side("ax", "ay", "bx", "by", "x", "y")
    length = F.abs(c("bx") - c("ax")) + F.abs(c("by") - c("ay"))
    slack = 1e-9 * length * F.greatest(F.lit(1.0), length)
    touches = (F.abs(side) <= slack) & (c("x") >= F.least("ax", "bx") - 1e-9) & (c("x") <= F.greatest("ax", "bx") + 1e-9) & (c("y") >= F.least("ay", "by") - 1e-9) & (c("y") <= F.greatest("ay", "by") + 1e-9)
    crosses = ((c("ay") <= c("y")) != (c("by") <= c("y"))) & (c("x") < c("ax") + (c("y") - c("ay")) / (c("by") - c("ay")) * (c("bx") - c("ax")))
    counted = met.groupBy(*keys).agg(F.coalesce(F.bool_or(touches), F.lit(False)).alias("_on"), F.count_if(F.coalesce(crosses, F.lit(False))).alias("_n"))
    return counted.withColumn("_in", F.when(c("_on"), 0).when(c("_n") % 2 == 1, 1).otherwise(-1)).drop("_on", "_n")


def _inner_points(e: DataFrame, id_col: str) -> DataFrame:
    """(uid, x, y): a point inside each polygon, in the first span of the line between its two lowest corners' heights."""
    c = F.col
    heights = F.array_sort(F.collect_set("ay"))
    line = e.groupBy(id_col).agg(heights.alias("_h")).where(F.size("_h") > 1).select(id_col, ((F.get("_h", F.lit(0)) + F.get("_h", F.lit(1))) / 2).alias("y"))
    met = e.join(_shuffled(line), id_col).where((c("ay") <= c("y")) != (c("by") <= c("y")))
    xs = met.groupBy(id_col, "y").agg(F.array_sort(F.collect_list(c("ax") + (c("y") - c("ay")) / (c("by") - c("ay")) * (c("bx") - c("ax")))).alias("_x"))
    return xs.select(id_col, ((F.get("_x", F.lit(0)) + F.get("_x", F.lit(1))) / 2).alias("x"), "y")


def within_footprint(parcels: DataFrame, footprint: DataFrame, band: float = 1.0, id_col: str = "uid", geometry: str = "geom") -> DataFrame:
    """Parcels that lie within the footprint polygon (one row uid, geom): no point of theirs is outside; boundaries may touch.

    Each edge of a parcel is cut where it meets an edge of the footprint; the middles of all pieces, and a point inside the parcel, must
    be inside or on the boundary, and no corner of the footprint inside the parcel. Edges meet in bands of height `band` only. Holes count as outside.
    """
    c = F.col
    own, foot = directed(parcels, id_col, geometry), directed(footprint)
    of_foot = foot.select(c("ax").alias("cx"), c("ay").alias("cy"), c("bx").alias("dx"), c("by").alias("dy"))
    met = _in_bands(own, band, "ay", "by").join(F.broadcast(_in_bands(of_foot, band, "cy", "dy")), "_band").where(_meet())
    # along the edge from 0 to 1: the crossing, or the footprint edge's ends where the two are parallel
    cross = (c("bx") - c("ax")) * (c("dy") - c("cy")) - (c("by") - c("ay")) * (c("dx") - c("cx"))
    at = F.try_divide((c("cx") - c("ax")) * (c("dy") - c("cy")) - (c("cy") - c("ay")) * (c("dx") - c("cx")), cross)
    square = (c("bx") - c("ax")) ** 2 + (c("by") - c("ay")) ** 2
    along = lambda x, y: F.try_divide((c(x) - c("ax")) * (c("bx") - c("ax")) + (c(y) - c("ay")) * (c("by") - c("ay")), square)
    places = F.filter(F.when(cross != 0, F.array(at)).otherwise(F.array(along("cx", "cy"), along("dx", "dy"))), lambda t: (t > 0) & (t < 1))
    cuts = met.groupBy(id_col, "ring", "edge").agg(F.flatten(F.collect_list(places)).alias("_cuts"))
    pieces = own.join(_shuffled(cuts), [id_col, "ring", "edge"], "left")
    ends = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.coalesce("_cuts", F.expr("array()").cast("array<double>")))))
    pieces = pieces.withColumn("_t", ends).select(id_col, "ring", "edge", "ax", "ay", "bx", "by", F.posexplode(F.transform(F.sequence(F.lit(0), F.size("_t") - 2), lambda i: (F.get(c("_t"), i) + F.get(c("_t"), i + 1)) / 2)).alias("piece", "t"))
    middles = pieces.select(id_col, "ring", "edge", "piece", (c("ax") + c("t") * (c("bx") - c("ax"))).alias("x"), (c("ay") + c("t") * (c("by") - c("ay"))).alias("y"))
    middles = middles.unionByName(_inner_points(own, id_col).select(id_col, F.lit(-1).alias("ring"), F.lit(0).alias("edge"), F.lit(0).alias("piece"), "x", "y"))
    out = _points_in(middles, foot, band, [id_col, "ring", "edge", "piece"], []).where("_in < 0").select(id_col)
    # corners of the footprint inside a parcel: its boundary runs there
    corners = _in_bands(own, band, "ay", "by").select(id_col, "_band").distinct().join(F.broadcast(foot.select(c("ax").alias("x"), c("ay").alias("y"), F.floor(c("ay") / band).cast("long").alias("_band")).distinct()), "_band").drop("_band")
    held = _points_in(corners, own, band, [id_col, "x", "y"], [id_col]).where("_in > 0").select(id_col)
    gone = out.unionByName(held).unionByName(parcels.join(_shuffled(own.select(id_col).distinct()), id_col, "left_anti").select(id_col)).distinct()
    return parcels.join(_shuffled(gone), id_col, "left_anti")
