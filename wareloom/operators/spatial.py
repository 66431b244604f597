"""Point in polygon: each point gets the attributes of the first (in polygon
order) polygon that contains it, or NULLs.

Plan:
1. A polygon is filed in a grid as coarse as itself: the cell size is the power
   of two at or above the longer side of its bounding box, so it covers at
   most four cells of that grid, whatever the unit of the coordinates and
   however different the polygons are.  One row per (polygon, cell).
2. A polygon's height is cut into bands, about one for every ``PER_BAND`` edges (fewer when
   its edges are so long that they would be kept more than ``COPIES`` times).  An edge is
   kept in the bands it touches.  One row per (polygon, band).
3. The distinct coordinates of the points are looked up once per grid size in
   use (a handful) by an equi-join on (size, cell x, cell y); those inside the bounding
   box go on to their band by (polygon, band) and meet its edges only, in the even-odd ray-casting
   test: edges of other bands do not cross the point's height, so the answer is that of all edges.
4. The smallest polygon per coordinate (partial aggregation) joins back to the
   points.  Points without coordinates are in no polygon; they and repeated coordinates are spread.

There are no hints: AQE broadcasts a polygon side that it measured to be
small and splits hot cells otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.functions.geo import bbox, close_rings

SMALLEST_LEVEL = -40  # cells of 2^-40 for polygons without extent
PER_BAND, COPIES = 16, 8


def _edges(rings: str) -> Column:
    """The edges of closed rings that are not level, as (x0, y0, x1, y1)."""
    pairs = F.transform(rings, lambda r: F.zip_with(F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))),
                                                    lambda p, q: F.struct(p[0].alias("x0"), p[1].alias("y0"), q[0].alias("x1"), q[1].alias("y1"))))
    return F.filter(F.flatten(pairs), lambda e: e["y0"] != e["y1"])


def shapes(polygons: DataFrame, attrs: list[str], rings: str = "rings", order: str = "poly_order") -> DataFrame:
    """(poly, hit, box, bands, edges): one row per polygon that has an extent."""
    filled = polygons.where(F.size(F.flatten(F.col(rings))) > 0)
    polys = filled.select(F.struct(F.col(order).alias("ord"), *[F.col(f"`{a}`") for a in attrs]).alias("hit"),
                          close_rings(F.filter(F.col(rings), lambda r: F.size(r) > 0)).alias("rings"))
    polys = polys.select("hit", bbox("rings").alias("box"), _edges("rings").alias("edges")).withColumn("poly", F.monotonically_increasing_id())
    height = F.col("box.ymax") - F.col("box.ymin")
    climbed = F.aggregate("edges", F.lit(0.0), lambda s, e: s + F.abs(e["y1"] - e["y0"]))
    most = F.size("edges") * (COPIES - 1) * height / climbed  # an edge is kept once, and once more for every band line it crosses
    bands = F.when((height > 0) & (climbed > 0), F.greatest(F.lit(1), F.least(F.floor(F.size("edges") / PER_BAND), F.floor(most)))).otherwise(1)
    return polys.withColumn("bands", bands.cast("int"))


def band(y: Column, box: str = "box", bands: str = "bands") -> Column:
    """The band of a height inside the box; never falls as y grows."""
    height = F.col(f"{box}.ymax") - F.col(f"{box}.ymin")
    at = F.floor((y - F.col(f"{box}.ymin")) / F.when(height > 0, height).otherwise(1.0) * F.col(bands)).cast("int")
    return F.least(F.greatest(at, F.lit(0)), F.col(bands) - 1)


def polygon_cells(polys: DataFrame) -> DataFrame:
    """(level, cx, cy, poly, box, bands): one row per polygon and cell of its grid."""
    side = F.greatest(F.col("box.xmax") - F.col("box.xmin"), F.col("box.ymax") - F.col("box.ymin"))
    level = F.when(side > 0, F.greatest(F.ceil(F.log2(side)), F.lit(SMALLEST_LEVEL))).otherwise(SMALLEST_LEVEL)
    polys = polys.select("poly", "box", "bands", level.cast("int").alias("level"))
    cell = F.pow(F.lit(2.0), F.col("level"))
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / cell).cast("long"), F.floor(F.col(hi) / cell).cast("long")))
    return polys.withColumn("cx", span("box.xmin", "box.xmax")).withColumn("cy", span("box.ymin", "box.ymax"))


def band_edges(polys: DataFrame) -> DataFrame:
    """(poly, band, edges): the edges that touch each band."""
    each = polys.select("poly", "box", "bands", F.explode("edges").alias("e"))
    low, high = band(F.least("e.y0", "e.y1")), band(F.greatest("e.y0", "e.y1"))
    each = each.withColumn("band", F.explode(F.sequence(low, high)))
    return each.groupBy("poly", "band").agg(F.collect_list("e").alias("edges"))


def _crossings(x: str, y: str) -> Column:
    """How many edges the ray to the right of (x, y) crosses."""
    px, py = F.col(x), F.col(y)
    cross = lambda e: ((e["y0"] > py) != (e["y1"] > py)) & (px < (e["x1"] - e["x0"]) * (py - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"])
    return F.size(F.filter("edges", cross))


def candidates(points: DataFrame, polys: DataFrame, x: str, y: str) -> DataFrame:
    """(__x, __y, poly, band) of the distinct coordinates inside a polygon's box."""
    cells = polygon_cells(polys)
    levels = sorted(r[0] for r in cells.select("level").distinct().collect())  # bounded by the exponents of a double
    spots = points.select(F.col(f"`{x}`").cast("double").alias("__x"), F.col(f"`{y}`").cast("double").alias("__y"))
    spots = spots.where("__x is not null and __y is not null and not isnan(__x) and not isnan(__y)").distinct()
    at = spots.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    cell = F.pow(F.lit(2.0), F.col("level"))
    at = at.withColumns({"cx": F.floor(F.col("__x") / cell).cast("long"), "cy": F.floor(F.col("__y") / cell).cast("long")})
    # the key is a struct, so that a hot cell's rows come straight from a shuffle and AQE may split them
    key = F.struct("level", "cx", "cy").alias("__cell")
    inside = F.col("__x").between(F.col("box.xmin"), F.col("box.xmax")) & F.col("__y").between(F.col("box.ymin"), F.col("box.ymax"))
    return at.select("__x", "__y", key).join(cells.select(key, "poly", "box", "bands"), "__cell").where(inside).select("__x", "__y", "poly", band(F.col("__y")).alias("band"))


def locate(points: DataFrame, polygons: DataFrame, attrs: list[str], x: str = "longitude", y: str = "latitude",
           rings: str = "rings", order: str = "poly_order") -> DataFrame:
    """Add ``attrs`` of the first containing polygon to every point."""
    from wareloom.operators.load import spread
    from wareloom.session import cut_lineage

    polys = cut_lineage(shapes(polygons, attrs, rings, order), "shapes")  # numbers of their own, read three times
    near = candidates(points, polys, x, y).select("__x", "__y", F.struct("poly", "band").alias("__band"))
    edges = band_edges(polys).select(F.struct("poly", "band").alias("__band"), "edges")
    found = near.join(edges, "__band").where(_crossings("__x", "__y") % 2 == 1).select("__x", "__y", F.col("__band.poly").alias("poly"))
    first = found.join(polys.select("poly", "hit"), "poly").groupBy("__x", "__y").agg(F.min("hit").alias("__hit"))
    first = first.select(F.struct("__x", "__y", F.lit(0).cast("bigint").alias("salt")).alias("__at"), "__hit")
    px, py = F.col(f"`{x}`").cast("double"), F.col(f"`{y}`").cast("double")
    placed = px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py)
    salt = F.when(placed, F.lit(0).cast("bigint")).otherwise(spread(points))
    keyed = points.withColumn("__at", F.struct(px.alias("__x"), py.alias("__y"), salt.alias("salt")))
    out = keyed.join(first, "__at", "left")
    return out.select(*[F.col(f"`{c}`") for c in points.columns], *[F.col("__hit")[a].alias(a) for a in attrs])
