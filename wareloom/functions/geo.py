"""Geometry as column expressions.

Spark 4.1 has no ``st_point`` / ``st_astext`` / ``st_contains``, so
geometry is carried as GeoJSON text or as coordinate arrays and handled with
``from_json`` and higher-order array functions (all JVM-side).

Ring layout used for polygons: ``array<array<array<double>>>`` = rings, each
ring a closed list of ``[x, y]`` positions.  A multipolygon is the
concatenation of the rings of its parts; the even-odd rule over all rings
then gives holes and multiple parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT_SCHEMA = "type string, coordinates array<double>"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def point_parts(col: Column | str) -> tuple[Column, Column]:
    """Longitude and latitude of a ``{"type":"Point","coordinates":[lon,lat]}`` value.

    The value may be JSON text or an already parsed struct; NULL stays NULL.
    """
    c = _c(col)
    coords = F.from_json(c.cast("string"), POINT_SCHEMA)["coordinates"]
    return F.try_element_at(coords, F.lit(1)), F.try_element_at(coords, F.lit(2))


def free_name(name: str, taken) -> str:
    """``name``, or its first form ``name_2``, ``name_3``, ... that is not taken."""
    n, out = 2, name
    while out in taken:
        out, n = f"{name}_{n}", n + 1
    return out


def split_point(df: DataFrame, column: str) -> DataFrame:
    """Replace a point column by ``longitude`` and ``latitude`` doubles; columns
    that have these names already stay, and the new ones get a suffix."""
    lon, lat = point_parts(F.col(f"`{column}`"))
    taken = set(df.columns) - {column}
    names = [free_name(n, taken) for n in ("longitude", "latitude")]
    split = df.select("*", lon.alias("__lon"), lat.alias("__lat")).drop(column)
    return split.withColumnsRenamed({"__lon": names[0], "__lat": names[1]})


def point(lon: Column | str, lat: Column | str) -> Column:
    """GeoJSON point struct from longitude / latitude columns (NULL when either is NULL)."""
    lon, lat = _c(lon), _c(lat)
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(F.lit("Point").alias("type"), F.array(lon.cast("double"), lat.cast("double")).alias("coordinates")))


# ---- GeoJSON geometry -> WKT ---------------------------------------------

def _pos(p: str) -> str:
    # one position: "x y" (or "x y z")
    return f"array_join(transform({p}, v -> cast(v as string)), ' ')"


def _seq(a: str, var: str) -> str:
    # list of positions: "x y, x y"
    return f"array_join(transform({a}, {var} -> {_pos(var)}), ', ')"


def _wkt_sql(g: str, nested: int = 2) -> str:
    """SQL text of the WKT of GeoJSON text ``g``; collections nest ``nested`` deep."""
    def coords(depth: int) -> str:
        return f"from_json({g}, 'struct<coordinates: {'array<' * depth}double{'>' * depth}>').coordinates"

    def shape(kind: str, inner: str, depth: int) -> str:
        return f"CASE WHEN size({coords(depth)}) > 0 THEN concat('{kind} (', {inner}, ')') ELSE '{kind} EMPTY' END"

    def joined(a: str, var: str, inner: str) -> str:
        return f"array_join(transform({a}, {var} -> concat('(', {inner}, ')')), ', ')"

    parts = f"from_json({g}, 'struct<geometries: array<string>>').geometries"
    collection = ""
    if nested:
        v = f"g{nested}"
        collection = f"""WHEN 'GeometryCollection' THEN CASE WHEN size({parts}) > 0
          THEN concat('GEOMETRYCOLLECTION (', array_join(transform({parts}, {v} -> {_wkt_sql(v, nested - 1)}), ', '), ')')
          ELSE 'GEOMETRYCOLLECTION EMPTY' END"""
    return f"""CASE get_json_object({g}, '$.type')
      WHEN 'Point' THEN {shape('POINT', _pos(coords(1)), 1)}
      WHEN 'MultiPoint' THEN {shape('MULTIPOINT', joined(coords(2), 'q', _pos('q')), 2)}
      WHEN 'LineString' THEN {shape('LINESTRING', _seq(coords(2), 'q'), 2)}
      WHEN 'MultiLineString' THEN {shape('MULTILINESTRING', joined(coords(3), 'r', _seq('r', 'q')), 3)}
      WHEN 'Polygon' THEN {shape('POLYGON', joined(coords(3), 'r', _seq('r', 'q')), 3)}
      WHEN 'MultiPolygon' THEN {shape('MULTIPOLYGON', joined(coords(4), 's', joined('s', 'r', _seq('r', 'q'))), 4)}
      {collection}
    END"""


def to_wkt(col: str) -> Column:
    """GeoJSON geometry text to WKT: the seven geometry types (collections up to
    two deep), ``EMPTY`` without coordinates; NULL geometry gives NULL."""
    return F.expr(_wkt_sql(f"`{col}`"))


def geometry_to_wkt(df: DataFrame, column: str = "geometry", out: str = "geometry_wkt") -> DataFrame:
    return df.withColumn(out, to_wkt(column)).drop(column)


# ---- polygons as rings -----------------------------------------------------

def rings_of_geojson(col: str) -> Column:
    """Rings of a Polygon / MultiPolygon GeoJSON text (multipolygon parts concatenated)."""
    g = f"`{col}`"
    return F.expr(f"""CASE get_json_object({g}, '$.type')
      WHEN 'Polygon' THEN from_json({g}, 'struct<coordinates: array<array<array<double>>>>').coordinates
      WHEN 'MultiPolygon' THEN flatten(from_json({g}, 'struct<coordinates: array<array<array<array<double>>>>>').coordinates)
    END""")


def close_rings(col: Column | str) -> Column:
    """Append the first position to every ring that is not closed."""
    return F.transform(_c(col), lambda r: F.when(r[0] == F.element_at(r, -1), r).otherwise(F.concat(r, F.array(r[0]))))


def bbox(col: Column | str) -> Column:
    """struct(xmin, ymin, xmax, ymax) of rings."""
    pts = F.flatten(_c(col))
    xs = F.transform(pts, lambda p: p[0])
    ys = F.transform(pts, lambda p: p[1])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def inside_sql(px: str, py: str, rings: str) -> str:
    """SQL text: even-odd ray casting of point (px, py) against closed rings."""
    return f"""(aggregate({rings}, 0, (acc, ring) -> acc + aggregate(sequence(0, size(ring) - 2), 0, (n, i) ->
        n + CASE WHEN ((ring[i][1] > {py}) <> (ring[i + 1][1] > {py}))
                  AND ({px} < (ring[i + 1][0] - ring[i][0]) * ({py} - ring[i][1]) / (ring[i + 1][1] - ring[i][1]) + ring[i][0])
             THEN 1 ELSE 0 END)) % 2 = 1)"""
