"""Geometry as plain Spark columns.

A point is two double columns (longitude, latitude). A polygon is
``rings: array<array<struct<x: double, y: double>>>`` holding the shell,
holes and, for multi-polygons, the rings of every part. Coordinates are
planar degrees; there is no CRS transform and no antimeridian handling.

Everything here is a Column expression, so it runs inside the JVM and is
planned by Catalyst like any built-in function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: mean Earth radius in metres used by the haversine distance.
EARTH_RADIUS_M = 6371000.0

def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres between two lon/lat points.

    ``a`` is clamped to 1 so that rounding can never produce NaN for
    antipodal points.
    """
    lon1, lat1, lon2, lat2 = (_c(x) for x in (lon1, lat1, lon2, lat2))
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    a = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlon) * F.sin(half_dlon)
    a = F.least(a, F.lit(1.0))
    return F.lit(EARTH_RADIUS_M) * (2 * F.atan2(F.sqrt(a), F.sqrt(1 - a)))


def _name(c: str) -> str:
    if not isinstance(c, str):
        raise TypeError("pass a column name; build derived values as columns first")
    return ".".join(f"`{p}`" for p in c.split("."))


def polygon_edges(rings: str, ordered: bool = False) -> Column:
    """All edges of all rings of column ``rings`` as
    ``array<struct<x1,y1,x2,y2>>``.

    With ``ordered``, each edge runs from its lower end (smaller y, then
    smaller x) to its upper one. Neighbouring polygons, which hold a shared
    edge in opposite directions, then evaluate identical arithmetic on it, so a
    point within rounding distance of the edge is given to exactly one of them.

    Rings with fewer than two vertices are dropped; open rings are closed.
    Higher-order functions are written as one SQL expression, so the whole
    expression is built by a single parse instead of many Python calls.
    """
    r = _name(rings)
    edges = (
        f"""flatten(transform(filter({r}, r -> size(r) >= 2), r ->
              transform(
                sequence(0, size(r) - IF(r[0].x = r[size(r) - 1].x AND r[0].y = r[size(r) - 1].y, 2, 1)),
                i -> named_struct(
                  'x1', r[i].x, 'y1', r[i].y,
                  'x2', r[(i + 1) % size(r)].x, 'y2', r[(i + 1) % size(r)].y))))"""
    )
    if ordered:
        edges = f"""transform({edges}, e -> IF(e.y1 > e.y2 OR (e.y1 = e.y2 AND e.x1 > e.x2),
                      named_struct('x1', e.x2, 'y1', e.y2, 'x2', e.x1, 'y2', e.y1), e))"""
    return F.expr(edges)


def bbox(edges: str) -> list[Column]:
    """``[min_x, min_y, max_x, max_y]`` of an edge array column."""
    e = _name(edges)
    return [
        F.expr(f"array_min(transform({e}, s -> least(s.x1, s.x2)))"),
        F.expr(f"array_min(transform({e}, s -> least(s.y1, s.y2)))"),
        F.expr(f"array_max(transform({e}, s -> greatest(s.x1, s.x2)))"),
        F.expr(f"array_max(transform({e}, s -> greatest(s.y1, s.y2)))"),
    ]


def contains_sql(edges: str, x: str, y: str) -> str:
    """SQL text of :func:`contains_point` over column names."""
    on_edge = on_edge_sql(edges, x, y)
    e, x, y = _name(edges), _name(x), _name(y)
    return f"""(size(filter({e}, s ->
          CASE WHEN (s.y1 > {y}) <> (s.y2 > {y})
               THEN {x} < (s.x2 - s.x1) * ({y} - s.y1) / (s.y2 - s.y1) + s.x1
               ELSE false END)) % 2 = 1)
      AND NOT {on_edge}"""


def on_edge_sql(edges: str, x: str, y: str) -> str:
    """SQL text: whether the point lies on one of the edges, over column names."""
    e, x, y = _name(edges), _name(x), _name(y)
    return f"""exists({e}, s ->
          (s.x2 - s.x1) * ({y} - s.y1) = (s.y2 - s.y1) * ({x} - s.x1)
          AND {x} BETWEEN least(s.x1, s.x2) AND greatest(s.x1, s.x2)
          AND {y} BETWEEN least(s.y1, s.y2) AND greatest(s.y1, s.y2))"""


def contains_point(edges: str, x: str, y: str) -> Column:
    """OGC *contains*: the point ``(x, y)`` is in the interior of the polygon
    whose edges are in column ``edges``.

    Even-odd rule over the edges of all rings (so holes and disjoint parts
    are handled), then points lying on any edge are excluded, because a
    polygon does not contain its boundary. The division only runs for edges
    that straddle the point's latitude, so a horizontal edge never divides by
    zero (Spark's ANSI mode would raise).
    """
    return F.expr(contains_sql(edges, x, y))


def point_geometry(lon, lat) -> Column:
    """GeoJSON-shaped point: ``struct<type: string, coordinates: array<double>>``; null without both coordinates."""
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(_c(lon).cast("double"), _c(lat).cast("double")).alias("coordinates"),
    )
    return F.when(_c(lon).isNotNull() & _c(lat).isNotNull(), point)


def geojson_geometry_schema() -> T.StructType:
    """Schema of the point documents written by the document sink."""
    return T.StructType(
        [
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.ArrayType(T.DoubleType())),
        ]
    )


def geometry_to_geojson(geometry) -> Column:
    """Geometry (a struct, or a VARIANT of any geometry type) to GeoJSON text; null stays null."""
    return F.to_json(_c(geometry))


def geometry_from_geojson(text) -> Column:
    """GeoJSON text to the point struct; a non-point keeps its type and gets
    null coordinates (a nested array cannot be read as ``array<double>``)."""
    return F.from_json(_c(text), geojson_geometry_schema())


def parts_from_coordinates(geometry_variant) -> Column:
    """A GeoJSON geometry of any simple type (a VARIANT) to ``array<array<struct<x,y>>>``:
    one list of positions for a point or multipoint, one a line, one a ring."""
    g = _c(geometry_variant)
    gtype = F.try_variant_get(g, "$.type", "string")

    def read(depth: int) -> Column:
        return F.try_variant_get(g, "$.coordinates", "array<" * depth + "double" + ">" * depth)

    def positions(part: Column) -> Column:
        return F.transform(part, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))

    def many(parts: Column) -> Column:
        return F.transform(parts, positions)

    return (
        F.when(gtype == "Point", F.array(positions(F.array(read(1)))))
        .when(gtype.isin("MultiPoint", "LineString"), F.array(positions(read(2))))
        .when(gtype.isin("MultiLineString", "Polygon"), many(read(3)))
        .when(gtype == "MultiPolygon", many(F.flatten(read(4))))
    )


def rings_from_coordinates(geometry_variant) -> Column:
    """Polygon or MultiPolygon GeoJSON geometry (a VARIANT) to ``rings``.

    The cast depth is chosen by ``type``: a cast at the wrong depth returns
    arrays of nulls rather than null, so it must never be guessed.
    """
    g = _c(geometry_variant)
    gtype = F.try_variant_get(g, "$.type", "string")
    poly = F.try_variant_get(g, "$.coordinates", "array<array<array<double>>>")
    multi = F.try_variant_get(
        g, "$.coordinates", "array<array<array<array<double>>>>"
    )

    def to_rings(rings: Column) -> Column:
        return F.transform(
            rings,
            lambda r: F.transform(
                r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))
            ),
        )

    return (
        F.when(gtype == "Polygon", to_rings(poly))
        .when(gtype == "MultiPolygon", to_rings(F.flatten(multi)))
        .otherwise(F.lit(None))
    )
