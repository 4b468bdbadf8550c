"""Column functions (pure Spark expressions, no UDFs)."""

from fieldatlas.functions.geo import (
    EARTH_RADIUS_M,
    bbox,
    contains_point,
    geojson_geometry_schema,
    geometry_from_geojson,
    geometry_to_geojson,
    haversine_m,
    point_geometry,
    polygon_edges,
    rings_from_coordinates,
)
from fieldatlas.functions.sets import jaccard, set_from_list

__all__ = [
    "EARTH_RADIUS_M",
    "bbox",
    "contains_point",
    "geojson_geometry_schema",
    "geometry_from_geojson",
    "geometry_to_geojson",
    "haversine_m",
    "jaccard",
    "point_geometry",
    "polygon_edges",
    "rings_from_coordinates",
    "set_from_list",
]
