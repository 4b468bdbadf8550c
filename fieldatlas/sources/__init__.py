"""Readers: JSON-lines documents, tables by format, GeoJSON features, shapefiles."""

from fieldatlas.sources.documents import read_json_lines, read_table, scan
from fieldatlas.sources.geojson import (
    feature_columns,
    read_features,
    read_feature_table,
    read_polygons,
    shape_columns,
)
from fieldatlas.sources.shapefile import read_shapefile, read_shapes

__all__ = [
    "feature_columns",
    "read_feature_table",
    "read_features",
    "read_json_lines",
    "read_polygons",
    "read_shapefile",
    "read_shapes",
    "read_table",
    "scan",
    "shape_columns",
]
