"""Operators: spatial join, diversity, similarity, nearest places,
document filters/sorts and writers. All take and return DataFrames."""

from fieldatlas.operators.diversity import (
    distinct_members,
    distinct_sketches,
    most_diverse,
    most_diverse_from_sketches,
    null_profile,
    richness,
    richness_from_sketches,
)
from fieldatlas.operators.documents import (
    cancelled_flights,
    field,
    flatten,
    from_json_text,
    to_json_text,
)
from fieldatlas.operators.nearest import (
    find_first,
    has_position,
    k_nearest,
    k_nearest_in_layout,
    name_or_default,
    points_only,
)
from fieldatlas.operators.shapes import shape_join
from fieldatlas.operators.similarity import most_similar, pair_overlaps
from fieldatlas.operators.sinks import (
    append_documents,
    clustered_layout,
    geojson_documents,
    replace_collection,
    write_clustered,
    write_documents,
    write_feature_collection,
    write_feature_lines,
)
from fieldatlas.operators.spatial import GridPlan, plan_grid, spatial_join

__all__ = [
    "GridPlan",
    "append_documents",
    "cancelled_flights",
    "clustered_layout",
    "distinct_members",
    "field",
    "find_first",
    "flatten",
    "from_json_text",
    "geojson_documents",
    "has_position",
    "k_nearest",
    "k_nearest_in_layout",
    "most_diverse",
    "most_similar",
    "name_or_default",
    "null_profile",
    "pair_overlaps",
    "plan_grid",
    "points_only",
    "replace_collection",
    "distinct_sketches",
    "most_diverse_from_sketches",
    "richness",
    "richness_from_sketches",
    "shape_join",
    "spatial_join",
    "to_json_text",
    "write_clustered",
    "write_documents",
    "write_feature_collection",
    "write_feature_lines",
]
