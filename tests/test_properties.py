"""Property: the grid join equals brute force for random polygons, points,
cell sizes and strategies."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from brute import join as brute_join
from fieldatlas.operators.spatial import spatial_join

RINGS = T.ArrayType(
    T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
)
POLY_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("rings", RINGS)])

coord = st.integers(min_value=-40, max_value=40).map(lambda v: v / 4.0)


@st.composite
def star_polygon(draw):
    """Star-shaped around its centre, so always simple; concave in general."""
    cx, cy = draw(coord), draw(coord)
    n = draw(st.integers(min_value=3, max_value=9))
    radii = draw(st.lists(st.integers(min_value=1, max_value=16), min_size=n, max_size=n))
    ring = [
        (cx + r / 2.0 * math.cos(2 * math.pi * i / n), cy + r / 2.0 * math.sin(2 * math.pi * i / n))
        for i, r in enumerate(radii)
    ]
    return ring + ring[:1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    polys=st.lists(star_polygon(), min_size=1, max_size=4),
    pts=st.lists(st.tuples(coord, coord), min_size=1, max_size=60),
    cell=st.sampled_from([None, 0.25, 1.0, 7.0]),
    strategy=st.sampled_from(["broadcast", "shuffle"]),
)
def test_grid_join_equals_brute_force(spark, polys, pts, cell, strategy):
    # add every vertex as a point too: boundary cases must be excluded
    pts = pts + [v for ring in polys for v in ring[:2]]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    named = [(f"p{i}", [ring]) for i, ring in enumerate(polys)]
    poly_df = spark.createDataFrame(
        [(n, [[{"x": x, "y": y} for x, y in r] for r in rings]) for n, rings in named], POLY_SCHEMA
    )
    pt_df = spark.createDataFrame(points, "pid long, lon double, lat double")
    out = spatial_join(pt_df, poly_df, cell_size=cell, strategy=strategy, skew="salt", rows_per_task=3)
    got = [(r.pid, r.name) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_join(points, named)
