import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brute import join as brute_join
from conftest import SF01
from fieldatlas import fixtures as fx
from fieldatlas.functions.geo import contains_point, polygon_edges
from fieldatlas.operators.spatial import spatial_join

RINGS = T.ArrayType(
    T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
)
POLY_SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("rings", RINGS)])
PT_SCHEMA = "pid string, lon double, lat double"


def ring(*pts):
    return [{"x": x if x is None else float(x), "y": float(y)} for x, y in pts]


SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
HOLE = ring((1, 1), (3, 1), (3, 3), (1, 3), (1, 1))
OTHER = ring((3, 3), (6, 3), (6, 6), (3, 6))  # open ring, overlaps the square's corner


def polygons(spark):
    return spark.createDataFrame(
        [("square", [SQUARE]), ("holed", [SQUARE, HOLE]), ("other", [OTHER])], POLY_SCHEMA
    )


MICRO_POINTS = [
    ("centre", 2.0, 2.0),
    ("inner", 0.5, 0.5),
    ("left_side", 0.0, 2.0),
    ("bottom_side", 2.0, 0.0),
    ("right_side", 4.0, 2.0),
    ("top_side", 2.0, 4.0),
    ("corner", 0.0, 0.0),
    ("vertex_other", 6.0, 6.0),
    ("outside", 7.0, 7.0),
    ("in_hole_edge", 1.0, 2.0),
    ("both", 3.5, 3.5),
    ("null_lon", None, 1.0),
]

EXPECTED = {
    ("centre", "square"),
    ("inner", "square"),
    ("inner", "holed"),
    ("in_hole_edge", "square"),
    ("both", "square"),
    ("both", "holed"),
    ("both", "other"),
}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize("cell_size", [None, 0.3, 1.0, 10.0])
def test_micro_containment(spark, strategy, cell_size):
    pts = spark.createDataFrame(MICRO_POINTS, PT_SCHEMA)
    out = spatial_join(
        pts, polygons(spark), cell_size=cell_size, strategy=strategy, rows_per_task=2, skew="salt"
    )
    got = {(r.pid, r.name) for r in out.collect()}
    assert got == EXPECTED


def test_contains_point_expression(spark):
    schema = T.StructType(
        [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("rings", RINGS)]
    )
    df = spark.createDataFrame([(2.0, 2.0, [SQUARE]), (0.0, 2.0, [SQUARE]), (5.0, 5.0, [SQUARE])], schema)
    edges = df.select("x", "y", polygon_edges("rings").alias("edges"))
    got = [r.c for r in edges.select(contains_point("edges", "x", "y").alias("c")).collect()]
    assert got == [True, False, False]


def test_output_columns_and_collisions(spark):
    pts = spark.createDataFrame([("p", "a", 2.0, 2.0)], "pid string, name string, lon double, lat double")
    polys = spark.createDataFrame(
        [("square", "x", [SQUARE])],
        T.StructType(
            [
                T.StructField("name", T.StringType()),
                T.StructField("a.b", T.StringType()),
                T.StructField("rings", RINGS),
            ]
        ),
    )
    out = spatial_join(pts, polys)
    assert out.columns == ["pid", "name", "community_name", "a.b", "lon", "lat"]
    assert [tuple(r) for r in out.collect()] == [("p", "a", "square", "x", 2.0, 2.0)]


def _fixture_inputs(spark):
    occ = fx.occurrences(spark, SF01)
    com = fx.communities(spark, SF01)
    pts = [(r.occ_id, r.lon, r.lat) for r in occ.collect()]
    polys = [(r.community, [[(p.x, p.y) for p in rg] for rg in r.rings]) for r in com.collect()]
    return occ, com, pts, polys


@pytest.mark.parametrize(
    "kw",
    [
        {},
        {"cell_size": 0.13},
        {"cell_size": 0.5},
        {"cell_size": 3.0},
        {"cell_size": 0.01, "max_cells_per_polygon": 64},
        {"strategy": "shuffle", "rows_per_task": 50, "skew": "salt"},
        {"strategy": "shuffle", "skew": "aqe"},
    ],
)
def test_grid_join_equals_brute_force(spark, kw):
    occ, com, pts, polys = _fixture_inputs(spark)
    expected = brute_join(pts, polys)
    out = spatial_join(occ, com, **kw)
    got = [(r.occ_id, r.community) for r in out.collect()]
    assert len(got) == len(set(got)), "a (point, polygon) pair met twice"
    assert set(got) == expected
    assert len(expected) == 15656


def test_multi_level_plan(spark):
    # one polygon much larger than the rest forces a coarser level for it
    big = ring((0, 0), (100, 0), (100, 100), (0, 100))
    small = ring((1, 1), (1.5, 1), (1.5, 1.5), (1, 1.5))
    polys = spark.createDataFrame([("big", [big]), ("small", [small])], POLY_SCHEMA)
    pts = spark.createDataFrame([("a", 1.2, 1.2), ("b", 50.0, 50.0), ("c", 101.0, 1.0)], PT_SCHEMA)
    out, plan = spatial_join(pts, polys, cell_size=0.1, max_cells_per_polygon=64, return_plan=True)
    assert len(plan.levels) == 2
    assert {(r.pid, r.name) for r in out.collect()} == {("a", "big"), ("a", "small"), ("b", "big")}


def test_plan_uses_cell_equi_join(spark):
    out = spatial_join(fx.occurrences(spark, SF01), fx.communities(spark, SF01))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "_fa_cx" in plan and "_fa_cy" in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_shuffle_plan_is_a_salted_merge_join(spark):
    out = spatial_join(
        fx.occurrences(spark, SF01), fx.communities(spark, SF01), strategy="shuffle", rows_per_task=2,
        skew="salt",
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_fa_salt" in plan and "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_hot_cell_with_a_third_of_all_points(spark):
    # a third of all points share one location; both strategies must give the full result
    n = 30000
    pts = spark.range(n).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise((F.col("id") * 7919 % 4000) / 1000.0).alias("lon"),
        F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise((F.col("id") * 104729 % 4000) / 1000.0).alias("lat"),
    )
    polys = polygons(spark)
    rows = [(r.pid, r.lon, r.lat) for r in pts.collect()]
    rings = {r.name: [[(p.x, p.y) for p in rg] for rg in r.rings] for r in polys.collect()}
    expected = brute_join(rows, list(rings.items()))
    for kw in (
        {"strategy": "broadcast"},
        {"strategy": "shuffle", "rows_per_task": 1000, "skew": "salt"},
        {"strategy": "shuffle", "skew": "aqe"},
    ):
        out = spatial_join(pts, polys, cell_size=0.5, **kw)
        got = [(r.pid, r.name) for r in out.collect()]
        assert len(got) == len(set(got))
        assert set(got) == expected
    hot = sum(1 for pid, name in expected if pid % 3 == 0)
    assert hot == n // 3  # (2, 2) is inside "square" and inside the hole of "holed"


def test_aqe_splits_the_hot_cell(spark):
    # one cell holds a third of all points; adaptive execution must split its partition
    n = 60000
    pts = spark.range(n).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise((F.col("id") * 7919 % 4000) / 1000.0).alias("lon"),
        F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise((F.col("id") * 104729 % 4000) / 1000.0).alias("lat"),
    ).repartition(16)
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        out = spatial_join(pts, polygons(spark), cell_size=0.5, strategy="shuffle", skew="aqe")
        got = sorted((r.pid, r.name) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
        ref = spatial_join(pts, polygons(spark), cell_size=0.5, strategy="broadcast")
        assert got == sorted((r.pid, r.name) for r in ref.collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_non_finite_points_match_nothing(spark):
    # (0, 0)'s cell lies inside the big square, so an unchecked NaN (cell 0) would match
    big = ring((-10, -10), (10, -10), (10, 10), (-10, 10))
    polys = spark.createDataFrame([("big", [big])], POLY_SCHEMA)
    pts = spark.createDataFrame(
        [("nan", float("nan"), 0.5), ("inf", float("inf"), 0.5), ("ninf", 0.5, float("-inf")), ("ok", 0.5, 0.5)],
        PT_SCHEMA,
    )
    for strategy in ("broadcast", "shuffle"):
        out = spatial_join(pts, polys, cell_size=1.0, strategy=strategy)
        assert [r.pid for r in out.collect()] == ["ok"]


def test_non_finite_polygon_is_left_out(spark):
    bad = ring((0, 0), (float("inf"), 0), (1, 1))
    nan = ring((0, 0), (float("nan"), 0), (1, 1))
    good = ring((0, 0), (4, 0), (4, 4), (0, 4))
    polys = spark.createDataFrame([("bad", [bad]), ("nan", [nan]), ("good", [good])], POLY_SCHEMA)
    pts = spark.createDataFrame([("a", 0.5, 0.2)], PT_SCHEMA)
    assert [(r.pid, r.name) for r in spatial_join(pts, polys).collect()] == [("a", "good")]


def test_polygon_with_a_null_vertex_is_left_out(spark):
    polys = spark.createDataFrame([("gap", [ring((0, 0), (4, 0), (None, 4), (0, 4))]), ("good", [ring((0, 0), (4, 0), (4, 4), (0, 4))])], POLY_SCHEMA)
    pts = spark.createDataFrame([("a", 0.5, 0.5)], PT_SCHEMA)
    assert [r.name for r in spatial_join(pts, polys).collect()] == ["good"]


def test_names_that_collide_in_any_case_or_again(spark):
    polys = spark.createDataFrame([("n", "c", "p", [ring((0, 0), (4, 0), (4, 4), (0, 4))])], T.StructType([T.StructField(c, T.StringType()) for c in ("NAME", "Community_name", "_polygon_0")] + [T.StructField("rings", RINGS)]))
    pts = spark.createDataFrame([("a", "b", "q", 1.0, 1.0)], "name string, community_NAME string, _fa_x string, lon double, lat double")
    out = spatial_join(pts, polys)
    assert out.columns[:3] == ["name", "community_NAME", "_fa_x"] and out.columns[-3:] == ["_polygon_0", "lon", "lat"]
    assert len({c.lower() for c in out.columns}) == 8
    row = out.first()
    assert sorted(v for v in row if isinstance(v, str)) == ["a", "b", "c", "n", "p", "q"]


def test_shared_borders_give_a_point_to_exactly_one_neighbour(spark):
    # points within rounding distance of random edges shared by two polygons in opposite directions
    r = random.Random(7)
    polys, pts = [], []
    for k in range(60):
        x, y = 10.0 * k, 0.0
        a, b = (x + r.uniform(3, 7), y + r.uniform(0, 1)), (x + r.uniform(3, 7), y + r.uniform(9, 10))
        polys.append((f"left{k}", [ring((x, y - 1), a, b, (x, y + 11))]))
        polys.append((f"right{k}", [ring((x + 10, y - 1), (x + 10, y + 11), b, a)]))
        for i in range(40):
            t = r.random()
            px = a[0] + t * (b[0] - a[0])
            pts.append((f"{k}-{i}", math.nextafter(px, r.choice([-1e9, 1e9])) if i % 2 else px, a[1] + t * (b[1] - a[1])))
    polygons_ = spark.createDataFrame(polys, POLY_SCHEMA)
    joined = spatial_join(spark.createDataFrame(pts, PT_SCHEMA), polygons_)
    seen = Counter(row.pid for row in joined.collect())
    # on an edge both leave the point out; otherwise exactly one has it
    assert max(seen.values()) == 1
    edges = {(row.a, row.b) for row in polygons_.select(F.explode(polygon_edges("rings", ordered=True)).alias("e")).select(F.struct("e.x1", "e.y1").alias("a"), F.struct("e.x2", "e.y2").alias("b")).collect()}
    for name, px, py in pts:
        if name not in seen:
            assert any((b.x2 - a.x1) * (py - a.y1) == (b.y2 - a.y1) * (px - a.x1) for a, b in edges)


def test_polygons_with_many_edges_keep_small_bands(spark):
    cells = 40
    star = [(math.cos(2 * math.pi * j / 600) * (3 + 0.3 * (j % 7)), math.sin(2 * math.pi * j / 600) * (3 + 0.3 * (j % 7))) for j in range(600)]
    polys = spark.createDataFrame([("star", [ring(*star)])], POLY_SCHEMA)
    pts = [(str(k), -6 + 12 * (k * 7919 % 1000) / 1000, -6 + 12 * (k * 104729 % 997) / 997) for k in range(3000)]
    expected = brute_join(pts, [("star", [star])])
    frame = spark.createDataFrame(pts, PT_SCHEMA)
    for kw in ({"strategy": "broadcast"}, {"strategy": "shuffle", "skew": "salt", "rows_per_task": 200}, {"strategy": "shuffle", "skew": "aqe"}):
        out, plan = spatial_join(frame, polys, cell_size=10 / cells, return_plan=True, **kw)
        assert {(r.pid, r.name) for r in out.collect()} == expected
    # a cell holds the edges of its row only, not the whole polygon
    assert plan.estimated_bytes < plan.cell_rows * 600 * 56 / 4


def test_hundreds_of_polygons_on_one_cell(spark):
    polys = spark.createDataFrame([(f"p{k}", [ring((0, 0), (1 + k / 1000, 0), (1, 1), (0, 1 + k / 1000))]) for k in range(400)], POLY_SCHEMA)
    pts = spark.createDataFrame([(str(k), 0.1 + k / 100, 0.2) for k in range(50)], PT_SCHEMA)
    out = spatial_join(pts, polys, cell_size=5.0, strategy="shuffle", skew="salt", rows_per_task=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "HashJoin" not in plan.split("SortMergeJoin")[0]
    assert out.count() == 50 * 400
