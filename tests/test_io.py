import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from fieldatlas import fixtures as fx
from fieldatlas.operators import nearest, sinks
from fieldatlas.operators.spatial import spatial_join
from fieldatlas.sources import documents as docsrc
from fieldatlas.sources import geojson

FEATURES = [
    {"type": "Feature", "properties": {"name": "A", "amenity": "restaurant"},
     "geometry": {"type": "Point", "coordinates": [8.81, 50.8]}},
    {"type": "Feature", "properties": {"name": None, "amenity": "restaurant"},
     "geometry": {"type": "Point", "coordinates": [8.7, 50.81]}},
    {"type": "Feature", "properties": {"name": "no geometry"}},
    {"type": "Feature", "properties": {"name": "null geometry"}, "geometry": None},
    {"type": "Feature", "properties": {"name": "short"}, "geometry": {"type": "Point", "coordinates": [1.0]}},
    {"type": "Feature", "properties": {"name": "area"},
     "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.mark.parametrize("root", ["array", "object"])
def test_geojson_roots_give_same_rows(spark, tmp_dir, root):
    doc = FEATURES if root == "array" else {"type": "FeatureCollection", "features": FEATURES}
    write(f"{tmp_dir}/in/f.geojson", "\n  " + json.dumps(doc))
    t = geojson.read_feature_table(spark, f"{tmp_dir}/in")
    rows = {r.name: r for r in t.collect()}
    assert len(t.collect()) == 6
    assert rows["A"].geometry_type == "Point" and (rows["A"].lon, rows["A"].lat) == (8.81, 50.8)
    assert rows["no geometry"].geometry_type is None
    assert rows["null geometry"].geometry_type is None
    assert rows["short"].lon is None  # coordinates of size 1 are not a position
    assert rows["area"].lon is None and rows["area"].geometry_type == "Polygon"
    pts = nearest.points_only(t).collect()
    assert sorted(r.name or "" for r in pts) == ["", "A", "short"]


def test_geojson_invalid_root_fails(spark, tmp_dir):
    write(f"{tmp_dir}/bad/f.geojson", '"just a string"')
    with pytest.raises(Exception, match="Invalid GeoJSON root"):
        geojson.read_features(spark, f"{tmp_dir}/bad").collect()


def test_geojson_lines_layout(spark, tmp_dir):
    text = "\n".join("\u001e" + json.dumps(f) for f in FEATURES) + "\n\n"
    write(f"{tmp_dir}/seq/f.geojsons", text)
    t = geojson.read_feature_table(spark, f"{tmp_dir}/seq", layout="lines")
    assert t.count() == 6


def test_declared_properties_schema(spark, tmp_dir):
    write(f"{tmp_dir}/p/f.geojson", json.dumps(FEATURES))
    t = geojson.read_feature_table(spark, f"{tmp_dir}/p", properties="name string")
    assert t.columns == ["name", "geometry_type", "lon", "lat"]


def test_polygons_from_geojson_feed_the_spatial_join(spark, tmp_dir):
    polys = [
        {"type": "Feature", "properties": {"community": "sq"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]],
                                                         [[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]]]}},
        {"type": "Feature", "properties": {"community": "multi"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 10], [11, 10], [11, 11], [10, 10]]],
                                                              [[[20, 20], [22, 20], [22, 22], [20, 22]]]]}},
        {"type": "Feature", "properties": {"community": "pt"},
         "geometry": {"type": "Point", "coordinates": [0, 0]}},
    ]
    write(f"{tmp_dir}/poly/f.geojson", json.dumps({"type": "FeatureCollection", "features": polys}))
    com = geojson.read_polygons(spark, f"{tmp_dir}/poly")
    assert com.columns == ["community", "rings"]
    assert com.count() == 2
    pts = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 10.8, 10.2), (4, 21.0, 21.0), (5, 15.0, 15.0)],
        "id long, lon double, lat double",
    )
    got = {(r.id, r.community) for r in spatial_join(pts, com).collect()}
    assert got == {(1, "sq"), (3, "multi"), (4, "multi")}


def test_feature_collection_writer_round_trip(spark, tmp_dir):
    feats = fx.place_features(spark, SF01)
    n = sinks.write_feature_collection(feats, f"{tmp_dir}/out", root="object", rows_per_file=400)
    assert n == 1500
    files = [f for d, _, fs in os.walk(f"{tmp_dir}/out") for f in fs if f.startswith("part-")]
    assert len(files) == 4
    t = geojson.read_feature_table(spark, f"{tmp_dir}/out")
    assert t.count() == 1500


def test_json_lines_blank_and_malformed(spark, tmp_dir):
    write(f"{tmp_dir}/ok/a.json", '{"a": 1}\n\n{"a": 2}\n   \n')
    assert docsrc.read_json_lines(spark, f"{tmp_dir}/ok", "a long").count() == 2
    write(f"{tmp_dir}/bad/a.json", '{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        docsrc.read_json_lines(spark, f"{tmp_dir}/bad", "a long").collect()
    assert docsrc.read_json_lines(spark, f"{tmp_dir}/bad", "a long", mode="PERMISSIVE").count() == 2


def test_overwrite_append_and_counts(spark, tmp_dir):
    docs = fx.flight_documents(spark, SF01)
    path = f"{tmp_dir}/docs"
    assert sinks.replace_collection(docs, path) == 700
    assert sinks.replace_collection(docs, path) == 700  # idempotent
    assert spark.read.parquet(path).count() == 700
    assert sinks.append_documents(docs, path) == 700
    assert spark.read.parquet(path).count() == 1400
    assert sinks.replace_collection(docs.limit(0), path) == 0
    empty = spark.read.parquet(path)
    assert empty.count() == 0 and empty.schema.simpleString() == docs.schema.simpleString()


def test_geojson_documents_shape(spark):
    df = spark.createDataFrame([(1, 8.0, 50.0, "x")], "id long, lon double, lat double, tag string")
    out = sinks.geojson_documents(df)
    assert out.columns == ["id", "tag", "geometry"]
    g = out.first().geometry
    assert g.type == "Point" and list(g.coordinates) == [8.0, 50.0]


def test_clustered_layout_pushes_box_filter(spark, tmp_dir):
    path = f"{tmp_dir}/occ"
    n = sinks.write_clustered(fx.occurrences(spark, SF01), path, partitions=4)
    assert n == 15000
    q = docsrc.scan(spark.read.parquet(path), F.col("lon").between(7.5, 8.5) & F.col("lat").between(48.0, 49.0))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lon), IsNotNull(lat), GreaterThanOrEqual(lon,7.5)" in plan
    assert q.count() == fx.occurrences(spark, SF01).where(
        F.col("lon").between(7.5, 8.5) & F.col("lat").between(48.0, 49.0)
    ).count()


def test_read_table_by_format(spark, tmp_dir):
    fx.occurrences(spark, SF01).write.mode("overwrite").orc(f"{tmp_dir}/orc")
    t = docsrc.read_table(spark, "orc", f"{tmp_dir}/orc")
    assert t.count() == 15000


def test_streaming_points_join_static_polygons(spark, tmp_dir):
    from fieldatlas.streaming import enrich_stream

    occ = fx.occurrences(spark, SF01)
    occ.write.mode("overwrite").parquet(f"{tmp_dir}/src")
    stream = spark.readStream.schema(occ.schema).parquet(f"{tmp_dir}/src")
    out = enrich_stream(stream, fx.communities(spark, SF01))
    q = (
        out.writeStream.format("memory").queryName("enriched_points")
        .option("checkpointLocation", f"{tmp_dir}/ckpt").start()
    )
    q.processAllAvailable()
    q.stop()
    assert spark.table("enriched_points").count() == 15656


def test_inferred_nested_properties(spark, tmp_dir):
    feats = [
        {"type": "Feature", "properties": {"name": "a", "meta": {"rank": 1, "tags": ["x"]}, "gone": None},
         "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}},
        {"type": "Feature", "properties": {"name": "b", "meta": {"rank": 2}},
         "geometry": {"type": "Point", "coordinates": [3.0, 4.0]}},
    ]
    write(f"{tmp_dir}/nested/f.geojson", json.dumps(feats))
    t = geojson.read_feature_table(spark, f"{tmp_dir}/nested")
    rows = {r.name: r for r in t.collect()}
    assert rows["a"].meta.rank == 1 and list(rows["a"].meta.tags) == ["x"]
    assert rows["b"].meta.tags is None and rows["a"].gone is None


def test_inferred_property_names_and_numbers(spark, tmp_dir):
    feats = [{"type": "Feature", "properties": {"a b": 1, "c.d": 2.5, "select": "x"},
              "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]
    write(f"{tmp_dir}/names/f.geojson", json.dumps(feats))
    t = geojson.read_feature_table(spark, f"{tmp_dir}/names")
    assert dict(t.dtypes)["c.d"] == "double" and dict(t.dtypes)["a b"] == "bigint"
    r = t.first()
    assert r["a b"] == 1 and r["c.d"] == 2.5 and r["select"] == "x"


@pytest.mark.parametrize("content", [
    '[{"type":"Feature","properties":{"a":1},"geometry":null}, {"type":"Fea',
    '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{}}',
    '{"type":"FeatureCollection"}',
    '{"type":"FeatureCollection","features":null}',
])
def test_damaged_collections_fail(spark, tmp_dir, content):
    write(f"{tmp_dir}/in/good.json", '[{"type":"Feature","properties":{"a":1},"geometry":null}]')
    assert geojson.read_features(spark, f"{tmp_dir}/in").count() == 1
    write(f"{tmp_dir}/in/bad.json", content)
    with pytest.raises(Exception, match="(?i)malformed|damaged|parse"):
        geojson.read_features(spark, f"{tmp_dir}/in").collect()


def test_empty_collections_are_legal(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.json", "[]")
    write(f"{tmp_dir}/in/b.json", '{"features":[]}')
    assert geojson.read_features(spark, f"{tmp_dir}/in").count() == 0


def test_properties_named_like_geometry_columns_survive(spark, tmp_dir):
    write(
        f"{tmp_dir}/in/a.json",
        '[{"type":"Feature","properties":{"lon":"L","LAT":"A","geometry_type":"g","property_lon":"own"},'
        '"geometry":{"type":"Point","coordinates":[1.5,2.5]}}]',
    )
    row = geojson.read_feature_table(spark, f"{tmp_dir}/in").first().asDict()
    assert (row["lon"], row["lat"], row["geometry_type"]) == (1.5, 2.5, "Point")
    assert sorted(v for k, v in row.items() if k.startswith("property_")) == ["A", "L", "g", "own"]


def test_every_geometry_is_kept_as_text_and_counted(spark, tmp_dir):
    write(
        f"{tmp_dir}/in/a.json",
        '[{"type":"Feature","properties":{"a":1},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}},'
        '{"type":"Feature","properties":{"a":2},"geometry":{"type":"Point","coordinates":[1.5,2.5]}},'
        '{"type":"Feature","properties":{"a":3},"geometry":null}]',
    )
    features = geojson.read_features(spark, f"{tmp_dir}/in")
    rows = {r.a: r for r in geojson.feature_columns(features, "a int", keep_geometry=True).collect()}
    assert json.loads(rows[1].geometry)["coordinates"] == [[[0, 0], [1, 0], [1, 1], [0, 0]]] and rows[1].lon is None
    assert json.loads(rows[2].geometry) == {"type": "Point", "coordinates": [1.5, 2.5]}
    assert rows[3].geometry in (None, "null")
    counts = geojson.point_counts(features).first()
    assert (counts.points, counts.rejected) == (1, 2)


def test_point_documents_without_a_position(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0)], "id int, lon double, lat double")
    rows = {r.id: r.geometry for r in sinks.geojson_documents(df).collect()}
    assert rows[1].coordinates == [1.0, 2.0] and rows[2] is None


def _scanned(df):
    """Rows that came out of the plan's file scans, once it has run."""
    df.collect()
    plan, todo, total = df._jdf.queryExecution().executedPlan(), [], 0
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
    return total


def test_clustered_layout_prunes_rows(spark, tmp_dir):
    points = spark.range(20000).select(
        "id", ((F.col("id") * 7919 % 9000) / 1000.0 + 6).alias("lon"), ((F.col("id") * 104729 % 8000) / 1000.0 + 47).alias("lat")
    )
    assert sinks.write_clustered(points, f"{tmp_dir}/t", rows_per_file=1500) == 20000
    stored = spark.read.parquet(f"{tmp_dir}/t")
    assert len(stored.inputFiles()) > 8
    box = stored.where(F.col("lon").between(7.5, 8.0) & F.col("lat").between(48.0, 48.5))
    assert box.count() == points.where(F.col("lon").between(7.5, 8.0) & F.col("lat").between(48.0, 48.5)).count()
    assert 0 < _scanned(box) < 20000 / 3


def test_writers_run_their_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(500).select(F.col("id").cast("string").alias("value"), F.rand(1).alias("lon"), F.rand(2).alias("lat"))
    counted = df.mapInArrow(count, df.schema)
    sinks.write_clustered(counted, f"{tmp_dir}/a", rows_per_file=100)
    assert seen.value == 500
    assert sinks.write_feature_collection(counted, f"{tmp_dir}/b", rows_per_file=100) == 500
    assert seen.value == 1000


def test_failed_replace_leaves_the_collection(spark, tmp_dir):
    import os

    import pytest
    from pyspark.sql import functions as F

    from fieldatlas.operators.sinks import replace_collection, write_clustered, write_documents

    rows = spark.range(100).withColumn("lon", F.col("id") / 10).withColumn("lat", F.lit(1.0))
    broken = rows.withColumn("lat", F.when(F.col("id") == 99, F.raise_error(F.lit("damaged")).cast("double")).otherwise(F.lit(2.0)))
    for fmt in ("parquet", "json"):
        path = f"{tmp_dir}/replace-{fmt}"
        assert replace_collection(rows, path, fmt) == 100
        for bad in (lambda: replace_collection(broken, path, fmt), lambda: write_documents(broken, path, fmt, partition_by=["id"])):
            with pytest.raises(Exception, match="damaged"):
                bad()
        assert sorted(r.id for r in spark.read.format(fmt).load(path).collect()) == list(range(100))
        # From a query on itself, and to nothing.
        assert replace_collection(spark.read.format(fmt).load(path).where("id >= 40"), path, fmt) == 60
        assert spark.read.format(fmt).load(path).count() == 60
        assert sorted(n for n in os.listdir(tmp_dir) if fmt in n) == [f"replace-{fmt}"]  # nothing staged is left
    path = f"{tmp_dir}/clustered"
    write_clustered(rows, path)
    assert write_clustered(spark.read.parquet(path).where("id < 7"), path) == 7 and spark.read.parquet(path).count() == 7
    empty = spark.read.parquet(path).limit(0)
    assert replace_collection(empty, path) == 0 and spark.read.parquet(path).columns == rows.columns


def test_text_behind_the_root_fails(spark, tmp_dir):
    import pytest

    from fieldatlas.sources.geojson import read_features

    one = '{"type":"Feature","properties":{"a":"\\\\\\"]}"},"geometry":null}'
    whole = {"array": f"[{one}]", "object": f'{{"type":"FeatureCollection","features":[{one}],"more":[1]}}'}
    good = [whole["array"], whole["object"], f"﻿ \n{whole['array']} \n", f" {whole['object']}\n\n", "[]", '{"features":[]}']
    bad = [whole["array"] * 2, whole["object"] + whole["array"], whole["array"] + " x", whole["object"] + "}", whole["array"] + "}", whole["array"] + '},{"root":[]', whole["array"][:-1], '{"features":null}']
    for k, text in enumerate(good + bad):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmp_dir}/{k}")
        features = read_features(spark, f"{tmp_dir}/{k}")
        if k < len(good):
            assert features.count() == (0 if k > 3 else 1)
        else:
            with pytest.raises(Exception):  # noqa: B017
                features.collect()
