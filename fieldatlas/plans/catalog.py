"""The registered queries and their independent SQL oracles.

Each query takes ``(spark, sf_dir)``, derives its inputs from the tables in
``sf_dir`` (``fieldatlas.fixtures``) and returns a DataFrame. The oracle is
ANSI SQL over the same tables, written without any of the library's
machinery (the spatial predicate is brute-force arithmetic over all
point-edge pairs), and must give the same rows. Queries that write go to the
shared folder of the session (``spark.checkpoint.dir``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldatlas import fixtures as fx
from fieldatlas.functions.geo import geometry_from_geojson
from fieldatlas.functions.sets import set_from_list
from fieldatlas.operators import diversity, documents, nearest, similarity, sinks
from fieldatlas.operators.shapes import shape_join
from fieldatlas.operators.spatial import spatial_join
from fieldatlas.session import default_parallelism, materialize, scratch_path
from fieldatlas.sources import documents as docsrc
from fieldatlas.sources import geojson
from fieldatlas.sources.shapefile import read_shapefile, read_shapes

# Fixed values used by the queries (the reference hard-codes its own).
ANCHOR_PATTERN = "(?i)customer#0000001.*"
AMENITY = "restaurant"
AIRPORT = "NATION_7"
MIN_CANCELLED = 30
TOP_K = 10
LAYOUT_FILES = 16
BOX = (7.5, 48.0, 8.5, 49.0)  # min lon, min lat, max lon, max lat

FLIGHT_SCHEMA = T.StructType(
    [
        T.StructField("carrier", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("airport", T.StructType([T.StructField("code", T.StringType())])),
        T.StructField("year", T.LongType()),
        T.StructField(
            "statistics",
            T.StructType(
                [
                    T.StructField(
                        "flights",
                        T.StructType(
                            [
                                T.StructField("total", T.LongType()),
                                T.StructField("cancelled", T.LongType()),
                            ]
                        ),
                    )
                ]
            ),
        ),
    ]
)

FLIGHT_FIELDS = {
    "carrier_name": "carrier.name",
    "airport_code": "airport.code",
    "year": "year",
    "total": "statistics.flights.total",
    "cancelled": "statistics.flights.cancelled",
}


# --------------------------------------------------------------------------- inputs


def _spread(spark: SparkSession) -> int:
    # The driver's tables are single Parquet row groups (one scan task each).
    return default_parallelism(spark)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial_join(
        fx.occurrences(spark, sf_dir), fx.communities(spark, sf_dir),
        min_partitions=_spread(spark),
    )


def _loaded_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.points_only(fx.places(spark, sf_dir))


# --------------------------------------------------------------------------- spatial


def q_diverse_communities(spark, sf_dir):
    return diversity.most_diverse(_joined(spark, sf_dir), TOP_K)


def q_species_sketches_appended(spark, sf_dir):
    """Distinct counts kept under append: the occurrences come in four batches, whose
    sketches are appended to one table; estimates from it stand beside the exact counts."""
    path = scratch_path(spark, "species-sketches")
    stored = materialize(_joined(spark, sf_dir).select("occ_id", "community", "species"), "species-batches")
    for batch in range(4):
        rows = stored.where(F.col("occ_id") % 4 == batch)
        sinks.append_documents(diversity.distinct_sketches(rows), path)
    kept = diversity.richness_from_sketches(spark.read.parquet(path), count_col="estimate")
    exact = diversity.richness(stored).select(F.col("community").alias("name"), "num_species")
    close = F.abs(F.col("estimate") - F.col("num_species")) <= 0.03 * F.col("num_species")
    return exact.join(kept, F.col("name").eqNullSafe(F.col("community"))).select("community", "num_species", close.alias("close"))


def q_spatial_join_rows(spark, sf_dir):
    return _joined(spark, sf_dir)


def q_spatial_join_counts(spark, sf_dir):
    return _joined(spark, sf_dir).groupBy("community").agg(
        F.count(F.lit(1)).alias("n_occurrences")
    )


def q_spatial_join_colliding_names(spark, sf_dir):
    # NAME collides with name, and its first prefixed form with community_name.
    pts = fx.occurrences(spark, sf_dir).select(
        "occ_id", "species", F.concat(F.lit("occ_"), F.col("occ_id").cast("string")).alias("name"),
        F.lit("x").alias("community_name"), "lon", "lat",
    )
    return spatial_join(
        pts, fx.communities(spark, sf_dir, name_col="NAME"), min_partitions=_spread(spark)
    )


def q_spatial_join_detailed(spark, sf_dir):
    joined = spatial_join(
        fx.occurrences(spark, sf_dir), fx.detailed_communities(spark, sf_dir),
        min_partitions=_spread(spark),
    )
    return joined.groupBy("community").agg(F.count(F.lit(1)).alias("n_occurrences"))


def q_tiling_cover(spark, sf_dir):
    joined = spatial_join(
        fx.occurrences(spark, sf_dir), fx.tiles(spark, sf_dir), min_partitions=_spread(spark)
    )
    per_point = joined.groupBy("occ_id").agg(F.count(F.lit(1)).alias("n_tiles"))
    return per_point.groupBy("n_tiles").agg(F.count(F.lit(1)).alias("n_points"))


def q_boundaries_shapefile_join(spark, sf_dir):
    path = scratch_path(spark, "communities-shapefile")
    fx.write_community_shapefile(spark, sf_dir, path)
    joined = spatial_join(
        fx.occurrences(spark, sf_dir), read_shapefile(spark, path), min_partitions=_spread(spark)
    )
    return joined.groupBy("NAME", "AREA_NO").agg(F.count(F.lit(1)).alias("n_occurrences"))


def q_species_set_algebra_null_group(spark, sf_dir):
    unnamed = F.when(F.col("community") != "NATION_7", F.col("community"))
    return similarity.pair_overlaps(_joined(spark, sf_dir).withColumn("community", unnamed), TOP_K)


def q_order_flag_sets(spark, sf_dir):
    # An order has at most a handful of lines, so its list is bounded.
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    lists = fx.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.coalesce(flag, F.lit("-"))).alias("flags")
    )
    some = F.transform("flags", lambda f: F.nullif(f, F.lit("-")))
    return lists.select(
        "l_orderkey", F.array_join(F.array_sort(set_from_list(some)), ",").alias("flag_set")
    )


def q_similar_communities_top10(spark, sf_dir):
    return similarity.most_similar(_joined(spark, sf_dir), TOP_K, TOP_K)


def q_species_set_algebra(spark, sf_dir):
    return similarity.pair_overlaps(_joined(spark, sf_dir), TOP_K)


def q_community_species(spark, sf_dir):
    return diversity.distinct_members(_joined(spark, sf_dir))


def q_species_distinct_with_nulls(spark, sf_dir):
    return diversity.null_profile(_joined(spark, sf_dir))


# --------------------------------------------------------------------------- places


def q_nearest_places(spark, sf_dir):
    pts = _loaded_points(spark, sf_dir)
    anchor = nearest.find_first(pts, ANCHOR_PATTERN)
    restaurants = pts.where(F.col("amenity") == AMENITY)
    return nearest.k_nearest(restaurants, anchor, TOP_K)


def q_nearest_places_clustered(spark, sf_dir):
    # The loaded points stored in the clustered layout (the index's role),
    # then the near query searches outward from the anchor.
    path = scratch_path(spark, "places-clustered")
    sinks.write_clustered(_loaded_points(spark, sf_dir), path, partitions=LAYOUT_FILES)
    pts = spark.read.parquet(path)
    anchor = nearest.find_first(pts, ANCHOR_PATTERN)
    restaurants = pts.where(F.col("amenity") == AMENITY)
    return nearest.k_nearest_in_layout(restaurants, anchor, TOP_K)


def q_place_lookup_regex(spark, sf_dir):
    return nearest.find_first(_loaded_points(spark, sf_dir), ANCHOR_PATTERN).select(
        "place_id", "name", "lon", "lat"
    )


def q_place_name_default(spark, sf_dir):
    pts = _loaded_points(spark, sf_dir).where(F.col("amenity") == AMENITY)
    return pts.select("place_id", nearest.name_or_default().alias("name"))


# --------------------------------------------------------------------------- documents


def q_flights_filter_sort(spark, sf_dir):
    docs = fx.flight_documents(spark, sf_dir)
    return documents.cancelled_flights(docs, AIRPORT, MIN_CANCELLED, extra={"year": "year"})


def q_flights_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "flights-jsonl")
    sinks.replace_collection(fx.flight_documents(spark, sf_dir), path, fmt="json")
    back = docsrc.read_json_lines(spark, path, FLIGHT_SCHEMA)
    return documents.flatten(back, FLIGHT_FIELDS)


def q_documents_append(spark, sf_dir):
    path = scratch_path(spark, "flights-append")
    docs = fx.flight_documents(spark, sf_dir)
    sinks.replace_collection(docs, path)
    sinks.append_documents(docs, path)
    return documents.flatten(docsrc.scan(spark.read.parquet(path)), FLIGHT_FIELDS)


def q_documents_replace_failed(spark, sf_dir):
    """A load that breaks on its last documents leaves the collection as it was."""
    path = scratch_path(spark, "replace-failed")
    sinks.replace_collection(fx.flight_documents(spark, sf_dir), path)
    year = F.when(F.col("year") >= 1995, F.raise_error(F.lit("damaged document")).cast("long")).otherwise(F.col("year"))
    try:
        sinks.replace_collection(fx.flight_documents(spark, sf_dir).withColumn("year", year), path)
        kept = False
    except PySparkException:
        kept = True
    return documents.flatten(spark.read.parquet(path), FLIGHT_FIELDS).withColumn("kept", F.lit(kept))


def q_documents_replace_self(spark, sf_dir):
    """A collection replaced by a query on itself."""
    path = scratch_path(spark, "replace-self")
    sinks.replace_collection(fx.flight_documents(spark, sf_dir), path)
    stored = spark.read.parquet(path)
    sinks.replace_collection(stored.where("statistics.flights.cancelled > 5"), path)
    return documents.flatten(spark.read.parquet(path), FLIGHT_FIELDS)


def q_documents_export_json(spark, sf_dir):
    text = documents.to_json_text(fx.flight_documents(spark, sf_dir))
    return documents.flatten(documents.from_json_text(text, FLIGHT_SCHEMA), FLIGHT_FIELDS)


# --------------------------------------------------------------------------- GeoJSON


def _geojson_points(spark, sf_dir, root):
    path = scratch_path(spark, f"places-{root}")
    sinks.write_feature_collection(fx.place_features(spark, sf_dir), path, root=root)
    table = geojson.read_feature_table(spark, path)
    return nearest.points_only(table).select("place_id", "name", "amenity", "lon", "lat")


def q_geojson_array_root(spark, sf_dir):
    return _geojson_points(spark, sf_dir, "array")


def q_geojson_object_root(spark, sf_dir):
    return _geojson_points(spark, sf_dir, "object")


def q_geojson_lines(spark, sf_dir):
    path = scratch_path(spark, "places-lines")
    sinks.write_feature_lines(fx.place_features(spark, sf_dir), path)
    table = geojson.read_feature_table(spark, path, layout="lines")
    return nearest.points_only(table).select("place_id", "name", "amenity", "lon", "lat")


def q_boundaries_geojson_join(spark, sf_dir):
    path = scratch_path(spark, "communities-geojson")
    sinks.write_feature_collection(fx.community_features(spark, sf_dir), path, root="object")
    com = geojson.read_polygons(spark, path, properties="community string")
    joined = spatial_join(fx.occurrences(spark, sf_dir), com, min_partitions=_spread(spark))
    return joined.groupBy("community").agg(F.count(F.lit(1)).alias("n_occurrences"))


def q_spatial_join_shuffled(spark, sf_dir):
    return spatial_join(
        fx.occurrences(spark, sf_dir), fx.communities(spark, sf_dir),
        strategy="shuffle", min_partitions=_spread(spark),
    )


def q_shapes_in_communities(spark, sf_dir):
    path = scratch_path(spark, "shape-features")
    sinks.write_feature_lines(fx.shape_features(spark, sf_dir), path)
    shapes = geojson.shape_columns(geojson.read_features(spark, path, layout="lines"), "shape_id bigint")
    return shape_join(shapes, fx.holed_communities(spark, sf_dir)).select("shape_id", "kind", "community")


def q_features_flatten(spark, sf_dir):
    path = scratch_path(spark, "places-flatten")
    sinks.write_feature_collection(fx.place_features(spark, sf_dir), path, root="object")
    return geojson.read_feature_table(
        spark, path, properties="place_id bigint, name string, amenity string"
    )


def q_geometry_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "places-geometry")
    sinks.write_feature_lines(fx.place_features(spark, sf_dir), path)
    features = geojson.read_features(spark, path, layout="lines")
    flat = geojson.feature_columns(features, "place_id bigint", keep_geometry=True)
    parsed = flat.select("place_id", geometry_from_geojson("geometry").alias("g"))
    return parsed.select(
        "place_id", F.col("g.type").alias("geometry_type"),
        F.col("g.coordinates")[0].alias("lon"), F.col("g.coordinates")[1].alias("lat"),
    )


def q_rejected_features(spark, sf_dir):
    path = scratch_path(spark, "places-rejected")
    sinks.write_feature_collection(fx.place_features(spark, sf_dir), path, root="array")
    return geojson.point_counts(geojson.read_features(spark, path))


def q_shapefile_families(spark, sf_dir):
    path = scratch_path(spark, "shapefile-families")
    fx.write_family_shapefiles(spark, sf_dir, path)
    last = F.element_at(F.element_at("parts", -1), -1)
    return read_shapes(spark, path).select(
        "NAME", "kind", F.size("parts").cast("long").alias("n_parts"), F.size(F.flatten("parts")).cast("long").alias("n_positions"),
        F.col("parts")[0][0]["x"].alias("first_x"), last["y"].alias("last_y"),
    )


def q_documents_null_position(spark, sf_dir):
    places = fx.places(spark, sf_dir).select(
        "place_id", F.when(F.col("place_id") % 7 != 0, F.col("lon")).alias("lon"), "lat"
    )
    return sinks.geojson_documents(places).select(
        "place_id", F.col("geometry").isNotNull().alias("has_geometry"),
        F.col("geometry.coordinates")[0].alias("lon"),
    )


def q_geojson_documents(spark, sf_dir):
    path = scratch_path(spark, "joined-documents")
    docs = sinks.geojson_documents(_joined(spark, sf_dir))
    sinks.replace_collection(docs, path, fmt="json")
    schema = T.StructType(
        [
            T.StructField("occ_id", T.LongType()),
            T.StructField("species", T.StringType()),
            T.StructField("community", T.StringType()),
            T.StructField("geometry", T.StructType([
                T.StructField("type", T.StringType()),
                T.StructField("coordinates", T.ArrayType(T.DoubleType())),
            ])),
        ]
    )
    back = docsrc.read_json_lines(spark, path, schema)
    return back.select(
        "occ_id", "species", "community",
        F.col("geometry.type").alias("geometry_type"),
        F.col("geometry.coordinates")[0].alias("lon"),
        F.col("geometry.coordinates")[1].alias("lat"),
    )


def q_write_count(spark, sf_dir):
    path = scratch_path(spark, "joined-count")
    written = sinks.replace_collection(_joined(spark, sf_dir), path)
    return spark.read.parquet(path).agg(
        F.lit(written).cast("long").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read"),
    )


def q_clustered_scan(spark, sf_dir):
    path = scratch_path(spark, "occurrences-clustered")
    sinks.write_clustered(fx.occurrences(spark, sf_dir), path, partitions=LAYOUT_FILES)
    x0, y0, x1, y1 = BOX
    return docsrc.scan(
        spark.read.parquet(path),
        F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1),
    )


def q_boundaries_edges(spark, sf_dir):
    from fieldatlas.functions.geo import polygon_edges

    c = fx.communities(spark, sf_dir)
    return c.select("community", F.posexplode(polygon_edges("rings")).alias("i", "e")).select(
        "community",
        F.col("i").cast("long").alias("i"),
        "e.x1", "e.y1", "e.x2", "e.y2",
    )


def q_table_source_options(spark, sf_dir):
    path = scratch_path(spark, "joined-json")
    sinks.replace_collection(_joined(spark, sf_dir), path, fmt="json")
    stored = docsrc.read_table(
        spark, "json", path, options={"mode": "FAILFAST"},
        schema="occ_id bigint, species string, community string, lon double, lat double",
    )
    return diversity.most_diverse(stored, TOP_K)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "diverse_communities": q_diverse_communities,
    "species_sketches_appended": q_species_sketches_appended,
    "spatial_join_rows": q_spatial_join_rows,
    "spatial_join_counts": q_spatial_join_counts,
    "spatial_join_colliding_names": q_spatial_join_colliding_names,
    "similar_communities_top10": q_similar_communities_top10,
    "species_set_algebra": q_species_set_algebra,
    "community_species": q_community_species,
    "species_distinct_with_nulls": q_species_distinct_with_nulls,
    "nearest_places": q_nearest_places,
    "nearest_places_clustered": q_nearest_places_clustered,
    "place_lookup_regex": q_place_lookup_regex,
    "place_name_default": q_place_name_default,
    "flights_filter_sort": q_flights_filter_sort,
    "flights_jsonl_roundtrip": q_flights_jsonl_roundtrip,
    "documents_append": q_documents_append,
    "documents_export_json": q_documents_export_json,
    "geojson_array_root": q_geojson_array_root,
    "geojson_object_root": q_geojson_object_root,
    "features_flatten": q_features_flatten,
    "geojson_lines": q_geojson_lines,
    "boundaries_geojson_join": q_boundaries_geojson_join,
    "spatial_join_shuffled": q_spatial_join_shuffled,
    "geojson_documents": q_geojson_documents,
    "write_count": q_write_count,
    "clustered_scan": q_clustered_scan,
    "boundaries_edges": q_boundaries_edges,
    "table_source_options": q_table_source_options,
    "spatial_join_detailed": q_spatial_join_detailed,
    "tiling_cover": q_tiling_cover,
    "boundaries_shapefile_join": q_boundaries_shapefile_join,
    "species_set_algebra_null_group": q_species_set_algebra_null_group,
    "order_flag_sets": q_order_flag_sets,
    "geometry_text_roundtrip": q_geometry_text_roundtrip,
    "rejected_features": q_rejected_features,
    "documents_null_position": q_documents_null_position,
    "shapes_in_communities": q_shapes_in_communities,
    "shapefile_families": q_shapefile_families,
    "documents_replace_failed": q_documents_replace_failed,
    "documents_replace_self": q_documents_replace_self,
}


# --------------------------------------------------------------------------- oracle SQL

_OCC = """occurrences AS (
  SELECT o_orderkey AS occ_id,
         CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE concat('sp_', o_custkey) END AS species,
         6e0  + ((o_orderkey * 7919)   % 9000) / 1e3 AS lon,
         47e0 + ((o_orderkey * 104729) % 8000) / 1e3 AS lat
  FROM orders)"""

_EDGES = """community_edges AS (
  SELECT n_name AS community, i,
         6.90037e0  + 1.8e0 * (n_nationkey % 5)        + ax AS x1,
         47.80037e0 + 1.6e0 * floor(n_nationkey / 5e0) + ay AS y1,
         6.90037e0  + 1.8e0 * (n_nationkey % 5)        + px AS x2,
         47.80037e0 + 1.6e0 * floor(n_nationkey / 5e0) + py AS y2
  FROM nation CROSS JOIN (VALUES
         (0, -1.1e0, -0.9e0,  1.1e0, -0.9e0),
         (1,  1.1e0, -0.9e0,  1.1e0,  0.9e0),
         (2,  1.1e0,  0.9e0,  0.0e0,  0.2e0),
         (3,  0.0e0,  0.2e0, -1.1e0,  0.9e0),
         (4, -1.1e0,  0.9e0, -1.1e0, -0.9e0)) AS o(i, ax, ay, px, py))"""

_JOINED = """joined AS (
  SELECT occ_id, max(species) AS species, community, max(lon) AS lon, max(lat) AS lat
  FROM occurrences, community_edges
  GROUP BY occ_id, community
  HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat)
                   AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
     AND sum(CASE WHEN (x2 - x1) * (lat - y1) = (y2 - y1) * (lon - x1)
                   AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
                   AND lat BETWEEN least(y1, y2) AND greatest(y1, y2) THEN 1 ELSE 0 END) = 0)"""

_PLACES = """places AS (
  SELECT c_custkey AS place_id,
         CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS name,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'restaurant' ELSE lower(c_mktsegment) END AS amenity,
         CASE WHEN c_custkey % 20 = 1 THEN 'LineString'
              WHEN c_custkey % 20 = 2 THEN NULL ELSE 'Point' END AS geometry_type,
         6e0  + ((c_custkey * 7919)   % 9000) / 1e3 AS lon,
         47e0 + ((c_custkey * 104729) % 8000) / 1e3 AS lat
  FROM customer),
pts AS (SELECT * FROM places WHERE geometry_type = 'Point')"""

_FLIGHTS = """flights AS (
  SELECT s_name AS carrier_name, n_name AS airport_code, CAST(year(l_shipdate) AS BIGINT) AS year,
         CAST(count(*) AS BIGINT) AS total,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS cancelled
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY s_name, n_name, year(l_shipdate))"""

_SPATIAL = f"WITH {_OCC},\n{_EDGES},\n{_JOINED}\n"

_TOP_DIVERSE = """SELECT CAST(rank AS BIGINT) AS rank, community, num_species FROM (
  SELECT community, count(DISTINCT species) AS num_species,
         row_number() OVER (ORDER BY count(DISTINCT species) DESC, community) AS rank
  FROM joined GROUP BY community) t
WHERE rank <= 10"""

_PAIRS = """, rich AS (SELECT community, count(DISTINCT species) AS n FROM joined GROUP BY community),
best AS (SELECT community, n FROM rich ORDER BY n DESC, community NULLS LAST LIMIT 10),
top AS (SELECT community, n, row_number() OVER (ORDER BY community NULLS LAST) AS pos FROM best),
mem AS (SELECT DISTINCT t.pos, j.species FROM joined j JOIN top t ON j.community IS NOT DISTINCT FROM t.community
        WHERE j.species IS NOT NULL),
inter AS (SELECT a.pos AS p1, b.pos AS p2, count(*) AS n_inter
          FROM mem a JOIN mem b ON a.species = b.species AND a.pos < b.pos
          GROUP BY a.pos, b.pos),
pairs AS (SELECT a.community AS community_1, b.community AS community_2, a.n AS n1, b.n AS n2,
                 CAST(coalesce(i.n_inter, 0) AS BIGINT) AS n_inter
          FROM top a JOIN top b ON a.pos < b.pos
          LEFT JOIN inter i ON i.p1 = a.pos AND i.p2 = b.pos),
scored AS (SELECT community_1, community_2, n1, n2, n_inter, n1 + n2 - n_inter AS n_union,
                  CASE WHEN n1 + n2 - n_inter = 0 THEN 0e0
                       ELSE CAST(n_inter AS DOUBLE) / CAST(n1 + n2 - n_inter AS DOUBLE) END AS similarity
           FROM pairs)
"""

_DETAILED = """community_edges AS (
  WITH v AS (
    SELECT n_name AS community, n_nationkey AS k, j,
           6.90037e0 + 1.8e0 * (n_nationkey % 5)
             + (0.9e0 + 0.0005e0 * ((j * 193 + n_nationkey * 37) % 200)) * cos(j * 6.283185307179586e0 / 512) AS x,
           47.80037e0 + 1.6e0 * floor(n_nationkey / 5e0)
             + (0.9e0 + 0.0005e0 * ((j * 193 + n_nationkey * 37) % 200)) * sin(j * 6.283185307179586e0 / 512) AS y
    FROM nation CROSS JOIN range(512) r(j))
  SELECT a.community, a.j AS i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM v a JOIN v b ON a.k = b.k AND b.j = (a.j + 1) % 512)"""

_TILES = """community_edges AS (
  WITH c AS (
    SELECT n_name AS community, q, n_nationkey % 5 + di AS i, CAST(floor(n_nationkey / 5e0) AS INT) + dj AS j
    FROM nation CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1)) AS o(q, di, dj)
  ), v AS (
    SELECT community, q, 6e0 + 1.8e0 * i + ((37 * i + 91 * j) % 17) / 23e0 - 0.4e0 AS x,
           47e0 + 1.6e0 * j + ((53 * i + 29 * j) % 19) / 29e0 - 0.3e0 AS y FROM c)
  SELECT a.community, a.q AS i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM v a JOIN v b ON a.community = b.community AND b.q = (a.q + 1) % 4)"""

_HAVERSINE = """6371000e0 * (2 * atan2(sqrt(least(1e0, a)), sqrt(1e0 - least(1e0, a))))"""

ORACLE_SQL: dict[str, str] = {
    "diverse_communities": _SPATIAL + _TOP_DIVERSE,
    "spatial_join_rows": _SPATIAL + "SELECT occ_id, species, community, lon, lat FROM joined",
    "spatial_join_counts": _SPATIAL
    + "SELECT community, count(*) AS n_occurrences FROM joined GROUP BY community",
    "spatial_join_colliding_names": _SPATIAL
    + "SELECT occ_id, species, concat('occ_', occ_id) AS name, 'x' AS community_name, "
    "community AS community_community_NAME, lon, lat FROM joined",
    "similar_communities_top10": _SPATIAL
    + _PAIRS
    + """SELECT CAST(rank AS BIGINT) AS rank, community_1, community_2, similarity FROM (
  SELECT community_1, community_2, similarity,
         row_number() OVER (ORDER BY similarity DESC, community_1, community_2) AS rank
  FROM scored) t WHERE rank <= 10""",
    "species_set_algebra": _SPATIAL
    + _PAIRS
    + "SELECT community_1, community_2, n1, n2, n_inter, n_union, similarity FROM scored",
    "community_species": _SPATIAL
    + "SELECT DISTINCT community, species FROM joined WHERE species IS NOT NULL",
    "species_distinct_with_nulls": _SPATIAL
    + """SELECT community, count(*) AS n_rows, count(DISTINCT species) AS n_distinct,
       CAST(sum(CASE WHEN species IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null
FROM joined GROUP BY community""",
    "nearest_places": f"""WITH {_PLACES},
anchor AS (SELECT lon, lat FROM pts WHERE regexp_matches(name, '(?i)customer#0000001.*')
           ORDER BY name, lon, lat LIMIT 1),
terms AS (SELECT p.place_id, coalesce(p.name, 'Unnamed Restaurant') AS name,
                 sin(radians(p.lat - an.lat) / 2) * sin(radians(p.lat - an.lat) / 2)
                 + cos(radians(an.lat)) * cos(radians(p.lat))
                   * sin(radians(p.lon - an.lon) / 2) * sin(radians(p.lon - an.lon) / 2) AS a
          FROM pts p, anchor an
          WHERE p.amenity = 'restaurant' AND p.lon IS NOT NULL AND p.lat IS NOT NULL),
d AS (SELECT place_id, name, round({_HAVERSINE}, 3) AS distance_m FROM terms)
SELECT CAST(rank AS BIGINT) AS rank, place_id, name, distance_m FROM (
  SELECT place_id, name, distance_m,
         row_number() OVER (ORDER BY distance_m, name, place_id) AS rank FROM d) t
WHERE rank <= 10""",
    "place_lookup_regex": f"""WITH {_PLACES}
SELECT place_id, name, lon, lat FROM pts WHERE regexp_matches(name, '(?i)customer#0000001.*')
ORDER BY name, lon, lat LIMIT 1""",
    "place_name_default": f"""WITH {_PLACES}
SELECT place_id, coalesce(name, 'Unnamed Restaurant') AS name FROM pts WHERE amenity = 'restaurant'""",
    "flights_filter_sort": f"""WITH {_FLIGHTS}
SELECT CAST(row_number() OVER (ORDER BY carrier_name, cancelled DESC, year) AS BIGINT) AS rank,
       carrier_name, airport_code, cancelled, year
FROM flights WHERE cancelled > 30 AND airport_code = 'NATION_7'""",
    "flights_jsonl_roundtrip": f"WITH {_FLIGHTS}\n"
    "SELECT carrier_name, airport_code, year, total, cancelled FROM flights",
    "documents_append": f"WITH {_FLIGHTS}\n"
    "SELECT carrier_name, airport_code, year, total, cancelled FROM flights\n"
    "UNION ALL\nSELECT carrier_name, airport_code, year, total, cancelled FROM flights",
    "documents_export_json": f"WITH {_FLIGHTS}\n"
    "SELECT carrier_name, airport_code, year, total, cancelled FROM flights",
    "geojson_array_root": f"WITH {_PLACES}\nSELECT place_id, name, amenity, lon, lat FROM pts",
    "geojson_object_root": f"WITH {_PLACES}\nSELECT place_id, name, amenity, lon, lat FROM pts",
    "features_flatten": f"""WITH {_PLACES}
SELECT place_id, name, amenity, geometry_type,
       CASE WHEN geometry_type = 'Point' THEN lon END AS lon,
       CASE WHEN geometry_type = 'Point' THEN lat END AS lat
FROM places""",
    "geojson_lines": f"WITH {_PLACES}\nSELECT place_id, name, amenity, lon, lat FROM pts",
    "boundaries_geojson_join": _SPATIAL
    + "SELECT community, count(*) AS n_occurrences FROM joined GROUP BY community",
    "spatial_join_shuffled": _SPATIAL + "SELECT occ_id, species, community, lon, lat FROM joined",
    "geojson_documents": _SPATIAL
    + "SELECT occ_id, species, community, 'Point' AS geometry_type, lon, lat FROM joined",
    "write_count": _SPATIAL
    + "SELECT count(*) AS rows_written, count(*) AS rows_read FROM joined",
    "clustered_scan": f"""WITH {_OCC}
SELECT occ_id, species, lon, lat FROM occurrences
WHERE lon BETWEEN 7.5e0 AND 8.5e0 AND lat BETWEEN 48e0 AND 49e0""",
    "boundaries_edges": f"WITH {_EDGES}\n"
    "SELECT community, CAST(i AS BIGINT) AS i, x1, y1, x2, y2 FROM community_edges",
    "table_source_options": _SPATIAL + _TOP_DIVERSE,
}
ORACLE_SQL["spatial_join_detailed"] = (
    f"WITH {_OCC},\n{_DETAILED},\n{_JOINED}\n"
    "SELECT community, count(*) AS n_occurrences FROM joined GROUP BY community"
)
ORACLE_SQL["tiling_cover"] = (
    f"WITH {_OCC},\n{_TILES},\n{_JOINED}\n"
    "SELECT n_tiles, count(*) AS n_points FROM (SELECT occ_id, count(*) AS n_tiles FROM joined GROUP BY occ_id) "
    "GROUP BY n_tiles"
)
ORACLE_SQL["boundaries_shapefile_join"] = (
    _SPATIAL
    + """, numbered AS (SELECT n_name, row_number() OVER (ORDER BY n_name) AS no FROM nation)
SELECT concat(community, chr(252)) AS "NAME", CASE WHEN no > 1 THEN CAST(no AS BIGINT) END AS "AREA_NO",
       count(*) AS n_occurrences
FROM joined JOIN numbered ON community = n_name GROUP BY community, no"""
)
ORACLE_SQL["species_set_algebra_null_group"] = (
    f"WITH {_OCC},\n{_EDGES},\n{_JOINED.replace('joined AS', 'named AS')},\n"
    "joined AS (SELECT CASE WHEN community <> 'NATION_7' THEN community END AS community, species FROM named)\n"
    + _PAIRS
    + "SELECT community_1, community_2, n1, n2, n_inter, n_union, similarity FROM scored"
)
ORACLE_SQL["order_flag_sets"] = """SELECT l_orderkey,
       coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (WHERE l_returnflag <> 'N'), '') AS flag_set
FROM lineitem GROUP BY l_orderkey"""
ORACLE_SQL["geometry_text_roundtrip"] = f"""WITH {_PLACES}
SELECT place_id, geometry_type, CASE WHEN geometry_type = 'Point' THEN lon END AS lon,
       CASE WHEN geometry_type = 'Point' THEN lat END AS lat
FROM places"""
ORACLE_SQL["rejected_features"] = f"""WITH {_PLACES}
SELECT count(*) FILTER (WHERE geometry_type = 'Point') AS points,
       count(*) FILTER (WHERE geometry_type IS DISTINCT FROM 'Point') AS rejected
FROM places"""
ORACLE_SQL["documents_null_position"] = f"""WITH {_PLACES}
SELECT place_id, place_id % 7 <> 0 AS has_geometry, CASE WHEN place_id % 7 <> 0 THEN lon END AS lon FROM places"""
# The clustered near query answers the same question as nearest_places.
ORACLE_SQL["nearest_places_clustered"] = ORACLE_SQL["nearest_places"]
# No vertex of these shapes lies on a border, so a shape is inside if its first vertex is, no segment
# crosses an edge, and (quadrilaterals) no vertex of the community, hole included, lies in it.
ORACLE_SQL["shapes_in_communities"] = """WITH edges AS (
  SELECT n_name AS community,
         6.90037e0  + 1.8e0 * (n_nationkey % 5)        + ax AS x1, 47.80037e0 + 1.6e0 * floor(n_nationkey / 5e0) + ay AS y1,
         6.90037e0  + 1.8e0 * (n_nationkey % 5)        + px AS x2, 47.80037e0 + 1.6e0 * floor(n_nationkey / 5e0) + py AS y2
  FROM nation CROSS JOIN (VALUES
         (-1.1e0, -0.9e0,  1.1e0, -0.9e0), (1.1e0, -0.9e0,  1.1e0,  0.9e0), (1.1e0, 0.9e0,  0.0e0,  0.2e0),
         (0.0e0,  0.2e0, -1.1e0,  0.9e0), (-1.1e0, 0.9e0, -1.1e0, -0.9e0),
         (-0.7e0, -0.7e0, -0.2e0, -0.7e0), (-0.2e0, -0.7e0, -0.2e0, -0.3e0), (-0.2e0, -0.3e0, -0.7e0, -0.7e0)) AS o(ax, ay, px, py)
), shapes AS (
  SELECT c_custkey AS shape_id, CASE WHEN c_custkey % 3 = 0 THEN 'Point' WHEN c_custkey % 3 = 1 THEN 'LineString' ELSE 'Polygon' END AS kind,
         6e0 + ((c_custkey * 7919) % 9000) / 1e3 AS lon, 47e0 + ((c_custkey * 104729) % 8000) / 1e3 AS lat,
         (1 + c_custkey % 9) / 20e0 AS w, (1 + c_custkey % 7) / 20e0 AS h
  FROM customer WHERE c_custkey % 7 <> 3
), placed AS (
  SELECT shape_id, kind, lon, lat, w, h, community FROM shapes, edges GROUP BY ALL
  HAVING sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1
), vertices AS (
  SELECT shape_id, kind, community, unnest(CASE kind WHEN 'Point' THEN [{'i': 0, 'x': lon, 'y': lat}]
    WHEN 'LineString' THEN [{'i': 0, 'x': lon, 'y': lat}, {'i': 1, 'x': lon + w, 'y': lat + h}, {'i': 2, 'x': lon + w, 'y': lat + -h}]
    ELSE [{'i': 0, 'x': lon, 'y': lat}, {'i': 1, 'x': lon + w, 'y': lat}, {'i': 2, 'x': lon + w, 'y': lat + h}, {'i': 3, 'x': lon + w / 4, 'y': lat + h}, {'i': 4, 'x': lon, 'y': lat}] END) AS v
  FROM placed
), segments AS (
  SELECT a.shape_id, a.kind, a.community, a.v.x AS ax, a.v.y AS ay, b.v.x AS bx, b.v.y AS by_ FROM vertices a
  JOIN vertices b ON a.shape_id = b.shape_id AND a.community = b.community AND b.v.i = a.v.i + 1
), crossing AS (
  SELECT DISTINCT shape_id, community FROM segments JOIN edges USING (community)
  WHERE ((bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax)) * ((bx - ax) * (y2 - ay) - (by_ - ay) * (x2 - ax)) < 0
    AND ((x2 - x1) * (ay - y1) - (y2 - y1) * (ax - x1)) * ((x2 - x1) * (by_ - y1) - (y2 - y1) * (bx - x1)) < 0
), covering AS (
  SELECT DISTINCT shape_id, community FROM (
    SELECT shape_id, community, x1, y1 FROM segments JOIN edges USING (community) WHERE kind = 'Polygon'
    GROUP BY ALL HAVING min((bx - ax) * (y1 - ay) - (by_ - ay) * (x1 - ax)) > 0)
)
SELECT shape_id, kind, community FROM placed
ANTI JOIN crossing USING (shape_id, community) ANTI JOIN covering USING (shape_id, community)"""
ORACLE_SQL["documents_replace_failed"] = f"""WITH {_FLIGHTS}
SELECT carrier_name, airport_code, year, total, cancelled, true AS kept FROM flights"""
ORACLE_SQL["documents_replace_self"] = f"""WITH {_FLIGHTS}
SELECT carrier_name, airport_code, year, total, cancelled FROM flights WHERE cancelled > 5"""
ORACLE_SQL["shapefile_families"] = f"""WITH {_EDGES}, corners AS (
  SELECT community, max(CASE WHEN i = 0 THEN x1 END) AS x0, max(CASE WHEN i = 0 THEN y1 END) AS y0, max(CASE WHEN i = 4 THEN y1 END) AS y4 FROM community_edges GROUP BY community)
SELECT community AS "NAME", kind, CAST(n_parts AS BIGINT) AS n_parts, CAST(n_positions AS BIGINT) AS n_positions, x0 AS first_x, CASE WHEN kind = 'MultiPoint' THEN y4 ELSE y0 END AS last_y
FROM corners CROSS JOIN (VALUES ('Point', 1, 1), ('MultiPoint', 1, 5), ('MultiLineString', 2, 6), ('MultiPolygon', 1, 6)) AS f(kind, n_parts, n_positions)"""
ORACLE_SQL["species_sketches_appended"] = (
    _SPATIAL + "SELECT community, count(DISTINCT species) AS num_species, true AS close FROM joined GROUP BY community"
)
