"""GeoJSON features as DataFrames.

Two layouts are read:

* ``collection``: files whose root is either an array of features or an
  object with a ``features`` array. JSON cannot be split inside a document,
  so each file is one task; the root is parsed with a declared schema that
  keeps every feature as raw text (no size limit per feature list), and each
  feature is then parsed on its own. Large collections should be written as
  many files.
* ``lines``: one feature per line (GeoJSON text sequences, optionally with
  the record separator). Splittable by Spark like any text file; the layout
  for very large inputs.

Features come out as a VARIANT column ``feature``; :func:`feature_columns`
turns them into flat columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldatlas.functions.geo import geometry_to_geojson, parts_from_coordinates, rings_from_coordinates

_RS = "\u001e"


def _collection_features(text: Column) -> Column:
    # First non-blank character; the anchored pattern stops reading there.
    first = F.regexp_extract(text, r"^[\s\x{FEFF}]*([\[{])", 1)
    # The root becomes a member of an object with another one behind it, so the parser has to come
    # to the text's end: a second root or other text there fails, or leaves the last member out.
    body = F.regexp_replace(text, r"^[\s\x{FEFF}]+", "")
    framed = F.concat(F.lit('{"root":'), body, F.lit(',"end":true}'))

    def read(root: str) -> Column:
        return F.from_json(framed, f"struct<root: {root}, end: boolean>", {"mode": "FAILFAST"})

    def to_end(parsed: Column, features: Column) -> Column:
        return F.when(parsed["end"], features)

    listed, wrapped = read("array<string>"), read("struct<features: array<string>>")
    as_array, as_object = to_end(listed, listed["root"]), to_end(wrapped, wrapped["root"]["features"])
    parsed = (
        F.when(first == "[", as_array)
        .when(first == "{", as_object)
        .otherwise(F.raise_error(F.lit("Invalid GeoJSON root: must start with '[' or '{'")).cast("array<string>"))
    )
    # A file that cannot be read whole must not look like a file without features.
    return F.coalesce(parsed, F.raise_error(F.lit("Damaged GeoJSON: no list of features, or text behind it")).cast("array<string>"))


def read_features(spark: SparkSession, path: str, layout: str = "collection") -> DataFrame:
    """One row per feature, column ``feature`` of type VARIANT."""
    if layout == "collection":
        files = spark.read.text(path, wholetext=True)
        texts = files.select(F.explode(_collection_features(F.col("value"))).alias("t"))
    elif layout == "lines":
        lines = spark.read.text(path)
        texts = lines.select(F.trim(F.regexp_replace("value", _RS, "")).alias("t")).where(
            F.col("t") != ""
        )
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return texts.select(F.parse_json("t").alias("feature"))


def point_counts(features: DataFrame, feature: str = "feature") -> DataFrame:
    """One row: ``points`` kept by a point load, and ``rejected`` (other or no geometry)."""
    is_point = F.coalesce(geometry_type(feature) == "Point", F.lit(False))
    return features.agg(F.count_if(is_point).alias("points"), F.count_if(~is_point).alias("rejected"))


def geometry_type(feature: Column | str = "feature") -> Column:
    f = F.col(feature) if isinstance(feature, str) else feature
    return F.try_variant_get(f, "$.geometry.type", "string")


def infer_properties(features: DataFrame, feature: str = "feature") -> str:
    """Schema of ``properties`` over all features (one distributed
    aggregation returning one DDL string)."""
    props = F.variant_get(F.col(feature), "$.properties", "variant")
    ddl = features.select(F.schema_of_variant_agg(props).alias("s")).first()["s"]
    return ddl


def _struct_ddl(ddl: str) -> str:
    # schema_of_variant writes OBJECT<...> (at every nesting level); VOID
    # marks keys that were always null; fractional numbers come out as
    # DECIMAL, which Spark's own JSON inference would read as DOUBLE.
    ddl = re.sub(r"\bVOID\b", "STRING", ddl)
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)", "DOUBLE", ddl)
    return re.sub(r"\bOBJECT<", "STRUCT<", ddl)


def feature_columns(features: DataFrame, properties=None, feature: str = "feature",
                    keep_polygons: bool = False, keep_geometry: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Flat columns: every property, then ``geometry_type, lon, lat``
    (coordinates only for points), with ``keep_polygons`` ``rings``, and with
    ``keep_geometry`` the geometry of any type as GeoJSON text ``geometry``;
    ``keep`` names further columns of ``features`` to keep.

    ``properties`` is a DDL string or StructType; when None it is inferred
    from all features. A property with the name of a geometry column (in any
    case) comes out as ``property_`` and its name.
    """
    f = F.col(feature)
    if properties is None:
        ddl = infer_properties(features, feature)
        schema = _struct_ddl(ddl) if ddl and ddl.upper().startswith("OBJECT<") else None
    elif isinstance(properties, T.StructType):
        schema = properties.simpleString()
    else:
        schema = properties if properties.lower().startswith("struct<") else f"struct<{properties}>"
    gtype = geometry_type(f)
    point = F.try_variant_get(f, "$.geometry.coordinates", "array<double>")
    is_point = (gtype == "Point") & (F.size(point) >= 2)
    cols = []
    if schema is not None:
        cols.append(F.try_variant_get(f, "$.properties", schema).alias("_p"))
    cols += [
        gtype.alias("geometry_type"),
        F.when(is_point, point[0]).alias("lon"),
        F.when(is_point, point[1]).alias("lat"),
    ]
    if keep_polygons:
        cols.append(rings_from_coordinates(F.variant_get(f, "$.geometry", "variant")).alias("rings"))
    if keep_geometry:
        cols.append(geometry_to_geojson(F.try_variant_get(f, "$.geometry", "variant")).alias("geometry"))
    out = features.select(*cols, *keep)
    if schema is None:
        return out
    names = [c for c in out.columns if c != "_p"]
    fields = out.select("_p.*").columns
    taken = {c.lower() for c in names}
    prop_fields = []
    for n in fields:
        name = n
        while name.lower() in taken:
            name = f"property_{name}"
        taken.add(name.lower())
        prop_fields.append(F.col("_p").getField(n).alias(name))
    return out.select(*prop_fields, *names)


def shape_columns(features: DataFrame, properties=None, feature: str = "feature") -> DataFrame:
    """Flat columns for :func:`fieldatlas.operators.shapes.shape_join`: every property, then
    ``kind`` (the geometry's type) and ``parts`` (its coordinates); null for no geometry."""
    parts = parts_from_coordinates(F.try_variant_get(F.col(feature), "$.geometry", "variant"))
    flat = feature_columns(features.withColumn("_fa_parts", parts), properties, feature, keep=["_fa_parts"])
    return flat.drop("lon", "lat").withColumnsRenamed({"geometry_type": "kind", "_fa_parts": "parts"})


def read_feature_table(spark: SparkSession, path: str, properties=None,
                       layout: str = "collection") -> DataFrame:
    """A feature file as a flat table: one row per feature, each property a
    column, geometry columns last."""
    return feature_columns(read_features(spark, path, layout), properties)


def read_polygons(spark: SparkSession, path: str, properties=None,
                  layout: str = "collection") -> DataFrame:
    """Polygon and MultiPolygon features as ``(*properties, rings)``; other
    geometries are left out."""
    t = feature_columns(read_features(spark, path, layout), properties, keep_polygons=True)
    return t.where(F.col("rings").isNotNull()).drop("geometry_type", "lon", "lat")
