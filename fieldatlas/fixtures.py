"""Inputs of the reference's programs, derived from the driver's tables.

The reference reads species occurrences, community boundaries, places and
airline statistics that are not part of its source tree. The builders below
derive stand-ins with the same shape from the TPC-H-like tables, so their
size grows with the scale factor. The SQL oracle (``fieldatlas.plans.catalog``)
derives the same rows with the same arithmetic.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Vertex offsets (degrees) of each community polygon around its
# centre, a concave pentagon; the first vertex closes the ring.
COMMUNITY_OFFSETS = [(-1.1, -0.9), (1.1, -0.9), (1.1, 0.9), (0.0, 0.2), (-1.1, 0.9)]
# Centre of community k is (6.90037 + 1.8 * (k % 5), 47.80037 + 1.6 * floor(k / 5)).
COMMUNITY_ORIGIN = (6.90037, 47.80037)
COMMUNITY_STEP = (1.8, 1.6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lattice(key, x_mult: int, y_mult: int):
    lon = F.lit(6.0) + (key * x_mult % 9000) / F.lit(1000.0)
    lat = F.lit(47.0) + (key * y_mult % 8000) / F.lit(1000.0)
    return lon, lat


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(occ_id, species, lon, lat)``: one occurrence per order."""
    o = table(spark, sf_dir, "orders")
    lon, lat = _lattice(F.col("o_orderkey"), 7919, 104729)
    species = F.when(F.col("o_custkey") % 50 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("sp_"), F.col("o_custkey").cast("string"))
    )
    return o.select(
        F.col("o_orderkey").alias("occ_id"),
        species.alias("species"),
        lon.alias("lon"),
        lat.alias("lat"),
    )


def communities(spark: SparkSession, sf_dir: str, name_col: str = "community") -> DataFrame:
    """``(community, rings)``: one closed concave pentagon per nation."""
    n = table(spark, sf_dir, "nation")
    cx = f"({COMMUNITY_ORIGIN[0]!r}D + {COMMUNITY_STEP[0]!r}D * (n_nationkey % 5))"
    cy = f"({COMMUNITY_ORIGIN[1]!r}D + {COMMUNITY_STEP[1]!r}D * floor(n_nationkey / 5.0D))"
    verts = [
        f"named_struct('x', {cx} + ({dx!r}D), 'y', {cy} + ({dy!r}D))" for dx, dy in COMMUNITY_OFFSETS
    ]
    ring = f"array({', '.join(verts + verts[:1])})"
    return n.selectExpr(f"n_name AS `{name_col}`", f"array({ring}) AS rings")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat places: ``(place_id, name, amenity, geometry_type, lon, lat)``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    lon, lat = _lattice(key, 7919, 104729)
    return c.select(
        key.alias("place_id"),
        F.when(key % 10 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("restaurant"))
        .otherwise(F.lower("c_mktsegment"))
        .alias("amenity"),
        F.when(key % 20 == 1, F.lit("LineString"))
        .when(key % 20 == 2, F.lit(None).cast("string"))
        .otherwise(F.lit("Point"))
        .alias("geometry_type"),
        lon.alias("lon"),
        lat.alias("lat"),
    )


def place_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places as GeoJSON feature text, one ``value`` per feature.

    Points carry ``[lon, lat]``, line strings two positions, and features
    whose geometry type is null carry a JSON ``null`` geometry.
    """
    p = places(spark, sf_dir)
    props = F.to_json(F.struct("place_id", "name", "amenity"))
    point = F.to_json(
        F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    )
    line = F.to_json(
        F.struct(
            F.lit("LineString").alias("type"),
            F.array(F.array("lon", "lat"), F.array(F.col("lon") + 0.001, F.col("lat"))).alias(
                "coordinates"
            ),
        )
    )
    geometry = (
        F.when(F.col("geometry_type") == "Point", point)
        .when(F.col("geometry_type") == "LineString", line)
        .otherwise(F.lit("null"))
    )
    text = F.concat(
        F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geometry, F.lit("}")
    )
    return p.select(text.alias("value"))


def flight_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested airline statistics, one document per (carrier, airport, year).

    ``carrier.name``, ``airport.code``, ``year``,
    ``statistics.flights.{total, cancelled}``. Line items are aggregated per
    supplier and year *before* the joins, so only one row per supplier-year
    crosses the join shuffle.
    """
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    per_supplier = li.groupBy(
        F.col("l_suppkey"), F.year("l_shipdate").cast("long").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("cancelled"),
    )
    flat = (
        per_supplier.join(sup, per_supplier.l_suppkey == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
        .groupBy("s_name", "n_name", "year")
        .agg(F.sum("total").cast("long").alias("total"), F.sum("cancelled").cast("long").alias("cancelled"))
    )
    return flat.select(
        F.struct(F.col("s_name").alias("name")).alias("carrier"),
        F.struct(F.col("n_name").alias("code")).alias("airport"),
        F.col("year"),
        F.struct(
            F.struct(F.col("total"), F.col("cancelled")).alias("flights")
        ).alias("statistics"),
    )


def community_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The communities as GeoJSON ``Polygon`` feature text (closed rings)."""
    c = communities(spark, sf_dir)
    coords = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p.x, p.y)))
    geometry = F.to_json(F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")))
    props = F.to_json(F.struct("community"))
    text = F.concat(
        F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), geometry, F.lit("}")
    )
    return c.select(text.alias("value"))


# The detailed polygon of community k has this many vertices, at radius
# 0.9 + 0.0005 * ((j * 193 + k * 37) % 200) degrees for vertex j, around the community's centre.
DETAILED_VERTICES = 512


def detailed_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(community, rings)``: one jagged star of ``DETAILED_VERTICES`` vertices per nation."""
    n = table(spark, sf_dir, "nation")
    cx = f"({COMMUNITY_ORIGIN[0]!r}D + {COMMUNITY_STEP[0]!r}D * (n_nationkey % 5))"
    cy = f"({COMMUNITY_ORIGIN[1]!r}D + {COMMUNITY_STEP[1]!r}D * floor(n_nationkey / 5.0D))"
    angle = f"(j * {2 * math.pi!r}D / {DETAILED_VERTICES})"
    radius = "(0.9D + 0.0005D * ((j * 193 + n_nationkey * 37) % 200))"
    ring = f"""transform(sequence(0, {DETAILED_VERTICES - 1}), j -> named_struct(
        'x', {cx} + {radius} * cos{angle}, 'y', {cy} + {radius} * sin{angle}))"""
    return n.selectExpr("n_name AS community", f"array({ring}) AS rings")


# Node (i, j) of the tiling lies at (6 + 1.8 i + jitter, 47 + 1.6 j + jitter), the
# jitters being ((37 i + 91 j) % 17) / 23 - 0.4 and ((53 i + 29 j) % 19) / 29 - 0.3.
def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tile, rings)``: quadrilaterals between irregular lattice nodes, one per
    nation; neighbours share their border nodes exactly."""
    n = table(spark, sf_dir, "nation")

    def node(di: int, dj: int) -> str:
        i, j = f"(n_nationkey % 5 + {di})", f"(CAST(floor(n_nationkey / 5.0D) AS INT) + {dj})"
        x = f"6.0D + 1.8D * {i} + ((37 * {i} + 91 * {j}) % 17) / 23.0D - 0.4D"
        y = f"47.0D + 1.6D * {j} + ((53 * {i} + 29 * {j}) % 19) / 29.0D - 0.3D"
        return f"named_struct('x', {x}, 'y', {y})"

    corners = ", ".join(node(di, dj) for di, dj in ((0, 0), (1, 0), (1, 1), (0, 1)))
    return n.selectExpr("n_name AS tile", f"array(array({corners})) AS rings")


def write_community_shapefile(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The communities as one shapefile (``.SHP``, ``.DBF``, ``.cpg``) below ``path``.

    One row per nation (25) comes to the driver and goes out through the
    session's file system; the names get a non-ASCII letter to exercise the code page.
    """
    rows = communities(spark, sf_dir).orderBy("community").collect()
    shapes, records = [], []
    for no, row in enumerate(rows, start=1):
        # The format closes every ring and runs shells clockwise.
        points = [(p.x, p.y) for p in row.rings[0]][::-1]
        xs, ys = zip(*points)
        body = struct.pack("<i4d2ii", 5, min(xs), min(ys), max(xs), max(ys), 1, len(points), 0)
        body += struct.pack(f"<{2 * len(points)}d", *[v for p in points for v in p])
        shapes.append(struct.pack(">ii", no, len(body) // 2) + body)
        records.append(b" " + f"{row.community}\u00fc".encode("iso8859-1").ljust(40) + (b"*****" if no == 1 else f"{no:5d}".encode()))
    content = b"".join(shapes)
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(content)) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    fields = b"".join(
        name.encode().ljust(11, b"\0") + kind + b"\0" * 4 + bytes([length, 0]) + b"\0" * 14
        for name, kind, length in (("NAME", b"C", 40), ("AREA_NO", b"N", 5))
    )
    dbf = struct.pack("<4BIHH20x", 3, 24, 1, 1, len(records), 32 + len(fields) + 1, 46) + fields + b"\r" + b"".join(records)
    write_files(spark, path, {"communities.SHP": header + content, "communities.DBF": dbf, "communities.cpg": b"ISO 88591"})


def write_files(spark: SparkSession, path: str, files: dict[str, bytes]) -> None:
    """Small files below ``path``, through the session's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name, data in files.items():
        at = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        out = at.getFileSystem(conf).create(at, True)
        out.write(bytearray(data))
        out.close()


def shapefile_bytes(code: int, shapes: list[list[list[tuple]]], names: list[str]) -> tuple[bytes, bytes]:
    """``.shp`` and ``.dbf`` content: shapes of one type code as parts of positions (no parts: a null shape), and a NAME each."""
    records = []
    for no, parts in enumerate(shapes, start=1):
        points = [p for part in parts for p in part]
        coords = struct.pack(f"<{2 * len(points)}d", *[v for p in points for v in p])
        if not points:
            body = struct.pack("<i", 0)
        elif code % 10 == 1:
            body = struct.pack("<i", code) + coords + b"\0" * 8 * (2 if code == 11 else 1 if code == 21 else 0)
        else:
            xs, ys = zip(*points)
            body = struct.pack("<i4d", code, min(xs), min(ys), max(xs), max(ys))
            starts = [sum(len(q) for q in parts[:k]) for k in range(len(parts))]
            if code % 10 == 8:
                body += struct.pack("<i", len(points)) + coords
            else:
                body += struct.pack(f"<ii{len(parts)}i", len(parts), len(points), *starts) + coords
            # Ranges and values: of Z and M in the Z forms, of M in the M forms.
            body += b"\0" * (16 + 8 * len(points)) * (2 if code // 10 == 1 else 1 if code // 10 == 2 else 0)
        records.append(struct.pack(">ii", no, len(body) // 2) + body)
    content = b"".join(records)
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(content)) // 2) + struct.pack("<2i8d", 1000, code, *[0.0] * 8)
    field = b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([40, 0]) + b"\0" * 14
    dbf = struct.pack("<4BIHH20x", 3, 24, 1, 1, len(names), 65, 41) + field + b"\r" + b"".join(b" " + n.encode().ljust(40) for n in names)
    return header + content, dbf


#: Type codes of the shapefiles that the queries read: every family, in plain, Z or M form.
SHAPE_FAMILIES = {"points": 11, "multipoints": 8, "lines": 23, "areas": 15}


def write_family_shapefiles(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One shapefile a family from the communities (one row per nation): a corner, all corners, two lines, the ring."""
    rows = communities(spark, sf_dir).orderBy("community").collect()
    rings = [[(p.x, p.y) for p in r.rings[0]] for r in rows]
    parts = {"points": lambda r: [r[:1]], "multipoints": lambda r: [r[:5]], "lines": lambda r: [r[:3], r[3:]], "areas": lambda r: [r[::-1]]}
    for name, code in SHAPE_FAMILIES.items():
        shp, dbf = shapefile_bytes(code, [parts[name](r) for r in rings], [r.community for r in rows])
        write_files(spark, path, {f"{name}.shp": shp, f"{name}.dbf": dbf})


# Offsets of a triangular hole from a community's centre.
PARK_HOLE = [(-0.7, -0.7), (-0.2, -0.7), (-0.2, -0.3)]


def holed_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(community, rings)``: the communities, each with a triangular hole."""
    n = table(spark, sf_dir, "nation")
    cx = f"({COMMUNITY_ORIGIN[0]!r}D + {COMMUNITY_STEP[0]!r}D * (n_nationkey % 5))"
    cy = f"({COMMUNITY_ORIGIN[1]!r}D + {COMMUNITY_STEP[1]!r}D * floor(n_nationkey / 5.0D))"

    def ring(offsets) -> str:
        verts = [f"named_struct('x', {cx} + ({dx!r}D), 'y', {cy} + ({dy!r}D))" for dx, dy in offsets]
        return f"array({', '.join(verts + verts[:1])})"

    return n.selectExpr("n_name AS community", f"array({ring(COMMUNITY_OFFSETS)}, {ring(PARK_HOLE)}) AS rings")


def shape_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON features of points, lines of three vertices and quadrilaterals, one per customer (every seventh without a geometry)."""
    key = F.col("c_custkey")
    lon, lat = _lattice(key, 7919, 104729)
    w, h = (F.lit(1) + key % 9) / F.lit(20.0), (F.lit(1) + key % 7) / F.lit(20.0)
    at = lambda dx, dy: F.array(lon + dx, lat + dy)
    zero = F.lit(0.0)
    quad = F.array(at(zero, zero), at(w, zero), at(w, h), at(w / 4, h), at(zero, zero))
    line = F.array(at(zero, zero), at(w, h), at(w, -h))
    shape = lambda name, c: F.to_json(F.struct(F.lit(name).alias("type"), c.alias("coordinates")))
    geometry = (
        F.when(key % 7 == 3, F.lit("null"))
        .when(key % 3 == 0, shape("Point", at(zero, zero)))
        .when(key % 3 == 1, shape("LineString", line))
        .otherwise(shape("Polygon", F.array(quad)))
    )
    text = F.concat(F.lit('{"type":"Feature","properties":{"shape_id":'), key.cast("string"), F.lit('},"geometry":'), geometry, F.lit("}"))
    return table(spark, sf_dir, "customer").select(text.alias("value"))
