"""Writers: replace, append, document shaping, clustered layout, GeoJSON files.

Every writer is one distributed write. The number of rows written is taken
with an ``Observation`` during that same write, so the plan is not run a
second time to count it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldatlas.functions.geo import point_geometry
from fieldatlas.session import release_tables, scratch_path


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to, which takes the place of ``path`` once all is written.

    What fails on the way leaves ``path`` as it was, and what is written may be
    read from ``path`` itself. The switch is two renames, each atomic where the
    storage renames atomically; should the second one fail, the first is undone.
    """
    mark = uuid.uuid4().hex
    staged, old = f"{path.rstrip('/')}.staged-{mark}", f"{path.rstrip('/')}.replaced-{mark}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at, new, gone = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staged, old))
    fs = at.getFileSystem(conf)
    try:
        yield staged
        held = fs.exists(at)
        if held and not fs.rename(at, gone):
            raise OSError(f"{path} could not be moved")
        if not fs.rename(new, at):
            if held:
                fs.rename(gone, at)
            raise OSError(f"{staged} could not be moved to {path}")
    except BaseException:
        fs.delete(new, True)
        raise
    if held:
        fs.delete(gone, True)


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                    options: Mapping[str, str] | None = None,
                    partition_by: list[str] | None = None) -> int:
    """Write ``df`` and return the number of rows written.

    ``overwrite`` replaces the whole collection (an empty input leaves an
    empty collection that keeps the schema), once everything is written: if the
    input or the write fails, the rows that were there stay, and a collection
    may be replaced by a query on itself. ``append`` adds rows.
    """
    if mode == "overwrite":
        with replacing(df.sparkSession, path) as staged:
            return write_documents(df, staged, fmt, "error", options, partition_by)
    obs = Observation("fieldatlas_write")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt).mode(mode).options(**dict(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get.get("rows", 0))


def replace_collection(df: DataFrame, path: str, fmt: str = "parquet", **kw) -> int:
    """Drop and bulk insert: the collection afterwards holds exactly ``df``."""
    return write_documents(df, path, fmt, "overwrite", **kw)


def append_documents(df: DataFrame, path: str, fmt: str = "parquet", **kw) -> int:
    """Insert ``df`` after the rows already there (batched, not per row)."""
    return write_documents(df, path, fmt, "append", **kw)


def geojson_documents(df: DataFrame, lon: str = "lon", lat: str = "lat",
                      geometry: str = "geometry") -> DataFrame:
    """Replace ``lon``/``lat`` by a GeoJSON point struct
    ``{type: "Point", coordinates: [lon, lat]}`` as the last column; null
    where a coordinate is null."""
    rest = [_q(c) for c in df.columns if c not in (lon, lat, geometry)]
    return df.select(*rest, point_geometry(_q(lon), _q(lat)).alias(geometry))


def z_order(cx: Column, cy: Column, bits: int = 16) -> Column:
    """Morton code of two non-negative cell numbers (``bits`` each)."""
    key = F.lit(0).cast("long")
    for i in range(bits):
        key = key.bitwiseOR(F.shiftleft(F.shiftright(cx, i).bitwiseAND(1), 2 * i))
        key = key.bitwiseOR(F.shiftleft(F.shiftright(cy, i).bitwiseAND(1), 2 * i + 1))
    return key


def clustered_layout(df: DataFrame, lon: str = "lon", lat: str = "lat",
                     cell_size: float = 0.05, partitions: int | None = None) -> DataFrame:
    """Order rows so that nearby points share files and row groups.

    Cells of ``cell_size`` degrees are numbered along a Z curve; rows are
    range-partitioned and sorted by that number, so Parquet min/max
    statistics of both ``lon`` and ``lat`` become narrow and a box filter
    skips most row groups. A hash of the row's content in the range key lets
    one crowded cell (even a third of all rows at one position) spread over
    several partitions instead of one, and a retried task deals its rows alike.
    """
    span = 1 << 16
    cx = F.pmod(F.floor((_q(lon) + 180.0) / cell_size), span)
    cy = F.pmod(F.floor((_q(lat) + 90.0) / cell_size), span)
    keyed = df.withColumn("_fa_z", z_order(cx, cy)).withColumn(
        "_fa_tie", F.xxhash64(*[_q(c) for c in df.columns])
    )
    parts = [partitions] if partitions else []
    return (
        keyed.repartitionByRange(*parts, "_fa_z", "_fa_tie")
        .sortWithinPartitions("_fa_z", _q(lon), _q(lat))
        .drop("_fa_z", "_fa_tie")
    )


def write_clustered(df: DataFrame, path: str, lon: str = "lon", lat: str = "lat",
                    cell_size: float = 0.05, partitions: int | None = None,
                    rows_per_file: int = 5_000_000) -> int:
    """Write ``df`` as Parquet in the clustered layout; returns rows written.

    The input runs once: it is stored and counted in the same write, then
    sampled and range-partitioned from the store, which is removed again.
    Without ``partitions``, the number of range partitions (one file each) is
    ``ceil(rows / rows_per_file)``, so files keep a bounded size.
    """
    spark = df.sparkSession
    store = scratch_path(spark, "to-cluster")
    rows = write_documents(df, store)
    if partitions is None:
        partitions = max(1, math.ceil(rows / rows_per_file))
    layout = clustered_layout(spark.read.parquet(store), lon, lat, cell_size, partitions)
    with replacing(spark, path) as staged:
        layout.write.parquet(staged)
    release_tables(spark, store)
    return rows


def write_feature_collection(features: DataFrame, path: str, root: str = "object",
                             rows_per_file: int = 100_000, bytes_per_file: int = 128 << 20,
                             text: str = "value") -> int:
    """Write GeoJSON files from feature texts, about ``rows_per_file`` features
    or ``bytes_per_file`` bytes each, whichever makes more files.

    The input runs once: it is stored, counted and measured in one write. The
    place of each row in that store gives its file number (the store does not
    change, so a retried task numbers its rows alike, and identical features
    spread like any others); one shuffle forms the groups and each file is
    one group of bounded size, joined into an array-root or an object-root
    (``FeatureCollection``) document.
    """
    if root not in ("array", "object"):
        raise ValueError("root must be 'array' or 'object'")
    spark = features.sparkSession
    store = scratch_path(spark, "features")
    obs = Observation("fieldatlas_features")
    size = F.sum(F.octet_length(text)).alias("bytes")
    features.select(_q(text).alias(text)).observe(obs, F.count(F.lit(1)).alias("rows"), size).write.parquet(store)
    n, total = int(obs.get["rows"]), int(obs.get["bytes"] or 0)
    files = max(1, math.ceil(n / rows_per_file), math.ceil(total / bytes_per_file))
    body = F.concat_ws(",", F.collect_list(_q(text)))
    doc = (
        F.concat(F.lit("["), body, F.lit("]"))
        if root == "array"
        else F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}"))
    )
    file_no = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    grouped = spark.read.parquet(store).groupBy(file_no.alias("file_no")).agg(doc.alias("value"))
    with replacing(spark, path) as staged:
        grouped.write.partitionBy("file_no").text(staged)
    release_tables(spark, store)
    return n


def write_feature_lines(features: DataFrame, path: str, text: str = "value") -> int:
    """Write one GeoJSON feature per line (a text sequence); files split and
    are read back by Spark in parallel. Returns rows written."""
    return write_documents(features.select(_q(text).alias("value")), path, fmt="text")
