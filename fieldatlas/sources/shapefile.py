"""Boundary files in the ESRI shapefile format as a DataFrame of shapes or polygons.

An ingestion job over a directory: ``binaryFile`` reads every ``.shp`` and
``.dbf`` file, the two are paired on their path stem, and each pair is
decoded in ``mapInPandas`` into one row per record: the attributes (typed
from the ``.dbf`` field descriptors) and ``rings`` for the spatial join.
Files are independent tasks; a shapefile is at most 2 GB by its format.
Decode once and keep the result as Parquet for repeated use.

Shape types read: points, multipoints, lines and polygons, each in its plain, Z
and M form; Z and M values are ignored. Null shapes give nulls; records flagged as deleted
in the ``.dbf`` are skipped together with their shape.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.session import importable_on_workers

# Shape type codes of the format (plain, Z and M forms), by the GeoJSON type they become.
KINDS = {1: "Point", 11: "Point", 21: "Point", 3: "MultiLineString", 13: "MultiLineString", 23: "MultiLineString",
         5: "MultiPolygon", 15: "MultiPolygon", 25: "MultiPolygon", 8: "MultiPoint", 18: "MultiPoint", 28: "MultiPoint"}
FILE_CODE = 9994

_ROWS_PER_BATCH = 1000
_DECODED = (
    "source string, record_no long, attrs map<string, string>, kind string, "
    "xs array<array<double>>, ys array<array<double>>"
)


def _shape(content: bytes) -> tuple[str, list, list] | None:
    """Kind and coordinates by part of one record; None for a null shape."""
    (code,) = struct.unpack_from("<i", content, 0)
    if code == 0:
        return None
    kind = KINDS.get(code)
    if kind is None:
        raise ValueError(f"shapes of type {code} cannot be read")
    if kind == "Point":
        x, y = struct.unpack_from("<dd", content, 4)
        return kind, [[x]], [[y]]
    if kind == "MultiPoint":
        (n_points,) = struct.unpack_from("<i", content, 36)
        parts, at = [0, n_points], 40
    else:
        n_parts, n_points = struct.unpack_from("<ii", content, 36)
        parts, at = [*struct.unpack_from(f"<{n_parts}i", content, 44), n_points], 44 + 4 * n_parts
    coords = struct.unpack_from(f"<{2 * n_points}d", content, at)
    xs = [list(coords[2 * a : 2 * b : 2]) for a, b in zip(parts, parts[1:])]
    ys = [list(coords[2 * a + 1 : 2 * b : 2]) for a, b in zip(parts, parts[1:])]
    return kind, xs, ys


def _shapes(shp: bytes) -> Iterator[tuple[str, list, list] | None]:
    """Every record's shape. A file of another length than its header says, or cut inside a record, raises."""
    if len(shp) < 100 or struct.unpack_from(">i", shp, 0)[0] != FILE_CODE:
        raise ValueError("not a .shp file")
    (words,) = struct.unpack_from(">i", shp, 24)
    if 2 * words != len(shp):
        raise ValueError(f"damaged .shp file: {len(shp)} bytes, its header says {2 * words}")
    pos = 100
    while pos < len(shp):
        size = 2 * struct.unpack_from(">i", shp, pos + 4)[0] if pos + 8 <= len(shp) else -1
        if size < 4 or pos + 8 + size > len(shp):
            raise ValueError(f"damaged .shp file: a record at {pos} does not fit")
        yield _shape(shp[pos + 8 : pos + 8 + size])
        pos += 8 + size


def descriptor_fields(block: bytes) -> list[tuple[str, str, int, int]]:
    """``(name, type, length, decimals)`` from consecutive 32-byte field
    descriptors (stops at the 0x0D terminator)."""
    fields = []
    for pos in range(0, len(block) - 31, 32):
        raw = block[pos : pos + 32]
        if raw[0] == 0x0D:
            break
        name = raw[:11].split(b"\x00", 1)[0].decode("ascii", "replace")
        fields.append((name, chr(raw[11]), raw[16], raw[17]))
    return fields


def dbf_fields(dbf: bytes) -> list[tuple[str, str, int, int]]:
    """Field descriptors ``(name, type, length, decimals)`` of a ``.dbf``."""
    (header_len,) = struct.unpack_from("<H", dbf, 8)
    return descriptor_fields(dbf[32:header_len])


def _records(dbf: bytes, encoding: str) -> Iterator[dict | None]:
    n, header_len, rec_len = struct.unpack_from("<IHH", dbf, 4)
    if header_len + n * rec_len > len(dbf):
        raise ValueError(f"damaged .dbf file: {len(dbf)} bytes, {n} records take {header_len + n * rec_len}")
    fields = dbf_fields(dbf)
    for i in range(n):
        rec = dbf[header_len + i * rec_len : header_len + (i + 1) * rec_len]
        if rec[:1] == b"*":
            yield None
            continue
        out, pos = {}, 1
        for name, _, length, _ in fields:
            text = rec[pos : pos + length].decode(encoding, "replace").strip()
            out[name] = text if text else None
            pos += length
        yield out


def code_page(text: bytes | None, default: str) -> str:
    """The Python codec that the text of a ``.cpg`` file names (``UTF-8``,
    ``ISO 88591``, ``1252``, ...); ``default`` if there is none or it is unknown."""
    name = (text or b"").decode("ascii", "ignore").strip()
    for candidate in (name, name.replace(" ", "-"), f"cp{name}", re.sub(r"(?i)iso[ _-]*8859[ _-]*", "iso8859-", name)):
        try:
            return codecs.lookup(candidate).name if candidate else default
        except LookupError:
            continue
    return default


def _decode(encoding: str):
    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["source", "record_no", "attrs", "kind", "xs", "ys"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for stem, shp, dbf, cpg in zip(pdf["stem"], pdf["shp"], pdf["dbf"], pdf["cpg"]):
                if dbf is None:
                    raise ValueError(f"{stem} has no .dbf file")
                rows = []
                codec = code_page(bytes(cpg) if cpg is not None else None, encoding)
                # Shapes and records come in pairs; one without the other raises.
                for no, (shape, rec) in enumerate(zip(_shapes(bytes(shp)), _records(bytes(dbf), codec), strict=True), start=1):
                    if rec is None:
                        continue
                    rows.append((stem, no, rec, *(shape or (None, None, None))))
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield frame(rows)
                        rows = []
                yield frame(rows)

    return run


def _spark_type(ftype: str, decimals: int) -> str:
    if ftype in ("N", "F"):
        return "double" if decimals > 0 or ftype == "F" else "bigint"
    if ftype == "L":
        return "boolean"
    return "string"


def _files(spark: SparkSession, path: str, ext: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*." + "".join(f"[{c}{c.upper()}]" for c in ext))
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.regexp_replace("path", rf"(?i)\.{ext}$", "").alias("stem"),
            F.col("content").alias(ext),
        )
    )


def read_shapefile(spark: SparkSession, path: str, encoding: str = "utf-8",
                   attributes: str | None = None) -> DataFrame:
    """All polygon shapefiles below ``path`` as ``(*attributes, rings)``, for the joins.

    As :func:`read_shapes`; ``rings`` is null for null shapes and for shapes of other kinds.
    """
    shapes = read_shapes(spark, path, encoding, attributes)
    rings = F.when(F.col("kind") == "MultiPolygon", F.col("parts")).alias("rings")
    return shapes.select(*[F.col(f"`{c}`") for c in shapes.columns[:-2]], rings)


def read_shapes(spark: SparkSession, path: str, encoding: str = "utf-8",
                attributes: str | None = None) -> DataFrame:
    """All shapefiles below ``path`` as ``(*attributes, kind, parts)``.

    ``kind`` is the GeoJSON type (Point, MultiPoint, MultiLineString or
    MultiPolygon; null for a null shape) and ``parts`` the positions: one list
    for points, one a line, one a ring. A ``.shp`` or ``.dbf`` file that is cut
    off, a ``.shp`` without its ``.dbf``, and numbers of shapes and records that
    differ, fail the read.

    ``attributes`` is a DDL list (``"GEN string, AGS string"``); when None the
    columns and types come from the ``.dbf`` field descriptors; only the
    distinct descriptor blocks (one per distinct schema) reach the driver.
    Logical fields become booleans, numeric fields longs or doubles (null
    where the field holds no number, e.g. an overflow fill of ``*``), all
    others strings. Text is decoded as the ``.cpg`` file beside it says, else
    with ``encoding``. Extensions may be in either case.
    """
    importable_on_workers(spark)
    shp = _files(spark, path, "shp")
    dbf = _files(spark, path, "dbf")
    pairs = shp.join(dbf, "stem", "left").join(_files(spark, path, "cpg"), "stem", "left").select("stem", "shp", "dbf", "cpg")
    decoded = pairs.mapInPandas(_decode(encoding), _DECODED)
    if attributes is None:
        # The descriptor block of each .dbf (bytes 33 .. header length), cut
        # out by Spark; only distinct blocks, one per distinct schema, reach
        # the driver.
        hx = F.hex(F.substring("dbf", 9, 2))
        header_len = F.conv(F.substring(hx, 3, 2), 16, 10).cast("int") * 256 + F.conv(
            F.substring(hx, 1, 2), 16, 10
        ).cast("int")
        blocks = (
            dbf.select(header_len.alias("n"), "dbf")
            .select(F.expr("substring(dbf, 33, n - 33)").alias("b"))
            .distinct()
            .collect()
        )
        cols: dict[str, str] = {}
        for row in blocks:
            for name, ftype, _, dec in descriptor_fields(bytes(row.b)):
                cols.setdefault(name, _spark_type(ftype, dec))
    else:
        schema = spark.createDataFrame([], attributes).schema
        cols = {f.name: f.dataType.simpleString() for f in schema.fields}
    parts = F.expr(
        "zip_with(xs, ys, (rx, ry) -> zip_with(rx, ry, (a, b) -> named_struct('x', a, 'y', b)))"
    )

    def typed(name: str, dtype: str):
        raw = F.col("attrs").getItem(name)
        if dtype == "boolean":
            return F.upper(raw).isin("T", "Y").alias(name)
        return raw.try_cast(dtype).alias(name)

    return decoded.select(*[typed(n, t) for n, t in cols.items()], "kind", parts.alias("parts"))
