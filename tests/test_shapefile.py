import os
import struct

from fieldatlas.operators.spatial import spatial_join
from fieldatlas.sources.shapefile import code_page, read_shapefile


def _polygon_content(rings):
    pts = [p for r in rings for p in r]
    xs = [p[0] for p in pts]
    ys = [p[1] for p in pts]
    parts, n = [], 0
    for r in rings:
        parts.append(n)
        n += len(r)
    body = struct.pack("<i4d", 5, min(xs), min(ys), max(xs), max(ys))
    body += struct.pack("<ii", len(rings), len(pts))
    body += struct.pack(f"<{len(parts)}i", *parts)
    body += b"".join(struct.pack("<2d", x, y) for x, y in pts)
    return body


def write_shapefile(stem, shapes, fields, records, deleted=()):
    """Minimal writer for tests: polygon shapes (None = null shape) + dbf."""
    recs = b""
    for i, shape in enumerate(shapes, start=1):
        content = struct.pack("<i", 0) if shape is None else _polygon_content(shape)
        recs += struct.pack(">ii", i, len(content) // 2) + content
    header = struct.pack(">i", 9994) + b"\x00" * 20 + struct.pack(">i", (100 + len(recs)) // 2)
    header += struct.pack("<ii", 1000, 5) + struct.pack("<4d", 0, 0, 0, 0) + b"\x00" * 32
    with open(stem + ".shp", "wb") as f:
        f.write(header + recs)
    header_len = 32 + 32 * len(fields) + 1
    rec_len = 1 + sum(f[2] for f in fields)
    dbf = struct.pack("<B3BIHH", 3, 124, 1, 1, len(records), header_len, rec_len) + b"\x00" * 20
    for name, ftype, length, dec in fields:
        dbf += name.encode().ljust(11, b"\x00") + ftype.encode() + b"\x00" * 4
        dbf += bytes([length, dec]) + b"\x00" * 14
    dbf += b"\x0d"
    for i, rec in enumerate(records):
        dbf += b"*" if i in deleted else b" "
        for (name, ftype, length, _), value in zip(fields, rec):
            text = "" if value is None else str(value)
            dbf += (text.rjust(length) if ftype in "NF" else text.ljust(length)).encode()
    dbf += b"\x1a"
    with open(stem + ".dbf", "wb") as f:
        f.write(dbf)


SQUARE = [(0, 0), (0, 4), (4, 4), (4, 0), (0, 0)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]
FAR = [(10, 10), (10, 12), (12, 12), (12, 10), (10, 10)]
FIELDS = [("GEN", "C", 12, 0), ("AGS", "N", 5, 0), ("AREA", "N", 8, 2), ("CITY", "L", 1, 0)]


def test_read_shapefile_types_rings_and_join(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/shp/sub")
    write_shapefile(
        f"{tmp_dir}/shp/communities",
        [[SQUARE, HOLE], None, [FAR], [FAR]],
        FIELDS,
        [("Holed", 1, 12.5, "T"), ("Nothing", 2, None, "F"), ("Far", 3, 4.0, None), ("Gone", 4, 1.0, "T")],
        deleted={3},
    )
    write_shapefile(f"{tmp_dir}/shp/sub/more", [[FAR]], FIELDS, [("Far2", 5, 4.0, "F")])
    com = read_shapefile(spark, f"{tmp_dir}/shp")
    assert com.columns == ["GEN", "AGS", "AREA", "CITY", "rings"]
    assert dict(com.dtypes) == {
        "GEN": "string", "AGS": "bigint", "AREA": "double", "CITY": "boolean",
        "rings": "array<array<struct<x:double,y:double>>>",
    }
    rows = {r.GEN: r for r in com.collect()}
    assert set(rows) == {"Holed", "Nothing", "Far", "Far2"}
    assert rows["Holed"].AGS == 1 and rows["Holed"].AREA == 12.5 and rows["Holed"].CITY is True
    assert rows["Nothing"].rings is None and rows["Nothing"].AREA is None
    assert len(rows["Holed"].rings) == 2 and rows["Holed"].rings[1][0].x == 1.0
    pts = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 11.0, 11.0), (4, 50.0, 50.0)], "id long, lon double, lat double"
    )
    got = {(r.id, r.GEN) for r in spatial_join(pts, com.where("rings IS NOT NULL")).collect()}
    assert got == {(1, "Holed"), (3, "Far"), (3, "Far2")}


def test_read_shapefile_declared_attributes(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/one")
    write_shapefile(f"{tmp_dir}/one/a", [[FAR]], FIELDS, [("Far", 3, 4.0, "F")])
    com = read_shapefile(spark, f"{tmp_dir}/one", attributes="GEN string, AGS string")
    assert [tuple(r)[:2] for r in com.collect()] == [("Far", "3")]


def test_upper_case_extensions_code_page_and_overflow(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    write_shapefile(f"{tmp_dir}/in/a", [[FAR], [SQUARE]], FIELDS, [("Mxn", "*****", 4.0, "F"), ("Plain", 7, "********", "T")])
    with open(f"{tmp_dir}/in/a.dbf", "rb") as f:
        data = f.read().replace(b"Mxn", b"M\xfcn")
    os.rename(f"{tmp_dir}/in/a.shp", f"{tmp_dir}/in/a.SHP")
    os.remove(f"{tmp_dir}/in/a.dbf")
    with open(f"{tmp_dir}/in/a.DBF", "wb") as f:
        f.write(data)
    with open(f"{tmp_dir}/in/a.cpg", "w") as f:
        f.write("ISO-8859-1")
    rows = {r.GEN: r for r in read_shapefile(spark, f"{tmp_dir}/in").collect()}
    assert set(rows) == {"Mün", "Plain"}
    assert rows["Mün"].AGS is None and rows["Plain"].AGS == 7 and rows["Plain"].AREA is None


def test_code_page_names():
    assert code_page(b"UTF-8", "x") == "utf-8" and code_page(b"1252", "x") == "cp1252"
    assert code_page(b"ISO 88591", "x") == "iso8859-1" and code_page(None, "utf-8") == "utf-8"
    assert code_page(b"no such page", "utf-8") == "utf-8"


def test_all_shape_families_and_forms(spark, tmp_dir):
    """Every type code, with null shapes between; and lines and points from files in the shape join."""
    from fieldatlas.fixtures import shapefile_bytes, write_files
    from fieldatlas.operators.shapes import shape_join
    from fieldatlas.sources.shapefile import KINDS, read_shapes

    parts = {
        "Point": [[(1.0, 2.0)]], "MultiPoint": [[(1.0, 2.0), (3.0, 4.0)]],
        "MultiLineString": [[(1.0, 1.0), (2.0, 2.0)], [(3.0, 3.0), (4.0, 4.0), (5.0, 3.0)]],
        "MultiPolygon": [[(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]],
    }
    for code, kind in KINDS.items():
        shp, dbf = shapefile_bytes(code, [parts[kind], [], parts[kind]], [f"a{code}", f"null{code}", f"b{code}"])
        write_files(spark, f"{tmp_dir}/all", {f"f{code}.shp": shp, f"f{code}.dbf": dbf})
    shapes = read_shapes(spark, f"{tmp_dir}/all")
    assert shapes.columns == ["NAME", "kind", "parts"]
    got = {r.NAME: (r.kind, r.parts and [[(p.x, p.y) for p in q] for q in r.parts]) for r in shapes.collect()}
    want = {f"{n}{code}": (kind, parts[kind]) for code, kind in KINDS.items() for n in "ab"}
    assert got == want | {f"null{code}": (None, None) for code in KINDS}
    square = spark.createDataFrame([("sq", [[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]])], "area string, rings array<array<struct<x:double,y:double>>>")
    assert {r.NAME for r in shape_join(shapes, square).collect()} == set(want)


def test_damaged_files_fail_the_read(spark, tmp_dir):
    import pytest

    from fieldatlas.fixtures import shapefile_bytes, write_files
    from fieldatlas.sources.shapefile import read_shapefile

    ring = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]]
    shp, dbf = shapefile_bytes(5, [ring, ring, ring], ["a", "b", "c"])
    record = (len(shp) - 100) // 3
    _, short = shapefile_bytes(5, [ring, ring], ["a", "b"])
    damaged = {
        "cut at a record": {"a.shp": shp[:-record], "a.dbf": dbf},
        "cut in a record": {"a.shp": shp[:-5], "a.dbf": dbf},
        "records cut": {"a.shp": shp, "a.dbf": dbf[:-41]},
        "fewer records": {"a.shp": shp, "a.dbf": short},
        "no records": {"a.shp": shp},
        "not a shapefile": {"a.shp": b"x" * 200, "a.dbf": dbf},
        "another type": {"a.shp": shp[:108] + b"\x1f" + shp[109:], "a.dbf": dbf},
    }
    write_files(spark, f"{tmp_dir}/whole", {"a.shp": shp, "a.dbf": dbf})
    assert read_shapefile(spark, f"{tmp_dir}/whole").count() == 3
    for k, (name, files) in enumerate(damaged.items()):
        write_files(spark, f"{tmp_dir}/{k}", files)
        with pytest.raises(Exception, match="damaged|no .dbf|not a .shp|cannot be read|shorter|longer"):
            read_shapefile(spark, f"{tmp_dir}/{k}", attributes="NAME string").collect()
            pytest.fail(name)
