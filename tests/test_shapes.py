"""Shapes in polygons: hand-made cases at several cell sizes, and random shapes against exact arithmetic."""

import random
from fractions import Fraction

import pytest

from fieldatlas.operators.shapes import shape_join
from fieldatlas.sources.geojson import read_features, shape_columns

SHAPE = "id string, kind string, parts array<array<struct<x:double,y:double>>>, want int"


def P(*positions):
    return [(float(x), float(y)) for x, y in positions]


SQUARE = [P((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)), P((4, 4), (6, 4), (6, 6), (4, 6), (4, 4))]
CUP = [P((20, 0), (30, 0), (30, 10), (26, 10), (26, 2), (24, 2), (24, 10), (20, 10))]
CASES = [
    ("point inside", "Point", [P((1, 1))], 1),
    ("point on an edge", "Point", [P((0, 1))], 0),
    ("point in the hole", "Point", [P((5, 5))], 0),
    ("line inside", "LineString", [P((1, 1), (9, 1), (9, 9))], 1),
    ("line through the hole", "LineString", [P((1, 5), (9, 5))], 0),
    ("line on the border", "LineString", [P((0, 1), (0, 9))], 0),
    ("line on the border and inside", "LineString", [P((0, 1), (0, 9), (2, 9))], 1),
    ("line on the hole's edge", "LineString", [P((4, 4), (6, 4))], 0),
    ("line along the hole's edge", "LineString", [P((1, 4), (9, 4))], 1),
    ("line that leaves", "LineString", [P((1, 1), (11, 1))], 0),
    ("line that touches the border", "LineString", [P((1, 1), (0, 5), (1, 9))], 1),
    ("line through a corner of the hole", "LineString", [P((3, 5), (5, 3))], 1),
    ("polygon inside", "Polygon", [P((1, 1), (3, 1), (3, 3), (1, 3))], 1),
    ("polygon around the hole", "Polygon", [P((3, 3), (7, 3), (7, 7), (3, 7))], 0),
    ("polygon that is the hole", "Polygon", [P((4, 4), (6, 4), (6, 6), (4, 6))], 0),
    ("the polygon itself", "Polygon", SQUARE, 1),
    ("the polygon without its hole", "Polygon", SQUARE[:1], 0),
    ("polygon with the same hole", "Polygon", [P((3, 3), (7, 3), (7, 7), (3, 7)), SQUARE[1]], 1),
    ("polygon with a larger hole", "Polygon", [P((2, 2), (8, 2), (8, 8), (2, 8)), P((3, 3), (7, 3), (7, 7), (3, 7))], 1),
    ("polygon over half the hole", "Polygon", [P((3, 3), (5, 3), (5, 5), (3, 5))], 0),
    ("polygon at the hole's corner", "Polygon", [P((4, 4), (2, 4), (2, 2), (4, 2))], 1),
    ("line across the cup's gap", "LineString", [P((21, 5), (29, 5))], 0),
    ("line round the cup's gap", "LineString", [P((21, 9), (21, 1), (29, 1), (29, 9))], 1),
    ("polygon over the cup's gap", "Polygon", [P((21, 1), (29, 1), (29, 9), (21, 9))], 0),
    ("line over the cup's mouth", "LineString", [P((21, 10), (29, 10))], 0),
    ("points inside and on the border", "MultiPoint", [P((1, 1), (0, 0))], 1),
    ("points on the border", "MultiPoint", [P((0, 1), (0, 0))], 0),
    ("lines inside", "MultiLineString", [P((1, 1), (2, 2)), P((8, 8), (9, 9))], 1),
    ("polygons inside", "MultiPolygon", [P((1, 1), (2, 1), (2, 2)), P((8, 8), (9, 8), (9, 9))], 1),
    ("polygons, one outside", "MultiPolygon", [P((1, 1), (2, 1), (2, 2)), P((8, 8), (11, 8), (9, 9))], 0),
    ("a line of one place", "LineString", [P((1, 1), (1, 1))], 1),
    ("a null coordinate", "LineString", [[(1.0, None), (2.0, 2.0)]], 0),
    ("not finite", "LineString", [[(1.0, float("nan")), (2.0, float("inf"))]], 0),
    ("no positions", "LineString", [], 0),
    ("no parts", "Polygon", None, 0),
    ("no area", "Polygon", [P((1, 1), (2, 1), (1, 1))], 0),
    ("another kind", "Curve", [P((1, 1))], 0),
    (None, None, None, 0),
]


@pytest.fixture(scope="module")
def polygons(spark):
    rows = [("square", "s", SQUARE), ("cup", "c", CUP), ("none", "n", None), ("empty", "e", [])]
    return spark.createDataFrame(rows, "id string, KIND string, rings array<array<struct<x:double,y:double>>>")


@pytest.mark.parametrize("cell_size", [None, 0.7, 50.0])
def test_cases(spark, polygons, cell_size):
    out = shape_join(spark.createDataFrame(CASES, SHAPE), polygons, cell_size=cell_size)
    assert out.columns == ["id", "kind", "parts", "want", "community_id", "community_KIND"]
    rows = out.collect()
    assert sorted(r.id for r in rows) == sorted(c[0] for c in CASES if c[3])
    assert all(r.community_id == ("cup" if "cup" in r.id else "square") for r in rows)


def test_empty_sides(spark, polygons):
    shapes = spark.createDataFrame(CASES, SHAPE)
    assert shape_join(shapes.limit(0), polygons).count() == 0
    assert shape_join(shapes, polygons.limit(0)).count() == 0


def _side(rings, x, y):
    """1 inside, 0 on an edge, -1 outside; exact."""
    inside = False
    for (x1, y1), (x2, y2) in _edges(rings):
        if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return 0
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return 1 if inside else -1


def _edges(rings):
    for r in rings:
        for a, b in zip(r, r[1:] + r[:1], strict=True):
            if a != b:
                yield a, b


def _sides(segments, rings):
    """The sides of all pieces of the segments, cut at every edge; exact."""
    for (px, py), (qx, qy) in segments:
        dx, dy, cuts = qx - px, qy - py, {Fraction(0), Fraction(1)}
        for (x1, y1), (x2, y2) in _edges(rings):
            den = dx * (y2 - y1) - dy * (x2 - x1)
            if den:
                if 0 <= ((x1 - px) * dy - (y1 - py) * dx) / den <= 1:
                    cuts.add(((x1 - px) * (y2 - y1) - (y1 - py) * (x2 - x1)) / den)
            elif (x1 - px) * dy == (y1 - py) * dx and (dx or dy):
                cuts |= {((x - px) * dx + (y - py) * dy) / (dx * dx + dy * dy) for x, y in ((x1, y1), (x2, y2))}
        cuts = sorted(c for c in cuts if 0 <= c <= 1)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield _side(rings, px + (a + b) / 2 * dx, py + (a + b) / 2 * dy)


def _contains(rings, kind, part):
    exact = lambda r: [(Fraction(x), Fraction(y)) for x, y in r]
    rings, part = [exact(r) for r in rings], exact(part)
    if kind == "Point":
        return _side(rings, *part[0]) == 1
    segments = list(zip(part, part[1:], strict=False)) if kind == "LineString" else list(_edges([part]))
    sides = list(_sides(segments, rings))
    if min(sides) < 0:
        return False
    if kind == "LineString":
        return max(sides) == 1
    # A convex polygon: its middle is inside it.
    middle = (sum(x for x, _ in part) / len(part), sum(y for _, y in part) / len(part))
    return _side(rings, *middle) == 1 and all(s < 1 for s in _sides(_edges(rings), [part]))


def test_random_shapes_against_exact_arithmetic(spark):
    """Small integer coordinates, so shapes often touch, follow and cross borders."""
    r = random.Random(5)
    rings = [P((0, 0), (12, 0), (12, 8), (6, 4), (0, 8)), P((2, 2), (4, 2), (4, 4)), P((8, 1), (10, 1), (10, 3), (8, 3))]
    polys = spark.createDataFrame([("p", rings)], "name string, rings array<array<struct<x:double,y:double>>>")
    rows = []
    for k in range(400):
        x, y, w, h = r.randrange(-1, 12), r.randrange(-1, 8), r.randrange(1, 5), r.randrange(1, 5)
        kind = r.choice(["Point", "LineString", "LineString", "Polygon", "Polygon"])
        part = {"Point": [(x, y)], "LineString": [(x, y)] + [(r.randrange(0, 13), r.randrange(0, 9)) for _ in range(r.randrange(1, 3))]}.get(
            kind, r.choice([[(x, y), (x + w, y), (x + w, y + h), (x, y + h)], [(x, y), (x + w, y), (x, y + h)]])
        )
        rows.append((str(k), kind, [P(*part)], 0))
    want = {i for i, kind, parts, _ in rows if _contains(rings, kind, parts[0])}
    got = [s.id for s in shape_join(spark.createDataFrame(rows, SHAPE), polys, cell_size=0.9).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 20 < len(want) < 300


def test_geojson_shapes(spark, polygons, tmp_dir):
    lines = [
        '{"type":"Feature","properties":{"id":"a"},"geometry":{"type":"MultiPolygon","coordinates":[[[[1,1],[2,1],[2,2],[1,1]]],[[[8,8],[9,8],[9,9],[8,8]]]]}}',
        '{"type":"Feature","properties":{"id":"b"},"geometry":{"type":"MultiLineString","coordinates":[[[1,1],[2,2]],[[3,5],[7,5]]]}}',
        '{"type":"Feature","properties":{"id":"c"},"geometry":{"type":"MultiPoint","coordinates":[[1,1],[2,2.5]]}}',
        '{"type":"Feature","properties":{"id":"d"},"geometry":null}',
        '{"type":"Feature","properties":{"id":"e"},"geometry":{"type":"Point","coordinates":[21,1,7]}}',
    ]
    spark.createDataFrame([(t,) for t in lines], "value string").write.text(f"{tmp_dir}/shapes")
    shapes = shape_columns(read_features(spark, f"{tmp_dir}/shapes", layout="lines"), "id string")
    assert shapes.columns == ["id", "kind", "parts"]
    got = {(r.id, r.community_id) for r in shape_join(shapes, polygons).collect()}
    assert got == {("a", "square"), ("c", "square"), ("e", "cup")}
