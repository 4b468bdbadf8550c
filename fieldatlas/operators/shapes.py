"""Shapes of any kind in polygons (``ST_Contains(polygon, shape)``): points, lines and polygons.

A polygon contains a shape if no part of the shape lies outside and some of
its inside lies inside. The join decides that piece by piece on the cells of
the point join (:mod:`fieldatlas.operators.spatial`):

1. *Candidates.* A contained shape has its first vertex in the polygon, so an
   equi join of that vertex's cell finds the pairs worth testing; boxes must nest.
2. *Crossings.* Each segment of a candidate meets the boundary cells of its
   polygon that it runs through. Edges there cut it at the places where it
   crosses, touches or leaves them.
3. *Sides.* Between two cuts a segment keeps its side, so the middle of every
   piece is looked up in the polygon's cells: inside, on the boundary (pieces
   along an edge are known to be) or outside.
4. *Decision.* One aggregate over all pieces of a pair: none outside, and one
   inside. A polygon is inside if one point of its inside is, and if no
   edge of the other polygon (a hole's, say) runs through its inside.

All steps are Spark expressions and equi joins on (polygon, cell); a shape's
segments and a polygon's cells are dealt over the tasks like rows of any kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions.geo import contains_sql, on_edge_sql, polygon_edges
from fieldatlas.operators.spatial import _out_names, _q, plan_grid, point_cells, prepare_polygons
from fieldatlas.session import default_parallelism, materialize

POINTS, LINES, POLYGONS = ("Point", "MultiPoint"), ("LineString", "MultiLineString"), ("Polygon", "MultiPolygon")
#: Pieces shorter than this share of their segment are rounding, not pieces.
LEAST_PIECE = 1e-9


def _in(kinds: tuple[str, ...]) -> str:
    return "_fa_kind IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"


def segments_sql(parts: str) -> str:
    """All segments of ``parts`` as ``array<struct<x1,y1,x2,y2>>``: rings closed, points as segments of length zero."""
    step = "named_struct('x1', r[i].x, 'y1', r[i].y, 'x2', r[j].x, 'y2', r[j].y)"
    line = step.replace("[j]", "[i + 1]")
    point = step.replace("[j]", "[i]")
    return f"""CASE
      WHEN {_in(POINTS)} THEN flatten(transform(filter({parts}, r -> size(r) > 0), r -> transform(sequence(0, size(r) - 1), i -> {point})))
      WHEN {_in(LINES)} THEN flatten(transform(filter({parts}, r -> size(r) > 1), r -> transform(sequence(0, size(r) - 2), i -> {line})))
    END"""


# A segment runs from (px, py) by (dx, dy); places on it are numbers from 0 to 1.
_DEN = "(dx * (e.y2 - e.y1) - dy * (e.x2 - e.x1))"
_AT = "(((e.x1 - px) * (e.y2 - e.y1) - (e.y1 - py) * (e.x2 - e.x1)) / {den})"
_ON = "(((e.x1 - px) * dy - (e.y1 - py) * dx) / {den})"
_FLAT = "((e.x1 - px) * dy = (e.y1 - py) * dx)"
_FROM = "(((e.x1 - px) * dx + (e.y1 - py) * dy) / (dx * dx + dy * dy))"
_TO = "(((e.x2 - px) * dx + (e.y2 - py) * dy) / (dx * dx + dy * dy))"


def _named(text: str, px: str, py: str, dx: str, dy: str) -> str:
    text = text.format(den=_DEN)
    for name, value in (("px", px), ("py", py), ("dx", dx), ("dy", dy)):
        text = text.replace(name, value)
    return text


def cuts_sql(edges: str, px="px", py="py", dx="dx", dy="dy") -> str:
    """``array<struct<a,b>>``: where ``edges`` meet a segment. A crossing or touch has ``a = b``; an edge along the segment has both its ends."""
    w = lambda text: _named(text, px, py, dx, dy)
    return f"""flatten(transform({edges}, e -> CASE
      WHEN {w('dx')} = 0 AND {w('dy')} = 0 THEN CAST(array() AS array<struct<a:double,b:double>>)
      WHEN {w(_DEN)} <> 0 THEN IF({w(_ON)} BETWEEN -{LEAST_PIECE}D AND 1 + {LEAST_PIECE}D AND {w(_AT)} BETWEEN 0 AND 1,
                           array(named_struct('a', {w(_AT)}, 'b', {w(_AT)})), CAST(array() AS array<struct<a:double,b:double>>))
      WHEN {w(_FLAT)} THEN array(named_struct('a', least({w(_FROM)}, {w(_TO)}), 'b', greatest({w(_FROM)}, {w(_TO)})))
      ELSE CAST(array() AS array<struct<a:double,b:double>>) END))"""


def pieces_sql(cuts: str) -> str:
    """``array<struct<t,along>>``: the middle of every piece between ``cuts``, and whether it lies along an edge."""
    places = f"""array_sort(array_distinct(concat(array(0D, 1D),
        filter(flatten(transform({cuts}, c -> array(c.a, c.b))), t -> t > 0 AND t < 1))))"""
    middles = f"""transform(filter(transform(sequence(1, size({places}) - 1), i -> named_struct('a', {places}[i - 1], 'b', {places}[i])),
        p -> p.b - p.a > {LEAST_PIECE}D), p -> (p.a + p.b) / 2)"""
    return f"transform({middles}, t -> named_struct('t', t, 'along', exists({cuts}, c -> c.a < t AND t < c.b)))"


def inside_point(edges: str) -> Column:
    """``struct<x,y>``: a point inside a polygon, from its edges (lower end first); null without an inside.

    It lies in the middle of the widest stretch of a scan line halfway between
    the two neighbouring vertex latitudes that lie farthest apart beside the
    tallest edge, which crosses that line.
    """
    tallest = f"array_max(transform({edges}, e -> named_struct('h', e.y2 - e.y1, 'low', e.y1, 'high', e.y2)))"
    lats = f"array_sort(array_distinct(filter(flatten(transform({edges}, e -> array(e.y1, e.y2))), l -> l BETWEEN _fa_t.low AND _fa_t.high)))"
    y = """array_max(transform(sequence(1, size(_fa_lats) - 1), i ->
        named_struct('gap', _fa_lats[i] - _fa_lats[i - 1], 'y', (_fa_lats[i] + _fa_lats[i - 1]) / 2))).y"""
    xs = f"""array_sort(transform(filter({edges}, e -> (e.y1 > _fa_y) <> (e.y2 > _fa_y)),
        e -> (e.x2 - e.x1) * (_fa_y - e.y1) / (e.y2 - e.y1) + e.x1))"""
    x = """array_max(transform(sequence(0, size(_fa_xs) div 2 - 1), k ->
        named_struct('gap', _fa_xs[2 * k + 1] - _fa_xs[2 * k], 'x', (_fa_xs[2 * k + 1] + _fa_xs[2 * k]) / 2))).x"""
    # One-element transforms stand for names, so each step is worked out once.
    step = f"transform(array({xs}), _fa_xs -> IF(size(_fa_xs) < 2, NULL, named_struct('x', {x}, 'y', _fa_y)))[0]"
    step = f"transform(array({y}), _fa_y -> {step})[0]"
    step = f"transform(array({lats}), _fa_lats -> {step})[0]"
    return F.expr(f"IF(size({edges}) = 0, NULL, transform(array({tallest}), _fa_t -> IF(_fa_t.h = 0, NULL, {step}))[0])")


def _stored_shapes(shapes: DataFrame, kind: str, parts: str) -> DataFrame:
    """Shapes with a key, their segments and box; without those that are empty or have a coordinate that is not finite."""
    named = shapes.select(
        *[_q(c).alias(f"_shape_{i}") for i, c in enumerate(shapes.columns)], _q(kind).alias("_fa_kind"), _q(parts).alias("_fa_parts")
    ).where(F.expr(_in(POINTS + LINES + POLYGONS)))
    ring = polygon_edges("_fa_parts", ordered=True)
    edges = F.when(F.expr(_in(POLYGONS)), ring).otherwise(F.expr(segments_sql("_fa_parts")))
    out = named.withColumn("_fa_segments", edges).drop("_fa_parts")
    for name, low, c in (("minx", "min", "x"), ("miny", "min", "y"), ("maxx", "max", "x"), ("maxy", "max", "y")):
        pick = "least" if low == "min" else "greatest"
        out = out.withColumn(f"_s_{name}", F.expr(f"array_{low}(transform(_fa_segments, e -> {pick}(e.{c}1, e.{c}2)))"))
    whole = "size(_fa_segments) > 0 AND NOT exists(_fa_segments, e -> e.x1 IS NULL OR e.y1 IS NULL OR e.x2 IS NULL OR e.y2 IS NULL)"
    finite = " AND ".join(f"_s_{c} BETWEEN -1.7e308 AND 1.7e308" for c in ("minx", "miny", "maxx", "maxy"))
    out = out.where(f"{whole} AND {finite}").withColumn("_fa_inside", F.when(F.expr(_in(POLYGONS)), inside_point("_fa_segments")))
    out = out.where(F.col("_fa_inside").isNotNull() | ~F.expr(_in(POLYGONS)))
    # Keys are settled when the shapes are stored.
    return materialize(out.withColumn("_s", F.monotonically_increasing_id()), "shapes")


_CELL = ["_p", "_fa_level", "_fa_cx", "_fa_cy"]


def _segment_cells(segments: DataFrame) -> DataFrame:
    """One row per cell that a segment runs through: rows of cells first, then the stretch of each that the segment spans."""
    low, high = "least(py, py + dy)", "greatest(py, py + dy)"
    rows = segments.withColumn("_fa_cy", F.expr(f"explode(sequence(floor({low} / _fa_size), floor({high} / _fa_size)))"))
    # Where the segment enters and leaves the row, a millionth of a cell wider.
    at = lambda y: f"IF(dy = 0, NULL, px + dx * greatest(0D, least(1D, ({y} - py) / dy)))"
    one, two = at("(_fa_cy * _fa_size - _fa_size * 1e-6D)"), at("((_fa_cy + 1) * _fa_size + _fa_size * 1e-6D)")
    first = f"IF(dy = 0, least(px, px + dx), least({one}, {two}))"
    last = f"IF(dy = 0, greatest(px, px + dx), greatest({one}, {two}))"
    return rows.withColumn("_fa_cx", F.expr(f"explode(sequence(floor({first} / _fa_size - 1e-6D), floor({last} / _fa_size + 1e-6D)))"))


def shape_join(
    shapes: DataFrame,
    polygons: DataFrame,
    *,
    kind: str = "kind",
    parts: str = "parts",
    rings: str = "rings",
    cell_size: float | None = None,
    max_cells_per_polygon: int = 1024,
    collision_prefix: str = "community_",
) -> DataFrame:
    """Inner join of shapes with the polygons that contain them: shape columns, then polygon attributes.

    ``kind`` is a GeoJSON geometry type and ``parts`` its coordinates as
    ``array<array<struct<x,y>>>``: one list of positions for (multi)points, one
    a line, one a ring. As in the Simple Features rules, a shape may touch the
    boundary but must have inside points in the polygon: a point or a line on
    the boundary is not contained, a polygon is contained in itself. Shapes of
    other kinds, without positions, with a coordinate that is null or not
    finite, and polygons without area, match nothing. Names that both sides
    have are prefixed as in the point join. The cells shape the work only.
    """
    spark = shapes.sparkSession
    stored = _stored_shapes(shapes, kind, parts)
    attrs = [c for c in polygons.columns if c != rings]
    inner = [f"_polygon_{i}" for i in range(len(attrs))]
    # Keyed and stored once: a key must not change between the joins below.
    keyed = polygons.repartition(default_parallelism(spark)).select(
        F.monotonically_increasing_id().alias("_p"), *[_q(c).alias(n) for c, n in zip(attrs, inner, strict=True)], _q(rings).alias("_rings")
    )
    keyed = materialize(keyed, "shape-polygons")
    geo = prepare_polygons(keyed.select("_p", "_rings"), "_rings")
    boxes = [f"_p_{c}" for c in ("minx", "miny", "maxx", "maxy")]
    geo = geo.withColumns({b: F.col(f"_fa{b[2:]}") for b in boxes})
    plan, cells = plan_grid(geo, cell_size, max_cells_per_polygon, strategy="shuffle")

    first = stored.select("_s", "_fa_kind", *[f"_s{b[2:]}" for b in boxes], F.expr("_fa_segments[0].x1").alias("_x"), F.expr("_fa_segments[0].y1").alias("_y"))
    nested = "_s_minx >= _p_minx AND _s_miny >= _p_miny AND _s_maxx <= _p_maxx AND _s_maxy <= _p_maxy"
    candidates = point_cells(first, plan, "_x", "_y").join(cells, ["_fa_level", "_fa_cx", "_fa_cy"]).where(nested)
    size = f"({plan.cell_size!r}D * pow(2, _fa_level))"
    pairs = materialize(candidates.select("_s", "_p", "_fa_level", F.expr(size).alias("_fa_size")), "shape-candidates")

    segments = stored.select("_s", F.posexplode("_fa_segments").alias("_i", "e")).selectExpr("_s", "_i", "e.x1 AS px", "e.y1 AS py", "e.x2 - e.x1 AS dx", "e.y2 - e.y1 AS dy")
    open_ = pairs.join(segments, "_s")
    slim = cells.select(*_CELL, "_fa_boundary", "_fa_edges")
    crossed = _segment_cells(open_).join(slim.where("_fa_boundary"), _CELL, "left")
    keys = ["_s", "_p", "_i", "_fa_level", "_fa_size", "px", "py", "dx", "dy"]
    cut = crossed.select(*keys, F.when(F.col("_fa_edges").isNotNull(), F.expr(cuts_sql("_fa_edges"))).alias("c"))
    cut = cut.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_list("c"))).alias("c"))
    probes = cut.select(*keys, F.explode(F.expr(pieces_sql("c"))).alias("m")).selectExpr(
        "_s", "_p", "_fa_level", "_fa_size", "px + m.t * dx AS x", "py + m.t * dy AS y", "m.along AS along", "false AS must"
    )
    middle = pairs.join(stored.where("_fa_inside IS NOT NULL").select("_s", "_fa_inside"), "_s").selectExpr(
        "_s", "_p", "_fa_level", "_fa_size", "_fa_inside.x AS x", "_fa_inside.y AS y", "false AS along", "true AS must"
    )
    looked_up = probes.union(middle).withColumns({"_fa_cx": F.expr("floor(x / _fa_size)"), "_fa_cy": F.expr("floor(y / _fa_size)")}).join(slim, _CELL, "left")
    side = f"""CASE WHEN along THEN 0 WHEN _fa_boundary IS NULL THEN -1 WHEN NOT _fa_boundary THEN 1
               WHEN {contains_sql('_fa_edges', 'x', 'y')} THEN 1 WHEN {on_edge_sql('_fa_edges', 'x', 'y')} THEN 0 ELSE -1 END"""
    sided = looked_up.select("_s", "_p", "must", F.expr(side).alias("side"))
    decided = sided.groupBy("_s", "_p").agg(
        F.min(F.when(~F.col("must"), F.col("side"))).alias("worst"), F.max("side").alias("best"), F.min(F.when(F.col("must"), F.col("side"))).alias("middle")
    )
    inside = materialize(decided.where("worst >= 0 AND best = 1 AND coalesce(middle, 1) = 1").select("_s", "_p"), "shapes-inside")

    # Polygons: edges of the other polygon inside them are gaps they would cover.
    areas = inside.join(pairs, ["_s", "_p"]).join(stored.where("_fa_inside IS NOT NULL").select("_s", F.col("_fa_segments").alias("own"), *[f"_s{b[2:]}" for b in boxes]), "_s")
    spread = areas.withColumn("_fa_cy", F.expr("explode(sequence(floor(_s_miny / _fa_size), floor(_s_maxy / _fa_size)))"))
    spread = spread.withColumn("_fa_cx", F.expr("explode(sequence(floor(_s_minx / _fa_size), floor(_s_maxx / _fa_size)))"))
    met = spread.join(slim.where("_fa_boundary"), _CELL).withColumn("g", F.explode("_fa_edges")).where(
        "least(g.x1, g.x2) < _s_maxx AND greatest(g.x1, g.x2) > _s_minx AND g.y1 < _s_maxy AND g.y2 > _s_miny OR "
        "g.y1 = g.y2 AND g.y1 > _s_miny AND g.y1 < _s_maxy AND least(g.x1, g.x2) < _s_maxx AND greatest(g.x1, g.x2) > _s_minx"
    )
    line = met.selectExpr("_s", "_p", "own", "g.x1 AS px", "g.y1 AS py", "g.x2 - g.x1 AS dx", "g.y2 - g.y1 AS dy")
    gaps = line.withColumn("c", F.expr(cuts_sql("own"))).withColumn("m", F.explode(F.expr(pieces_sql("c")))).where("NOT m.along")
    gaps = gaps.selectExpr("_s", "_p", "own", "px + m.t * dx AS x", "py + m.t * dy AS y").where(contains_sql("own", "x", "y"))
    kept = inside.join(gaps.select("_s", "_p").distinct(), ["_s", "_p"], "left_anti")

    out_poly = _out_names(shapes.columns, attrs, collision_prefix)
    given = [F.col(f"_shape_{i}").alias(c) for i, c in enumerate(shapes.columns)]
    joined = kept.join(stored.select("_s", *[f"_shape_{i}" for i in range(len(shapes.columns))]), "_s").join(keyed.drop("_rings"), "_p")
    return joined.select(*given, *[F.col(n).alias(o) for n, o in zip(inner, out_poly, strict=True)])
