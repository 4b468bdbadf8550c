"""Point-in-polygon join (``ST_Contains(polygon, point)``) as an equi join.

Plain Spark plans a theta join on a spatial predicate as a nested loop over
all pairs. Here it becomes an equi join on grid cells followed by an exact
refinement:

1. every polygon gets a *level*: cells of ``cell_size * 2**level`` degrees,
   the finest level at which its bounding box covers at most
   ``max_cells_per_polygon`` cells, and one row per covered cell that is
   not wholly outside it (see :func:`polygon_cells`);
2. every point gets one cell per level in use (usually a single level);
3. ``(level, cell_x, cell_y)`` is joined as an equi join, so Spark can use a
   broadcast hash join or a shuffled join with skew handling;
4. candidates in boundary cells are refined with the exact even-odd test
   with boundary exclusion (:func:`fieldatlas.functions.contains_point`).

A point falls into exactly one cell per level and a polygon uses exactly one
level, so every (point, polygon) pair meets at most once: no deduplication.
The result does not depend on the cell size; only the speed does.

Physical strategy, decided from two single-row aggregations over the
polygon side and forced by a join hint (Spark's own estimate cannot
override it):

* ``broadcast`` (broadcast hash join) when the polygon cells, edges
  included, are estimated below ``broadcast_limit_bytes``. The point side is
  never shuffled; skew among points cannot hurt.
* ``shuffle`` (sort-merge join, whose per-cell buffer of polygons spills)
  otherwise. Hot cells are split either by adaptive execution's
  skew-join handling (default when enabled: no extra pass) or by salting:
  cells holding more than ``rows_per_task`` points spread their points over
  ``ceil(n / rows_per_task)`` salt values and replicate their polygon cells
  once per salt value. The hot-cell table has at most
  ``points / rows_per_task`` rows and is only broadcast below the same byte
  limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions.geo import bbox, contains_point, contains_sql, polygon_edges
from fieldatlas.session import default_parallelism, materialize

_MAX_LEVEL = 60
_EDGE_BYTES = 56  # four doubles in a struct in an array: values, null bits, offset and size
_CELL_ROW_BYTES = 48
_HOT_ROW_BYTES = 40
_FINITE = 1.7e308  # largest magnitude treated as a coordinate


@dataclass(frozen=True)
class GridPlan:
    """What the planner decided, from statistics of the polygon side."""

    cell_size: float
    levels: tuple[int, ...]
    polygons: int
    cell_rows: int
    estimated_bytes: int
    strategy: str

    def size(self, level: int) -> float:
        return self.cell_size * (2.0**level)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def prepare_polygons(
    polygons: DataFrame, rings: str = "rings", attrs: list[str] | None = None
) -> DataFrame:
    """Attributes + edges + bounding box. Polygons without edges, or with a
    null, NaN or infinite coordinate (no finite box, or a gap in a ring), are
    left out. Edges run from their lower to their upper end, so that neighbours
    decide a shared border alike."""
    attrs = [c for c in polygons.columns if c != rings] if attrs is None else attrs
    with_edges = polygons.select(
        *[_q(c) for c in attrs], polygon_edges(rings, ordered=True).alias("_fa_edges")
    ).where(
        "size(_fa_edges) > 0 AND NOT exists(_fa_edges, e -> e.x1 IS NULL OR e.y1 IS NULL OR e.x2 IS NULL OR e.y2 IS NULL)"
    )
    minx, miny, maxx, maxy = bbox("_fa_edges")
    boxed = with_edges.select(
        "*",
        minx.alias("_fa_minx"),
        miny.alias("_fa_miny"),
        maxx.alias("_fa_maxx"),
        maxy.alias("_fa_maxy"),
    )
    finite = F.lit(True)
    for c in ("_fa_minx", "_fa_miny", "_fa_maxx", "_fa_maxy"):
        finite = finite & F.col(c).between(-_FINITE, _FINITE)
    return boxed.where(finite)


_SIZE = "(_fa_base * pow(2, _fa_level))"


def _with_level(geo: DataFrame, cell_size: float, max_cells: int) -> DataFrame:
    """Finest level whose cells of ``cell_size * 2**level`` degrees cover the
    polygon's box with at most ``max_cells`` cells."""
    # Cell counts in doubles, so an extreme extent cannot overflow a long.
    fits = f"""l -> (CAST(floor(_fa_maxx / (_fa_base * pow(2, l))) AS DOUBLE)
                   - CAST(floor(_fa_minx / (_fa_base * pow(2, l))) AS DOUBLE) + 1)
                  * (CAST(floor(_fa_maxy / (_fa_base * pow(2, l))) AS DOUBLE)
                   - CAST(floor(_fa_miny / (_fa_base * pow(2, l))) AS DOUBLE) + 1)
                  <= {int(max_cells)}"""
    return geo.select("*", F.lit(float(cell_size)).alias("_fa_base")).selectExpr(
        "*",
        f"coalesce(array_min(filter(sequence(0, {_MAX_LEVEL}), {fits})), {_MAX_LEVEL}) AS _fa_level",
    )


def plan_grid(
    geo: DataFrame,
    cell_size: float | None = None,
    max_cells_per_polygon: int = 1024,
    strategy: str = "auto",
    broadcast_limit_bytes: int = 64 << 20,
    cells_per_extent: int = 16,
) -> tuple[GridPlan, DataFrame]:
    """Choose the cell size, levels and join strategy; return the cell table.

    One single-row aggregation over the polygons, then the cell table is
    written once to the shared folder, so the statistics below and the join
    read it instead of building it again; nothing of the point side is read. The default cell size is the median polygon extent
    divided by ``cells_per_extent``.
    """
    ext = F.greatest(
        F.col("_fa_maxx") - F.col("_fa_minx"), F.col("_fa_maxy") - F.col("_fa_miny")
    )
    first = geo.agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(ext, 0.5).alias("m")
    ).first()
    if cell_size is None:
        median = first["m"]
        cell_size = float(median) / cells_per_extent if median and median > 0 else 1.0
    cells = materialize(
        polygon_cells(_with_level(geo, cell_size, max_cells_per_polygon), cell_size), "polygon-cells"
    )
    attr_cols = [c for c in cells.columns if not c.startswith("_fa_")]
    attr_bytes = (
        F.length(F.to_json(F.struct(*[_q(c) for c in attr_cols]))) if attr_cols else F.lit(0)
    )
    row_bytes = F.coalesce(F.size("_fa_edges"), F.lit(0)) * _EDGE_BYTES + _CELL_ROW_BYTES
    stats = cells.agg(
        F.collect_set("_fa_level").alias("levels"),  # at most _MAX_LEVEL + 1 values
        F.count(F.lit(1)).alias("cells"),
        F.sum(row_bytes + attr_bytes).alias("bytes"),
    ).first()
    est = int(stats["bytes"] or 0)
    if strategy == "auto":
        strategy = "broadcast" if est <= broadcast_limit_bytes else "shuffle"
    if strategy not in ("broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    plan = GridPlan(
        cell_size=cell_size,
        levels=tuple(sorted(stats["levels"] or [0])),
        polygons=int(first["n"]),
        cell_rows=int(stats["cells"] or 0),
        estimated_bytes=est,
        strategy=strategy,
    )
    return plan, cells


def polygon_cells(geo: DataFrame, cell_size: float) -> DataFrame:
    """One row per (polygon, cell) that can hold a contained point.

    Each covered cell, widened by a margin far above rounding error, is
    classified on the polygon side:

    * no edge's bounding box touches it: the cell lies wholly inside or wholly
      outside; its centre decides. Outside cells are dropped, inside cells
      match every point without a test (``_fa_boundary = false``);
    * otherwise it is a boundary cell and keeps only the edges that can
      matter for a point in it: those overlapping its latitude band and
      reaching its west side (the crossing ray runs east).
    """
    attrs = [f"`{c}`" for c in geo.columns if not c.startswith("_fa_")]
    keys = ["_fa_level", "_fa_cx", "_fa_cy"]
    # Rows of cells first: each row cuts its latitude band out of the polygon's
    # edges once, and its cells choose from that band only. Frames are widened
    # by a margin far above rounding error.
    banded = geo.selectExpr(
        *attrs, "_fa_edges", "_fa_minx", "_fa_maxx", "_fa_miny", "_fa_maxy", "_fa_level",
        f"{_SIZE} AS _fa_size",
    ).selectExpr(
        "*", "explode(sequence(floor(_fa_miny / _fa_size), floor(_fa_maxy / _fa_size))) AS _fa_cy",
    ).selectExpr(
        *attrs, "_fa_level", "_fa_size", "_fa_cy", "_fa_minx", "_fa_maxx",
        """filter(_fa_edges, e -> e.y2 >= _fa_cy * _fa_size - _fa_size * 1e-6
                              AND e.y1 <= (_fa_cy + 1) * _fa_size + _fa_size * 1e-6) AS _fa_row""",
    )
    framed = banded.selectExpr(
        "*", "explode(sequence(floor(_fa_minx / _fa_size), floor(_fa_maxx / _fa_size))) AS _fa_cx",
    ).selectExpr(
        *attrs, *keys, "_fa_row",
        "_fa_cx * _fa_size - _fa_size * 1e-6 AS _fa_x0",
        "(_fa_cx + 1) * _fa_size + _fa_size * 1e-6 AS _fa_x1",
        "(_fa_cx + 0.5D) * _fa_size AS _fa_mx",
        "(_fa_cy + 0.5D) * _fa_size AS _fa_my",
    )
    with_band = framed.selectExpr(
        *attrs, *keys, "_fa_x1", "_fa_mx", "_fa_my",
        "filter(_fa_row, e -> greatest(e.x1, e.x2) >= _fa_x0) AS _fa_band",
    )
    classified = with_band.selectExpr(
        *attrs, *keys, "_fa_band",
        "exists(_fa_band, e -> least(e.x1, e.x2) <= _fa_x1) AS _fa_boundary",
        f"{contains_sql('_fa_band', '_fa_mx', '_fa_my')} AS _fa_centre",
    )
    return classified.where("_fa_boundary OR _fa_centre").selectExpr(
        *attrs, *keys, "_fa_boundary", "IF(_fa_boundary, _fa_band, NULL) AS _fa_edges"
    )


def point_cells(points: DataFrame, plan: GridPlan, lon: str, lat: str) -> DataFrame:
    """One row per point and level in use (one row when one level is used).

    Points with a null, NaN or infinite coordinate get no cell and so match
    nothing (``between`` is false for NaN and infinities in Spark).
    """
    x, y = _q(lon), _q(lat)
    finite = x.between(-_FINITE, _FINITE) & y.between(-_FINITE, _FINITE)

    def cell(c, size):
        return F.when(finite, F.floor(c / F.lit(size)))

    if len(plan.levels) == 1:
        lv = plan.levels[0]
        size = plan.size(lv)
        return points.select(
            "*",
            F.lit(lv).alias("_fa_level"),
            cell(x, size).alias("_fa_cx"),
            cell(y, size).alias("_fa_cy"),
        )
    keys = F.array(
        *[
            F.struct(
                F.lit(lv).alias("l"),
                cell(x, plan.size(lv)).alias("cx"),
                cell(y, plan.size(lv)).alias("cy"),
            )
            for lv in plan.levels
        ]
    )
    return (
        points.withColumn("_fa_k", F.explode(keys))
        .withColumn("_fa_level", F.col("_fa_k.l"))
        .withColumn("_fa_cx", F.col("_fa_k.cx"))
        .withColumn("_fa_cy", F.col("_fa_k.cy"))
        .drop("_fa_k")
    )


_KEYS = ["_fa_level", "_fa_cx", "_fa_cy"]


def _refine(lon: str, lat: str) -> Column:
    inside = contains_point("_fa_edges", lon, lat)
    return ~F.col("_fa_boundary") | inside


def _salted(
    pts: DataFrame,
    cells: DataFrame,
    rows_per_task: int,
    broadcast_limit_bytes: int,
) -> tuple[DataFrame, DataFrame]:
    """Spread points of hot cells over salt values; replicate their polygon cells."""
    hot = (
        pts.groupBy(*_KEYS)
        .agg(F.count(F.lit(1)).alias("_fa_n"))  # partial aggregation, one row per cell
        .where(F.col("_fa_n") > rows_per_task)
        .select(*_KEYS, F.ceil(F.col("_fa_n") / F.lit(rows_per_task)).alias("_fa_salts"))
    )
    n_hot = hot.count()  # bounded by points / rows_per_task
    if n_hot == 0:
        return pts.withColumn("_fa_salt", F.lit(0)), cells.withColumn("_fa_salt", F.lit(0))
    hot_side = F.broadcast(hot) if n_hot * _HOT_ROW_BYTES <= broadcast_limit_bytes else hot
    salts = F.coalesce(F.col("_fa_salts"), F.lit(1))
    pts = pts.join(hot_side, _KEYS, "left").withColumn(
        "_fa_salt", F.pmod(F.xxhash64(*[_q(c) for c in pts.columns if not c.startswith("_fa_")]), salts).cast("int")
    )
    cells = cells.join(hot_side, _KEYS, "left").withColumn(
        "_fa_salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int")))
    )
    return pts.drop("_fa_salts"), cells.drop("_fa_salts")


def _skew_mode(points: DataFrame, skew: str) -> str:
    """How hot cells are split in the shuffled strategy.

    ``aqe``: adaptive execution splits a skewed join partition at run time by
    ranges of map output, so even a single cell holding a third of all points
    is spread over several tasks, with no extra pass. ``salt``: one extra
    aggregation over the points finds cells above ``rows_per_task`` and
    salts them; it works whatever the session settings. ``auto`` picks
    ``aqe`` when the session has adaptive skew-join handling on.
    """
    if skew not in ("auto", "aqe", "salt"):
        raise ValueError(f"unknown skew mode {skew!r}")
    if skew != "auto":
        return skew
    conf = points.sparkSession.conf
    on = lambda k, d: (conf.get(k, d) or d).lower() == "true"
    aqe = on("spark.sql.adaptive.enabled", "true") and on(
        "spark.sql.adaptive.skewJoin.enabled", "true"
    )
    return "aqe" if aqe else "salt"


def _out_names(point_names: list[str], polygon_names: list[str], prefix: str) -> list[str]:
    """Output names of the polygon attributes: prefixed until no other output
    column has the name, in any case (Spark does not tell cases apart)."""
    taken, out = {c.lower() for c in point_names}, []
    for name in polygon_names:
        while name.lower() in taken:
            name = prefix + name
        taken.add(name.lower())
        out.append(name)
    return out


def spatial_join(
    points: DataFrame,
    polygons: DataFrame,
    *,
    lon: str = "lon",
    lat: str = "lat",
    rings: str = "rings",
    cell_size: float | None = None,
    max_cells_per_polygon: int = 1024,
    cells_per_extent: int = 16,
    strategy: str = "auto",
    broadcast_limit_bytes: int = 64 << 20,
    rows_per_task: int = 2_000_000,
    collision_prefix: str = "community_",
    min_partitions: int | None = None,
    skew: str = "auto",
    return_plan: bool = False,
):
    """Inner join of points with the polygons that contain them.

    Output columns: point columns except ``lon``/``lat``, then polygon
    attribute columns (a name already used, in any case, is prefixed with
    ``collision_prefix`` until it is free), then ``lon``, ``lat`` last. Unmatched points
    are dropped, a point inside two polygons yields two rows, and a point with
    a null, NaN or infinite coordinate, or lying on a polygon's boundary,
    matches nothing.

    ``cell_size`` (default: median polygon extent / ``cells_per_extent``) and
    ``max_cells_per_polygon`` shape the grid; ``strategy`` is ``auto``,
    ``broadcast`` or ``shuffle``; ``skew`` (``auto``, ``aqe``, ``salt``) and
    ``rows_per_task`` govern hot cells in the shuffled strategy;
    ``min_partitions`` deals the points round-robin over that many partitions
    before the per-point test, for a point side that arrives in one piece (a
    single Parquet row group, a gzip file); ``return_plan`` also returns the
    :class:`GridPlan`. The polygons are always dealt over the cluster's cores.
    """
    point_attrs = [c for c in points.columns if c not in (lon, lat)]
    poly_attrs = [c for c in polygons.columns if c != rings]
    out_poly = _out_names(points.columns, poly_attrs, collision_prefix)
    # Inside the join the attributes have names that no column of either side has.
    inner = _out_names([*points.columns, rings], [f"_polygon_{i}" for i in range(len(poly_attrs))], "_")
    renamed = polygons.select(
        *[_q(c).alias(n) for c, n in zip(poly_attrs, inner)], _q(rings)
    ).repartition(default_parallelism(polygons.sparkSession))

    geo = prepare_polygons(renamed, rings)
    plan, cells = plan_grid(
        geo, cell_size, max_cells_per_polygon, strategy, broadcast_limit_bytes,
        cells_per_extent,
    )
    if min_partitions and not points.isStreaming:
        points = points.repartition(min_partitions)
    pts = point_cells(points, plan, lon, lat)

    if plan.strategy == "broadcast":
        joined = pts.join(F.broadcast(cells), _KEYS, "inner")
    elif _skew_mode(points, skew) == "aqe":
        # Sort-merge, whatever Spark's own size estimate: the polygons of one
        # cell are a buffer that spills, where a hash build could not.
        joined = pts.join(cells.hint("merge"), _KEYS, "inner")
    else:
        pts, cells = _salted(pts, cells, rows_per_task, broadcast_limit_bytes)
        joined = pts.join(cells.hint("merge"), _KEYS + ["_fa_salt"], "inner")
    result = joined.where(_refine(lon, lat)).select(
        *[_q(c) for c in point_attrs],
        *[_q(n).alias(c) for n, c in zip(inner, out_poly)],
        _q(lon),
        _q(lat),
    )
    return (result, plan) if return_plan else result
