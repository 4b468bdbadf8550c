"""Find a place by name, then rank other places by great-circle distance.

The anchor lookup returns at most one row (``limit(1)`` after the regex
filter); its two coordinates are fetched once, exactly as Spark evaluates a
scalar subquery, and enter the distance expression as literals, so the terms
of the anchor are constant-folded and the candidate side is scanned once
with no join at all. Ranking keeps the best ``k`` per task and merges ``k``
per task (``TakeOrderedAndProject``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.functions.geo import EARTH_RADIUS_M, haversine_m
from fieldatlas.plans.ranking import top_k

# Fixed value: the name shown for a place without a name.
UNNAMED = "Unnamed Restaurant"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def points_only(features: DataFrame, geometry_type: str = "geometry_type") -> DataFrame:
    """Keep features whose geometry exists and is a ``Point``."""
    return features.where(_q(geometry_type) == "Point")


def has_position(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Both coordinates present (a position of size >= 2)."""
    return df.where(_q(lon).isNotNull() & _q(lat).isNotNull())


def find_first(places: DataFrame, pattern: str, name: str = "name",
               order: Sequence[str] = ("name", "lon", "lat")) -> DataFrame:
    """The first place (in ``order``) whose name matches ``pattern``.

    ``pattern`` is an unanchored Java regex; prefix it with ``(?i)`` for a
    case-insensitive match. At most one row.
    """
    return places.where(_q(name).rlike(pattern)).orderBy(*[_q(c) for c in order]).limit(1)


def name_or_default(name: str = "name", default: str = UNNAMED) -> Column:
    return F.coalesce(_q(name), F.lit(default))


def anchor_point(anchor: DataFrame, lon: str = "lon", lat: str = "lat") -> tuple[float, float] | None:
    """The one anchor position, fetched once (at most one row)."""
    at = anchor.select(_q(lon).alias("x"), _q(lat).alias("y")).limit(1).first()
    if at is None or at.x is None or at.y is None:
        return None
    return float(at.x), float(at.y)


def _ranked(candidates: DataFrame, at: tuple[float, float] | None, k: int, lon: str, lat: str,
            keep: Sequence[str], name: str, decimals: int | None) -> DataFrame:
    if at is None:
        empty = candidates.select(
            *[_q(c) for c in keep],
            F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("double").alias("distance_m"),
        ).limit(0)
        return top_k(empty, [F.col("distance_m")], k)
    dist = haversine_m(F.lit(at[0]), F.lit(at[1]), _q(lon), _q(lat))
    if decimals is not None:
        dist = F.round(dist, decimals)
    scored = has_position(candidates, lon, lat).select(
        *[_q(c) for c in keep],
        name_or_default(name).alias("name"),
        dist.alias("distance_m"),
    ).where(F.col("distance_m").isNotNull())
    order = [F.col("distance_m"), F.col("name")] + [_q(c) for c in keep]
    return top_k(scored, order, k)


def k_nearest(candidates: DataFrame, anchor: DataFrame, k: int = 10, *,
              lon: str = "lon", lat: str = "lat", keep: Sequence[str] = ("place_id",),
              name: str = "name", decimals: int | None = 3) -> DataFrame:
    """``(rank, *keep, name, distance_m)`` for the ``k`` nearest candidates.

    ``anchor`` holds at most one row with ``lon``/``lat``; with no anchor the
    result is empty. Distances are rounded to ``decimals`` (millimetres by
    default) before ranking, so equal rounded distances are ordered by name
    and then by the ``keep`` columns.
    """
    return _ranked(candidates, anchor_point(anchor, lon, lat), k, lon, lat, keep, name, decimals)


def _box_clearance_m(x: float, y: float, r: float) -> float:
    """Shortest great-circle distance from ``(x, y)`` to any point outside the
    box ``[x - r, x + r] x [y - r, y + r]`` (degrees, r <= 90).

    Latitude edges are ``r`` degrees of arc away along the meridian. Beyond a
    longitude edge a point lies across the plane of that meridian's great
    circle, at least ``asin(sin(r) * cos(y))`` of arc away.
    """
    north = 90.0 - y if y + r > 90.0 else r
    south = y + 90.0 if y - r < -90.0 else r
    arc_lat = math.radians(min(north, south, r))
    arc_lon = math.asin(min(1.0, math.sin(math.radians(r)) * math.cos(math.radians(y))))
    return EARTH_RADIUS_M * min(arc_lat, arc_lon)


def k_nearest_in_layout(candidates: DataFrame, anchor: DataFrame, k: int = 10, *,
                        lon: str = "lon", lat: str = "lat", keep: Sequence[str] = ("place_id",),
                        name: str = "name", decimals: int | None = 3,
                        start_radius_deg: float = 0.25, growth: float = 4.0) -> DataFrame:
    """Exact ``k`` nearest on a table in the clustered layout
    (:func:`fieldatlas.operators.sinks.write_clustered`), the role a spherical
    geospatial index plays for a near query.

    A box around the anchor is searched first; its ``lon``/``lat`` filter
    reaches the Parquet scan, so only row groups near the anchor are read.
    The answer is final once ``k`` rows are found and the k-th distance is
    below the box's clearance (no point outside the box can be closer);
    otherwise the box grows by ``growth``. Each step is one distributed top-k
    returning at most ``k`` rows, which are the result once they suffice (no
    step runs twice); choose ``start_radius_deg`` so that the first box usually
    holds ``k`` candidates. The box covers the globe after a handful of
    steps, and then the whole table is ranked as :func:`k_nearest` does.
    """
    at = anchor_point(anchor, lon, lat)
    if at is None:
        return _ranked(candidates, None, k, lon, lat, keep, name, decimals)
    x, y = at
    r = start_radius_deg
    slack = 10.0 ** -(decimals or 0)  # rounding of the reported distance
    while r < 90.0 and -180.0 <= x - r and x + r <= 180.0:
        box = _q(lon).between(x - r, x + r) & _q(lat).between(y - r, y + r)
        found = _ranked(candidates.where(box), at, k, lon, lat, keep, name, decimals)
        rows = found.collect()  # at most k rows
        kth = max((row.distance_m for row in rows), default=None)
        if len(rows) == k and kth + slack < _box_clearance_m(x, y, r):
            return candidates.sparkSession.createDataFrame(rows, found.schema)
        r *= growth
    return _ranked(candidates, at, k, lon, lat, keep, name, decimals)
