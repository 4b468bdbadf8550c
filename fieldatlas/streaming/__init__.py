"""Streaming.

The reference has no streaming program: no stream source or sink, no
watermark, window or state. Nothing here adds one. The spatial join is a
stream-static equi join, so it also runs unchanged on a streaming point
source when the polygon side is a static table and the broadcast strategy is
used (the salted strategy needs an aggregation over the points, which a
stream cannot provide up front).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldatlas.operators.spatial import spatial_join


def enrich_stream(points: DataFrame, polygons: DataFrame, **kw) -> DataFrame:
    """Spatial join of a streaming point DataFrame with static polygons."""
    if not points.isStreaming or polygons.isStreaming:
        raise ValueError("expects a streaming point side and a static polygon side")
    if kw.get("strategy", "auto") == "shuffle":
        raise ValueError("a streaming point side needs the broadcast strategy")
    out, plan = spatial_join(points, polygons, return_plan=True, **kw)
    if plan.strategy != "broadcast":
        raise ValueError(
            f"polygon side estimated at {plan.estimated_bytes} bytes, above the broadcast limit"
        )
    return out
