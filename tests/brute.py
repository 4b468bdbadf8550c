"""Brute-force references computed in plain Python on small collected inputs."""

from __future__ import annotations


def ring_edges(ring):
    pts = list(ring)
    if pts[0] != pts[-1]:
        pts.append(pts[0])
    return [(pts[i][0], pts[i][1], pts[i + 1][0], pts[i + 1][1]) for i in range(len(pts) - 1)]


def contains(edges, x, y) -> bool:
    crossings = 0
    for x1, y1, x2, y2 in edges:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            crossings += 1
        if (
            (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1)
            and min(x1, x2) <= x <= max(x1, x2)
            and min(y1, y2) <= y <= max(y1, y2)
        ):
            return False
    return crossings % 2 == 1


def join(points, polygons):
    """points: [(id, x, y)], polygons: [(name, [ring, ...])] -> {(id, name)}"""
    out = set()
    for name, rings in polygons:
        edges = [e for r in rings if len(r) >= 2 for e in ring_edges(r)]
        for pid, x, y in points:
            if x is not None and y is not None and contains(edges, x, y):
                out.add((pid, name))
    return out
