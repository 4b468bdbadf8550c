"""Exact top-k inner-product search with a KD-tree per shard.

Vectors are dealt over shards of bounded size by hash. A task builds its
shard's tree along the principal axes of the shard's vectors (median splits of
the widest side, tight bounding boxes) and answers queries by best-first
traversal: a box's bound is the largest inner product any point of it could
have, and a box below the kth score found so far is never opened. The kth score travels: every query is first answered in its home
shard only, and that kth score is the starting bound in all other shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.llm.text import ready_workers
from fieldatlas.session import default_parallelism, materialize

LEAF = 128
QUERY_BLOCK = 256
#: A share of the lengths' product that covers the rounding of rotated bounds, with room to spare.
ROUNDING = 1e-12
HITS = "query_id long, vec_id long, score long"


def principal_axes(points: np.ndarray) -> np.ndarray:
    """An orthogonal matrix; its columns are the directions in which the points spread."""
    if len(points) < 2 or not points.shape[1]:
        return np.eye(points.shape[1])
    from_mean = points - points.mean(axis=0)
    return np.linalg.eigh(from_mean.T @ from_mean)[1]


class Tree:
    """Nodes in arrays; the children of node i are ``child[i]`` and the next one.

    Boxes lie in rotated coordinates, where a few axes hold most of the spread;
    scores are computed from the points as given. ``opened`` counts leaves read.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.given, self.opened = points, 0
        self.axes = principal_axes(points)
        points = points @ self.axes
        order = np.arange(len(ids))
        low, high, child, span, least = [], [], [], [], []
        todo = [(0, len(ids))] if len(ids) else []
        for a, b in todo:  # grows while it is walked
            box = points[order[a:b]]
            lo, hi = box.min(axis=0), box.max(axis=0)
            low.append(lo)
            high.append(hi)
            span.append((a, b))
            least.append(ids[order[a:b]].min())
            if b - a <= LEAF or not box.shape[1] or (lo == hi).all():
                child.append(-1)
                continue
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(box[:, (hi - lo).argmax()], half)]
            child.append(len(todo))
            todo += [(a, a + half), (a + half, b)]
        self.ids, self.points = ids[order], self.given[order]
        self.reach = np.linalg.norm(self.points, axis=1).max(initial=0.0)
        del self.given
        self.low, self.high = np.array(low), np.array(high)
        self.child, self.span, self.least = child, span, least

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """[queries, nodes]: no point of the node's box scores higher. Scores are whole, so bounds are rounded to them."""
        turned = queries @ self.axes
        best = np.maximum(turned, 0) @ self.high.T + np.minimum(turned, 0) @ self.low.T
        margin = ROUNDING * np.linalg.norm(queries, axis=1) * self.reach * (1 + queries.shape[1])
        return np.floor(best + margin[:, None] + ROUNDING)

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best points of score ``floor`` or more, other than ``own``; ties to smaller ids."""
        ids, scores = np.empty(0, np.int64), np.empty(0)
        worst, worst_id = floor, np.inf
        heap = [(-bounds[0], 0)] if len(bounds) else []
        while heap:
            bound, node = heappop(heap)
            if -bound < worst:
                break
            if -bound == worst and self.least[node] > worst_id:
                continue
            first = self.child[node]
            if first >= 0:
                for c in (first, first + 1):
                    if bounds[c] >= worst:
                        heappush(heap, (-bounds[c], c))
                continue
            a, b = self.span[node]
            self.opened += 1
            got = self.points[a:b] @ query
            new = np.flatnonzero((got >= worst) & (self.ids[a:b] != own))
            if not len(new):
                continue
            ids, scores = np.concatenate([ids, self.ids[a:b][new]]), np.concatenate([scores, got[new]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                worst, worst_id = scores[-1], ids[-1]
        return ids, scores


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of each component as double; products of these are exact below 2 ** 53."""
    return np.floor(vectors.astype(np.float64) * scale)


def _search(k: int, scale: float):
    """Streams rows sorted by (shard, is query): a shard's vectors, then its queries."""
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            name, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            ids, floor = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            lists = batch.column(4)
            cut = np.flatnonzero((np.diff(name) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cut], [*cut, len(name)], strict=True):
                if a == b:
                    continue
                if name[a] != shard:
                    shard, held, tree = name[a], [], None
                part = lists.slice(a, b - a)
                points = integers(part.flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1) if len(part) else np.empty((0, 0)), scale)
                if not asks[a]:
                    held.append((ids[a:b], points))
                    continue
                if tree is None:
                    tree = Tree(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])) if held else None
                    held = []
                if tree is None:
                    continue
                found = []
                for q in range(0, b - a, QUERY_BLOCK):
                    block = points[q : q + QUERY_BLOCK]
                    for j, bounds in enumerate(tree.bounds(block)):
                        at = a + q + j
                        got, scores = tree.search(int(ids[at]), block[j], bounds, k, floor[at])
                        found.append((np.full(len(got), ids[at]), got, scores.astype(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=out)

    return rows


def usable(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """id, vector, dim, copy: rows with an id whose vector has no null or non-finite component.

    Rows equal in both are numbered; beyond k they cannot be told from those in an answer of k rows and are left out.
    """
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False)))
    equal = rows.groupBy(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).count()
    copies = F.explode(F.sequence(F.lit(1), F.least("count", F.lit(k)).cast("int")))
    return equal.select("id", "vector", F.size("vector").alias("dim"), copies.alias("copy"))


def top_k(vectors: DataFrame, query_every: int, k: int = 5, scale: float = 256.0, id_col="vec_id", vector_col="embedding", shard_rows: int = 65536) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of every query.

    Queries are the rows whose id is divisible by ``query_every``, candidates
    all rows but the query's own, of vectors scaled to integers; ties go to
    the smaller id. Rows that repeat a candidate's id are candidates of their
    own; rows that repeat a query's id are answered together, equal ones as one,
    and are not candidates of each other. Vectors that are null or hold a null or non-finite
    component take no part; vectors are compared with those of their own
    length only. An empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    ready_workers(spark)
    rows = materialize(usable(vectors, id_col, vector_col, k), "knn-vectors")
    tasks = default_parallelism(spark)
    counts = rows.groupBy("dim").count().select("dim", F.greatest(F.ceil(F.col("count") / shard_rows), F.least(F.lit(tasks), F.ceil(F.col("count") / 2048))).alias("shards"))
    # One row per vector length. Shard names are (length, number) hashed to one long.
    counts = F.broadcast(counts)
    named = lambda number: F.xxhash64("dim", number)
    place = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "id", "vector", "copy"), F.col("shards"))
    dealt = rows.join(counts, "dim")
    points = dealt.select(named(place("vector")).alias("shard"), F.lit(False).alias("asks"), "id", F.lit(0.0).alias("floor"), "vector")
    asking = dealt.where((F.col("id") % query_every == 0) & (F.col("copy") == 1)).withColumn("home", place("home"))

    def found(queries: DataFrame) -> DataFrame:
        both = points.unionByName(queries.select("shard", F.lit(True).alias("asks"), "id", "floor", "vector"))
        return both.repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(_search(k, scale), HITS)

    low = F.lit(float("-inf"))
    first = materialize(found(asking.select(named("home").alias("shard"), "id", low.alias("floor"), "vector")), "knn-home")
    bound = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score")).cast("double").alias("bound"))
    spread = asking.join(bound, "id", "left").withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    others = spread.where("number != home").select(named("number").alias("shard"), "id", F.coalesce("bound", low).alias("floor"), "vector")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # At most k rows per query and shard.
    return (
        first.unionByName(found(others))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
