"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.session import materialize


def _give_back(rows: DataFrame, least: DataFrame, salts: int) -> DataFrame:
    """``rows`` (u, v) with m, the least node of u: by node and salt, so a hub's rows are spread over ``salts`` tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)))
    by_salt = salted.select("u", "salt").distinct().join(least, "u")
    return salted.join(by_salt, ["u", "salt"])


def components(edges: DataFrame, most_rounds: int = 60, salts: int = 16) -> DataFrame:
    """node, root (the smallest node it is connected with) of every node of ``edges`` (a, b) that is not its own root.

    Each round links every node's larger neighbours, then its smaller ones, to
    the smallest neighbour, until the stars stop changing; a logarithmic number
    of rounds in practice. Per-node minima are aggregated map-side first and given
    back by salt, so a hub's neighbours never meet in one task. Null ends and loops link nothing.
    """
    now = materialize(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars"
    )
    sign = F.bit_xor(F.xxhash64("a", "b")).alias("sign"), F.count(F.lit(1)).alias("n")
    last = now.agg(*sign).first()
    if not last.n:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(most_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _give_back(both.where("v > u"), low, salts).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        below = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = _give_back(below, low, salts).select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now = materialize(small.where("a <> b").distinct(), "stars")
        seen = now.agg(*sign).first()
        if seen == last:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = seen
    raise RuntimeError("components did not settle")
