"""Ranks 1..n on an ordered result without moving it to one task.

``top_k`` is for a bounded prefix: ``orderBy().limit(k)`` plans as
``TakeOrderedAndProject`` (each task keeps its best k, the driver merges k
per task), and the rank is then numbered on at most k rows.

``global_rank`` numbers an unbounded result: it range-partitions and sorts,
stores the sorted rows once in the shared folder together with
``monotonically_increasing_id`` (partition index in the high bits, position
in the low 33 bits), counts rows per partition (one row per partition), and
adds the count of all earlier partitions. Storing the rows pins partition
contents, so the counts and the numbered rows can never disagree, and it
cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.session import scratch_path

_LOW_BITS = 33


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """First ``k`` rows in ``order`` plus their 1-based rank (a BIGINT).

    ``order`` must be a total order for reproducible results.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    head = df.orderBy(*order).limit(k)
    # At most k rows reach this window, so a global window is safe here.
    ranked = head.withColumn(
        rank_col, F.row_number().over(Window.orderBy(*order)).cast("long")
    )
    return ranked.select(rank_col, *[c for c in df.columns])


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """All rows of ``df`` with their 1-based position in ``order``."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    # Rows equal in ``order`` are told apart by their content, so the range
    # partitioner can split even a key held by a third of all rows, and a
    # retried task deals its rows alike.
    (
        df.withColumn("_fa_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        .orderBy(*order, F.col("_fa_tie"))
        .drop("_fa_tie")
        .withColumn("_fa_mid", F.monotonically_increasing_id())
        .write.mode("overwrite")
        .parquet(path)
    )
    stored = spark.read.parquet(path)
    part = F.shiftright("_fa_mid", _LOW_BITS)
    local = F.col("_fa_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    counts = stored.groupBy(part.alias("_fa_part")).agg(F.count(F.lit(1)).alias("_fa_n"))
    # One row per partition: a global window here is bounded by the partition count.
    offsets = counts.select(
        "_fa_part",
        F.coalesce(
            F.sum("_fa_n").over(
                Window.orderBy("_fa_part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_fa_offset"),
    )
    out = stored.join(F.broadcast(offsets), part == F.col("_fa_part")).select(
        (F.col("_fa_offset") + local + 1).cast("long").alias(rank_col),
        *[F.col(f"`{c}`") for c in df.columns],
    )
    return out
