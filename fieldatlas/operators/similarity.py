"""Pairwise Jaccard similarity of the value sets of the top groups.

Following the reference, only the ``k_groups`` most diverse groups are
compared. Instead of collecting their sets to the driver and looping over
pairs, intersections are counted with bitmaps:

* distinct ``(group, value)`` rows of the top groups (a null-safe join with the
  ``k_groups`` top rows, which number the groups by name);
* one bitmap per value of the groups that hold it (``bit_or`` of one bit a
  group, partially aggregated before the shuffle);
* values with equal bitmaps are counted together, so pairs are emitted once
  per distinct bitmap, not once per value: at most ``k_groups**2 / 2`` rows
  each, however many values share it;
* sum per pair = intersection size;
* union = n1 + n2 - intersection, from the distinct counts already known.

Pairs with no common value still get a row (similarity 0): each of the
``k_groups`` top rows emits its pairs with the groups after it in the sorted
top list (a scalar subquery of ``k_groups`` entries), so no cross join is
planned and no single row carries all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.functions.sets import jaccard
from fieldatlas.plans.ranking import top_k
from fieldatlas.session import materialize


def _q(name: str):
    return F.col(f"`{name}`")


#: Groups in one word of a bitmap: the bits of a positive long.
WORD_BITS = 62


def shared_counts(members: DataFrame, k_groups: int) -> DataFrame:
    """``(p1, p2, n_inter)`` for ``p1 < p2``: how many values both groups hold.

    ``members`` has distinct rows ``(pos, v)`` with positions 1 to ``k_groups``.
    """
    words = [f"w{k}" for k in range((k_groups + WORD_BITS - 1) // WORD_BITS)]
    at = F.col("pos") - 1
    bit = F.expr(f"shiftleft(1L, (pos - 1) % {WORD_BITS})")
    bits = [
        F.bit_or(F.when(F.floor(at / WORD_BITS) == k, bit).otherwise(F.lit(0).cast("long"))).alias(w)
        for k, w in enumerate(words)
    ]
    by_bitmap = members.groupBy("v").agg(*bits).groupBy(*words).agg(F.count(F.lit(1)).alias("n"))
    held = F.concat(*[
        F.expr(f"filter(sequence({1 + k * WORD_BITS}, {(k + 1) * WORD_BITS}), p -> getbit({w}, p - {1 + k * WORD_BITS}) = 1)")
        for k, w in enumerate(words)
    ])
    return (
        by_bitmap.select("n", held.alias("held"))
        .where(F.size("held") > 1)
        .select("n", "held", F.explode("held").alias("p1"))
        .select("n", "p1", F.explode(F.filter("held", lambda p: p > F.col("p1"))).alias("p2"))
        .groupBy("p1", "p2")
        .agg(F.sum("n").alias("n_inter"))
    )


def pair_overlaps(df: DataFrame, k_groups: int = 10, group: str = "community",
                  value: str = "species") -> DataFrame:
    """All pairs of the ``k_groups`` most diverse groups with
    ``n1, n2, n_inter, n_union, similarity``; ``community_1 < community_2``,
    and the null group, a group like any other, comes second in its pairs.

    One distinct ``(group, value)`` table feeds everything (set sizes, the
    top groups, the bitmaps). It is written once to the shared folder,
    so the input (typically a spatial join) is computed once however many
    branches read it; null values are kept in it only so that groups whose
    values are all null still count as groups of size 0.
    """
    pairs_gv = materialize(
        df.select(_q(group).alias("g"), _q(value).alias("v")).distinct(), "group-values"
    )
    sizes = pairs_gv.groupBy("g").agg(F.count("v").alias("n"))
    best = top_k(sizes, [F.col("n").desc(), F.col("g").asc_nulls_last()], k_groups)
    # The at most k top groups, numbered by name (the null group last), are
    # fetched once: everything below reads these rows instead of ranking again.
    by_name = Window.orderBy(F.col("g").asc_nulls_last())
    numbered = best.select(F.row_number().over(by_name).alias("pos"), "g", "n")
    top = df.sparkSession.createDataFrame(numbered.collect(), numbered.schema)
    members = (
        pairs_gv.where(F.col("v").isNotNull())
        .join(top.select("pos", F.col("g").alias("top_g")), F.col("g").eqNullSafe(F.col("top_g")))
        .select("pos", "v")
    )
    inter = shared_counts(members, k_groups)
    # Unordered pairs of the bounded top list: the sorted list (k entries)
    # enters as a scalar subquery and each top row emits its pairs with the
    # groups after it.
    listed = top.agg(F.array_sort(F.collect_list(F.struct("pos", "g", "n")))).scalar()
    pairs = top.select("pos", "g", "n", listed.alias("t")).select(
        F.col("pos").alias("q1"),
        F.col("g").alias("community_1"),
        F.col("n").alias("n1"),
        F.explode(F.filter("t", lambda y: y.pos > F.col("pos"))).alias("r"),
    )
    joined = pairs.join(
        inter, (F.col("q1") == F.col("p1")) & (F.col("r.pos") == F.col("p2")), "left"
    ).select(
        "community_1",
        F.col("r.g").alias("community_2"),
        "n1",
        F.col("r.n").alias("n2"),
        F.coalesce(F.col("n_inter"), F.lit(0)).cast("long").alias("n_inter"),
    )
    return joined.select(
        "*",
        (F.col("n1") + F.col("n2") - F.col("n_inter")).alias("n_union"),
        jaccard("n_inter", "n1", "n2").alias("similarity"),
    )


def most_similar(df: DataFrame, k_groups: int = 10, k_pairs: int = 10,
                 group: str = "community", value: str = "species") -> DataFrame:
    """``(rank, community_1, community_2, similarity)``: the ``k_pairs`` most
    similar pairs among the ``k_groups`` most diverse groups."""
    p = pair_overlaps(df, k_groups, group, value).select(
        "community_1", "community_2", "similarity"
    )
    return top_k(
        p,
        [F.col("similarity").desc(), F.col("community_1"), F.col("community_2").asc_nulls_last()],
        k_pairs,
    )
