"""Distinct-value counts per group and the most diverse groups.

``count_distinct`` plans as two aggregation phases: rows are first reduced
to distinct (group, value) pairs, shuffled on both columns, and only then
counted per group with a partial (map-side) count. A group holding a third
of all rows therefore never lands in one task, and no set is materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.plans.ranking import top_k


def _q(name: str):
    return F.col(f"`{name}`")


def richness(df: DataFrame, group: str = "community", value: str = "species",
             count_col: str = "num_species", rsd: float | None = None) -> DataFrame:
    """``(group, count_col)``: distinct non-null values per group.

    The null group is a group of its own; null values are not counted.
    With ``rsd`` (relative standard deviation, e.g. 0.01) the count is a
    HyperLogLog++ estimate: one pass with partial aggregation of fixed-size
    sketches per group, no shuffle of distinct pairs.
    """
    counted = (
        F.count_distinct(_q(value))
        if rsd is None
        else F.approx_count_distinct(_q(value), rsd)
    )
    return df.groupBy(_q(group)).agg(counted.alias(count_col))


def most_diverse(df: DataFrame, k: int = 10, group: str = "community",
                 value: str = "species", count_col: str = "num_species",
                 rsd: float | None = None) -> DataFrame:
    """``(rank, group, count_col)``: the ``k`` groups with most distinct values,
    ties broken by group name; ``rsd`` as in :func:`richness`."""
    r = richness(df, group, value, count_col, rsd)
    return top_k(r, [F.col(count_col).desc(), _q(group).asc_nulls_last()], k)


def distinct_members(df: DataFrame, group: str = "community",
                     value: str = "species") -> DataFrame:
    """The set of each group as a long table of distinct ``(group, value)``
    rows, nulls removed. This is the form of a set that scales: no group is
    ever collected into one row."""
    return df.select(_q(group), _q(value)).where(_q(value).isNotNull()).distinct()


def null_profile(df: DataFrame, group: str = "community", value: str = "species") -> DataFrame:
    """Per group: rows, distinct non-null values, rows with a null value."""
    return df.groupBy(_q(group)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(_q(value)).alias("n_distinct"),
        F.sum(F.when(_q(value).isNull(), 1).otherwise(0)).cast("long").alias("n_null"),
    )


def distinct_sketches(df: DataFrame, group: str = "community", value: str = "species",
                      lg_k: int = 14) -> DataFrame:
    """``(group, sketch)``: one mergeable HLL sketch of the non-null values per group.

    For collections that grow by appends: sketch every new batch, append the
    rows to a table of sketches, and rank from that table alone
    (:func:`richness_from_sketches`) instead of counting everything again. A
    sketch takes at most ``2**lg_k`` bytes and its estimate has a relative
    standard error of about ``0.83 / 2**(lg_k / 2)`` (0.65 % by default). A
    group whose values are all null has an empty sketch; no rows give no rows.
    """
    return df.groupBy(_q(group)).agg(
        F.hll_sketch_agg(_q(value).cast("string"), lg_k).alias("sketch")
    )


def richness_from_sketches(sketches: DataFrame, group: str = "community",
                           count_col: str = "num_species") -> DataFrame:
    """``(group, count_col)``: estimated distinct values per group, over all its sketches.

    Values that several batches hold count once. Sketches of different
    ``lg_k`` may be mixed; the result has the precision of the coarsest.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg(F.col("sketch"), F.lit(True)))
    return sketches.groupBy(_q(group)).agg(merged.alias(count_col))


def most_diverse_from_sketches(sketches: DataFrame, k: int = 10, group: str = "community",
                               count_col: str = "num_species") -> DataFrame:
    """``(rank, group, count_col)`` as :func:`most_diverse`, read from sketches only."""
    r = richness_from_sketches(sketches, group, count_col)
    return top_k(r, [F.col(count_col).desc(), _q(group).asc_nulls_last()], k)
