"""Mixing sources to target weights by systematic sampling.

Targets share a total over the sources by weight, stop at a multiple of each
source's size and pass the excess on (water filling, solved in closed form
over one row per source). Within a source every document has the same expected
copies ``rate = target / size of the source``, so the prefix sum of expected
copies is ``k * rate`` for the k-th document; with one random offset ``u`` a
document is emitted once per integer in ``(u + (k-1) rate, u + k rate]``.
Documents are ranked by size, which keeps the taken words near the target.

The rank is built in two levels, so no task sorts a whole source: rows fall
into cells (source, size band, hash of the id), cells are counted, a running
sum over the cells of a source gives each cell's offset, and rows are numbered
inside their cell only. A source has at most ``bands x salts`` cells however
many rows it holds. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.llm.text import hex_unit, quoted, whole, word_count
from fieldatlas.session import materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SALTS = 64


def _bits(size: Column) -> Column:
    return F.length(F.bin(size)).cast("int")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, size and the cell keys of every row."""
    size = word_count(whole(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    return _with_cell(rows, "id", "size")


def _with_cell(rows: DataFrame, id_col: str, size_col: str) -> DataFrame:
    """Band: the bit length and the four leading bits of the size; salt: from the id."""
    size, bits = F.col(size_col), _bits(F.col(size_col))
    salt = F.floor(hex_unit(F.coalesce(F.col(id_col).cast("string"), F.lit("")), 2) * SALTS).cast("int")
    shift = F.greatest(bits - 4, F.lit(0))
    top = F.floor(size / F.pow(F.lit(2.0), shift)).cast("int")
    return rows.withColumns({"_fa_bits": bits, "_fa_top": top, "_fa_salt": salt})


def targets(cells: DataFrame, share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """source, source_size, target, rate and offset u; one row per source."""
    per = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int"))).withColumns(
        {"cap": F.col("source_size") * F.lit(most), "total": F.sum("source_size").over(Window.partitionBy()) * F.lit(share)}
    )
    ratio = F.col("cap") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - before) / rest)
    # The first source (by cap per weight) that its level does not fill sets the level of all.
    level = F.max(F.when(ratio >= F.col("level"), F.col("level"))).over(Window.partitionBy())
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    name = F.coalesce(F.concat(F.lit(f"{seed}|"), F.col("source")), F.lit(f"{seed}"))
    return per.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        hex_unit(name).alias("u"),
    )


def _plan(rows: DataFrame, share: float, most: float, seed: str) -> DataFrame:
    """Per cell: its first rank and its source's target, rate and offset."""
    keys = ["source", "_fa_bits", "_fa_top", "_fa_salt"]
    cells = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("cell_size"))
    up_to = Window.partitionBy("source").orderBy("_fa_bits", "_fa_top", "_fa_salt").rowsBetween(Window.unboundedPreceding, -1)
    ranked = cells.withColumn("first", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    goal = targets(cells, share, most, seed).withColumnRenamed("source", "goal_source")
    joined = ranked.join(goal, F.col("source").eqNullSafe(F.col("goal_source")))
    return joined.select(
        F.col("source").alias("p_source"),
        *[F.col(k).alias(f"p{k}") for k in keys[1:]],
        *[F.col(c).alias(f"p_{c}") for c in ("first", "source_size", "target", "rate", "u")],
    )


def _copies(rows: DataFrame, plan: DataFrame, tie: list[Column]) -> DataFrame:
    """Adds p_from and p_copies: the integers before a row's interval, and those in it."""
    same = F.col("source").eqNullSafe(F.col("p_source"))
    for k in ("_fa_bits", "_fa_top", "_fa_salt"):
        same = same & (F.col(k) == F.col(f"p{k}"))
    in_cell = Window.partitionBy("source", "_fa_bits", "_fa_top", "_fa_salt").orderBy("size", *tie)
    numbered = rows.withColumn("p_k", F.row_number().over(in_cell)).join(plan, same)
    k = F.col("p_first") + F.col("p_k")
    edge = lambda n: F.floor(F.col("p_u") + n * F.col("p_rate"))
    return numbered.withColumn("p_from", edge(k - 1)).withColumn("p_copies", edge(k) - F.col("p_from"))


def mix_plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", share=1.5, most=2.0, seed="mix") -> DataFrame:
    """For every row: id, size, source_size, target, copies, taken (copies x size).

    Null text has size 0; null is a source of its own, ranked last; sources
    of size 0 have target 0. Rows of one id and size are interchangeable, so
    reruns agree. Other columns, whatever their names, are not read; an empty
    table gives an empty result.
    """
    rows = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    out = _copies(rows, _plan(rows, share, most, seed), [F.col("id")])
    return out.select(
        F.col("id").alias(id_col),
        "size",
        F.col("p_source_size").alias("source_size"),
        F.col("p_target").alias("target"),
        F.col("p_copies").alias("copies"),
        (F.col("p_copies") * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", share=1.5, most=2.0, seed="mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept."""
    slim = materialize(sized(docs, id_col, text_col, source_col), "mix-sizes")
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(
        F.struct(*[docs[quoted(c)].alias(n) for c, n in zip(docs.columns, names, strict=True)]).alias("row"),
        docs[id_col].alias("id"),
        docs[source_col].alias("source"),
        word_count(whole(docs[text_col])).alias("size"),
    )
    tie = [F.col("id"), F.xxhash64(F.to_json("row"))]
    taken = _copies(_with_cell(rows, "id", "size"), _plan(slim, share, most, seed), tie).where("p_copies > 0")
    again = taken.withColumn("p_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("p_copies"))))
    return again.select(*[F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names, strict=True)])
