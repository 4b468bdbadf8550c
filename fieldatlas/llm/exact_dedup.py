"""Exact dedup by skew-safe combining.

Three levels, each of which compares whole normalised texts (they are part of
the grouping key, the digest only routes them): Spark's map-side aggregation
deduplicates every task's rows, salted digest groups merge those over ``salts``
tasks per digest, and the salt winners are combined globally. A group holding a
third of all rows therefore sends at most one row per map task and salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm.text import ascii_lower, numbered, quoted, whole
from fieldatlas.session import materialize


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = ascii_lower(whole(text_col))
    return docs.select(F.col(id_col).alias("id"), norm.alias("norm"), F.sha2(norm, 256).alias("digest"))


def _salt(id_col: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(salts))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct normalised text: digest, keep_id (largest id), group_size.

    Should two different texts ever share a digest, the query fails instead
    of merging them.
    """
    salted = (
        _keyed(docs, id_col, text_col)
        .withColumn("salt", _salt("id", salts))
        .groupBy("digest", "salt", "norm")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    merged = salted.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share one digest")).cast("long"))
    return merged.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.coalesce(one, F.sum("n")).alias("group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """A verdict for every row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty. Of equal texts the row with the largest id stays; a null id loses
    to any other. Rows repeating the kept id with the same text are the same
    document and share its verdict. An empty table gives an empty result;
    other columns, whatever their names, are not read.
    """
    rows = materialize(_keyed(docs, id_col, text_col).select("id", "digest", _salt("id", salts).alias("salt")), "dedup-digests")
    # Verdicts go back the way the rows came: to each salt of a digest, then to its rows.
    by_salt = rows.select("digest", "salt").distinct().join(groups(docs, id_col, text_col, salts), "digest")
    return rows.join(by_salt, ["digest", "salt"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The documents that ``exact_dedup`` keeps, with all their columns."""
    digest: Column = F.sha2(ascii_lower(whole(text_col)), 256)
    won = groups(docs, id_col, text_col, salts).select("digest", "keep_id")
    # The kept id is part of the join key, so the copies of one text are spread by id.
    return docs.join(won, (digest == won["digest"]) & docs[id_col].eqNullSafe(won["keep_id"])).select(*[docs[quoted(c)] for c in docs.columns])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One document per distinct text, with all its columns: of the rows that ``keep_distinct``
    keeps, repeats of an id (or of no id) included, the one with the smallest hash of its content."""
    kept = keep_distinct(docs, id_col, text_col, salts)
    named = docs.select(F.col(id_col).alias("id"), F.sha2(ascii_lower(whole(text_col)), 256).alias("digest"))
    again = named.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if materialize(again, "dedup-repeats").isEmpty():
        return kept
    rows = numbered(kept)
    digest = F.sha2(ascii_lower(whole(f"c{docs.columns.index(text_col)}")), 256)
    # Maps and variants have no hash; rows that differ in those only are told apart by nothing else.
    plain = [f"c{k}" for k, f in enumerate(docs.schema) if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    row = F.struct(*rows.columns)
    # Each task sends one row per digest, so rows repeated many times do not meet.
    one = rows.groupBy(digest.alias("digest")).agg(F.min_by(row, F.xxhash64(*plain, *[F.col(c).isNull() for c in plain])).alias("row"))
    return one.select("row.*").toDF(*docs.columns)
