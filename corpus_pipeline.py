"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and rereads it as the next one's documents.
All stages but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.llm import bpe, ppm
from fieldatlas.llm.exact_dedup import keep_one
from fieldatlas.llm.jaccard import keep_one_per_class
from fieldatlas.llm.mixing import mix
from fieldatlas.session import materialize

#: Text that every learned language codes worse than no model would is in none of them.
MOST_BITS = 8.0
#: What links near copies in the corpus: shared five-word shingles, 0.8 of all. (op8_jaccard_join has its own rule.)
NEAR = {"width": 5, "num": 80, "den": 100}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those that no learned language explains."""
    named = ppm.identify(docs, ppm.learn(docs))
    lang, _, bits = named.columns[len(docs.columns) :]
    return named.where((F.col(lang) != ppm.NO_LANGUAGE) & (F.col(bits) <= MOST_BITS)).drop(*named.columns[len(docs.columns) :])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays, as one row however often that id is repeated."""
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents, the one with the smallest id stays.

    Documents link when the Jaccard similarity of their five-word shingles is
    at least 0.8. Documents are rows: two texts under one id are two documents.
    Rows without an id link with nothing and stay.
    """
    return keep_one_per_class(docs, **NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 2 times)."""
    return mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether the ids decode to the text's bytes."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    vocab = bpe.vocabulary(ranks, public_tokenizers.PATTERN)
    named = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.encode_and_decode(named, vocab)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot train the language models or run the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
