"""Document collections as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession


def read_json_lines(spark: SparkSession, path: str, schema, mode: str = "FAILFAST") -> DataFrame:
    """One JSON document per line with a declared schema.

    Blank lines are skipped. With ``FAILFAST`` a malformed line fails the
    load, as a document parse error does in the reference; ``PERMISSIVE``
    keeps going with nulls. Files are split across tasks by line.
    """
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_table(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
               options: Mapping[str, str] | None = None, schema=None) -> DataFrame:
    """Any source Spark knows, by format name and options.

    Filters and projections applied afterwards are pushed into sources that
    support it (Parquet, ORC, JDBC, ...).
    """
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def scan(df: DataFrame, where: Column | None = None) -> DataFrame:
    """All columns, optionally filtered (``find(filter)``)."""
    out = df.select("*")
    return out if where is None else out.where(where)
