"""Filters, sorts and projections on nested documents.

Nested fields are addressed by dotted paths; Catalyst prunes the nested
schema at the Parquet scan and pushes comparisons on nested fields into it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.plans.ranking import global_rank


def field(path: str) -> Column:
    """A nested field by dotted path, e.g. ``statistics.flights.cancelled``."""
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def flatten(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Project nested paths to flat columns: ``{output_name: path}``."""
    return df.select(*[field(p).alias(n) for n, p in fields.items()])


def cancelled_flights(docs: DataFrame, airport_code: str, min_cancelled: int, *,
                      code_path: str = "airport.code",
                      count_path: str = "statistics.flights.cancelled",
                      name_path: str = "carrier.name",
                      extra: Mapping[str, str] | None = None,
                      ranked: bool = True) -> DataFrame:
    """Documents of one airport with more than ``min_cancelled`` cancellations,
    by carrier name ascending and cancellations descending.

    Output: ``carrier_name, airport_code, cancelled`` plus ``extra`` paths, and
    a ``rank`` giving the order (computed without moving rows to one task).
    """
    extra = dict(extra or {})
    picked = docs.where(
        (field(count_path) > F.lit(min_cancelled)) & (field(code_path) == F.lit(airport_code))
    )
    flat = flatten(
        picked,
        {"carrier_name": name_path, "airport_code": code_path, "cancelled": count_path, **extra},
    )
    order = [F.col("carrier_name").asc(), F.col("cancelled").desc()] + [
        F.col(c).asc() for c in extra
    ]
    return global_rank(flat, order) if ranked else flat.orderBy(*order)


def to_json_text(df: DataFrame, column: str = "json") -> DataFrame:
    """Each document as one JSON text."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(column))


def from_json_text(df: DataFrame, schema, column: str = "json") -> DataFrame:
    """JSON text back to typed columns with a declared schema."""
    return df.select(F.from_json(F.col(column), schema).alias("_d")).select("_d.*")

