"""Set-valued helpers.

Sets of unbounded size are kept as long tables ``(group, element)`` by the
operators; these helpers are for small, already-bounded values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jaccard(n_inter, n_left, n_right) -> Column:
    """|A∩B| / |A∪B| from the three sizes; 0.0 when both sets are empty."""
    inter, left, right = _c(n_inter), _c(n_left), _c(n_right)
    union = left + right - inter
    return F.when(union == 0, F.lit(0.0)).otherwise(
        inter.cast("double") / union.cast("double")
    )


def set_from_list(values) -> Column:
    """List to set: nulls removed, duplicates removed."""
    return F.array_distinct(F.array_compact(_c(values)))
