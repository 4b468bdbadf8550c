"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.session import importable_on_workers, short_batches

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: A word: a maximal run of characters other than space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_workers(spark: SparkSession) -> None:
    """What the operators that run Python in tasks ask of the session."""
    importable_on_workers(spark)
    short_batches(spark)


#: In a Python worker, by operator: the name of what it keeps from task to task, the thing itself, and when it was last asked for.
_KEPT: dict[str, tuple[str, object, float]] = {}
#: Operators may take turns in a worker; what one has not asked for in this time is from another stage.
IDLE_S = 5.0


def kept(owner: str, name: str, make: Callable[[], object]):
    """What ``make`` makes, kept in this Python worker until ``owner`` asks for another name or :func:`let_go`."""
    held = _KEPT.get(owner)
    if held is None or held[0] != name:
        held = None
        _KEPT.pop(owner, None)  # the old one goes before the new one comes
        held = name, make()
    _KEPT[owner] = (*held[:2], time.monotonic())
    return held[1]


def let_go(idle_s: float | None = None) -> None:
    """Drops what operators keep in this Python worker and have not asked for in ``idle_s`` seconds (``IDLE_S``).

    Workers outlive stages: without this an operator's tables stay beside the memory of all later ones.
    """
    now = time.monotonic()
    idle = [k for k, (_, _, at) in _KEPT.items() if now - at >= (IDLE_S if idle_s is None else idle_s)]
    for k in idle:
        del _KEPT[k]
    if idle:
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; elsewhere freed memory goes back in its own time
        if trim:
            trim(0)


def lean(rows: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``rows`` for mapInArrow, in workers that first let go of what earlier stages kept."""

    def run(batches: Iterator) -> Iterator:
        let_go()
        yield from rows(batches)

    return run


def whole(text: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def quoted(name: str) -> str:
    """A column's name as Spark reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def numbered(docs: DataFrame) -> DataFrame:
    """The same columns under the names c0, c1, ..., which Python operators can be given safely."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """True for the rows a classifier may not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def free_name(name: str, taken) -> str:
    """``name``, underscored until no column of ``taken`` has it (in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def hex_unit(value: Column, digits: int = 8) -> Column:
    """A number in [0, 1) fixed by the text ``value``."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, digits), 16, 10).cast("long") / F.lit(float(16**digits))
