"""Substring dedup by hashing lines (or paragraphs) and the sentences in them.

Texts are cut into lines, and lines into sentences, numbered in their order.
Normalised units are hashed and digests are grouped globally (one partial
aggregate per task, so a unit that a third of all documents share sends one row
per task). Only numbers and digests are shuffled: a document gets back the
numbers of its units that occurred before, and its passages are found where its
text is cut again. The occurrence with the smallest (document, number) stays:

- every later occurrence of a whole line goes, whatever its length;
- inside lines that stay, consecutive sentences that all occurred before go
  when together they hold ``min_run_chars`` characters, so that a passage put
  into the middle of a line is found and single short sentences are not torn
  out of a paragraph.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm.chunks import pieces
from fieldatlas.llm.text import ready_workers
from fieldatlas.session import materialize

#: Where a block ends: kept with the block before it.
BREAKS = {"line": re.compile(r"\n+"), "paragraph": re.compile(r"\n[ \t]*\n\s*")}
#: Where a sentence ends, in scripts with spaces between words and in those without: its mark (or a line's end) and what separates.
SENTENCE = re.compile(r"[\n.!?\u3002\uff01\uff1f](?:(?<=\n)\n*|(?<=[.!?])[ \t]+|(?<=[\u3002\uff01\uff1f])(?![\u3002\uff01\uff1f]))")
UNITS = "id long, tie long, unit int, digest binary"
#: What tells rows apart: the id, and a hash of the text for ids that hold several.
ROW = ["id", "tie"]
#: Text that a worker holds in Python at once, and rows of a batch that it sends.
PIECE_BYTES = 1 << 20
BATCH_ROWS = 20_000


def normalise(unit: str) -> str:
    """Lower case, white space collapsed."""
    return " ".join(unit.lower().split())


def cut(text: str, breaks: re.Pattern) -> Iterator[tuple[int, int]]:
    """Start and stop of every unit; separators stay between the units."""
    at = 0
    for m in breaks.finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def sentences(block: str) -> list[tuple[int, int]]:
    """Start and stop of every sentence that is not blank; marks stay with the sentence before them."""
    out, at = [], 0
    for m in SENTENCE.finditer(block):
        start, stop = m.span()
        end = start if block[start] == "\n" else start + 1
        if at < end and not block[at:end].isspace():
            out.append((at, end))
        at = stop
    if at < len(block) and not block[at:].isspace():
        out.append((at, len(block)))
    return out


def spans_of(text: str, breaks: re.Pattern) -> Iterator[tuple[int, int, bool, bool]]:
    """Start and stop of every unit that is not blank, and whether it is a block and a sentence.

    A block of one sentence is both; a block of several comes before them. A
    unit's place in this order is its number.
    """
    for a, b in cut(text, breaks):
        parts = sentences(text[a:b])
        if len(parts) > 1:
            yield a + parts[0][0], a + parts[-1][1], True, False
        for start, stop in parts:
            yield a + start, a + stop, len(parts) == 1, True


def digests_of(text: str, breaks: re.Pattern) -> list[bytes]:
    """The digest of every unit's normalised text."""
    return [hashlib.blake2b(normalise(text[a:b]).encode(), digest_size=16).digest() for a, b, _, _ in spans_of(text, breaks)]


def unit_rows(docs: DataFrame, id_col="doc_id", text_col="text", unit="line") -> DataFrame:
    """A row of ``UNITS`` for every block and every sentence that is not blank."""
    name = unit
    ready_workers(docs.sparkSession)
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    schema = pa.schema([(column.split()[0], t) for column, t in zip(UNITS.split(", "), types, strict=True)])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        breaks = BREAKS[name]
        for batch in batches:
            for piece in pieces(batch, PIECE_BYTES):
                found = [digests_of(text, breaks) for text in piece.column(2).to_pylist()]
                n = np.array([len(d) for d in found])
                row = np.repeat(np.arange(len(n)), n)
                number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                own = [piece.column(k).take(pa.array(row)) for k in (0, 1)]
                made = pa.RecordBatch.from_arrays([*own, pa.array(number, pa.int32()), pa.array(chain.from_iterable(found), pa.binary())], schema=schema)
                for at in range(0, made.num_rows, BATCH_ROWS):
                    yield made.slice(at, BATCH_ROWS)

    named = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    rows = named.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    return rows.mapInArrow(spread, UNITS)


def repeated_units(docs: DataFrame, id_col="doc_id", text_col="text", unit="line") -> DataFrame:
    """id, tie, again: the numbers of the units of every row that occurred before, where there are any."""
    units = unit_rows(docs, id_col, text_col, unit)
    place = F.struct(*ROW, "unit")
    many = units.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    many = materialize(many, "repeated-units")
    # A digest with a thousandth of all repeated units is hot: at most a thousand are, and they are broadcast.
    total = many.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(many.where(F.col("n") * 1000 >= total).select("digest", F.col("first").alias("hot_first")))
    rest = many.where(F.col("n") * 1000 < total).select(F.col("digest").alias("key"), "first")
    # A hot unit needs no second join: its key is its own place, which spreads it and meets nothing.
    own = F.concat(F.lit("unit "), F.col("id"), F.lit(" "), F.col("tie"), F.lit(" "), F.col("unit")).cast("binary")
    known = units.join(hot, "digest", "left").select(
        *ROW, "unit", F.when(F.col("hot_first").isNull(), F.col("digest")).otherwise(own).alias("key"), (place != F.col("hot_first")).alias("hot_again")
    )
    # A unit that occurs once joins with nothing.
    again = known.join(rest, "key", "left").where(F.coalesce("hot_again", place != F.col("first"), F.lit(False)))
    # Repeated rows have the same units; each counts once.
    return again.groupBy(*ROW).agg(F.collect_set("unit").alias("again"))


def passages_of(text: str, again: set[int], breaks: re.Pattern, min_run_chars: int) -> list[tuple[int, int, int]]:
    """Start, stop and normalised characters of every passage of ``text`` that goes; ``again`` are the numbers of the units that occurred before."""
    out: list[tuple[int, int, int]] = []
    run: list[tuple[int, int, int, int]] = []  # start, stop, characters and the block that goes (its start, or -1) of every sentence

    def close() -> None:
        # A long run goes as one passage, of a short one the whole blocks.
        if sum(r[2] for r in run) >= min_run_chars:
            parts = [run]
        else:
            parts = [list(own) for block, own in groupby(run, itemgetter(3)) if block >= 0]
        out.extend((own[0][0], own[-1][1], sum(r[2] for r in own)) for own in parts if own)
        run.clear()

    gone, gone_stop = -1, -1
    for number, (start, stop, block, sentence) in enumerate(spans_of(text, breaks)):
        if block and number in again:
            gone, gone_stop = start, stop
        if not sentence:
            continue
        inside = gone_stop >= stop
        if inside or number in again:
            run.append((start, stop, len(normalise(text[start:stop])), gone if inside else -1))
        elif run:
            close()
    close()
    return out


CLEANED = "id long, text string, removed array<struct<start:int,stop:int,chars:bigint>>"
_REMOVED = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("chars", pa.int64())]))


def _cleaned(rows: DataFrame, unit: str, min_run_chars: int) -> DataFrame:
    """``CLEANED`` of rows of id, text and again (null: nothing)."""
    name = unit
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("removed", _REMOVED)])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        breaks = BREAKS[name]
        for batch in batches:
            for piece in pieces(batch, PIECE_BYTES):
                texts, removed = piece.column(1).to_pylist(), []
                for k, again in enumerate(piece.column(2).to_pylist()):
                    gone = passages_of(texts[k], set(again), breaks, min_run_chars) if again else []
                    removed.append([{"start": a, "stop": b, "chars": n} for a, b, n in gone])
                    if gone:
                        edges = [0, *chain.from_iterable((a, b) for a, b, _ in gone), len(texts[k])]
                        texts[k] = "".join([texts[k][a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string()), pa.array(removed, _REMOVED)], schema=schema)

    return rows.select("id", "text", "again").mapInArrow(clean, CLEANED)


def line_dedup(docs: DataFrame, id_col="doc_id", text_col="text", unit="line", min_run_chars: int = 100) -> DataFrame:
    """Every document without its repeated passages: id, text, n_removed,
    removed_chars, removed (array of start, stop, chars; offsets of the
    original text in code points, end exclusive, in order).

    A null text stays null with nothing removed. Rows without an id cannot be
    ranked: they are returned unchanged and their units count nowhere. Rows
    that repeat an id with the same text are one document and get the same
    passages; rows that repeat an id with another text are documents of their
    own, ranked by a hash of the text. Other columns are not read; an empty table gives an empty result.
    """
    found = repeated_units(docs, id_col, text_col, unit).select(F.col("id").alias("its_id"), F.col("tie").alias("its_tie"), "again")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    out = _cleaned(rows.join(found, (F.col("id") == F.col("its_id")) & (F.col("tie") == F.col("its_tie")), "left"), unit, min_run_chars)
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])
    return out.select(F.col("id").alias(id_col), "text", F.size("removed").cast("long").alias("n_removed"), length.alias("removed_chars"), "removed")
