"""Language ID by prediction by partial matching (PPM) over bytes.

Each language gets a tree of byte contexts of 0 to 3 bytes with symbol counts.
The code length of a byte in a context is the escape-C estimate: with n
sightings of the context, d of them distinct symbols, a symbol seen c times
costs -log2(c / (n + d)) bits, an unseen one -log2(d / (n + d)) bits plus its
cost in the context shortened by one byte, and below the empty context every
byte costs 8 bits. A context never seen costs nothing to leave. Statistics are
frozen after training, so the cost of a byte depends on the last four bytes
only and the trees of all languages can be stored together, as sorted n-gram
keys with one column of bits per language; a text's code length is a sum of
looked-up bits, exact for the model, computed over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fieldatlas.llm.text import free_name, held_out, lean, numbered, ready_workers

#: Bytes that stand before every text, so that its first bytes have a context.
LEAD = b"\n\n\n"
NO_LANGUAGE = "und"
#: Bits held at once: bytes of a block times languages.
BLOCK_CELLS = 2 << 20
#: The hash of a row falls into one of 2 ** SLOT_BITS slots when a sample is drawn.
SLOT_BITS = 14
#: Languages whose bits share tables: a table has a row for each gram that any of them has.
COLUMNS = 16


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The key of each byte with the ``order`` bytes before it (from byte 3 on)."""
    key = np.zeros(len(data) - len(LEAD), np.uint32)
    for back in range(order, -1, -1):
        key = (key << np.uint32(8)) | data[len(LEAD) - back : len(data) - back]
    return key


class _Lookup:
    """Places of known keys by an open-addressing table, for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        slots = np.full(1 << self.bits, -1, np.int32)
        held = np.zeros(1 << self.bits, np.uint32)
        todo, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(todo):  # each free slot takes one of its claimants; the others move on
            free = slots[at] < 0
            slots[at[free]] = todo[free]
            lost = slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)
        held[slots >= 0] = keys[slots[slots >= 0]]
        self.slots, self.held = slots, held

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        at = self._home(keys)
        out = self.slots[at]
        miss = np.flatnonzero((out >= 0) & (self.held[at] != keys))
        while len(miss):
            at_m = at[miss] = (at[miss] + 1) & ((1 << self.bits) - 1)
            out[miss] = self.slots[at_m]
            miss = miss[(out[miss] >= 0) & (self.held[at_m] != keys[miss])]
        return out


@dataclass
class Block:
    """Bits of some languages: ``pair`` for every two bytes; three and four where seen."""

    languages: list[str]
    pair: np.ndarray  # [65536, languages]: cost of a byte after one byte
    leave: list[tuple[_Lookup, np.ndarray]]  # escape bits of contexts of 2 and of 3 bytes
    seen: list[tuple[_Lookup, np.ndarray]]  # full cost of 3-grams and of 4-grams

    def bits(self, data: np.ndarray) -> np.ndarray:
        """[bytes, languages]: the code length of every byte behind the lead."""
        return self._order(data, 3, None)

    def _order(self, data: np.ndarray, order: int, rows: np.ndarray | None) -> np.ndarray:
        key = grams(data, order)
        key = key if rows is None else key[rows]
        if order == 1:
            return self.pair[key]
        lookup, cost = self.seen[order - 2]
        place = lookup.find(key)
        out = cost[place]
        miss = np.flatnonzero(place < 0)
        if len(miss):
            context, escape = self.leave[order - 2]
            shorter = self._order(data, order - 1, miss if rows is None else rows[miss])
            out[miss] = shorter + escape[context.find(key[miss] >> np.uint32(8))]
        return out


@dataclass
class Model:
    """Bits of all languages, in blocks of columns; a language's bits depend on its own sample only."""

    blocks: list[Block]

    @property
    def languages(self) -> list[str]:
        return [name for block in self.blocks for name in block.languages]


def train(samples: dict[str, list[bytes]]) -> Model:
    """Frozen statistics of the sample texts of each language."""
    names = sorted(samples)
    return Model([_trained({n: samples[n] for n in names[k : k + COLUMNS]}) for k in range(0, len(names), COLUMNS)])


def _trained(samples: dict[str, list[bytes]]) -> Block:
    names = sorted(samples)
    joined = {n: [np.frombuffer(LEAD + t, np.uint8) for t in samples[n]] for n in names}

    def counted(name: str, order: int) -> tuple[np.ndarray, np.ndarray]:
        keys = [grams(t, order) for t in joined[name] if len(t) > len(LEAD)]
        return np.unique(np.concatenate(keys) if keys else np.empty(0, np.uint32), return_counts=True)

    # Order 0 and 1 are dense; below order 0 every byte costs 8 bits.
    cost = np.empty((256, len(names)))
    pair = np.empty((65536, len(names)), np.float64)
    trees = {}
    for k, name in enumerate(names):
        key, n = counted(name, 0)
        total, distinct = n.sum(), len(key)
        cost[:, k] = 8.0 + (np.log2((total + distinct) / distinct) if distinct else 0.0)
        cost[key, k] = np.log2((total + distinct) / n)
        trees[name] = {o: counted(name, o) for o in (1, 2, 3)}
        context, escape, first, many = _contexts(*trees[name][1])
        leave = np.zeros(256)
        leave[context] = escape
        dense = np.repeat(leave, 256) + np.tile(cost[:, k], 256)
        dense[trees[name][1][0]] = many
        pair[:, k] = dense
    model = Block(names, pair.astype(np.float32), [], [])
    for order in (2, 3):
        contexts = np.unique(np.concatenate([trees[n][order][0] >> np.uint32(8) for n in names] or [np.empty(0, np.uint32)]))
        seen = np.unique(np.concatenate([trees[n][order][0] for n in names] or [np.empty(0, np.uint32)]))
        escapes = np.zeros((len(contexts) + 1, len(names)), np.float32)  # the last row: context of no language
        bits = np.zeros((len(seen) + 1, len(names)), np.float32)
        for k, name in enumerate(names):
            context, escape, _, many = _contexts(*trees[name][order])
            escapes[np.searchsorted(contexts, context), k] = escape
            own = np.searchsorted(seen, trees[name][order][0])
            other = np.setdiff1d(np.arange(len(seen)), own, assume_unique=True)
            bits[own, k] = many
            # A gram of another language: leave the context, then the next shorter one.
            bits[other, k] = escapes[np.searchsorted(contexts, seen[other] >> np.uint32(8)), k] + _shorter(model, seen[other], order - 1)[:, k]
        model.leave.append((_Lookup(contexts), escapes))
        model.seen.append((_Lookup(seen), bits))
    return model


def _contexts(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted grams: the contexts, their escape bits, their first grams, and the grams' own bits."""
    context, first, size = np.unique(keys >> np.uint32(8), return_index=True, return_counts=True)
    if not len(keys):
        return context, np.empty(0), first, np.empty(0)
    total = np.add.reduceat(n, first) + size
    return context, np.log2(total / size), first, np.log2(np.repeat(total, size) / n)


def _shorter(model: Block, keys: np.ndarray, order: int) -> np.ndarray:
    """Costs of the last ``order`` + 1 bytes of each key."""
    data = np.zeros((len(keys), len(LEAD) + 1), np.uint8)
    for back in range(order + 1):
        data[:, len(LEAD) - back] = (keys >> np.uint32(8 * back)) & np.uint32(255)
    out = np.empty((len(keys), len(model.languages)), np.float32)
    key = (keys & np.uint32((1 << (8 * (order + 1))) - 1)) if order < 3 else keys
    if order == 1:
        return model.pair[key]
    lookup, cost = model.seen[order - 2]
    place = lookup.find(key)
    out[:] = cost[place]
    miss = np.flatnonzero(place < 0)
    if len(miss):
        context, escape = model.leave[order - 2]
        out[miss] = _shorter(model, key[miss], order - 1) + escape[context.find(key[miss] >> np.uint32(8))]
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """[texts, languages]: bits of each whole text."""
    return np.hstack([np.zeros((len(texts), 0)), *[_block_lengths(block, texts) for block in model.blocks]])


def _block_lengths(model: Block, texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), len(model.languages)))
    most = max(1, BLOCK_CELLS // max(1, len(model.languages)))
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) <= most):
            size += len(texts[stop])
            stop += 1
        if stop - begin == 1 and size > most:  # one very long text, in overlapping pieces
            text = LEAD + texts[begin]
            for a in range(0, size, most):
                piece = np.frombuffer(text[a : a + most + len(LEAD)], np.uint8)
                out[begin] += model.bits(piece).sum(axis=0, dtype=np.float64)
        else:
            group = [LEAD + t for t in texts[begin:stop]]
            data = np.frombuffer(b"".join(group), np.uint8)
            bits = model.bits(data)
            edge = np.cumsum([0] + [len(t) for t in group])
            first, last = edge[:-1], edge[1:] - len(LEAD)  # bits skip the first lead only
            for k in np.flatnonzero(last > first):
                out[begin + k] = bits[first[k] : last[k]].sum(axis=0, dtype=np.float64)
        begin = stop
    return out


def training_sample(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", most_bytes: int = 400_000, all_bytes: int = 80_000_000) -> dict[str, list[bytes]]:
    """For each language at least ``most_bytes`` bytes of texts, or all it has, chosen by hash of the row.

    Every language is sampled. Where they are so many that their samples would
    pass ``all_bytes``, each gets an equal part of that instead of
    ``most_bytes``. Texts are whole up to the wanted bytes, so a language's
    sample is smaller than twice those. Reads only rows that are not held out
    and whose text and language are not null.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(F.lit("sample"), F.col(id_col), F.col(text_col)).alias("at")
    )
    many = rows.select("lang").distinct().count()
    most_bytes = max(1, min(most_bytes, all_bytes // max(1, many)))
    rows = rows.withColumns({"text": F.substring("text", 1, most_bytes), "slot": F.shiftright("at", 64 - SLOT_BITS)})
    # Bytes by slot of the hash: the first slots that hold the wanted bytes, then the first rows of those.
    slots = rows.groupBy("lang", "slot").agg(F.sum(F.octet_length("text")).alias("size"))
    last = _first(slots, "size", most_bytes, "slot").groupBy("lang").agg(F.max("slot").alias("last"))
    near = rows.join(F.broadcast(last), "lang").where("slot <= last")
    found: dict[str, list[bytes]] = {}
    for lang, text in _first(near, F.octet_length("text"), most_bytes, "at", "text").select("lang", "text").collect():
        found.setdefault(lang, []).append(bytes(text))
    return {lang: sorted(texts) for lang, texts in found.items()}


def _first(rows: DataFrame, size, wanted: int, *order: str) -> DataFrame:
    """Of each language, the rows before which the sizes of the others in order sum to less than ``wanted``."""
    before = Window.partitionBy("lang").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.col(size) if isinstance(size, str) else size
    return rows.withColumn("before", F.coalesce(F.sum(size).over(before), F.lit(0))).where(F.col("before") < wanted)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and lang_pred, score, bits_per_byte (underscored where ``docs`` has them).

    The language with the shortest code length, ties to the first in order of
    name. score is its share of 2 ** -(bits per byte) over all languages. A
    null text, or one without a letter, is ``und`` with score 0 and
    bits_per_byte null; so is every text if nothing was learned. Repeated rows
    get the same answer; an empty table gives an empty result.
    """
    names = []
    for name in ("lang_pred", "score", "bits_per_byte"):
        names.append(free_name(name, [*docs.columns, *names]))
    place = docs.columns.index(text_col)
    letter = F.coalesce(F.col(f"c{place}").rlike(r"\p{L}"), F.lit(False))
    ready_workers(docs.sparkSession)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ask = batch.column(batch.num_columns - 1).to_pylist()
            ask = [k for k, yes in enumerate(ask) if yes and model.languages]
            lang, score, per = [NO_LANGUAGE] * batch.num_rows, [0.0] * batch.num_rows, [None] * batch.num_rows
            texts = batch.column(place).take(pa.array(ask, pa.int64())).cast(pa.binary()).to_pylist()
            bits = code_lengths(model, texts) / np.array([[len(t)] for t in texts]).reshape(-1, 1)
            for k, row in zip(ask, bits, strict=True):
                best = int(row.argmin())
                lang[k], per[k], score[k] = model.languages[best], float(row[best]), float(1 / (2.0 ** (row[best] - row)).sum())
            columns = [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(per, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)])
    schema = schema.add("p", "string").add("s", "double").add("b", "double")
    return numbered(docs).select("*", letter.alias("ask")).mapInArrow(lean(answer), schema).toDF(*docs.columns, *names)


def learn(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", most_bytes: int = 400_000) -> Model:
    """The model of the languages of ``docs``, from a bounded sample of its rows that are not held out."""
    return train(training_sample(docs, id_col, text_col, lang_col, most_bytes))
