"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split by the tokenizer's pattern. First tier: a minimal perfect hash
over the vocabulary resolves pre-tokens that are tokens as a whole; its one
candidate is compared byte for byte. Second tier: other pre-tokens are merged
with a heap of candidate pairs over a linked list of bytes, lowest rank and then
leftmost first. Results of short pre-tokens are remembered from task to task of a
Python worker, in tables by age that are bounded in rows and bytes: when the youngest
is full the oldest goes, and what is found in an older one moves back, so frequent
words stay.

Under the public pattern white space only begins pre-tokens, so texts are cut at
spaces first, and chunks between spaces are remembered in the same way.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from operator import getitem

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from fieldatlas.llm.chunks import at_spaces, no_gc
from fieldatlas.llm.text import free_name, kept, numbered, ready_workers

#: Rows of a table, of pre-tokens or of chunks: a new word costs a hundred times a remembered one.
#: ``TABLES`` small tables hold fewer rows than two large ones that are as long in forgetting.
REMEMBERED = 115_000
TABLES = 4
REMEMBER_LENGTH = 48
#: Bytes of a row, about, that fill a table as well: text, ids, and what Python adds to both and to their place in the table.
ROW_BYTES = 240
PLACE_BYTES = 160
PIECE_BYTES = 1 << 19


@dataclass(frozen=True)
class Vocabulary:
    """Tokens by id, the pattern, and the seeds of the minimal perfect hash."""

    tokens: tuple[bytes, ...]
    pattern: str
    seeds: array
    slots: array
    name: str


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def vocabulary(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    """Builds the hash by hash-and-displace.

    Keys fall into buckets; the largest buckets first, each takes the first
    seed that sends its keys to free places. A bucket of one key takes a free
    place directly, stored as a negative seed. ``slots`` has the id at each place.
    """
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    n = len(ranks)
    n_buckets = max(1, n // 3)
    buckets: list[list[bytes]] = [[] for _ in range(n_buckets)]
    for token in ranks:
        buckets[xxhash.xxh64_intdigest(token) % n_buckets].append(token)
    seeds, slots = array("q", [0]) * n_buckets, array("q", [-1]) * n
    by_size = sorted(range(n_buckets), key=lambda b: -len(buckets[b]))
    for b in by_size:
        if len(buckets[b]) < 2:
            break
        seed = 1
        while True:
            places = [xxhash.xxh64_intdigest(t, seed) % n for t in buckets[b]]
            if len(set(places)) == len(places) and all(slots[p] < 0 for p in places):
                break
            seed += 1
        seeds[b] = seed
        for t, p in zip(buckets[b], places, strict=True):
            slots[p] = ranks[t]
    free = (p for p in range(n) if slots[p] < 0)
    for b in by_size:
        if len(buckets[b]) == 1:
            p = next(free)
            seeds[b] = -p - 1
            slots[p] = ranks[buckets[b][0]]
    name = hashlib.sha256(pattern.encode() + b"".join(len(t).to_bytes(4, "big") + t for t in tokens)).hexdigest()
    return Vocabulary(tuple(tokens), pattern, seeds, slots, name)


class Memory(dict):
    """Text to what ``make`` makes of it; short texts are remembered, the last ``rows`` * (``TABLES`` - 1) at least if they are small."""

    def __init__(self, make: Callable[[str], bytes], rows: int | None = None):
        super().__init__()
        self.older: deque[dict[str, bytes]] = deque(maxlen=TABLES - 1)
        self.make, self.bytes, self.rows = make, 0, rows or REMEMBERED

    def __missing__(self, piece: str) -> bytes:
        for table in self.older:
            ids = table.get(piece)
            if ids is not None:
                break
        else:
            ids = self.make(piece)
        if len(piece) <= REMEMBER_LENGTH:
            if len(self) >= self.rows or self.bytes >= self.rows * ROW_BYTES:
                self.older.appendleft(dict(self))
                self.clear()
                self.bytes = 0
            self[piece] = ids
            self.bytes += (1 if piece.isascii() else 4) * len(piece) + len(ids) + PLACE_BYTES
        return ids


class Coder:
    """Packed ids of texts; pre-tokens and chunks are worked out once while they are remembered, ``rows`` of each a table (``REMEMBERED``)."""

    def __init__(self, vocab: Vocabulary, rows: int | None = None):
        self.vocab = vocab
        self.split = regex.compile(vocab.pattern).findall
        self.packed = [array("i", [k]).tobytes() for k in range(len(vocab.tokens))]
        self.ranks = {t: k for k, t in enumerate(vocab.tokens) if t}
        # Ranks of two bytes, a row for each first one.
        self.pairs: list[list[int | None]] = [[None] * 256 for _ in range(256)]
        for t, k in self.ranks.items():
            if len(t) == 2:
                self.pairs[t[0]][t[1]] = k
        self.single = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.pre_tokens, self.chunks = Memory(self._pre_token, rows), Memory(self._chunk, rows)
        self.cuts = vocab.pattern == public_tokenizers.PATTERN

    def whole_token(self, data: bytes) -> int:
        """First tier: the id of ``data`` if it is a token, else -1."""
        vocab = self.vocab
        if not vocab.slots:
            return -1
        seed = vocab.seeds[xxhash.xxh64_intdigest(data) % len(vocab.seeds)]
        place = -seed - 1 if seed < 0 else xxhash.xxh64_intdigest(data, seed) % len(vocab.slots)
        found = vocab.slots[place]
        return found if vocab.tokens[found] == data else -1

    def merge(self, data: bytes) -> list[int]:
        """Second tier: heap over linked bytes.

        A part begins at a byte and ends where ``after`` points; ``found`` has
        its id and ``now`` the heap's entry (rank and place) of its pair with
        the next part, if it has one. Other entries are stale: a place's pairs
        only grow, so none comes back.
        """
        n, rank_of, push, pop = len(data), self.ranks.get, heappush, heappop
        found = list(map(self.single.__getitem__, data))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        shift = n.bit_length()
        mask = (1 << shift) - 1
        pairs = map(getitem, map(self.pairs.__getitem__, data), data[1:])
        now = [-1 if r is None else r << shift | at for at, r in enumerate(pairs)]
        now.append(-1)
        heap = [entry for entry in now if entry >= 0]
        heapify(heap)
        while heap:
            entry = pop(heap)
            at = entry & mask
            if now[at] != entry:
                continue
            gone = after[at]
            after[at] = end = after[gone]
            found[at], found[gone] = entry >> shift, -2
            now[gone] = now[at] = -1
            if end < n:
                before[end] = at
                r = rank_of(data[at : after[end]])
                if r is not None:
                    now[at] = entry = r << shift | at
                    push(heap, entry)
            if at:
                left = before[at]
                r = rank_of(data[left:end])
                if r is None:
                    now[left] = -1
                else:
                    now[left] = entry = r << shift | left
                    push(heap, entry)
        return [r for r in found if r != -2]

    def _pre_token(self, piece: str) -> bytes:
        data = piece.encode()
        found = self.whole_token(data)
        return self.packed[found] if found >= 0 else array("i", self.merge(data)).tobytes()

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pre_tokens.__getitem__, self.split(text)))

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a space and ``chunk``; ASCII letters are one pre-token with it, which is kept as a chunk only."""
        if chunk.isalpha() and chunk.isascii():
            return self._pre_token(" " + chunk)
        own, signs = self.chunks, self.pre_tokens
        return b"".join([own[p[1:]] if p[0] == " " and p[1:].isalpha() and p.isascii() else signs[p] for p in self.split(" " + chunk)])

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, packed as 32-bit integers."""
        if not self.cuts:
            return self._split(text)
        first, *rest = at_spaces(text)
        return b"".join([self._split(first), *map(self.chunks.__getitem__, rest)])


def coder(vocab: Vocabulary, rows: int | None = None) -> Coder:
    return kept("bpe", f"{vocab.name} {rows}", lambda: Coder(vocab, rows))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``PIECE_BYTES`` bytes."""
    if not batch.num_rows:
        return
    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def _with_columns(docs: DataFrame, source: str, none, made: list[tuple[str, DataType]], work) -> DataFrame:
    """``docs`` and the columns that ``work(Arrow array)`` makes of column ``source``, its nulls read as ``none``."""
    given = F.coalesce(F.col(f"c{docs.columns.index(source)}"), none).alias("given")
    names: list[str] = []
    for name, _ in made:
        names.append(free_name(name, [*docs.columns, *names]))
    ready_workers(docs.sparkSession)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                columns = [*piece.columns[:-1], *work(piece.column(piece.num_columns - 1))]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)])
    for name, (_, kind) in zip(names, made, strict=True):
        schema = schema.add(f"made_{name}", kind)
    return numbered(docs).select("*", given).mapInArrow(spread, schema).toDF(*docs.columns, *names)


def _encoded(vocab: Vocabulary, texts: pa.Array, rows: int | None = None) -> pa.Array:
    encode_one = coder(vocab, rows).encode
    with no_gc():
        packed = [encode_one(t) for t in texts.to_pylist()]
    offsets = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _decoded(vocab: Vocabulary, lists: pa.Array) -> pa.Array:
    tokens, sizes = kept("bpe-tokens", vocab.name, lambda: (pa.array(vocab.tokens, pa.binary()), np.array([len(t) for t in vocab.tokens], np.int64)))
    ids, edge = lists.flatten(), lists.offsets.to_numpy()
    # The tokens stand one after the other as a list's bytes do, so only its ends are worked out.
    ends = np.append(0, np.cumsum(sizes[ids.to_numpy()]))[edge - edge[0]].astype(np.int32)
    joined = tokens.take(ids).buffers()[2] if len(ids) else None
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends), joined or pa.py_buffer(b"")])


_IDS, _BYTES = ArrayType(IntegerType()), BinaryType()


def encode(docs: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """All columns and ids (array<int>; renamed ``_ids`` where taken): the whole text's tokens.

    Null and empty texts have no ids. Special tokens are ordinary text. Rows
    are independent, so repeated rows get the same ids; an empty table gives
    an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocab)
    return _with_columns(docs, text_col, F.lit(""), [("ids", _IDS)], lambda texts: [_encoded(held.value, texts)])


def decode(docs: DataFrame, vocab: Vocabulary, ids_col: str = "ids") -> DataFrame:
    """All columns and decoded (binary): the bytes of the ids; null ids give no bytes."""
    held = docs.sparkSession.sparkContext.broadcast(vocab)
    none = F.array().cast("array<int>")
    return _with_columns(docs, ids_col, none, [("decoded", _BYTES)], lambda lists: [_decoded(held.value, lists)])


def encode_and_decode(docs: DataFrame, vocab: Vocabulary, text_col: str = "text", remembered: int | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one pass over the rows: all columns, ids and decoded.

    ``remembered``: rows of a table of words (``REMEMBERED``); more take less time and more memory of a worker.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocab)

    def both(texts: pa.Array) -> list[pa.Array]:
        with no_gc():
            ids = _encoded(held.value, texts, remembered)
            return [ids, _decoded(held.value, ids)]

    return _with_columns(docs, text_col, F.lit(""), [("ids", _IDS), ("decoded", _BYTES)], both)
