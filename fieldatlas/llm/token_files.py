"""Token-id files: concatenated ids, with Elias-Fano coded document boundaries.

A data set is a folder of files; in the order of (shard, part) they hold all
documents in ascending id order. One file::

    magic (8 bytes) | ids of all documents before this file (8, big-endian) |
    HEAD | boundaries | document ids | ids | newline

Boundaries are the places behind each document's last id, counted from the
file's start, so they are below 2**31 and need no 64-bit table; they and the
document ids (less the smallest) are Elias-Fano coded. Ids are little-endian
integers of two bytes where the vocabulary allows it, else four. Documents
without an id come first and have no entry among the document ids.

Writing: rows are dealt by range of (id, hash of the text, place in the input),
so ids come out in order and an id held by many rows is spread; each task codes
its rows in order and closes a file whenever ``file_ids`` ids are together. The
files' contents are stored once with their numbers of ids, a running sum over
files gives each its first place, and Spark's own writer commits them, one row a
file, to any storage Spark can reach (each ends in the newline of that writer).
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from fieldatlas.llm.chunks import Chunks, by_kind, encode_texts, encode_words, json_tokenizer, pieces
from fieldatlas.llm.elias_fano import EliasFano, encode
from fieldatlas.llm.text import ready_workers, whole
from fieldatlas.session import default_parallelism, release_tables, scratch_path

MAGIC = b"FATOKEN1"
HEAD = struct.Struct("<IIIIBq")  # shard, part, documents, those without an id, bytes an id, smallest id
#: Text that one range of ids should hold; smaller inputs are cut into a few ranges a core.
RANGE_BYTES = 64 << 20
#: Up to this many files, their places (24 bytes each) are broadcast to the tasks that write them.
MOST_BROADCAST = 1 << 20


class TokenFile:
    """One file's bytes; offsets come from the select structures."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if bytes(data[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token file")
        self.first = int.from_bytes(data[8:16], "big")
        self.shard, self.part, self.n, self.nameless, width, self.least = HEAD.unpack_from(data, 16)
        at = 16 + HEAD.size
        self.ends = EliasFano(data[at:])
        at += self.ends.size
        self.names = EliasFano(data[at:])
        at += self.names.size
        total = int(self.ends.select([self.n - 1])[0]) if self.n else 0
        self.ids = np.frombuffer(data, f"<u{width}", total, at)
        if len(data) != at + total * width + 1:
            raise ValueError("a token file of another length than its boundaries say")

    def offsets(self, ks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where documents ``ks`` start and stop among the file's ids."""
        ks = np.asarray(ks, np.int64)
        starts = np.zeros(len(ks), np.int64)
        starts[ks > 0] = self.ends.select(ks[ks > 0] - 1)
        return starts, self.ends.select(ks)

    def document(self, k: int) -> np.ndarray:
        """The ids of document ``k`` of the file."""
        (start,), (stop,) = self.offsets([k])
        return self.ids[start:stop]

    def doc_ids(self) -> pa.Array:
        named = self.names.select(np.arange(self.names.n)) + self.least
        return pa.concat_arrays([pa.nulls(self.nameless, pa.int64()), pa.array(named, pa.int64())])


def _body(shard: int, part: int, doc_ids: list, sizes: list[int], ids: list[bytes], width: int) -> bytes:
    """A file's bytes behind magic and first place; ids are ascending, None first."""
    named = np.array([i for i in doc_ids if i is not None], np.int64)
    least = int(named[0]) if len(named) else 0
    head = HEAD.pack(shard, part, len(doc_ids), len(doc_ids) - len(named), width, least)
    # Differences of 64-bit ids: exact as unsigned numbers.
    above = named.astype(np.uint64) - np.uint64(least & (2**64 - 1))
    return b"".join([head, encode(np.cumsum(sizes, dtype=np.int64)), encode(above), *ids])


#: Chunks and words in one table are fewer than in one each, so it may hold more.
SHARE = 1.5
#: What a chunk without white space is cut into: runs of letters (ASCII and Latin up to U+023F, but for U+0130, which folds to two signs), and of other ASCII signs.
#: An apostrophe stays with the letters behind it, and what touches any other character stays whole.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LETTER = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf])"
_UNITS = re.compile(_LETTER + rb"+(?![A-Za-z\x80-\xff])|[!-@\[-`{-~]+(?:\Z|(?<!')(?=[A-Za-z]))|[\x00-\xff]+")


class Coder:
    """Packed ids of UTF-8 texts by a tokenizer that drops white space and folds case.

    Texts are cut at ASCII white space, chunks not met before into words and
    signs (lower-cased where they are ASCII), and what is new of those goes to the library.
    """

    def __init__(self, data: bytes, special_as_text: bool):
        self.tokenizer = json_tokenizer(data, special_as_text)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.special = [] if special_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.edge = np.zeros(max(names.values(), default=0) + 1, bool)
        self.edge[[i for t, i in names.items() if suffix and t.endswith(suffix)]] = True
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        folds = normal is not None and normal.normalize_str("A") == "a"
        self.fold = bytes.lower if folds else bytes
        # Lower-case ASCII words come through normalizer and pre-tokenizer as they are, so both may be left out.
        self.plain = self.tokenizer
        if cut is not None and cut.pre_tokenize_str(_LETTERS) == [(_LETTERS, (0, 26))] and (normal is None or normal.normalize_str(_LETTERS) == _LETTERS):
            self.plain = json_tokenizer(data, True)
            self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        # One table for chunks and for what they are cut into: most words are met as both.
        self.units = Chunks(bytes.split, lambda chunks: self.units.parts(list(map(self._cut, chunks)), self._encode), SHARE)

    def _cut(self, chunk: bytes) -> list[bytes]:
        if chunk.isalpha():
            return [self.fold(chunk)]
        if b"|" in chunk and any(s in chunk.lower() for s in self.special):
            return [chunk]
        return [self.fold(u) if u.isascii() else u for u in _UNITS.findall(chunk)]

    def _encode(self, units: list[bytes]) -> list[bytes]:
        def many(tokenizer: Tokenizer) -> Callable[[list[str]], list[bytes]]:
            return lambda words: encode_words(tokenizer, words, " ", self.edge, True, self.kind)

        rest = lambda found: by_kind(found, str.isalpha, many(self.tokenizer), lambda signs: encode_texts(self.tokenizer, signs, self.kind))
        return by_kind([u.decode() for u in units], lambda u: u.isascii() and u.islower() and u.isalpha(), many(self.plain), rest)

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The packed ids of every text."""
        return list(map(b"".join, self.units.of(list(map(self._folded, texts)))))

    def _folded(self, text: bytes) -> bytes:
        """With A-Z lower-cased, unless a special token would come of it, or a letter and a mark (U+0300 to U+037F) that are one sign in one case only."""
        low = self.fold(text)
        return text if b"\xcc" in text or b"\xcd" in text or any(s in low for s in self.special) else low


_coders: dict[str, Coder] = {}


def _coder(name: str, data: bytes, special_as_text: bool) -> Coder:
    """One tokenizer a worker."""
    if name not in _coders:
        _coders.clear()
        _coders[name] = Coder(data, special_as_text)
    return _coders[name]


def _files(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, file_ids: int, special_as_text: bool, ranges: int) -> DataFrame:
    """shard, part, n_ids and body of every file, in order of ids."""
    spark = docs.sparkSession
    ready_workers(spark)
    with open(tokenizer, "rb") as f:
        held = spark.sparkContext.broadcast(f.read())
    name = f"{tokenizer} {special_as_text}"
    text = whole(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("place")]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(name, held.value, special_as_text)
        width = coder.width
        shard, part = TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(width, "little")
        doc_ids, sizes, ids, together = [], [], [], 0

        def close() -> pa.RecordBatch:
            made = _body(shard, part, doc_ids, sizes, ids, width)
            return pa.RecordBatch.from_pylist([{"shard": shard, "part": part, "n_ids": together, "body": made}], schema=schema)

        for batch in batches:
            for piece in pieces(batch):
                names, texts = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                for doc_id, coded in zip(names, coder.of(texts), strict=True):
                    packed = coded + end
                    if together and together + len(packed) // width > file_ids:
                        yield close()
                        part, together = part + 1, 0
                        doc_ids, sizes, ids = [], [], []
                    doc_ids.append(doc_id)
                    sizes.append(len(packed) // width)
                    ids.append(packed)
                    together += sizes[-1]
        if doc_ids:
            yield close()

    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("body", pa.binary())])
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("id", "text")
    return dealt.mapInArrow(spread, "shard int, part int, n_ids long, body binary")


def _first(files: DataFrame) -> DataFrame:
    """shard, part, first: the ids of all files before each. Sums run inside shards, then over one row a shard."""
    slim = files.select("shard", "part", "n_ids")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = slim.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return slim.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shards, "shard").select("shard", "part", (F.col("base") + F.col("inside")).alias("first"))


def _big_endian(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col="doc_id", text_col="text", end_id: int = 1, file_ids: int = 1 << 21, special_as_text: bool = False) -> int:
    """Codes every whole text, adds ``end_id`` to each document and writes the files to ``path``, in ascending id order.

    ``tokenizer`` is a file of the tokenizers library, read by the driver;
    its pre-tokens must be runs of letters, of other signs or of apostrophe and
    letters, without white space. The strings of its special tokens
    are special tokens in texts too, as in the library, unless
    ``special_as_text``. Null texts are empty: their documents hold the end id
    only. Rows without an id come first; rows that repeat an id stand side by
    side, ordered by a hash of their text. A file holds ``file_ids`` ids at most
    unless one document has more. Other columns are not read; an empty table
    gives a folder without files. Returns the number of ids written.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    ranges = max(-(-size // RANGE_BYTES), 4 * default_parallelism(spark))
    store = scratch_path(spark, "token-files")
    _files(docs, tokenizer, id_col, text_col, end_id, file_ids, special_as_text, ranges).write.options(**{"compression": "none", "parquet.enable.dictionary": "false"}).parquet(store)
    staged = spark.read.parquet(store)
    total = staged.agg(F.count(F.lit(1)).alias("files"), F.sum("n_ids").alias("ids")).first()
    places = _first(staged)
    if total.files <= MOST_BROADCAST:
        places = F.broadcast(places)
    whole_files = staged.join(places, ["shard", "part"]).select(F.concat(F.lit(MAGIC), _big_endian(F.col("first")), F.col("body")).cast("string").alias("value"))
    whole_files.write.mode("overwrite").option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    release_tables(spark, store)
    return total.ids or 0


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary, four little-endian bytes an id), from the files alone."""
    ready_workers(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                names = file.doc_ids()
                # Runs of documents of about a million ids.
                at = 0
                while at < file.n:
                    start, _ = file.offsets([at])
                    stop = at + max(1, int(np.searchsorted(file.offsets(np.arange(at, min(file.n, at + 8192)))[1], start[0] + (1 << 20), "right")))
                    starts, stops = file.offsets(np.arange(at, stop))
                    data = file.ids[starts[0] : stops[-1]].astype("<u4").tobytes()
                    edges = np.concatenate([starts, stops[-1:]]) - starts[0]
                    ids = pa.Array.from_buffers(pa.binary(), stop - at, [None, pa.py_buffer((4 * edges).astype(np.int32)), pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([names.slice(at, stop - at), pa.array(starts + file.first), pa.array(stops - starts), ids], schema=schema)
                    at = stop

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    return files.select("content").mapInArrow(spread, "doc_id long, start long, n_tokens long, ids binary")
