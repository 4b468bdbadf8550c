"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizations of the same bytes are two sorted lists of token ends. Their
merge (of equal ends A's first) has one step a token; a step is a link, the
overlap of the A and the B token there, unless it is a B end equal to the A end
before it, which closes a group instead. Binary searches along diagonals cut a
merge into pieces of ``STEPS`` steps that need nothing of each other but one
token beyond the cut on each side; pieces of long texts therefore go to different
tasks like short texts do. A piece counts its links and spells out its
groups; what it leaves open at its edges is stitched to its neighbours'.

How many links of the corpus hold an id pair is counted in two levels: pieces
lie in blocks of bounded size, a block's distinct pairs are counted first, and
the corpus's counts come back to each block once for each of its pairs.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from fieldatlas.llm.chunks import Chunks, at_spaces, by_kind, encode_texts, encode_words, json_tokenizer, pieces
from fieldatlas.llm.text import ready_workers, whole
from fieldatlas.session import materialize, scratch_path

#: Merge steps of a piece, and of the pieces of a block.
STEPS = 1 << 16
BLOCK_STEPS = 1 << 20


@dataclass(frozen=True)
class Side:
    """A tokenizer of space + text by its file's bytes: byte-level JSON, or a sentencepiece model, which adds the space itself."""

    name: str
    data: bytes
    byte_level: bool


def read_side(path: str) -> Side:
    """The tokenizer in file ``path``: byte-level BPE of the tokenizers library (.json) or a sentencepiece model."""
    with open(path, "rb") as f:
        return Side(path, f.read(), path.endswith(".json"))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


#: The pre-tokens of byte-level tokenizers; used on ASCII text only, where all libraries agree on letters.
_PRE_TOKEN = regex.compile(public_tokenizers.PATTERN)


class ByteLevel:
    """A byte-level tokenizer on space + chunk: chunks not met before are cut into pre-tokens, and new ones of those go to the library."""

    def __init__(self, data: bytes):
        self.tokenizer, letters = json_tokenizer(data, special_as_text=True), _byte_letters()
        entries = {i: t for t, i in self.tokenizer.get_vocab().items()}
        # Special tokens are never met; their names may hold other letters.
        self.tokens = [bytes(letters.get(c, 0) for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        self.kind = _kind(self.tokens)
        self.edge = np.array([t[:1] == b" " for t in self.tokens])
        # A space and ASCII letters are one pre-token, spelled by the letter for the space and themselves.
        self.plain, self.space = json_tokenizer(data, special_as_text=True), next(c for c, b in letters.items() if b == 0x20)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Half the rows of the table of chunks, which asks for them: a worker's memory is short.
        self.units = Chunks(lambda text: _PRE_TOKEN.findall(text) if text.isascii() else [text], self._encode, 0.5)

    def _encode(self, units: list[str]) -> list[bytes]:
        words = lambda found: encode_words(self.plain, [self.space + w[1:] for w in found], " ", self.edge, False, self.kind)
        others = lambda found: encode_texts(self.tokenizer, found, self.kind)
        return by_kind(units, lambda u: u[0] == " " and u.isascii() and u[1:].isalpha(), words, others)

    def many(self, chunks: list[str]) -> list[bytes]:
        return list(map(b"".join, self.units.of([" " + c for c in chunks])))


class Sentence:
    """A sentencepiece model, which puts the space before a chunk itself."""

    def __init__(self, data: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        names = map(self.model.id_to_piece, range(self.model.vocab_size()))
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.kind = _kind(self.tokens)

    def many(self, chunks: list[str]) -> list[bytes]:
        code = "H" if self.kind.itemsize == 2 else "I"
        return [array(code, ids).tobytes() for ids in self.model.encode(chunks, num_threads=1)]


def _kind(tokens: list) -> np.dtype:
    return np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")


class Pair:
    """Both tokenizers, and the chunks that they have coded."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = ((ByteLevel if s.byte_level else Sentence)(s.data) for s in (a, b))
        for side in (self.a, self.b):
            side.sizes = np.array([len(t) for t in side.tokens], np.int64)
            side.spelling = pa.array(side.tokens, pa.binary())
        self.chunks = Chunks(at_spaces, self._many)
        self.spelled: list[list[str]] | None = None

    def _many(self, chunks: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids of A and B, and whether both sides' bytes are those of space + chunk."""
        given = pa.array([" " + c for c in chunks], pa.string()).cast(pa.binary())
        coded = [(side.many(chunks), side) for side in (self.a, self.b)]
        same = pc.and_(*[pc.equal(_spelled(side, packed), given) for packed, side in coded])
        return list(zip(coded[0][0], coded[1][0], same.to_pylist(), strict=True))

    def of(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B of every text; none where their bytes are not those of space + text."""
        for text, coded in zip(texts, self.chunks.of(texts), strict=True):
            own_a, own_b, same = zip(*coded, strict=True)
            a, b = np.frombuffer(b"".join(own_a), self.a.kind), np.frombuffer(b"".join(own_b), self.b.kind)
            if not text or not all(same):
                given = b" " + text.encode()
                if not text or any(b"".join(map(s.tokens.__getitem__, x.tolist())) != given for s, x in ((self.a, a), (self.b, b))):
                    a, b = a[:0], b[:0]
            yield a, b

    def strings(self) -> tuple[list[str], int]:
        """Every id as text before each sign that may follow it: A ',', A '|', B ',' and B ';'; and the number of A's."""
        if self.spelled is None:
            n, m = len(self.a.tokens), len(self.b.tokens)
            self.spelled = [f"{i}{s}" for k, s in ((n, ","), (n, "|"), (m, ","), (m, ";")) for i in range(k)]
        return self.spelled, len(self.a.tokens)


def _spelled(side: ByteLevel | Sentence, packed: list[bytes]) -> pa.Array:
    """The bytes of the tokens of every run of packed ids."""
    ids = np.frombuffer(b"".join(packed), side.kind)
    edge = np.cumsum([0, *map(len, packed)]) // side.kind.itemsize
    # The tokens stand one after the other as a run's bytes do, so only its ends are worked out.
    ends = np.append(0, np.cumsum(side.sizes[ids]))[edge].astype(np.int32)
    joined = side.spelling.take(pa.array(ids)).buffers()[2] if len(ids) else None
    return pa.Array.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(ends), joined or pa.py_buffer(b"")])


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(a: Side, b: Side) -> Pair:
    """One pair of tokenizers a worker."""
    key = (a.name, b.name)
    if key not in _pairs:
        _pairs.clear()
        _pairs[key] = Pair(a, b)
    return _pairs[key]


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a`` are among the first d steps of the merge, for every diagonal d; of equal ends ``a``'s is first."""
    d = np.asarray(diagonals, np.int64)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) // 2, 0)
        taken = np.zeros(len(d), bool)
        taken[open_] = a[mid[open_]] <= b[(d - 1 - mid)[open_]]
        low, high = np.where(open_ & taken, mid + 1, low), np.where(open_ & ~taken, mid, high)
    return low


def cut(a_ends: np.ndarray, b_ends: np.ndarray, steps: int) -> list[tuple[int, int, int, int]]:
    """The merge in pieces of equal work: (first A, next A, first B, next B) of each."""
    total = len(a_ends) + len(b_ends)
    diagonals = np.append(np.arange(0, total, steps), total)
    i = merge_path(a_ends, b_ends, diagonals)
    j = diagonals - i
    return list(zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist(), strict=True))


def steps_of(a_size: np.ndarray, b_size: np.ndarray, n_a: int, n_b: int, lag: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A piece's links (places of the A and the B token in it) and the ends that close its groups.

    Sizes are of its tokens, those beyond the cut included; its own are the
    first ``n_a`` and ``n_b``. Its first A token starts ``lag`` bytes behind its
    first B token.
    """
    a_ends, b_ends = lag + np.cumsum(a_size), np.cumsum(b_size)
    # The A end before the piece may be equal to its first B end.
    before = np.searchsorted(a_ends, b_ends[:n_b], "left")
    equal = np.zeros(n_b, bool)
    inside = before < n_a
    equal[inside] = a_ends[before[inside]] == b_ends[:n_b][inside]
    equal |= b_ends[:n_b] == lag
    alone = np.flatnonzero(~equal)
    left = np.concatenate([np.arange(n_a), np.searchsorted(a_ends, b_ends[alone], "right")])
    right = np.concatenate([np.searchsorted(b_ends, a_ends[:n_a], "left"), alone])
    return left, right, b_ends[:n_b][equal]


@dataclass
class Groups:
    """A piece's groups as text: those it opens and closes, and its parts of the groups at its edges."""

    closed: int
    head_a: str
    head_b: str
    body: str
    tail_a: str
    tail_b: str


def spell(pair: Pair, a: np.ndarray, b: np.ndarray, lag: int, closing: np.ndarray) -> Groups:
    """``a1,a2|b1;a3|b2,b3`` of a piece's own ids; ``closing`` are the ends of its groups."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    a_ends, b_ends = lag + np.cumsum(pair.a.sizes[a]), np.cumsum(pair.b.sizes[b])
    ga, gb = np.searchsorted(closing, a_ends, "left"), np.searchsorted(closing, b_ends, "left")
    texts, n = pair.strings()
    # A group's A ids stand before its B ids; the last of each has the sign that ends its list.
    at_a = np.arange(len(a)) + np.searchsorted(gb, ga, "left")
    at_b = np.arange(len(b)) + np.searchsorted(ga, gb, "right")
    last_a, last_b = np.append(ga[1:] != ga[:-1], True)[: len(a)], np.append(gb[1:] != gb[:-1], True)[: len(b)]
    codes = np.empty(len(a) + len(b), np.int64)
    codes[at_a] = a + np.where(last_a, n, 0)
    codes[at_b] = 2 * n + b + np.where(last_b, len(pair.b.tokens), 0)
    spelled = [texts[c] for c in codes.tolist()]

    def part(g: int) -> tuple[str, str]:
        x, y = int((ga == g).sum()), int((gb == g).sum())
        first = 0 if g == 0 else len(spelled) - x - y
        return "".join(spelled[first : first + x])[:-1], "".join(spelled[first + x : first + x + y])[:-1]

    m = len(closing)
    head = part(0)
    tail = part(m) if m else ("", "")
    first, last = int((ga == 0).sum() + (gb == 0).sum()), len(spelled) - int((ga == m).sum() + (gb == m).sum())
    return Groups(m, *head, "".join(spelled[first:last])[:-1] if m else "", *tail)


def stitch(parts: list[Groups]) -> str:
    """The text of all groups from the pieces in order."""
    out, open_a, open_b = [], [], []
    for p in parts:
        open_a.append(p.head_a)
        open_b.append(p.head_b)
        if p.closed:
            out.append(",".join(filter(None, open_a)) + "|" + ",".join(filter(None, open_b)))
            if p.body:
                out.append(p.body)
            open_a, open_b = [p.tail_a], [p.tail_b]
    return ";".join(out)


PIECES = "key long, doc_id long, many boolean, block string, piece int, lag int, n_a int, n_b int, a binary, b binary"
_PIECES = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("many", pa.bool_()), ("block", pa.string()), ("piece", pa.int32()), ("lag", pa.int32()), ("n_a", pa.int32()), ("n_b", pa.int32()), ("a", pa.binary()), ("b", pa.binary())]
)


def token_pieces(docs: DataFrame, a: Side, b: Side, id_col="doc_id", text_col="text") -> DataFrame:
    """The pieces of every document's merge, with their ids (``many``: of several pieces); one without tokens has one empty piece.

    ``a`` and ``b`` hold the piece's own ids and one beyond. Keys number rows of
    the input; they are settled when the pieces are stored.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    held = spark.sparkContext.broadcast((a, b))

    def rows(pair: Pair, key: int, doc_id: int | None, text: str, x: np.ndarray, y: np.ndarray) -> Iterator[tuple]:
        if len(x) + len(y) <= STEPS:
            yield key, doc_id, False, 0, 0, len(x), len(y), x.tobytes(), y.tobytes()
            return
        x_ends, y_ends = np.cumsum(pair.a.sizes[x]), np.cumsum(pair.b.sizes[y])
        for k, (i, i_next, j, j_next) in enumerate(cut(x_ends, y_ends, STEPS)):
            lag = int(x_ends[i - 1] if i else 0) - int(y_ends[j - 1] if j else 0)
            yield key, doc_id, True, k, lag, i_next - i, j_next - j, x[i : i_next + 1].tobytes(), y[j : j_next + 1].tobytes()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*held.value)
        block: dict[bool, tuple[str, int]] = {False: ("", BLOCK_STEPS), True: ("", BLOCK_STEPS)}
        for batch in batches:
            for part in pieces(batch):
                keys, ids, texts = (c.to_pylist() for c in part.columns)
                out = []
                for key, doc_id, text, (x, y) in zip(keys, ids, texts, pair.of(texts), strict=True):
                    for key, doc_id, many, piece, lag, n_a, n_b, own_a, own_b in rows(pair, key, doc_id, text, x, y):
                        name, steps = block[many]
                        if steps >= BLOCK_STEPS:
                            name, steps = f"{'many' if many else 'one'}-{key}-{piece}", 0
                        block[many] = name, steps + max(n_a + n_b, 16)
                        out.append((key, doc_id, many, name, piece, lag, n_a, n_b, own_a, own_b))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _PIECES.types, strict=True)], schema=_PIECES)

    named = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return named.mapInArrow(spread, PIECES)


def _links(pair: Pair, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A piece's links as id pairs (A's id in the upper half), the ends that close its groups, and its own ids."""
    a, b = np.frombuffer(row["a"], pair.a.kind), np.frombuffer(row["b"], pair.b.kind)
    left, right, closing = steps_of(pair.a.sizes[a], pair.b.sizes[b], row["n_a"], row["n_b"], row["lag"])
    return a[left].astype(np.int64) << 32 | b[right], closing, a[: row["n_a"]], b[: row["n_b"]]


def block_pairs(stored: DataFrame, a: Side, b: Side) -> DataFrame:
    """block, pair, n: how many links of each block hold an id pair (a block that two tasks read has its pairs twice)."""
    held = stored.sparkSession.sparkContext.broadcast((a, b))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(*held.value)
        block, links, together = None, [], 0

        def close() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(links), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([block] * len(found), pa.string()), pa.array(found), pa.array(n.astype(np.int64))], names=["block", "pair", "n"])

        for batch in batches:
            for part in pieces(batch):
                for row in part.to_pylist():
                    if links and (row["block"] != block or together >= 4 * BLOCK_STEPS):
                        yield close()
                        links, together = [], 0
                    block = row["block"]
                    links.append(_links(pair, row)[0])
                    together += len(links[-1])
        if links:
            yield close()

    return stored.select("block", "lag", "n_a", "n_b", "a", "b").mapInArrow(spread, "block string, pair long, n long")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, count (links of the corpus that hold it), best: whether no pair of its B id has more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id")
    # One row per id of B's vocabulary at most.
    highest = F.broadcast(counts.groupBy(b_id).agg(F.max("count").alias("highest")))
    return counts.withColumn("b_id", b_id).join(highest, "b_id").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


_SUMS = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64())]
_TEXTS = ["head_a", "head_b", "body", "tail_a", "tail_b"]
_ONE = pa.schema([("doc_id", pa.int64()), *_SUMS, ("groups", pa.string())])
_PART = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), *_SUMS, *[(c, pa.string()) for c in _TEXTS]])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _counted(stored: DataFrame, known: DataFrame, a: Side, b: Side, many: bool) -> DataFrame:
    """Every piece's sums and groups, from its block's pairs; where documents have one piece, as their rows."""
    held = stored.sparkSession.sparkContext.broadcast((a, b))
    schema = _PART if many else _ONE

    def count(own: pa.Table, table: pa.Table) -> pa.Table:
        pair, out, rows = pair_of(*held.value), [], own.to_pylist()
        found = [_links(pair, row) for row in rows]
        # One hash of the block's pairs answers for all of its links.
        links = np.concatenate([np.empty(0, np.int64), *[f[0] for f in found]])
        at = pc.index_in(pa.array(links), value_set=pa.array(table["pair"].to_numpy())).to_numpy()
        edge = np.cumsum([0, *[len(f[0]) for f in found]])
        counts, best = (np.append(0, np.cumsum(table[c].to_numpy()[at], dtype=np.int64))[edge] for c in ("count", "best"))
        counts, best = np.diff(counts).tolist(), np.diff(best).tolist()
        for row, (links, closing, x, y), n, n_best in zip(rows, found, counts, best, strict=True):
            spelled = spell(pair, x, y, row["lag"], closing) if len(links) else Groups(0, "", "", "", "", "")
            out.append(
                {
                    "key": row["key"], "doc_id": row["doc_id"], "piece": row["piece"], "n_a": row["n_a"], "n_b": row["n_b"],
                    "n_groups": spelled.closed, "n_links": len(links), "n_best": n_best, "count_sum": n,
                    **({c: getattr(spelled, c) for c in _TEXTS} if many else {"groups": stitch([spelled])}),
                }
            )
        return pa.Table.from_pylist(out, schema=schema)

    left = stored.where("many" if many else "NOT many").groupBy("block")
    right = known.where(F.col("block").startswith("many" if many else "one")).groupBy("block")
    return left.cogroup(right).applyInArrow(count, _ddl(schema))


def _stitched(parts: DataFrame) -> DataFrame:
    """One row per document of several pieces."""

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        groups = stitch([Groups(r["n_groups"], *(r[c] for c in _TEXTS)) for r in rows])
        sums = {c: sum(r[c] for r in rows) for c, _ in _SUMS}
        return pa.Table.from_pylist([{"doc_id": rows[0]["doc_id"], **sums, "groups": groups}], schema=_ONE)

    return parts.groupBy("key").applyInArrow(join, _ddl(_ONE))


def align(docs: DataFrame, a: Side, b: Side, id_col="doc_id", text_col="text") -> DataFrame:
    """How two tokenizers' tokens of every whole text correspond: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    Byte offsets where tokens of both end cut a text into groups, spelled as
    ``a1,a2|b1;a3|b2,b3`` (decimal ids in order). Links are the pairs of an A
    and a B token whose bytes overlap. A pair's count is the number of links of
    all documents that hold its ids; ``n_best`` are a document's links with the
    highest count of their B id (ties included), ``count_sum`` the sum of
    counts over its links. Texts that are null or empty, and those whose A or B
    bytes are not those of space + text, have no tokens: zeros, and no groups.
    Rows are documents of their own, whatever ids or texts they repeat; other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    store = scratch_path(spark, "align-pieces")
    token_pieces(docs, a, b, id_col, text_col).write.option("compression", "zstd").parquet(store)
    stored = spark.read.parquet(store)
    pairs = materialize(block_pairs(stored, a, b), "align-pairs")
    known = materialize(pairs.select("block", "pair").join(pair_counts(pairs), "pair"), "align-counts")
    out = _counted(stored, known, a, b, many=False).union(_stitched(_counted(stored, known, a, b, many=True)))
    return out.withColumnRenamed("doc_id", id_col)
