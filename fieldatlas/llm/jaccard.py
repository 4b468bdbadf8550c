"""N-gram Jaccard join: classes of documents whose shingle sets link directly or through others.

1. Sets. Every text becomes a sorted array of shingle hashes; equal sets are
   one set from here on (a group of exact copies costs one row per task).
2. Size-banded tiles. Sets that link differ in at most H elements, and their
   sizes fall into one size band or into neighbouring ones. A band cuts the
   hash space into more than H slices; each element in which two sets differ
   touches one slice, so among the first H + 1 slices that a set fills at least
   one is the same in both. A tile is (band, slice, content of the slice). No
   link is lost, and sets that only share a common passage rarely share the
   whole content of a slice.
3. Bitmaps. Sets of a tile carry hashed bitmaps. Every bit that is set in one
   only stands for an element the other lacks, so bit counts bound the overlap
   from above. Pairs within the bound connect a tile's sets into candidate
   clusters; tiles with equal members are compared once.
4. Exact step. Within a candidate cluster the sets themselves are built again
   from the texts, and pairs that pass the bound and are not yet connected are
   decided by exact intersection of the sorted arrays.

Tiles and clusters of more than ``BLOCK`` sets are cut into blocks, and pairs of
blocks go to different tasks, so no task holds more than two blocks. A task
passes on a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm.graph import components
from fieldatlas.llm.shingles import mix, shingle_set, stream
from fieldatlas.llm.text import free_name, lean, quoted, ready_workers
from fieldatlas.session import materialize

BLOCK = 512
#: Members of a tile that are held together to see whether another tile has the same ones.
HELD = 4096
WIDEST = 1 << 15
GROWTH = 1.5
ROUNDS = 8
_ROUND = stream(ROUNDS, 21)
_MARK = stream(4, 22)


class Rule:
    """Links when den * intersection >= num * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * GROWTH)))
        self.edges = np.array(edges)

    def links(self, overlap, a, b):
        return (overlap > 0) & (self.den * overlap >= self.num * (a + b - overlap))

    def most_partner(self, n: int) -> int:
        return n * self.den // self.num

    def most_difference(self, n: int, high: int) -> int:
        """Of a set of n and any it links with, of at most ``high`` elements."""
        return (self.den - self.num) * (n + max(n, min(high, self.most_partner(n)))) // (self.den + self.num)

    def tiles(self, elements: np.ndarray) -> np.ndarray:
        """The tiles of a set, as hashes."""
        n, out = len(elements), []
        band = int(np.searchsorted(self.edges, n, "right")) - 1
        for own in (band, band + 1):
            if own > band and self.most_partner(n) < self.edges[own]:
                break
            high = int(self.edges[own + 1]) - 1
            differ = self.most_difference(n, high)
            if differ == 0:  # only an equal set
                continue
            slices = self.most_difference(high, high) * 10 // 9 + 2
            for k in range(ROUNDS):
                at = ((mix(elements ^ _ROUND[k]) >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
                order = np.argsort(at, kind="stable")
                at = at[order]
                first = np.flatnonzero(np.diff(at, prepend=np.uint64(slices)))
                content = np.add.reduceat(mix(elements[order] + _MARK[0]), first)
                name = at[first] + np.uint64(own << 40) + np.uint64(k << 36)
                out.append(mix(content ^ mix(name * _MARK[1]))[: differ + 1])
                if len(first) > differ:
                    break
            else:  # fills too few slices every time: such sets of a band share a tile
                out.append(mix(np.array([own], np.uint64) * _MARK[2]))
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def set_key(elements: np.ndarray) -> int:
    """A 64-bit name of the set's content (0 for the empty set)."""
    return int(mix(np.add.reduce(mix(elements ^ _MARK[3]))[None] + np.uint64(len(elements)))[0].astype(np.int64)) if len(elements) else 0


def bitmap(elements: np.ndarray, scale: int = 1) -> np.ndarray:
    """Bits 0/1, as many as the next power of two of ``scale`` times the size, 64 at least.

    ``WIDEST`` bounds the memory of a block; the bounds of larger sets are only looser.
    """
    width = min(WIDEST, max(64, 1 << int(scale * len(elements) - 1).bit_length()))
    bits = np.zeros(width, np.uint8)
    bits[(elements & np.uint64(width - 1)).astype(np.int64)] = 1
    return bits


def _fold(bits: np.ndarray, width: int) -> np.ndarray:
    return bits if len(bits) == width else bits.reshape(-1, width).max(axis=0)


def most_overlap(bits: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """[sets, sets]: no overlap is larger."""
    width = min(map(len, bits))
    x = np.array([_fold(b, width) for b in bits], np.float32)
    ones = x.sum(axis=1)
    missing = ones[:, None] - x @ x.T  # elements of the row's set that the column's lacks, at least
    most = sizes[:, None] - missing
    return np.minimum(most, most.T)


def _sets(width: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, bits = [], [], []
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                found = shingle_set(data, width)
                n.append(len(found))
                key.append(set_key(found))
                bits.append(np.packbits(bitmap(found)).tobytes() if len(found) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(bits, pa.binary())], names=["id", "n", "key", "bits"])

    return rows


def _tiles(width: int, rule: Rule) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tiles, keys = [], []
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                found = shingle_set(data, width)
                key = set_key(found)
                if not len(found) or key in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(key)
                own = rule.tiles(found)
                tiles.append(own.view(np.int64))
                keys.append(np.full(len(own), key, np.int64))
            if tiles:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tiles)), pa.array(np.concatenate(keys))], names=["tile", "key"])

    return rows


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (tile, key): the sets of tiles with several, under a name of the member list.

    A tile of more than ``HELD`` sets passes through under its own name, so
    memory does not grow with a tile.
    """
    tile, held, name, out = None, [], None, []

    def flush():
        if name is None and len(held) > 1:
            keys = np.array(held, np.int64)
            mark = mix(np.add.reduce(mix(keys.view(np.uint64)))[None] + np.uint64(len(keys))).view(np.int64)
            out.append((np.repeat(mark, len(keys)), keys))

    def batch_of():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["members", "key"])

    for batch in batches:
        tiles, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(keys) != 0)) + 1
        at = np.concatenate([[0], new]) if len(tiles) else new
        tiles, keys = tiles[at], keys[at]
        edge = np.flatnonzero(np.diff(tiles)) + 1
        # A tile of one set inside the batch has no partner: only runs of several are looked at one by one.
        lone = np.concatenate([[0], edge]) if len(tiles) else edge
        size = np.diff(np.append(lone, len(tiles)))
        for a, n in zip(lone.tolist(), size.tolist(), strict=True):
            if a and a + n < len(tiles) and n == 1:
                continue
            if tiles[a] != tile:
                flush()
                tile, held, name = tiles[a], [], None
            own = keys[a : a + n].tolist()
            own = own[1:] if held and own[0] == held[-1] else own
            held.extend(own)
            if name is None and len(held) > HELD:
                name = tile
            if name is not None and own:
                out.append((np.full(len(held), name), np.array(held, np.int64)))
                held = held[-1:]  # passed on already, kept to tell repeats
        if sum(len(o[1]) for o in out) > 100_000:
            yield batch_of()
            out = []
    flush()
    if out:
        yield batch_of()


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        name = batch.column(0).to_numpy()
        edge = (np.flatnonzero(np.diff(name)) + 1).tolist()
        for a, b in zip([0, *edge], [*edge, len(name)], strict=True):
            if held and held[0].column(0)[0].as_py() != name[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _forest(ids: np.ndarray, side: np.ndarray, may: np.ndarray, proof=None) -> list[tuple[int, int]]:
    """A spanning forest, as (set, smallest of its tree), of the pairs that ``may`` link and that ``proof`` confirms."""
    n = len(ids)
    cross = side[:, None] != side[None, :] if side.any() else ~np.eye(n, dtype=bool)
    trees = _Union(n)
    a, b = np.nonzero(np.triu(may & cross, 1))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        if trees.root(i) != trees.root(j) and (proof is None or proof(i, j)):
            trees.join(i, j)
    least: dict[int, int] = {}
    for i in range(n):
        r = trees.root(i)
        least[r] = min(least.get(r, int(ids[i])), int(ids[i]))
    return [(int(ids[i]), least[trees.root(i)]) for i in range(n) if ids[i] != least[trees.root(i)]]


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidates(rule: Rule) -> Callable:
    """Rows (group, side, id, n, bits) to forests of the pairs within the bitmap bound."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches):
            ids, sizes = group.column(2).to_numpy(), group.column(3).to_numpy()
            bits = [np.unpackbits(np.frombuffer(b, np.uint8)) for b in group.column(4).to_pylist()]
            found += _forest(ids, group.column(1).to_numpy(), rule.links(most_overlap(bits, sizes), sizes[:, None], sizes[None, :]))
            if len(found) >= 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)

    return rows


def _exact(width: int, rule: Rule) -> Callable:
    """Rows (group, side, id, text) to forests of the pairs that link."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches):
            sets = [shingle_set(t, width) for t in group.column(3).cast(pa.binary()).to_pylist()]
            sizes = np.array([len(s) for s in sets])
            may = rule.links(most_overlap([bitmap(s, 4) for s in sets], sizes), sizes[:, None], sizes[None, :])

            def proof(i, j, sets=sets, sizes=sizes):
                return bool(rule.links(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), sizes[i], sizes[j]))

            found += _forest(group.column(2).to_numpy(), group.column(1).to_numpy(), may, proof)
            if len(found) >= 50_000:
                yield _edges(found)
                found = []
        if found:
            yield _edges(found)

    return rows


def _in_blocks(rows: DataFrame, name: str, id_col: str) -> DataFrame:
    """``rows`` dealt to groups of one or two blocks: columns group, side and those of ``rows``.

    A row of a list of up to ``BLOCK`` goes to one group. In longer lists rows
    fall into blocks by hash and each goes to the pair of its block with every
    block; side tells the two apart, and pairs within a block meet in that
    block's own group.
    """
    long = rows.groupBy(name).count().where(F.col("count") > BLOCK).select(name, F.ceil(F.col("count") / (BLOCK // 2)).cast("int").alias("blocks"))
    dealt = rows.join(long, name, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64(F.lit("block"), F.col(id_col)), F.col("blocks")).cast("int")
    each = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair: Column = F.xxhash64(name, F.least("block", "other"), F.greatest("block", "other"))
    return each.select(pair.alias("group"), (F.col("block") > F.col("other")).cast("int").alias("side"), *rows.columns)


def jaccard_classes(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 4, num: int = 85, den: int = 100, salts: int = 16) -> DataFrame:
    """id, n_shingles, component_id for every row with an id; rows without one have null for both ids.

    Words are runs of characters other than space and \\t to \\r, after
    lower-casing A-Z. A set holds the distinct ``width``-word shingles; with
    fewer words the whole sequence is the only one; without words or text it
    is empty and links with nothing. Two documents link when ``den`` *
    intersection >= ``num`` * union. component_id is the smallest id reachable
    by links, itself included. Repeated rows get the same class; an empty
    table gives an empty result; other columns are not read. Elements and sets
    are named by 64-bit hashes.
    """
    ready_workers(docs.sparkSession)
    rule = Rule(num, den)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    sets = materialize(rows.mapInArrow(lean(_sets(width)), "id long, n long, key long, bits binary"), "jaccard-sets")
    # One representative per distinct set: its smallest id.
    named = sets.where("id IS NOT NULL AND n > 0")
    one = named.groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("bits").alias("bits"))

    tiles = rows.where("id IS NOT NULL").select("text").mapInArrow(lean(_tiles(width, rule)), "tile long, key long")
    shared = tiles.repartition("tile").sortWithinPartitions("tile", "key").mapInArrow(lean(_shared), "members long, key long").distinct()
    shared = materialize(shared, "jaccard-tiles")
    with_bits = _in_blocks(shared.join(one, "key").select("members", "id", "n", "bits"), "members", "id").select("group", "side", "id", "n", "bits")
    close = with_bits.repartition("group").sortWithinPartitions("group").mapInArrow(lean(_candidates(rule)), "a long, b long")
    clusters = components(close)

    # Root and members of each candidate cluster, with their texts.
    member = clusters.select("node", "root").union(clusters.select(F.col("root").alias("node"), "root").distinct())
    # Candidates grow with the corpus, so this is a shuffle at every size, never a broadcast.
    placed = _in_blocks(member, "root", "node").hint("merge")
    texts = rows.join(placed, F.col("node") == F.col("id")).select("group", "side", "id", "text")
    linked = texts.repartition("group").sortWithinPartitions("group").mapInArrow(lean(_exact(width, rule)), "a long, b long")
    root = components(linked)

    classes = one.join(root, F.col("id") == F.col("node"), "left").select("key", F.coalesce("root", "id").alias("root"))
    # Classes go back by key and salt, so the copies of one set never meet in one task.
    salted = sets.select("id", "n", "key", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    by_salt = salted.where("id IS NOT NULL AND n > 0").select("key", "salt").distinct().join(classes, "key")
    return salted.join(by_salt, ["key", "salt"], "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("n") > 0, F.col("root")), F.col("id"))).alias("component_id"),
    )


def keep_one_per_class(docs: DataFrame, id_col="doc_id", text_col="text", width: int = 4, num: int = 85, den: int = 100, salts: int = 16) -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest id, of rows that repeat it any one.

    Rows are told apart by a key of their own, so rows that share an id but
    not the text are documents like any others: neither goes because the other
    does, and they link nothing by their id. Rows without an id link with
    nothing and stay.
    """
    key = free_name("_fa_row", docs.columns)
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "jaccard-rows")
    named = keyed.where(F.col(quoted(id_col)).isNotNull()).select(F.col(key).alias("row"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    found = jaccard_classes(named, "row", "text", width, num, den, salts).select("row", "component_id")
    ranked = found.join(named.select("row", "id"), "row").withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    best = ranked.groupBy("component_id").agg(F.min(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Given back by salt, so a large class never meets in one task.
    by_salt = ranked.select("component_id", "salt").distinct().join(best, "component_id")
    gone = ranked.join(by_salt, ["component_id", "salt"]).where(F.col("row") != F.col("best.row")).select(F.col("row").alias(key))
    return keyed.join(gone, key, "left_anti").select(*[F.col(quoted(c)) for c in docs.columns])
