"""Source divergence audit: which sources of a language use its terms otherwise.

In-mapper stripes: each partition folds whole documents into hash stripes, one
a (language, term), which hold the document frequency and the counts by source.
Full tables are spilled as rows and merged by (language, term) in one shuffle,
so a term that every document holds costs a row per task and source. Merged
stripes of kept terms directly emit the divergences: blocks of stripes meet the
shares of the language's sources, every stripe adds its part to each pair of
sources, and a block passes on sums and its ten best terms a source only.

All arithmetic is on integers. A language's sources are cut into tiles, and its
stripes into blocks, so no task holds more than a block and two tiles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldatlas.llm.chunks import pieces
from fieldatlas.llm.text import ready_workers, whole
from fieldatlas.session import materialize

#: Bytes that belong to terms, lower-cased (A-Z only); all others become spaces. In UTF-8 every byte of a character from U+0080 on is 0x80 or above.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Entries (language, term, source) that a mapper holds before it spills; 256 bytes of text count as one more.
HELD = 800_000
#: Entries that a merging task holds at once.
MERGED = 1 << 16
TILE = 256
#: Cells (stripes x sources of two tiles) that one block may have.
CELLS = 1 << 17
UNIT = 1_000_000_000


def terms(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of letters A-Z, a-z and of characters from U+0080 on, A-Z lower-cased."""
    return data.translate(_FOLD).split()


STRIPES = "lang string, term binary, source string, df long, n long"


def mapper_stripes(docs: DataFrame, text_col="text", lang_col="lang", source_col="source") -> DataFrame:
    """lang, term, source, df, n: the spilled stripes of every partition.

    ``df`` counts the source's documents that hold the term, ``n`` its
    occurrences. A row without a term marks each (lang, source) seen.
    """
    ready_workers(docs.sparkSession)

    def rows(table: dict) -> Iterator[pa.RecordBatch]:
        langs, names, sources, dfs, ns = [], [], [], [], []
        for (lang, source), (df, n) in table.items():
            langs += [lang] * (len(n) + 1)
            sources += [source] * (len(n) + 1)
            names += [None, *n]
            dfs += [0, *map(df.__getitem__, n)]
            ns += [0, *n.values()]
        for a in range(0, len(names), 50_000):
            part = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs[part], pa.string()), pa.array(names[part], pa.binary()), pa.array(sources[part], pa.string()), pa.array(dfs[part], pa.int64()), pa.array(ns[part], pa.int64())],
                names=["lang", "term", "source", "df", "n"],
            )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for piece in pieces(batch):
                for data, lang, source in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    found = terms(data)
                    df, n = table.setdefault((lang, source), (Counter(), Counter()))
                    held -= len(n)
                    n.update(found)
                    df.update(set(found))
                    held += len(n) + (len(data) >> 8) + 1
                    if held >= HELD:
                        yield from rows(table)
                        table, held = {}, 0
        yield from rows(table)

    named = docs.select(whole(text_col).cast("binary").alias("text"), whole(lang_col).alias("lang"), whole(source_col).alias("source"))
    return named.mapInArrow(spread, STRIPES)


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it (null is a value)."""
    one, two = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.fill_null(pc.not_equal(one, two), False).to_numpy(zero_copy_only=False)
    return other | (pc.is_null(one).to_numpy(zero_copy_only=False) != pc.is_null(two).to_numpy(zero_copy_only=False))


def _merge(rows: pa.Table, least_df: int) -> pa.RecordBatch:
    """Whole stripes from sorted entries: those without a term, and those in ``least_df`` documents."""
    terms_, langs = rows["term"].combine_chunks(), rows["lang"].combine_chunks()
    starts = np.flatnonzero(np.append(True, _changes(terms_) | _changes(langs)))
    sizes = np.diff(np.append(starts, len(rows)))
    n = rows["n"].to_numpy()
    dfs, totals = np.add.reduceat(rows["df"].to_numpy(), starts), np.add.reduceat(n, starts)
    kept = (dfs >= least_df) | pc.is_null(terms_).to_numpy(zero_copy_only=False)[starts]
    entry = np.repeat(kept, sizes)
    sources = rows["source"].combine_chunks().filter(pa.array(entry))
    counts = pa.StructArray.from_arrays([sources, pa.array(n[entry])], names=["source", "n"])
    offsets = pa.array(np.append(0, np.cumsum(sizes[kept])).astype(np.int32))
    at = pa.array(starts[kept])
    return pa.RecordBatch.from_arrays(
        [langs.take(at), terms_.take(at), pa.array(dfs[kept]), pa.array(totals[kept]), pa.ListArray.from_arrays(offsets, counts)], names=["lang", "term", "df", "total", "counts"]
    )


def merged_stripes(docs: DataFrame, text_col="text", lang_col="lang", source_col="source", least_df: int = 10) -> DataFrame:
    """lang, term, df, total and counts (array of source, n) of every kept term; and, without a term, the sources of each language.

    Spilled entries are sorted by key in the tasks they are dealt to (on disk
    where they must be) and merged as they stream by; a key's entries are
    combined whenever ``MERGED`` rows are together, so a hot key takes no more room than its sources.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < MERGED:
                continue
            table = _combined(held)
            ends = np.flatnonzero(_changes(table["term"].combine_chunks()) | _changes(table["lang"].combine_chunks()))
            done = int(ends[-1]) + 1 if len(ends) else 0
            if done:
                yield _merge(table.slice(0, done), least_df)
            held, rows = table.slice(done).to_batches(), len(table) - done
        if rows:
            yield _merge(_combined(held), least_df)

    dealt = mapper_stripes(docs, text_col, lang_col, source_col).repartition("lang", "term").sortWithinPartitions("term", "lang")
    return dealt.mapInArrow(spread, "lang string, term binary, df long, total long, counts array<struct<source:string,n:long>>")


def _combined(batches: list[pa.RecordBatch]) -> pa.Table:
    """One entry a (term, lang, source), in the order of the keys."""
    rows = pa.Table.from_batches(batches)
    key = np.append(0, np.cumsum(_changes(rows["term"].combine_chunks()) | _changes(rows["lang"].combine_chunks())))
    source = rows["source"].combine_chunks().dictionary_encode()
    code = key * len(source.dictionary) + source.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(code[order]) > 0))
    found = rows.select(["lang", "term", "source"]).take(pa.array(order[starts]))
    for name in ("df", "n"):
        found = found.append_column(name, pa.array(np.add.reduceat(rows[name].to_numpy()[order], starts)))
    return found


def shares(counts: np.ndarray, sizes: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(UNIT (count + 2) / (size + 2 kept)), exact whatever the counts."""
    if counts.size and int(counts.max()) + 2 > (2**63 - 1) // UNIT:
        exact = (UNIT * (counts.astype(object) + 2)) // (sizes.astype(object) + 2 * kept)
        return 1 + exact.astype(np.int64)
    return 1 + UNIT * (counts + 2) // (sizes + 2 * kept)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are below 2^30, so squares fit 64 bits."""
    return (p - q) * (p - q) // (p + q)


def _best(values: np.ndarray, names: list, most: int) -> list[tuple[bytes, int]]:
    """The highest values, ties to the smaller name."""
    if len(values) > most:
        least = np.partition(values, len(values) - most)[len(values) - most]
        chosen = np.flatnonzero(values >= least)
    else:
        chosen = range(len(values))
    return [(n, -v) for v, n in sorted((-int(values[k]), names[k]) for k in chosen)[:most]]


_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.binary()), ("value", pa.int64())])


def _emit(lang: str, x: int, y: int, stripes: pa.Table, groups: pa.Table, most_terms: int) -> pa.Table:
    """What a block of stripes adds to the pairs between two tiles of sources, and its best terms of tile x where x = y."""
    if not groups.num_rows:  # tiles that no source fell into
        return _OUT.empty_table()
    groups = groups.sort_by("source")
    sources, tile, sizes = groups["source"].to_pylist(), groups["tile"].to_numpy(), groups["size"].to_numpy()
    kept, whole_size = groups["kept"][0].as_py(), groups["whole_size"][0].as_py()
    counts = np.zeros((stripes.num_rows, len(sources)), np.int64)
    if stripes.num_rows:
        lists = stripes["counts"].combine_chunks()
        flat, edge = lists.flatten(), lists.offsets.to_numpy()
        at = {s: k for k, s in enumerate(sources)}
        column = np.array([at[s] for s in flat.field("source").to_pylist()], np.int64)
        counts[np.repeat(np.arange(len(lists)), np.diff(edge)), column] = flat.field("n").to_numpy()
    p = shares(counts, sizes, kept) if stripes.num_rows else counts
    out = []
    for i in np.flatnonzero(tile == x):
        others = np.flatnonzero(tile == y)
        others = others[others > i] if x == y else others
        sums = divergence(p[:, [i]], p[:, others]).sum(axis=0) if len(p) else np.zeros(len(others), np.int64)
        for j, value in zip(others.tolist(), sums.tolist(), strict=True):
            out += [(lang, sources[i], "pair", sources[j].encode(), value), (lang, sources[j], "pair", sources[i].encode(), value)]
    if x == y and len(p):
        names, q = stripes["term"].to_pylist(), shares(stripes["total"].to_numpy(), np.array(whole_size), kept)
        for i in range(len(sources)):
            own = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
            best = _best(divergence(p[own, i], q[own]), [names[k] for k in own.tolist()], most_terms)
            out += [(lang, sources[i], "term", name, value) for name, value in best]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _OUT.types, strict=True)], schema=_OUT) if out else _OUT.empty_table()


def divergences(docs: DataFrame, text_col="text", lang_col="lang", source_col="source", least_df: int = 10, most_terms: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs.

    Part ``pair`` has every other source of the language and the divergence
    from it, summed over all kept terms (those in at least ``least_df`` of the
    language's documents); part ``term`` the ``most_terms`` terms that the
    source uses more than the language does. Null text, language and source are
    the empty string; a source whose documents hold no kept term is a source
    like any other, a language without kept terms has pairs of value 0.
    Repeated rows are documents of their own. Other columns are not read; an
    empty table gives an empty result. Pairs grow with the square of a
    language's sources, as they must.
    """
    stripes = materialize(merged_stripes(docs, text_col, lang_col, source_col, least_df), "stripes")
    counted = stripes.select("lang", F.col("term").isNotNull().alias("kept"), F.explode("counts").alias("c"))
    sizes = counted.groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("size"))
    vocabulary = stripes.groupBy("lang").agg(F.count("term").alias("kept"), F.sum("total").alias("whole_size"))
    # One row a language: into how many tiles its sources go, and into how many blocks its stripes.
    sources = sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.least(F.col("n"), F.lit(2 * TILE)) / CELLS)).cast("int")
    plan = materialize(vocabulary.join(sources, "lang").select("lang", "kept", "whole_size", tiles.alias("tiles"), blocks.alias("blocks")), "stripe-plan")

    def tile(source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.col("tiles")).cast("int")

    keys = ["lang", "x", "y", "block"]
    upper = F.expr("flatten(transform(sequence(0, tiles - 1), x -> transform(sequence(x, tiles - 1), y -> struct(x as x, y as y))))")
    rows = stripes.where("term IS NOT NULL").join(plan.select("lang", "tiles", "blocks"), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    rows = rows.withColumn("at", F.explode(upper)).withColumn("counts", F.filter("counts", lambda c: tile(c["source"]).isin(F.col("at.x"), F.col("at.y"))))
    left = rows.select("lang", "at.x", "at.y", "block", "term", "total", "counts")
    known = sizes.join(plan, "lang").withColumn("tile", tile(F.col("source"))).withColumn("at", F.explode(upper)).where(F.col("tile").isin(F.col("at.x"), F.col("at.y")))
    known = known.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    right = known.select("lang", "at.x", "at.y", "block", "source", "tile", "size", "kept", "whole_size").toDF(*keys, "source", "tile", "size", "kept", "whole_size")

    def emit(key: tuple, stripes: pa.Table, groups: pa.Table) -> pa.Table:
        lang, x, y, _ = (k.as_py() for k in key)
        return _emit(lang, x, y, stripes, groups, most_terms)

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(emit, "lang string, source string, part string, item binary, value long")
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= most_terms))
    return ranked.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")
