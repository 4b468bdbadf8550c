import heapq
import random
import sys

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from fieldatlas.llm import bpe, kdtree
from fieldatlas.llm.kdtree import Tree, top_k
from llm_rows import empty, odd  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocab():
    return bpe.vocabulary(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def _ids(coder, text):
    return np.frombuffer(coder.encode(text), np.int32).tolist()


def test_minimal_perfect_hash(vocab):
    coder = bpe.Coder(vocab)
    assert sorted(vocab.slots) == list(range(len(vocab.tokens)))  # every place taken, once
    assert all(coder.whole_token(t) == k for k, t in enumerate(vocab.tokens))
    assert coder.whole_token(b"no such token at all") == -1 and coder.whole_token(b"") == -1


def test_encode_against_tiktoken(vocab, oracle, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    coder, r = bpe.Coder(vocab), random.Random(1)
    alphabet = [chr(k) for k in range(32, 127)] + list("éüñßçÀ漢字日本語한국어 ​\n\t\r\x0b\x0c\x1c\x85🙂👍🏽١٢½²Ⅷ́") + ["'s", "'ll", " the", "  ", "\n\n", "aaaa", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(80)))
        assert _ids(coder, text) == oracle.encode_ordinary(text)
    for text in ("", "a" * 5000, "ab" * 3000, " " * 5000):
        assert _ids(coder, text) == oracle.encode_ordinary(text)


def test_small_vocabularies():
    assert bpe.vocabulary({}, "x").tokens == ()
    ranks = {bytes([k]): k for k in range(256)} | {b"ab": 256, b"abc": 257}
    coder = bpe.Coder(bpe.vocabulary(ranks, public_tokenizers.PATTERN))
    assert _ids(coder, "abcab") == [257, 256]
    assert _ids(coder, "cabx") == [99, 256, 120]


def test_words_of_a_large_vocabulary_are_merged_once(vocab, monkeypatch):
    coder, merged, cut = bpe.Coder(vocab), [], []
    monkeypatch.setattr(coder, "merge", lambda data: merged.append(data) or [0])
    split = coder.split
    monkeypatch.setattr(coder, "split", lambda text: cut.append(text) or split(text))
    words = "".join(chr(97 + k) for k in range(26))
    text = " ".join(f"zq{a}{b}{c}{d}xj" for a in words for b in words for c in words[:20] for d in words[:19])
    coder.encode(text), coder.encode(text)
    assert len(merged) <= text.count(" ") + 1  # some 257 000 words, none worked out again
    assert len(cut) <= 2  # words of letters do not go through the pattern


def test_words_are_remembered_once(vocab, oracle):
    """A word of ASCII letters is a row among the chunks only, met alone or beside a sign; it is merged once."""
    coder, merged = bpe.Coder(vocab), []
    merge = coder.merge
    coder.merge = lambda data: merged.append(data) or merge(data)
    text = "It zqvxkj (zqvxkj zqvxkj, and zqvxkj. zqvxkj"
    assert _ids(coder, text) == oracle.encode_ordinary(text)
    assert merged.count(b" zqvxkj") == 1
    assert "zqvxkj" in coder.chunks and " zqvxkj" not in coder.pre_tokens


def test_memory_is_bounded_in_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 1000)
    made = []
    memory = bpe.Memory(lambda piece: made.append(piece) or piece.encode() * 4)
    held = lambda: [*memory.items(), *[i for t in ([memory.older] if isinstance(memory.older, dict) else memory.older) for i in t.items()]]
    for _ in range(2):
        assert [memory[f"w{k}"] for k in range(2900)] == [f"w{k}".encode() * 4 for k in range(2900)]
    assert len(made) == 2900 and len(held()) <= 4000  # the last 3000 are known, few older ones are kept
    for k in range(4000):
        memory[f"{k:04}" + "漢" * 40]
    assert sum(sys.getsizeof(a) + sys.getsizeof(b) for a, b in held()) < 1_000_000
    assert memory["x" * 100] and "x" * 100 not in memory  # long ones are not kept


def test_tables_of_a_size_of_their_own(vocab, oracle, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    coder, made = bpe.Coder(vocab, 1000), []
    merge = coder.merge
    monkeypatch.setattr(coder, "merge", lambda data: made.append(data) or merge(data))
    text = "x " + " ".join(f"zqv{chr(97 + k // 26)}{chr(97 + k % 26)}xj" for k in range(600))
    assert _ids(coder, text) == oracle.encode_ordinary(text) == _ids(coder, text)
    assert len(made) == len(set(made))  # none worked out again


def test_decoding_makes_no_python_object_a_token(vocab):
    class Counted(tuple):
        asked = 0

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)

    counted = bpe.Vocabulary(Counted(vocab.tokens), vocab.pattern, vocab.seeds, vocab.slots, "counted")
    lists = pa.array([[9], [], [300, 301, 302] * 50, [5]], pa.list_(pa.int32()))
    want = [b"".join(vocab.tokens[i] for i in ids) for ids in lists.to_pylist()]
    assert bpe._decoded(counted, lists).to_pylist() == want and Counted.asked == 0
    assert bpe._decoded(vocab, lists.slice(1, 2)).to_pylist() == want[1:3]
    assert bpe._decoded(vocab, lists.slice(1, 1)).to_pylist() == [b""] and bpe._decoded(vocab, lists.slice(0, 0)).to_pylist() == []


def test_cuts_at_spaces_hold_for_the_public_pattern_only(vocab, oracle):
    for text in ("a  b", " a", "a ", "a \t b", "a\x1c \tb", "it 's", "a  b", "▁ a", "a. \n\n b  "):
        assert _ids(bpe.Coder(vocab), text) == oracle.encode_ordinary(text)
    ranks = {bytes([k]): k for k in range(256)} | {b"a b": 256}
    ranks |= {b"a ": 257}
    assert _ids(bpe.Coder(bpe.vocabulary(ranks, r"(?s).+")), "a b a b") == [256, 32, 256]


def test_frames_round_trip(odd, empty, vocab, oracle, monkeypatch):
    out = bpe.decode(bpe.encode(odd, vocab), vocab, "_ids")
    assert out.columns == [*odd.columns, "_ids", "_decoded"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r.text or ""
        assert r["_ids"] == oracle.encode_ordinary(text) and bytes(r["_decoded"]) == text.encode()
    assert bpe.decode(bpe.encode(empty, vocab), vocab, "_ids").count() == 0
    monkeypatch.setattr(bpe, "PIECE_BYTES", 500)
    both = bpe.encode_and_decode(odd, vocab)
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    assert both.columns == out.columns and sorted(both.collect(), key=key) == sorted(rows, key=key)
    assert bpe.encode_and_decode(empty, vocab).count() == 0


def _vectors(n, d, seed):
    r = np.random.default_rng(seed)
    return r.integers(-50, 50, (n, d)).astype(float)


@pytest.mark.parametrize("n,d", [(1, 3), (700, 2), (900, 16), (500, 0)])
def test_tree_against_brute_force(n, d, monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF", 8)
    points = _vectors(n, d, n)
    points[: n // 3] = points[0]  # many equal vectors
    ids = np.random.default_rng(1).permutation(n).astype(np.int64)
    tree = Tree(ids, points)
    for q in range(0, n, 37):
        query = points[q]
        want = heapq.nsmallest(5, ((-int(points[k] @ query), int(ids[k])) for k in range(n) if k != q))
        got = tree.search(int(ids[q]), query, tree.bounds(query[None])[0], 5, -np.inf)
        assert list(zip((-got[1]).astype(int).tolist(), got[0].tolist(), strict=True)) == want


def test_boxes_spare_leaves_of_clustered_vectors():
    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 64)) * 100
    points = np.floor(centres[r.integers(0, 40, 8000)] + r.normal(size=(8000, 64)) * 10)
    ids = np.arange(8000)
    tree = Tree(ids, points)
    leaves = sum(c < 0 for c in tree.child)
    asked = ids[::200]
    for q, bounds in zip(asked, tree.bounds(points[asked]), strict=True):
        scores = points @ points[q]
        assert all(bounds[n] >= scores[np.isin(ids, tree.ids[a:b])].max() for n, (a, b) in enumerate(tree.span) if tree.child[n] < 0)
        got, found = tree.search(int(q), points[q], bounds, 5, -np.inf)
        want = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != q)[:5]
        assert [(-s, i) for s, i in zip(found, got, strict=True)] == want
    assert tree.opened / (len(asked) * leaves) < 0.25


def test_top_k_keeps_rows_of_repeated_ids(spark):
    rows = [(50, [1.0, 1.0]), (1, [0.1, 0.1]), (1, [9.0, 9.0]), (1, [9.0, 9.0]), (2, [0.5, 0.5]), (100, [1.0, 0.0]), (100, [0.0, 2.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), 50).collect()
    own = sorted(tuple(r)[1:] for r in got if r.query_id == 50)
    assert own == [(1, 1, 1179648), (2, 1, 1179648), (3, 100, 131072), (4, 2, 65536), (5, 100, 65536)]
    both = sorted(tuple(r)[1:] for r in got if r.query_id == 100)  # two vectors under one query id: one answer
    assert both == [(1, 1, 1179648), (2, 1, 1179648), (3, 1, 589824), (4, 1, 589824), (5, 50, 131072)]
    many = spark.range(3000).selectExpr("if(id < 2000, 7, id) AS vec_id", "array(cast(1 AS double), cast(id % 3 AS double)) AS embedding")
    assert [r.vec_id for r in top_k(many, 50, shard_rows=64).where("query_id = 2500").orderBy("rank").collect()] == [7] * 5


def test_top_k_frames(spark):
    r = np.random.default_rng(4)
    rows = [(k, r.normal(0, 0.2, 6).tolist(), "x", 1) for k in range(300)]
    rows += [(k, rows[0][1], "x", 1) for k in range(300, 420)]
    rows += [(50, rows[50][1], "x", 1)]  # a repeated row
    rows += [(500, None, "x", 1), (550, [0.1, None, 0.0, 0.0, 0.0, 0.0], "x", 1), (600, [float("nan")] * 6, "x", 1), (650, [float("inf")] * 6, "x", 1), (None, [0.1] * 6, "x", 1)]
    rows += [(700, [0.5, 0.5], "x", 1), (701, [0.25, 0.1], "x", 1), (750, [], "x", 1), (800, [], "x", 1), (850, [1.0, 2.0, 3.0], "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, shard int").repartition(4)
    got = sorted(tuple(r) for r in top_k(frame, 50, shard_rows=64).collect())
    clean = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean[i] = np.floor(256 * np.array(v, np.float32).astype(float))
    want = []
    for i, v in clean.items():
        if i % 50 == 0:
            best = heapq.nsmallest(5, ((-int(w @ v), j) for j, w in clean.items() if j != i and len(w) == len(v)))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert got == sorted(want)
    assert top_k(frame.limit(0), 50).count() == 0


def test_oracles_on_the_small_tables(spark):
    from fieldatlas.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in LLM_ORACLE_SQL.items():
        rel = con.execute(sql)
        names = [c[0] for c in rel.description]
        frame = LLM_QUERIES[name](spark, sf)
        assert sorted(names) == sorted(frame.columns)
        plain = lambda rows: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)
        assert plain(tuple(r) for r in frame.select(*names).collect()) == plain(rel.fetchall())
