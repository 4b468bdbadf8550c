import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldatlas.llm import align as al
from fieldatlas.llm.align import Pair, align, cut, merge_path, read_side, spell, steps_of, stitch
from fieldatlas.llm.queries import op11_token_alignment
from llm_rows import empty, odd  # noqa: F401

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def sides():
    return read_side(A), read_side(B)


@pytest.fixture(scope="module")
def pair(sides):
    return Pair(*sides)


class Whole:
    """Whole texts by the libraries themselves, and plain loops over tokens."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.names = {i: t for t, i in self.a.get_vocab().items()}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
        self.byte = {c: b for b, c in letters.items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.names[i])) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        given = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == given == b"".join(t for _, t in b) else ([], [])

    def expected(self, rows):
        docs, count = [], Counter()
        for key, text in rows:
            a, b = self.tokens(text)
            spans = []
            for side in (a, b):
                at, out = 0, []
                for i, t in side:
                    out.append((i, at, at + len(t)))
                    at += len(t)
                spans.append(out)
            links, j = [], 0
            for x, start, stop in spans[0]:
                while j and spans[1][j - 1][2] > start:
                    j -= 1
                while j < len(spans[1]) and spans[1][j][1] < stop:
                    if spans[1][j][2] > start:
                        links.append((x, spans[1][j][0]))
                    j += 1
            ends = sorted({s[2] for s in spans[0]} & {s[2] for s in spans[1]})
            groups, i, j = [], 0, 0
            for e in ends:
                left, right = [], []
                while i < len(spans[0]) and spans[0][i][2] <= e:
                    left.append(str(spans[0][i][0]))
                    i += 1
                while j < len(spans[1]) and spans[1][j][2] <= e:
                    right.append(str(spans[1][j][0]))
                    j += 1
                groups.append(",".join(left) + "|" + ",".join(right))
            count.update(links)
            docs.append((key, len(a), len(b), links, groups))
        best = defaultdict(int)
        for (_, y), n in count.items():
            best[y] = max(best[y], n)
        return Counter(
            (key, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), ";".join(groups))
            for key, n_a, n_b, links, groups in docs
        )


@pytest.fixture(scope="module")
def whole():
    return Whole()


def test_merge_path():
    r = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.sort(r.choice(60, r.integers(0, 25), replace=False)) for _ in range(2))
        steps = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
        d = np.arange(len(steps) + 1)
        assert merge_path(a, b, d).tolist() == [sum(s == 0 for _, s in steps[:k]) for k in d]


@pytest.mark.parametrize("steps", [1, 2, 3, 7, 10**6])
def test_pieces_give_the_links_and_groups_of_the_whole(pair, whole, steps):
    r = random.Random(steps)
    words = "the Größe naïve 12345 unbelievable!! \n\n  über 漢字漢 🙂🏽 token-ization x".split(" ")
    for _ in range(60):
        text = " ".join(r.choice(words) for _ in range(r.randrange(1, 30)))
        ((a, b),) = pair.of([text])
        a_ends, b_ends = np.cumsum(pair.a.sizes[a]), np.cumsum(pair.b.sizes[b])
        links, parts = Counter(), []
        found = cut(a_ends, b_ends, steps)
        assert all((i2 - i) + (j2 - j) == steps for i, i2, j, j2 in found[:-1])
        for i, i2, j, j2 in found:
            x, y = a[i : i2 + 1], b[j : j2 + 1]
            lag = int(a_ends[i - 1] if i else 0) - int(b_ends[j - 1] if j else 0)
            left, right, closing = steps_of(pair.a.sizes[x], pair.b.sizes[y], i2 - i, j2 - j, lag)
            links.update(zip((left + i).tolist(), (right + j).tolist(), strict=True))
            parts.append(spell(pair, x[: i2 - i], y[: j2 - j], lag, closing))
        a_starts, b_starts = a_ends - pair.a.sizes[a], b_ends - pair.b.sizes[b]
        overlaps = {(i, j) for i in range(len(a)) for j in range(len(b)) if a_starts[i] < b_ends[j] and b_starts[j] < a_ends[i]}
        assert links == Counter(dict.fromkeys(overlaps, 1))
        ((*_, groups),) = whole.expected([(0, text)])
        assert stitch(parts) == groups


def test_chunks_equal_whole_texts(sides, whole, monkeypatch):
    from fieldatlas.llm import chunks

    monkeypatch.setattr(chunks, "REMEMBERED", 40)
    fresh, r = Pair(*sides), random.Random(9)
    alphabet = list("abcXYZ019.,'’\n\t\r\x00\x01\x1c   ­​\x85éüñß漢字日本🙂½▁") + ["'s", "  ", "   ", "\n ", " the", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "é"]
    for _ in range(80):
        texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(50))) for _ in range(15)] + ["", " ", "a ", " a", "x" * 300, "▁", "w " * 40]
        for text, (a, b) in zip(texts, fresh.of(texts), strict=True):
            want_a, want_b = whole.tokens(text)
            assert a.tolist() == [i for i, _ in want_a] and b.tolist() == [i for i, _ in want_b], repr(text)


def test_bytes_of_many_runs_of_ids(sides):
    pair, runs = Pair(*sides), [[7, 300, 301], [], [12], [500, 7]]
    for side in (pair.a, pair.b):
        packed = [np.array(ids, side.kind).tobytes() for ids in runs]
        assert al._spelled(side, packed).to_pylist() == [b"".join(side.tokens[i] for i in ids) for ids in runs]
        assert al._spelled(side, []).to_pylist() == [] and al._spelled(side, [b""]).to_pylist() == [b""]


@pytest.mark.parametrize("steps,block", [(1 << 16, 1 << 20), (50, 400)])
def test_odd_rows(spark, odd, empty, sides, whole, monkeypatch, steps, block):
    monkeypatch.setattr(al, "STEPS", steps)
    monkeypatch.setattr(al, "BLOCK_STEPS", block)
    more = [(500, "a▁b"), (501, " lead and trail "), (502, "<|endoftext|> <s>"), (503, "\x00 \x01")]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + more
    docs = odd.select("doc_id", "text", "c0", "score").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = Counter(map(tuple, align(docs, *sides).collect()))
    assert got == whole.expected(rows)
    assert align(empty, *sides).count() == 0


def test_query(spark, whole):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    want = Counter((*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in whole.expected(rows).elements())
    assert Counter(map(tuple, op11_token_alignment(spark, path).collect())) == want
