import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldatlas.llm import chunks, token_files
from fieldatlas.llm.elias_fano import EliasFano, encode
from fieldatlas.llm.queries import op13_token_files
from fieldatlas.llm.token_files import TokenFile, read_token_files, write_token_files
from llm_rows import empty, odd  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _expected(rows, tokenizer, end_id=1):
    """id, start, n, crc of every row in ascending id order; the text's whole ids by one call."""
    out, start = [], 0
    coded = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id]) for i, t in rows]
    for i, ids in sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 700, 9000])
@pytest.mark.parametrize("most", [0, 1, 40, 10**6, 2**40, 2**62])
def test_elias_fano(n, most):
    r = np.random.default_rng(n + most % 97)
    values = np.sort(r.integers(0, most + 1, n))
    data = encode(values)
    coded = EliasFano(data + b"more")
    assert coded.size == len(data) and (coded.select(np.arange(n)) == values).all()
    if n:
        ks = r.integers(0, n, 50)
        assert (coded.select(ks) == values[ks]).all()
    if n > 500 and most:  # two bits and the low bits a value, and the select structure
        assert 8 * len(data) <= n * (3.2 + max(0, np.log2((most + 1) / n))) + 1500
    with pytest.raises(IndexError):
        coded.select([n])


def test_values_must_not_decrease():
    with pytest.raises(ValueError):
        encode(np.array([3, 2]))


@pytest.mark.parametrize("remembered,together", [(40, 3), (10**6, 500)])
def test_chunks_equal_whole_texts(monkeypatch, remembered, together):
    monkeypatch.setattr(chunks, "REMEMBERED", remembered)
    monkeypatch.setattr(chunks, "TOGETHER", together)
    with open(PATH, "rb") as f:
        data = f.read()
    r = random.Random(3)
    alphabet = list("abcXYZH019.,'’\n\t\r\v\x00   \xad \u200b\x85\x1c\xa0éüñßÇÀİΣς漢字日本🙂½²\u0331\u0338<|>()") + ["e\u0301", " \u0308", "'s", "'LL", "'re", "  ", "\n ", " the", "THE", "<|endoftext|>", "<|STARTOFTEXT|>", "ﬁ", "</w>"]
    for special in (False, True):
        plain = Tokenizer.from_file(PATH)
        plain.encode_special_tokens = special
        coder = token_files.Coder(data, special)
        for _ in range(120):
            texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(20)] + ["", " ", "w " * 50, "v" * 300]
            got = [np.frombuffer(c, coder.kind).tolist() for c in coder.of([t.encode() for t in texts])]
            assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert max(map(len, coder.units.young)) <= chunks.REMEMBER_LENGTH


def test_words_are_in_one_table_with_chunks():
    with open(PATH, "rb") as f:
        coder = token_files.Coder(f.read(), False)
    plain, text = Tokenizer.from_file(PATH), "zqvx zqvx. (ZQVX wkqj, wkqj " + "v" * 60 + "."
    assert np.frombuffer(coder.of([text.encode()])[0], coder.kind).tolist() == plain.encode(text, add_special_tokens=False).ids
    held = [k for c in vars(coder).values() if isinstance(c, chunks.Chunks) for k in c.young]
    assert held.count(b"zqvx") == held.count(b"wkqj") == held.count(b"wkqj,") == 1 and max(map(len, held)) <= chunks.REMEMBER_LENGTH


def test_chunks_are_made_once_while_they_are_remembered(monkeypatch):
    made = []
    memory = chunks.Chunks(str.split, lambda new: made.extend(new) or [c.upper() for c in new])
    words = [f"w{k}" for k in range(280_000)]
    long = "v" * (chunks.REMEMBER_LENGTH + 1)
    for a in range(0, len(words), 30_000):
        part = words[a : a + 30_000]
        assert memory.of([" ".join(part), f"{long} {part[0]}", ""]) == [[w.upper() for w in part], [long.upper(), part[0].upper()], []]
    assert len(made) == len(words) + 10 and long not in memory.young  # long chunks are not kept
    made.clear()
    for a in range(0, len(words), 30_000):
        memory.of([" ".join(words[a : a + 30_000])])
    assert not made


def test_odd_rows(spark, odd, empty, tokenizer, tmp_dir, monkeypatch):
    monkeypatch.setattr(token_files, "RANGE_BYTES", 200_000)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    write_token_files(odd, f"{tmp_dir}/a", PATH, file_ids=3000)
    got = read_token_files(spark, f"{tmp_dir}/a").collect()
    assert len(got) == len(rows)
    for r in got:
        assert len(r.ids) == 4 * r.n_tokens and r.ids[-4:] == b"\x01\0\0\0"
    # Rows that repeat an id stand in an order of their own; all others are fixed.
    want, named = _expected(rows, tokenizer), {}
    for i, start, n, crc in want:
        named.setdefault(i, []).append((n, crc))
    found, at = {}, 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        found.setdefault(r.doc_id, []).append((r.n_tokens, zlib.crc32(r.ids)))
    assert list(found) == list(named) and all(sorted(found[i]) == sorted(named[i]) for i in named)
    files = spark.read.format("binaryFile").load(f"{tmp_dir}/a").select("content").collect()
    sizes = [len(TokenFile(f.content).ids) for f in files]
    assert len(files) > 10 and all(s <= 3000 or TokenFile(f.content).n == 1 for s, f in zip(sizes, files, strict=True))
    assert write_token_files(empty, f"{tmp_dir}/b", PATH) == 0 and read_token_files(spark, f"{tmp_dir}/b").count() == 0


def test_random_access_and_wide_ids(spark, tokenizer, tmp_dir):
    rows = [(-(2**63), "Lowest."), (2**63 - 1, "highest"), (0, "<|endoftext|> is special"), (7, None), (7, ""), (5, "a\nb\r\n\x00 c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    total = write_token_files(docs.coalesce(1), f"{tmp_dir}/c", PATH)
    want = _expected(rows, tokenizer)
    assert total == sum(n for _, _, n, _ in want)
    got = sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in read_token_files(spark, f"{tmp_dir}/c").collect())
    assert got == [(s, i, n, c) for i, s, n, c in want]
    docs.write.mode("overwrite").parquet(f"{tmp_dir}/d")
    write_token_files(spark.read.parquet(f"{tmp_dir}/d"), f"{tmp_dir}/e", PATH, special_as_text=True, end_id=9)
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    files = [TokenFile(f.content) for f in spark.read.format("binaryFile").load(f"{tmp_dir}/e").collect()]
    found = {f.doc_ids()[k].as_py(): f.document(k).tolist() for f in files for k in range(f.n)}
    assert found[0] == [*plain.encode(rows[2][1], add_special_tokens=False).ids, 9]


def test_a_cut_file_is_refused(spark, tmp_dir):
    write_token_files(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), f"{tmp_dir}/f", PATH)
    content = bytes(spark.read.format("binaryFile").load(f"{tmp_dir}/f").where("length > 0").first().content)
    for bad in (content[:-2], b"x" + content[1:], content + b"\n"):
        with pytest.raises(ValueError):
            TokenFile(bad)


def test_query(spark, tokenizer):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = sorted(map(tuple, op13_token_files(spark, path).collect()), key=lambda r: r[1])
    assert got == _expected(rows, tokenizer)
