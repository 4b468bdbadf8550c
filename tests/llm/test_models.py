import math
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldatlas.llm import nbsvm, ppm
from fieldatlas.llm.text import held_out
from llm_rows import empty, odd, prose  # noqa: F401


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def _bits(sample: list[bytes], text: bytes) -> float:
    """PPM-C with counters per context, one byte at a time."""
    seen: dict[bytes, Counter] = {}
    for t in sample:
        t = ppm.LEAD + t
        for i in range(3, len(t)):
            for o in range(4):
                seen.setdefault(t[i - o : i], Counter())[t[i]] += 1
    total, text = 0.0, ppm.LEAD + text
    for i in range(3, len(text)):
        for o in (3, 2, 1, 0):
            c = seen.get(text[i - o : i])
            if not c:
                continue
            n, d = sum(c.values()), len(c)
            if text[i] in c:
                total -= math.log2(c[text[i]] / (n + d))
                break
            total -= math.log2(d / (n + d))
        else:
            total += 8
    return total


def test_code_lengths_against_brute_force():
    sample = {lang: [prose(lang, 200, k).encode() for k in range(3)] for lang in ("en", "de")}
    sample["tiny"] = [b"z"]
    model = ppm.train(sample)
    texts = [b"", b"x", b"\xff\xfe zz", "straße der people".encode(), prose("en", 50, 9).encode(), prose("de", 50, 9).encode()]
    got = ppm.code_lengths(model, texts)
    for k, t in enumerate(texts):
        assert got[k] == pytest.approx([_bits(sample[n], t) for n in model.languages], rel=1e-5, abs=1e-4)


def test_long_texts_in_pieces(monkeypatch):
    model = ppm.train({lang: [prose(lang, 500, 1).encode()] for lang in ("en", "de")})
    texts = [prose("en", 900, 2).encode(), b"", prose("de", 20, 3).encode()]
    whole = ppm.code_lengths(model, texts)
    monkeypatch.setattr(ppm, "BLOCK_CELLS", 200)
    assert ppm.code_lengths(model, texts) == pytest.approx(whole)


def test_identify_odd_rows(odd, empty):
    out = ppm.identify(odd, ppm.learn(odd))
    assert out.columns == [*odd.columns, "_lang_pred", "_score", "bits_per_byte"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r["_lang_pred"], r["_score"], r.bits_per_byte) == ("und", 0.0, None)
        elif r.doc_id is not None and r.doc_id < 104:
            assert r["_lang_pred"] == ("en" if r.doc_id % 2 and r.doc_id < 100 or r.doc_id in (100, 101, 102) else "de") and 0.5 < r["_score"] <= 1
    nothing = ppm.identify(odd, ppm.learn(empty)).collect()
    assert {r["_lang_pred"] for r in nothing} == {"und"}
    assert ppm.identify(empty, ppm.learn(empty)).count() == 0


def test_training_reads_no_held_out_row_and_is_bounded(spark):
    docs = spark.createDataFrame([(k, f"{k} " + prose("en", 50, k), "en") for k in range(300)], "doc_id long, text string, lang string")
    sample = ppm.training_sample(docs, most_bytes=5000)["en"]
    assert not any(_held(int(t.split()[0])) for t in sample)
    assert 5000 <= sum(map(len, sample)) < 6000
    got = {r.doc_id: r.h for r in docs.select("doc_id", held_out("doc_id").alias("h")).collect()}
    assert all(h == _held(i) for i, h in got.items())


def test_every_language_has_its_sample(spark):
    """Few long texts, and short ones beside a very long one: all are sampled up to the wanted bytes."""
    rows = [(100 * k + j, prose("en", 800, k)[:3000], f"long{k:02}") for k in range(12) for j in range(3)]
    rows += [(5000 + k, prose("de", 4, k), "outlier") for k in range(400)] + [(9000, "ab " * 700_000, "outlier")]
    rows += [(None, prose("de", 10, k), "no id") for k in range(300)] + [(9001, "", "empty")]
    rows = [r for r in rows if not _held(r[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = ppm.training_sample(docs, most_bytes=2000)
    for lang in {r[2] for r in rows}:
        texts = [r[1].encode()[:2000] for r in rows if r[2] == lang]
        assert min(2000, sum(map(len, texts))) <= sum(map(len, sample[lang])) < 4000
        assert not Counter(sample[lang]) - Counter(texts)
    assert ppm.training_sample(docs.repartition(7), most_bytes=2000) == sample


def test_more_languages_than_two_hundred(spark):
    """Languages of two letters of their own: each is learned and its texts are named by it."""
    names = {f"l{k:03}": chr(0x4E00 + 2 * k) + chr(0x4E01 + 2 * k) for k in range(230)}
    rows = [(10 * k + j, letters * 20, lang) for k, (lang, letters) in enumerate(names.items()) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = ppm.learn(docs)
    assert model.languages == sorted(names)
    out = ppm.identify(docs, model).collect()
    assert len(out) == len(rows) and all(r.lang_pred == r.lang for r in out)
    few = ppm.training_sample(docs, all_bytes=230 * 200)
    assert len(few) == 230 and all(200 <= sum(map(len, texts)) < 400 for texts in few.values())


def test_blocks_of_languages(monkeypatch):
    sample = {f"{lang}{k}": [prose(lang, 100, k).encode()] for k in range(3) for lang in ("en", "de")}
    texts = [b"", "straße der people".encode(), prose("en", 50, 9).encode()]
    whole = ppm.train(sample)
    monkeypatch.setattr(ppm, "COLUMNS", 4)
    blocks = ppm.train(sample)
    assert len(blocks.blocks) == 2 and blocks.languages == whole.languages == sorted(sample)
    assert ppm.code_lengths(blocks, texts) == pytest.approx(ppm.code_lengths(whole, texts))


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = ppm.identify(docs, ppm.learn(docs)).where(held_out("doc_id"))
    right = out.where("lang_pred = lang").count()
    assert right / out.count() > 0.95


def test_distinct_buckets_in_pieces(monkeypatch):
    scratch = np.empty(1 << nbsvm.BITS, np.int32)
    text = prose("de", 300, 1)
    whole = set(nbsvm.distinct(text, nbsvm.SIZES, nbsvm.BITS, scratch).tolist())
    assert whole == set(nbsvm.features(text).tolist())
    monkeypatch.setattr(nbsvm, "PIECE", 50)
    pieces = set(nbsvm.distinct(text, nbsvm.SIZES, nbsvm.BITS, scratch).tolist())
    assert whole <= pieces and len(pieces) < 1.5 * len(whole)  # pieces add grams at their own edges only


@pytest.mark.parametrize("piece", [1, 5, 50, 64])
def test_pieces_have_the_grams_of_the_whole_text(monkeypatch, piece):
    scratch = np.empty(1 << nbsvm.BITS, np.int32)
    for text in (prose("de", 300, 1), "İΣΑΣ " * 30, "x" * 65):
        whole = set(nbsvm.features(text).tolist())
        monkeypatch.setattr(nbsvm, "PIECE", piece)
        assert set(nbsvm.distinct(text, nbsvm.SIZES, nbsvm.BITS, scratch).tolist()) == whole


def test_fit_separates_and_handles_few_rows():
    clean = [prose("en", 40, k) for k in range(60)]
    bad = [prose("en", 20, k) + " horrid vile wretch " + prose("en", 20, -k) for k in range(30)]
    fitted = nbsvm.fit(clean[:40] + bad[:20], np.array([0] * 40 + [1] * 20))
    scores = fitted.score(clean[40:] + bad[20:])
    assert scores[:20].max() < 0.3 < scores[20:].min()
    assert 0 <= fitted.score([None, ""]).min() <= 1
    assert nbsvm.fit([], np.array([])).score(["x"]) == pytest.approx([0.5])
    assert nbsvm.fit(["a", "b"], np.array([1, 1])).score([""])[0] > 0.5
    assert nbsvm.fit(["", "a"], np.array([1, 0])).score(["a"]).shape == (1,)


def test_classify_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(k, k % 5 == 0, "x") for k in range(40)] + [(3, None, "x"), (None, True, "x"), (3, False, "x")], "doc_id long, flag boolean, text string")
    labels = labels.selectExpr("doc_id", "cast(flag as int) AS toxic", "text")
    model = nbsvm.learn(odd, labels)
    out = nbsvm.classify(odd, model)
    assert out.columns == [*odd.columns, "_score"]
    rows = out.collect()
    assert len(rows) == odd.count() and all(0 <= r["_score"] <= 1 for r in rows)
    assert nbsvm.training_rows(odd.union(odd), labels, most=4).count() <= 6  # however often an id is repeated
    assert nbsvm.classify(empty, nbsvm.learn(empty, labels)).count() == 0
    assert nbsvm.classify(odd, nbsvm.learn(odd, labels.limit(0))).count() == odd.count()


def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = nbsvm.classify(docs, nbsvm.learn(docs, labels)).join(labels, "doc_id").where(held_out("doc_id"))
    rows = out.select("score", "toxic").collect()
    wrong = sum((r.score >= 0.3) != (r.toxic == 1) for r in rows)
    assert wrong / len(rows) < 0.05
