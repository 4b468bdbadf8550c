import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from fieldatlas.llm import stripes
from fieldatlas.llm.queries import LLM_ORACLE_SQL, op12_source_audit
from fieldatlas.llm.stripes import divergences, shares, terms
from llm_rows import empty, odd, prose  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def _expected(rows, least_df=10, most=10):
    """Every row with Python integers; rows are (text, lang, source)."""
    df, count, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = TERM.findall((text or "").translate(LOWER))
        df[lang].update(set(found))
        for t, n in Counter(found).items():
            count[lang, source, t] += n
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least_df]

        def share(n, size):
            return 1 + 10**9 * (n + 2) // (size + 2 * len(kept))

        of = {s: {t: count[lang, s, t] for t in kept} for s in sources}
        size = {s: sum(of[s].values()) for s in sources}
        p = {s: {t: share(n, size[s]) for t, n in of[s].items()} for s in sources}
        q = {t: share(sum(of[s][t] for s in sources), sum(size.values())) for t in kept}
        for s in sources:
            pairs = [(-sum((a - b) ** 2 // (a + b) for a, b in zip(p[s].values(), p[o].values(), strict=True)), o.encode()) for o in sources if o != s]
            best = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t.encode()) for t in kept if of[s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(best)[:most], 1)}
    return out


def _rows(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_terms():
    text = "Éa É_b 12 cD-é🙂x\x7fY\x80z {q} ÀB"
    assert [t.decode() for t in terms(text.encode())] == TERM.findall(text.translate(LOWER))


@pytest.mark.parametrize("held,tile,cells", [(400_000, 256, 1 << 21), (300, 2, 16)])
def test_odd_rows(spark, odd, monkeypatch, held, tile, cells):
    """Also with spills after every few documents, tiles of two sources and blocks of few stripes."""
    for name, value in (("HELD", held), ("TILE", tile), ("CELLS", cells), ("MERGED", cells)):
        monkeypatch.setattr(stripes, name, value)
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    out = divergences(odd)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert _rows(out) == _expected(rows)
    for least in (1, 10**6):
        assert _rows(divergences(odd, least_df=least)) == _expected(rows, least)


def test_many_sources_and_ties(spark, monkeypatch):
    monkeypatch.setattr(stripes, "TILE", 3)
    rows = [(prose("en", 30, k) + f" own{k % 5}", "en", f"s{k % 17}") for k in range(120)]
    rows += [("same words here", "xx", s) for s in ("b", "a", "c", "é", "z", "") for _ in range(4)] + [("", "yy", "one"), ("1 2", "yy", "two"), (None, "zz", None)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert _rows(divergences(docs, most_terms=3)) == _expected(rows, most=3)


def test_empty_table(empty):
    assert divergences(empty).count() == 0


def test_large_counts_are_exact():
    counts = np.array([[0, 5], [10**13, 3]])
    sizes = np.array([10**13, 8])
    want = [[1 + 10**9 * (int(n) + 2) // (int(s) + 4) for n, s in zip(row, sizes, strict=True)] for row in counts]
    assert shares(counts, sizes, 2).tolist() == want


def test_query_against_sql(spark):
    path = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet')")
    want = set(duck.execute(LLM_ORACLE_SQL["op12_source_audit"]).fetchall())
    assert _rows(op12_source_audit(spark, path)) == want and len(want) > 100
    documents = spark.read.parquet(f"{path}/documents.parquet").select("text", "lang", "source").collect()
    assert want == _expected(map(tuple, documents))
