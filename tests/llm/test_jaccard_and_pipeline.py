import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from fieldatlas.llm import jaccard, ppm, text
from fieldatlas.llm.graph import components
from fieldatlas.llm.jaccard import Rule, bitmap, jaccard_classes, most_overlap
from fieldatlas.llm.shingles import shingle_set, word_hashes
from llm_rows import empty, odd  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}


def _classes(rows, width=4, num=85, den=100):
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 2 * min(len(x), len(y)) >= max(len(x), len(y)):
            both = len(x & y)
            if both and den * both >= num * (len(x) + len(y) - both):
                a, b = root(a), root(b)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def _families(seed, n, words=400):
    """Documents of all sizes with copies that differ by a few words, near the threshold."""
    r = random.Random(seed)
    rows = []
    for f in range(n):
        base = [f"w{r.randrange(words)}" for _ in range(r.choice([1, 3, 4, 6, 9, 12, 20, 40, 80, 150]))]
        for _ in range(r.randrange(1, 6)):
            own = list(base)
            for _ in range(r.randrange(0, 1 + max(1, len(base) // 25))):
                own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
            rows.append((len(rows) * 7 % 10007, " ".join(own)))
    return rows


@pytest.mark.parametrize("block,held", [(512, 4096), (4, 3)])
def test_classes_against_brute_force(spark, monkeypatch, block, held):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HELD", held)
    base = " ".join(f"v{k}" for k in range(90))
    rows = _families(block, 60) + [(20000 + k, base.replace(f"v{k} ", f"y{k} ")) for k in range(40)] + [(30000 + k, base) for k in range(5)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == _classes(rows)


def test_odd_rows(spark, odd, empty):
    out = jaccard_classes(odd).collect()
    assert len(out) == odd.count()
    want = _classes([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None])
    for r in out:
        assert (r.n_shingles, r.component_id) == want[r.doc_id] if r.doc_id is not None else r.component_id is None
    assert jaccard_classes(empty).count() == 0


def test_linked_sets_share_a_tile():
    """The tiles of two sets meet whenever the sets link, at every size and overlap."""
    rule, r = Rule(85, 100), np.random.default_rng(5)
    for _ in range(1500):
        n = int(r.choice([2, 5, 6, 7, 8, 11, 12, 13, 20, 50, 200]))
        pool = r.integers(0, 2**63, 3 * n, dtype=np.uint64)
        a = np.unique(pool[:n])
        drop, add = r.integers(0, n // 6 + 2), r.integers(0, n // 6 + 2)
        b = np.unique(np.concatenate([a[drop:], pool[n : n + add]]))
        both = len(np.intersect1d(a, b))
        if len(b) and rule.links(both, len(a), len(b)) and (len(a) != len(b) or (a != b).any()):
            assert np.intersect1d(rule.tiles(a), rule.tiles(b)).size
    for n in range(1, 400):  # the bound on differences covers every pair of sizes that can link
        for m in range(n, min(rule.most_partner(n), 500) + 1):
            least = next((o for o in range(n + 1) if rule.links(o, n, m)), None)
            band = int(np.searchsorted(rule.edges, m, "right")) - 1
            high = int(rule.edges[band + 1]) - 1
            if least is not None:
                assert n + m - 2 * least <= min(rule.most_difference(n, high), rule.most_difference(m, high))


@pytest.mark.parametrize("widest", [1 << 15, 64])
def test_bitmap_bound_is_never_too_low(monkeypatch, widest):
    monkeypatch.setattr(jaccard, "WIDEST", widest)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 2**63, int(n), dtype=np.uint64)) for n in (5, 60, 70, 130)]
    sets += [np.unique(np.concatenate([s[: len(s) // 2], sets[2][:30]])) for s in sets]
    sizes = np.array([len(s) for s in sets])
    most = most_overlap([bitmap(s) for s in sets], sizes)
    for i, j in combinations(range(len(sets)), 2):
        assert most[i, j] >= len(np.intersect1d(sets[i], sets[j]))


def test_shingles(monkeypatch):
    assert len(shingle_set(b"", 4)) == 0 and len(shingle_set(b" \t\n", 4)) == 0
    assert len(shingle_set(b"one two", 4)) == 1 and (shingle_set(b"ONE two", 4) == shingle_set(b"one  TWO ", 4)).all()
    assert (shingle_set(b"a b", 4) != shingle_set(b"b a", 4)).all()
    assert len(shingle_set(b"a b c d e", 4)) == 2 and len(shingle_set(b"a a a a a a", 4)) == 1
    assert len(word_hashes("x\x85y z w".encode())) == 2  # only ASCII white space separates
    text = " ".join(f"w{k}" for k in range(500)).encode()
    whole = word_hashes(text)
    from fieldatlas.llm import shingles

    monkeypatch.setattr(shingles, "PIECE", 40)
    assert (word_hashes(text) == whole).all()


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(120)] + [(5, 5), (None, 3)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in up if root(i) != i}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stages_on_odd_rows(spark, odd, empty):
    docs, nothing = odd, empty
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, "").cache()
        nothing = stage(spark, nothing, "")
        assert nothing.count() == 0
        assert k == 4 or docs.columns == nothing.columns == odd.columns
        kept[name] = Counter(r.doc_id for r in docs.collect())
    ids = kept["language_id"]
    assert not {110, 111, 112, 113} & set(ids) and {0, 1, 100, 104, 120, 122} <= set(ids) and ids[3] == 3
    assert {1, 100} & set(kept["exact_dedup"]) == set() and kept["exact_dedup"][101] == 1
    near = kept["near_dedup"]
    assert 101 in near and 102 not in near and 103 in near and 104 not in near
    assert set(kept["mix_sources"]) <= set(near) and max(kept["mix_sources"].values()) <= 6
    assert kept["encode"] == kept["mix_sources"]
    assert all(r.round_trip for r in docs.collect())


def test_run_on_the_small_tables(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = out.collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    folded = Counter({texts[r.doc_id].translate(LOWER): 1 for r in rows})
    assert len(folded) == len({r.doc_id for r in rows})  # no two documents of one text


def test_near_dedup_stage_against_brute_force(spark):
    """Five words and 0.8, with pairs that only this rule links (not four words and 0.85)."""
    words = [f"v{k}" for k in range(100)]

    def edited(*places):
        return " ".join(f"y{k}" if k in places else w for k, w in enumerate(words))

    # Two edits of 100 words: 5 words 86/106 = 0.811, 4 words 89/105 = 0.848.
    rows = [(50000, edited()), (50001, edited(30, 60))] + _families(3, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    want, strict = _classes(rows, 5, 80, 100), _classes(rows)
    assert want[50001][1] == 50000 and strict[50001][1] == 50001
    assert kept == sorted(i for i, (_, root) in want.items() if root == i)


def test_near_dedup_stage_goes_by_row(spark):
    """An id with two texts: its copy goes, its other text stays, and texts are not linked by a shared id."""
    base, more = (" ".join(f"{c}{k}" for k in range(120)) for c in "tu")
    rows = [(3, base), (7, base + " x"), (7, "a text of its own, found nowhere else"), (9, more), (7, more + " y"), (9, more + " z"), (4, more + " w"), (None, base)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    assert Counter(map(tuple, kept)) == Counter([rows[0], rows[2], rows[6], rows[7]])


def test_near_dedup_stage_against_brute_force_with_repeated_ids(spark):
    rows = [(i % 50, t) for i, t in _families(11, 50)]
    numbered = _classes(list(enumerate(t for _, t in rows)), 5, 80, 100)
    groups = {}
    for k, (_, root) in numbered.items():
        groups.setdefault(root, []).append(k)
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "").collect()
    place = {}
    for k, row in enumerate(rows):
        place.setdefault(row, k)
    assert len(kept) == len(groups)
    for r in kept:  # one of each class, with the smallest id of the class
        members = groups.pop(numbered[place[tuple(r)]][1])
        assert r.doc_id == min(rows[k][0] for k in members)


def test_exact_dedup_stage_keeps_one_row_per_text(spark, odd, empty):
    """A table ingested twice, and texts that only rows without an id have."""
    once = odd.unionByName(odd)
    more = spark.createDataFrame([(None, "Alone twice"), (None, "alone TWICE"), (7000, "x1"), (7000, "X1"), (7001, "X1")], "doc_id long, text string")
    docs = once.unionByName(more, allowMissingColumns=True)
    want = {}
    for r in docs.collect():
        folded = (r.text or "").translate(LOWER)
        want[folded] = max(want.get(folded, -1), -1 if r.doc_id is None else r.doc_id)
    stage = corpus_pipeline.exact_dedup(spark, docs, "")
    rows = stage.collect()
    assert stage.columns == odd.columns and stage.dtypes == odd.dtypes
    assert Counter((r.text or "").translate(LOWER) for r in rows) == Counter(dict.fromkeys(want, 1))
    assert all(want[(r.text or "").translate(LOWER)] == (-1 if r.doc_id is None else r.doc_id) for r in rows)
    given = set(map(tuple, docs.collect()))
    assert all(tuple(r) in given for r in rows)  # whole rows, not columns of several
    again = corpus_pipeline.exact_dedup(spark, docs.repartition(7), "").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert corpus_pipeline.exact_dedup(spark, empty, "").count() == 0


def test_what_is_kept_goes_when_idle_or_renamed(monkeypatch):
    monkeypatch.setattr(text, "_KEPT", {})
    made = []
    make = lambda: made.append(1) or object()
    first = text.kept("bpe", "a", make)
    assert text.kept("bpe", "a", make) is first and len(made) == 1
    assert list(text.lean(iter)([1, 2])) == [1, 2] and text.kept("bpe", "a", make) is first  # just used: may take turns
    monkeypatch.setattr(text, "IDLE_S", 0.0)
    for rows in (jaccard._sets(2), jaccard._tiles(2, jaccard.Rule(8, 10)), jaccard._shared):
        text.kept("bpe", "a", make)
        assert list(text.lean(rows)(iter(()))) == [] and not text._KEPT
    assert text.kept("bpe", "b", make) is not first and set(text._KEPT) == {"bpe"}


def test_tasks_let_go_of_what_earlier_stages_kept(spark, monkeypatch):
    seen = []
    for module in (jaccard, ppm):
        monkeypatch.setattr(module, "lean", lambda rows: seen.append(rows.__qualname__.split(".")[0]) or text.lean(rows))
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, "a b c d e f g h", "x")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.component_id for r in jaccard_classes(docs, width=4, num=80).collect()} == {1: 1, 2: 1}
    assert set(seen) == {"_sets", "_tiles", "_shared", "_candidates", "_exact"}
    assert ppm.identify(docs.drop("lang"), ppm.train({"x": [b"a b c"]})).count() == 2 and "identify" in seen
