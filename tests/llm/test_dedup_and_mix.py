import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from fieldatlas.llm.exact_dedup import exact_dedup, keep_distinct
from fieldatlas.llm.line_dedup import line_dedup, repeated_units, sentences, unit_rows
from fieldatlas.llm.mixing import mix, mix_plan
from llm_rows import empty, odd  # noqa: F401

LOWER = {i: i + 32 for i in range(65, 91)}


def test_exact_dedup_against_brute_force(odd):
    rows = [(r.doc_id, (r.text or "").translate(LOWER)) for r in odd.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = Counter()
    for i, t in rows:
        keep = max((x for x in groups[t] if x is not None), default=None)
        want[(i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact_dedup(odd).collect())) == want


def test_keep_distinct_keeps_whole_rows(odd):
    kept = keep_distinct(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 101 in ids and 1 not in ids and 100 not in ids and 102 in ids
    assert ids.count(3) == 3  # rows that repeat an id and its text are one document
    assert 112 in ids and 111 in ids and 110 not in ids  # null is empty; the largest id stays


def test_only_ascii_letters_fold(spark):
    docs = spark.createDataFrame([(1, "É"), (2, "é"), (3, "A"), (4, "a")], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact_dedup(docs).collect()} == {1: 1, 2: 2, 3: 4, 4: 4}


def test_empty_tables(empty):
    assert exact_dedup(empty).count() == keep_distinct(empty).count() == mix(empty).count() == mix_plan(empty).count() == line_dedup(empty).count() == 0


def _targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Water filling, one round after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: share * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix_plan(odd):
    rows = mix_plan(odd).collect()
    source = {r.doc_id: r.source for r in odd.collect()}
    sizes = Counter()
    for r in odd.collect():
        sizes[r.source] += len((r.text or "").split())
    assert len(rows) == odd.count()
    want, taken, longest = _targets(sizes), Counter(), Counter()
    for r in rows:
        if r.doc_id is None:
            continue
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * longest[s] + 10
    again = mix_plan(odd.repartition(7)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_repeats_rows_as_planned(odd):
    planned = Counter()
    for r in mix_plan(odd).collect():
        planned[r.doc_id] += r.copies
    out = mix(odd)
    assert out.columns == odd.columns
    got = Counter(r.doc_id for r in out.collect())
    assert got == +planned


def test_one_source_is_capped(spark):
    docs = spark.createDataFrame([(k, "w " * 10, "a") for k in range(50)] + [(99, "", "zero")], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mix_plan(docs).collect()}
    assert sum(r.taken for r in rows.values()) == pytest.approx(750, abs=10)
    assert rows[99].target == 0 and rows[99].taken == 0


def _plain(t):
    return " ".join(t.lower().split())


def _blocks(text, unit):
    """Blocks as lists of (start, stop, normalised) sentences, character by character."""
    ends = re.compile(r"\n+" if unit == "line" else r"\n[ \t]*\n\s*")
    at = 0
    for gap in [*ends.finditer(text), None]:
        stop = gap.start() if gap else len(text)
        parts, begin = [], at
        for k in range(at, stop + 1):
            prev, here = text[k - 1 : k] if k > at else "", text[k : k + 1] if k < stop else ""
            blank = prev and prev in ".!?" and here and here in " \t"
            wide = prev and prev in "\u3002\uff01\uff1f" and here not in ("\u3002", "\uff01", "\uff1f")
            if k == stop or blank or wide or here == "\n":
                if _plain(text[begin:k]):
                    parts.append((begin, k, _plain(text[begin:k])))
                begin = k
                while blank and begin < stop and text[begin] in " \t":
                    begin += 1
                if here == "\n":
                    begin = k + 1
        if parts:
            yield parts, _plain(text[at:stop])
        at = gap.end() if gap else stop


def _brute_lines(rows, unit, least):
    first = {}
    for i, t in sorted(rows):
        for parts, norm in _blocks(t, unit):
            for a, n in [(parts[0][0], norm), *[(p[0], p[2]) for p in parts]]:
                first.setdefault(n, (i, a))
                first[n] = min(first[n], (i, a))
    out = {}
    for i, t in rows:
        spans, run = [], []

        def close():
            if sum(len(n) for _, _, n, _ in run) >= least:
                spans.append((run[0][0], run[-1][1]))
            else:
                for block in sorted({g for *_, g in run if g is not None}):
                    own = [r for r in run if r[3] == block]
                    spans.append((own[0][0], own[-1][1]))
            run.clear()

        for nr, (parts, norm) in enumerate(_blocks(t, unit)):
            gone = first[norm] != (i, parts[0][0])
            for a, b, n in parts:
                if gone or first[n] != (i, a):
                    run.append((a, b, n, nr if gone else None))
                elif run:
                    close()
        if run:
            close()
        out[i] = spans
    return out


@pytest.mark.parametrize("unit,least", [("line", 100), ("line", 1), ("paragraph", 100), ("paragraph", 10_000), ("line", 10_000)])
def test_line_dedup_against_brute_force(spark, unit, least):
    shared = "This passage is shared. It has several sentences in it. Each of them is long enough to count for the run. So the whole run goes. " * 2
    wide = "\u8fd9\u662f\u4e00\u53e5\u3002" * 3 + "\u8fd9\u662f\u53e6\u4e00\u53e5\uff01"
    rows = [
        (1, f"First text here.\nOwn line of one. {shared}The end of one.\nTwo parts. Of a line."),
        (2, f"Second text, which starts {shared}and goes on.\n\nOwn line of one.\n\nfirst  TEXT here.\nTwo parts.   Of a line. \nNew. Two parts."),
        (3, "First text here.\nFirst text here.\n\n\nAnother.\nOf a line.\nTwo parts. Of a line.\n\nTwo parts. Of a line."),
        (4, ""), (5, "\u00e9. \u00f1. \u00e9. \U0001f642 \u00e9."), (6, wide), (7, f"un\n{wide}\ndos{wide}"), (8, wide),
    ]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), unit=unit, min_run_chars=least).collect()}
    want = _brute_lines(rows, unit, least)
    for i, t in rows:
        assert [(s.start, s.stop) for s in got[i].removed] == want[i]
        rest, at = "", 0
        for a, b in want[i]:
            rest, at = rest + t[at:a], b
        assert got[i].text == rest + t[at:]
        assert got[i].removed_chars == len(t) - len(got[i].text) and got[i].n_removed == len(want[i])
    assert got[8].text == "" and got[8].n_removed == 1  # an unspaced line like any other
    if unit == "line":  # no later copy of a whole line is left
        left = Counter(_plain(line) for r in got.values() for line in r.text.split("\n") if _plain(line))
        assert max(n for line, n in left.items() if line in {_plain(x) for _, t in rows for x in t.split("\n")}) == 1


def test_line_dedup_on_random_texts(spark):
    r = random.Random(6)
    words = ["a", "bb", "ccc", "d.", "e!", "f\u3002", "\n", "\n\n", " \t", "G."]
    rows = [(k, " ".join(r.choice(words) for _ in range(r.randrange(40)))) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    for unit, least in (("line", 12), ("paragraph", 30)):
        got = {x.doc_id: [(s.start, s.stop) for s in x.removed] for x in line_dedup(frame, unit=unit, min_run_chars=least).collect()}
        assert got == _brute_lines(rows, unit, least)


def test_line_dedup_odd_rows(odd):
    got = line_dedup(odd).collect()
    assert len(got) == odd.count()
    text = {r.doc_id: r.text for r in odd.collect()}
    assert all(r.text == text[r.doc_id] for r in got if r.n_removed == 0 and r.doc_id is not None)
    assert {r.doc_id for r in got if r.n_removed} >= {100, 104}
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)


def test_line_dedup_goes_by_row(spark):
    """Passages are cut out of the text that holds them, not out of another one with its id; repeated rows count once."""
    passage = " ".join(f"shared{k}" for k in range(30)) + "."
    alone = " ".join(f"own{k}" for k in range(60)) + "."
    rows = [(1, passage), (2, f"Head here. {passage} Tail here."), (2, alone), (2, f"Head here. {passage} Tail here.")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r.doc_id, r.text, r.n_removed) for r in got) == Counter({(1, passage, 0): 1, (2, alone, 0): 1, (2, "Head here.  Tail here.", 1): 2})
    short = "Short one. And two."
    rows = [(1, f"It says: {short} So it is."), (2, f"It does not say: {short} Not so."), (2, f"It does not say: {short} Not so.")]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.n_removed == 0 for r in got)  # a short run inside a line, however often the row is


def test_line_dedup_shuffles_numbers_not_units(spark, capsys):
    """Of units only place and digest are dealt, and documents get back numbers: rows of offsets and windows over all units filled executors."""
    passage = "Said here and there, and everywhere else. " * 3
    rows = [(1, f"One line.\n{passage}\nLast."), (2, f"New.\nOne line.\nAnother {passage}"), (2, f"New.\nOne line.\nAnother {passage}"), (3, "Its own.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert unit_rows(frame).columns == ["id", "tie", "unit", "digest"]
    assert sorted((r.id, sorted(r.again)) for r in repeated_units(frame).collect()) == [(1, [3, 4]), (2, [1, 4, 5])]
    line_dedup(frame).explain()
    assert "Window" not in capsys.readouterr().out


def test_sentences_end_at_their_marks():
    cuts = lambda s: [s[a:b] for a, b in sentences(s)]
    assert cuts("One. Two!\tThree? 3.14 is.") == ["One.", "Two!", "Three?", "3.14 is."]
    assert cuts("一。二！？ 三.\n\n四") == ["一。", "二！？", " 三.", "四"]
    assert cuts(" . 。 \n ") == [" .", "。"] and cuts("") == cuts(" \t") == []
