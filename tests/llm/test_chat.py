from collections import defaultdict

from fieldatlas.llm.chat import format_chats
from llm_rows import empty, odd  # noqa: F401

SCHEMA = "conv_id long, turn long, role string, text string, pos string, h1 string, conv string"


def _brute(rows):
    convs = defaultdict(set)
    for c, n, role, text, *_ in rows:
        if c is not None:
            convs[c].add((n is None, n or 0, role or "unknown", text or ""))
    lists = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in lists.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in lists.values())
        same = [d for d, o in lists.items() if o == own]
        if not longer and c == min(same):
            out[c] = (len(own), len(same), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in own))
    return out


def test_against_brute_force(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", None), (None, "odd é"), ("user", "")]
    rows = []
    for c in range(30):
        for k in range(1 + c % 5):
            rows.append((c, k, *talk[k]) if c % 7 else (c, k, "user", f"own {c}"))
    rows += [(50, None, "user", "late"), (50, 0, "user", "hi"), (51, 2, "user", "tie b"), (51, 2, "user", "tie a"), (52, 0, "user", "hi"), (52, 0, "user", "hi")]
    rows += [(None, 0, "user", "nobody's"), (53, 9, "user", "x" * 100_000)]
    rows = [(*r, "x", None, "y") for r in rows]
    got = {r.conv_id: (r.n_turns, r.n_equal, r.rendered) for r in format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == _brute(rows)


def test_order_matters_and_empty(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (2, 2, "user", "c")]
    rows = [(*r, None, None, None) for r in rows]
    assert {r.conv_id for r in format_chats(spark.createDataFrame(rows, SCHEMA)).collect()} == {1, 2}
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
