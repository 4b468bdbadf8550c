import random
import re

import numpy as np
import pytest

from fieldatlas.llm import automaton, secret_scan
from fieldatlas.llm.secret_scan import RULES, find_secrets, scan
from llm_rows import empty, odd  # noqa: F401

NAMES = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
PATTERNS = {
    "assign": (rf"(?:{NAMES}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
    "access": (r"AKIA([A-Z0-9]+)", 16),
    "hex": (r"([0-9a-f]+)", 24),
    "github": (r"gh[pousr]_([A-Za-z0-9]+)", 36),
    "slack": (r"xox[abprs]-([A-Za-z0-9-]+)", 10),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.([A-Za-z0-9_-]+)", 1),
    "pem": (r"-----BEGIN [A-Z ]*(PRIVATE KEY-----)", 1),
}
PARTS = "password PassWd secret token api_key APIKEY = : \" ' abc123 AKIA ABCDEFGH12345678 deadbeef 0123456789abcdef é 🙂 ſ ghp_ xoxb- eyJ . token= / x".split() + [" ", "  ", "A1b2" * 9, "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "\n"]


def brute(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, rule in enumerate(RULES):
        pattern, least = PATTERNS[rule.kind]
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return sorted(out)


def test_scan_against_re():
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randrange(40))) for _ in range(3000)]
    texts += ["", "a" * 30_000 + "AKIA" + "Z" * 9000 + ' password="' + "q" * 5000]
    got = scan([t.encode() for t in texts])
    assert sum(map(len, got.values())) > 1000
    for k, t in enumerate(texts):
        assert got.get(k, []) == brute(t), t


@pytest.mark.parametrize("lane", [1, 3, 16, 100])
def test_lanes_give_one_walk(lane):
    dfa = automaton.compile_rules([b"abc+", b"[0-9]{3,5}x", b"(ab|cd)*e"], search=True)
    r = random.Random(lane)
    data = bytes(r.choice(b"abcde0123x") for _ in range(2000))
    state, want = 0, []
    for k, byte in enumerate(data):
        state = dfa.table[state + dfa.classes[byte]]
        if dfa.accepts[state // dfa.width]:
            want.append((k + 1, int(dfa.accepts[state // dfa.width])))
    ends, bits = automaton.accept_positions(dfa, np.frombuffer(data, np.uint8), lane)
    assert list(zip(ends.tolist(), bits.tolist(), strict=True)) == want


def test_minimal_automaton():
    assert len(automaton.compile_rules([b"(a|b)(a|b)"], search=False).accepts) == 4  # start, one, two, dead
    with pytest.raises(ValueError):
        automaton.compile_rules([b"a*"], search=True)


def test_find_secrets(odd, spark):
    rows = spark.createDataFrame([(1, "é password: 'hunter22' x"), (2, None), (3, ""), (3, ""), (4, "token=abc secret=abcdef0")], "doc_id long, text string")
    got = sorted((r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans]) for r in find_secrets(rows).collect())
    assert got == [(1, [("assign", 2, 21)]), (2, []), (3, []), (3, []), (4, [("assign", 10, 24)])]
    assert find_secrets(odd).count() == odd.count()


def test_small_blocks(monkeypatch, spark):
    monkeypatch.setattr(secret_scan, "BLOCK_BYTES", 64)
    texts = [f"{'w ' * k} token = abcdef{k}" for k in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in find_secrets(rows).collect():
        assert [(s.start, s.stop) for s in r.spans] == [(a, b) for a, _, b in brute(texts[r.doc_id])]


def test_empty_table(empty):
    assert find_secrets(empty).count() == 0
