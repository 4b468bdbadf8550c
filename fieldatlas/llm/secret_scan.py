"""Secret scan: all rules in one byte pass of a combined deterministic automaton.

The combined automaton marks where matches can end. Each mark is then resolved
with the rule's own small automata: the backward one gives the leftmost start,
the forward one the longest end (rules are greedy and leftmost, and do not
overlap within a kind). Documents without a mark cost the byte pass only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldatlas.llm.automaton import Dfa, accept_positions, compile_rules
from fieldatlas.llm.text import ready_workers, whole

BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail``; matches whose tail is under ``min_tail`` bytes are found, passed over and dropped.

    (A counted repeat behind a head that may overlap itself would multiply the
    states of the combined automaton, so counts are left to ``min_tail``.)
    """

    kind: str
    head: str
    tail: str
    min_tail: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])

BASE_RULES = (
    Rule("assign", rf"({_NAMES})[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", r"AKIA", r"[A-Z0-9]+", 16),
    Rule("hex", r"", r"[0-9a-f]{8,}", 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 10),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*", r"PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


@lru_cache(maxsize=4)
def machines(rules: tuple[Rule, ...]) -> tuple[Dfa, list[tuple[Dfa, Dfa, Dfa | None]]]:
    """The combined automaton; for each rule the backward, forward and head ones."""
    whole_rule = [(r.head + r.tail).encode() for r in rules]
    own = [
        (
            compile_rules([p], search=False, backward=True),
            compile_rules([p], search=False),
            compile_rules([r.head.encode()], search=False) if r.min_tail and r.head else None,
        )
        for r, p in zip(rules, whole_rule, strict=True)
    ]
    return compile_rules(whole_rule, search=True), own


def _resolve(rule: Rule, own: tuple, data: bytes, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    backward, forward, head = own
    done = 0
    for end in ends.tolist():
        if end <= done:
            continue
        start = backward.longest(data, end, done, -1)
        if start < 0:
            continue
        done = forward.longest(data, start, len(data))
        if done - (head.longest(data, start, done) if head else start) >= rule.min_tail:
            yield start, done


def scan(texts: list[bytes], rules: tuple[Rule, ...] = RULES, built: tuple | None = None) -> dict[int, list[tuple[int, int, int]]]:
    """By place in ``texts``: (start, rule number, end) in code points, in order."""
    combined, own = built or machines(rules)
    joined = np.frombuffer(b"\xff".join(texts), np.uint8)  # a byte of no UTF-8 text: no match crosses it
    ends, bits = accept_positions(combined, joined)
    if not len(ends):
        return {}
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    doc = np.searchsorted(first, ends - 1, side="right") - 1
    found: dict[int, list[tuple[int, int, int]]] = {}
    for at, lo, hi in zip(*_runs(doc), strict=True):
        data = texts[at]
        spans = [
            (start, k, end)
            for k, rule in enumerate(rules)
            for start, end in _resolve(rule, own[k], data, ends[lo:hi][(bits[lo:hi] >> k) & 1 > 0] - first[at])
        ]
        if spans:
            if not data.isascii():
                points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                spans = [(int(points[a]), k, int(points[b])) for a, k, b in spans]
            found[at] = sorted(spans)
    return found


def _runs(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    edge = np.flatnonzero(np.diff(values)) + 1
    lo = np.concatenate([[0], edge])
    return values[lo].tolist(), lo.tolist(), np.concatenate([edge, [len(values)]]).tolist()


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id and spans (array of kind, start, stop; code points, end exclusive) of every row.

    Spans are ordered by start, then by the order of the rules. Null and empty
    texts have none; repeated rows are scanned each; other columns are not
    read; an empty table gives an empty result. Texts of any length are
    scanned whole: a text longer than a block is a block of its own.
    """
    ready_workers(docs.sparkSession)
    built = machines(rules)  # once, on the driver; a few hundred kB travel with the tasks
    kinds = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def blocks(column) -> Iterator[tuple[int, list[bytes]]]:
        texts, size, begin = [], 0, 0
        for k, t in enumerate(column.cast(pa.binary()).to_pylist()):
            texts.append(t)
            size += len(t)
            if size >= BLOCK_BYTES:
                yield begin, texts
                texts, size, begin = [], 0, k + 1
        yield begin, texts

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for begin, texts in blocks(batch.column(1)):
                for k, found in scan(texts, rules, built).items():
                    out[begin + k] = [{"kind": rules[r].kind, "start": a, "stop": b} for a, r, b in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(kinds))], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(spans, f"id {kind}, spans array<struct<kind:string,start:bigint,stop:bigint>>").withColumnRenamed("id", id_col)
