"""Byte automata: rules to one minimal DFA, and a vectorised scan with it.

``re`` parses a rule; the parse tree becomes an NFA over bytes, subset
construction makes it deterministic and partition refinement minimal. The
result is a flat transition array over byte classes, premultiplied by the
number of classes, so that one step of many lanes is one addition and one take.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

import numpy as np


class _Nfa:
    """Thompson construction; every state has empty moves and at most one byte-set move."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.move: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.empty.append([])
        self.move.append(None)
        return len(self.empty) - 1

    def add(self, tree, start: int, backward: bool = False) -> int:
        """Adds the sequence ``tree`` behind ``start``; returns its last state."""
        for op, arg in reversed(list(tree)) if backward else tree:
            start = self._item(op, arg, start, backward)
        return start

    def _item(self, op, arg, start, backward):
        if op in (rc.LITERAL, rc.IN, rc.ANY):
            end = self.state()
            self.move[start] = (_bytes(op, arg), end)
            out = self.state()
            self.empty[end].append(out)
            return out
        if op is rc.SUBPATTERN:
            return self.add(arg[3], start, backward)
        if op is rc.BRANCH:
            out = self.state()
            for option in arg[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(option, first, backward)].append(out)
            return out
        if op is rc.MAX_REPEAT:
            low, high, tree = arg
            for _ in range(low):
                start = self._fresh(start)
                start = self.add(tree, start, backward)
            if high is rc.MAXREPEAT:
                loop = self._fresh(start)
                body = self._fresh(loop)
                self.empty[self.add(tree, body, backward)].append(loop)
                return self._fresh(loop)
            out = self.state()
            for _ in range(high - low):
                self.empty[start].append(out)
                start = self.add(tree, self._fresh(start), backward)
            self.empty[start].append(out)
            return out
        raise ValueError(f"unsupported in a rule: {op}")

    def _fresh(self, start: int) -> int:
        new = self.state()
        self.empty[start].append(new)
        return new

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _bytes(op, arg) -> frozenset:
    if op is rc.LITERAL:
        found = {arg}
    elif op is rc.ANY:
        found = set(range(256)) - {10}
    else:
        negate = arg[0][0] is rc.NEGATE
        found = set()
        for kind, value in arg[negate:]:
            found |= {value} if kind is rc.LITERAL else set(range(value[0], value[1] + 1))
        found = set(range(256)) - found if negate else found
    if found and max(found) > 255:
        raise ValueError("rules are over bytes")
    return frozenset(found)


@dataclass(frozen=True)
class Dfa:
    """``table[state + classes[byte]]`` is the next state; states are multiples of ``width``.

    ``accepts[state // width]`` has a bit for each rule; the first state is 0,
    and ``dead`` (or -1) is the state that nothing leaves. Accepting states have
    the highest numbers: those from ``first_accept`` on.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray
    width: int
    first_accept: int
    dead: int

    def longest(self, data: bytes, at: int, stop: int, step: int = 1) -> int:
        """The far end of the longest match from ``at`` towards ``stop``, or -1."""
        state, found = 0, at if self.accepts[0] else -1
        table, classes, dead, first = self.table, self.classes, self.dead, self.first_accept
        while at != stop:
            state = table[state + classes[data[at if step > 0 else at - 1]]]
            if state == dead:
                break
            at += step
            if state >= first:
                found = at
        return found


def compile_rules(patterns: list[bytes], search: bool, backward: bool = False) -> Dfa:
    """One DFA of all patterns. ``search``: matches may begin at any byte."""
    nfa, ends = _Nfa(), {}
    root = nfa.state()
    for k, pattern in enumerate(patterns):
        first = nfa._fresh(root)
        ends[nfa.add(rp.parse(pattern), first, backward)] = k
    classes = _byte_classes([m[0] for m in nfa.move if m])
    width = int(classes.max()) + 1
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]
    start = nfa.closure([root])
    number, todo, rows = {start: 0}, [start], []
    while todo:
        now = todo.pop(0)
        row = []
        for byte in sample:
            then = {nfa.move[s][1] for s in now if nfa.move[s] and byte in nfa.move[s][0]}
            then = nfa.closure(then | {root}) if search else nfa.closure(then)
            if then not in number:
                number[then] = len(number)
                todo.append(then)
            row.append(number[then])
        rows.append(row)
    accepts = np.array([sum(1 << ends[s] for s in states if s in ends) for states in number], np.int64)
    return _minimal(np.array(rows, np.int64), accepts, classes)


def _byte_classes(sets: list[frozenset]) -> np.ndarray:
    """Bytes that no rule tells apart share a class."""
    of = {}
    return np.array([of.setdefault(tuple(b in s for s in dict.fromkeys(sets)), len(of)) for b in range(256)], np.int32)


def _minimal(rows: np.ndarray, accepts: np.ndarray, classes: np.ndarray) -> Dfa:
    """Partition refinement: blocks split until their rows lead to the same blocks."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[rows]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    one = np.array([np.flatnonzero(block == b)[0] for b in range(block.max() + 1)])
    order = sorted(range(len(one)), key=lambda b: (accepts[one[b]] > 0, b != block[0], b))
    if accepts[0]:
        raise ValueError("a rule matches nothing at all")
    place = np.empty(len(one), np.int64)
    place[order] = np.arange(len(one))
    width = rows.shape[1]
    table = place[block[rows[one[order]]]] * width
    kept = accepts[one[order]]
    loops = [s for s in range(len(one)) if not kept[s] and (table[s] == s * width).all()]
    dead = loops[0] * width if loops and loops[0] else -1
    return Dfa(classes, table.astype(np.int32).ravel(), kept, width, int(np.searchsorted(kept > 0, True)) * width, dead)


def accept_positions(dfa: Dfa, data: np.ndarray, lane: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """One pass over ``data``: ends (exclusive) where some rule matches, and the rules' bits.

    The bytes are dealt over lanes that advance together. A lane first assumes
    the start state; where its predecessor ends in another state it is walked
    again from there until both walks meet, so the result is that of one walk.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lanes = -(-len(data) // lane)
    padded = np.zeros(lanes * lane, np.uint8)
    padded[: len(data)] = data
    classes = np.ascontiguousarray(dfa.classes.astype(np.int32)[padded].reshape(lanes, lane).T)
    states = np.empty((lane, lanes), np.int32)
    state, index = np.zeros(lanes, np.int32), np.empty(lanes, np.int32)
    for j in range(lane):
        np.add(state, classes[j], out=index)
        state = np.take(dfa.table, index, out=states[j])
    redo, begin = np.flatnonzero(states[-1, :-1]) + 1, states[-1, :-1][states[-1, :-1] != 0]
    while len(redo):
        active, now = redo, begin
        for j in range(lane):
            now = dfa.table[now + classes[j, active]]
            differs = now != states[j, active]
            active, now = active[differs], now[differs]
            if not len(active):
                break
            states[j, active] = now
        inside = active < lanes - 1
        redo, begin = active[inside] + 1, now[inside]
    step, at = np.nonzero(states >= dfa.first_accept)
    where = at * lane + step
    order = np.argsort(where, kind="stable")
    where, found = where[order], dfa.accepts[states[step, at][order] // dfa.width]
    real = where < len(data)
    return where[real] + 1, found[real]
