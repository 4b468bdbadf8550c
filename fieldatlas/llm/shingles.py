"""Word shingles of whole texts as sorted arrays of 64-bit hashes, vectorised with numpy."""

from __future__ import annotations

import re

import numpy as np

SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
PIECE = 1 << 20
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SEPARATORS)] = False
_BREAK = re.compile(rb"[\x20\x09-\x0d]")


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE = stream(256, 11)
_PLACE = stream(16, 12)
_BASE = stream(1, 13)[0]


def _piece_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    word = _IS_WORD[raw]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    if not len(edge):
        return np.empty(0, np.uint64)
    size = edge[1::2] - edge[::2]
    first = np.cumsum(size) - size
    letters = raw[word]
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(size.max()) - 1, _BASE)]))
    place = np.arange(len(letters)) - np.repeat(first, size)
    return mix(np.add.reduceat(_BYTE[letters] * power[place], first) + size.astype(np.uint64) * _PLACE[15])


def word_hashes(data: bytes) -> np.ndarray:
    """One hash per word of the text's lower-cased (A-Z) bytes, in order."""
    data = data.lower()
    if len(data) <= PIECE:
        return _piece_hashes(data)
    parts, at = [], 0
    while at < len(data):  # pieces end at a separator
        found = _BREAK.search(data, at + PIECE)
        stop = found.start() if found else len(data)
        parts.append(_piece_hashes(data[at:stop]))
        at = stop
    return np.concatenate(parts)


def shingle_set(data: bytes, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words than ``width`` the whole sequence is the one shingle."""
    words = word_hashes(data)
    n = len(words)
    if n == 0:
        return words
    many = min(n, width)
    total = np.full(n - many + 1, np.uint64(many))
    for k in range(many):
        total += words[k : n - many + 1 + k] * _PLACE[k]
    return np.unique(mix(total))
