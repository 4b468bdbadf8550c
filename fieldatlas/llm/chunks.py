"""Encoding by chunks: texts are cut where no token can cross, and the ids of frequent chunks are remembered.

A tokenizer may be used this way if a text's ids are those of its chunks one
after the other, whatever the cut. Chunks also bound what the library holds at
once: it never sees more than one batch's new chunks.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

REMEMBERED = 300_000
REMEMBER_LENGTH = 48
#: Small enough that a batch and what it meets of the tables stay in a processor's cache: half the time of 1 MB.
PIECE_BYTES = 3 << 16
#: Words that are handed to the library as one text.
TOGETHER = 500

_SPACES = re.compile(r"(?<=\S) (?=[\s\S])")
#: White space, and the sign for a space of sentencepiece, right before a space: there the space is no cut.
_NO_CUT = [c + " " for c in " \t\n\v\f\r"], [c + " " for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\u2581"]


def at_spaces(text: str) -> list[str]:
    """Cuts at, and drops, each space between a character that is not white space and any other."""
    if text[:1] == " " or text[-1:] == " " or any(w in text for w in _NO_CUT[0]) or not text.isascii() and any(w in text for w in _NO_CUT[1]):
        return _SPACES.split(text)
    return text.split(" ")


class Chunks:
    """Chunk to whatever ``encode_many`` makes of it, in two tables of bounded size.

    When the younger table is full it becomes the older one; what is found
    there moves back, so frequent chunks stay. Long chunks are not kept. A table
    holds about ``share`` times ``REMEMBERED`` chunks.
    """

    def __init__(self, cut: Callable[[str], list], encode_many: Callable[[list], list], share: float = 1):
        self.cut, self.encode_many, self.share = cut, encode_many, share
        self.young: dict = {}
        self.old: dict = {}

    def of(self, texts: list) -> list[list]:
        """For every text, what its chunks became, in order."""
        with no_gc():
            if len(self.young) >= REMEMBERED * self.share:
                self.old, self.young = self.young, {}
            cuts = list(map(self.cut, texts))
            missing, old = set(chain.from_iterable(cuts)).difference(self.young), self.old
            self.young.update([(chunk, old[chunk]) for chunk in missing if chunk in old])
            new = list(missing.difference(old))
            if new:
                self.young.update(zip(new, self.encode_many(new), strict=True))
            known = self.young.__getitem__
            out = [list(map(known, chunks)) for chunks in cuts]
            for chunk in new:
                if len(chunk) > REMEMBER_LENGTH:
                    del self.young[chunk]
            return out

    def parts(self, cuts: list[list], encode_new: Callable[[list], list]) -> list[bytes]:
        """The packed ids of chunks that are cut into smaller ones, which are remembered as chunks are."""
        young, old = self.young, self.old
        wanted = set(chain.from_iterable(cuts))
        own = {p: young[p] for p in wanted if p in young}
        missing = wanted.difference(own)
        found = {p: old[p] for p in missing if p in old}
        new = list(missing.difference(found))
        found.update(zip(new, encode_new(new), strict=True))
        young.update((p, ids) for p, ids in found.items() if len(p) <= REMEMBER_LENGTH)
        own.update(found)
        return [own[c[0]] if len(c) == 1 else b"".join([own[p] for p in c]) for c in cuts]


@contextmanager
def no_gc():
    """The tables hold no cycles; looking for some among many small lists takes a quarter of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def pieces(batch: pa.RecordBatch, limit: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes (``PIECE_BYTES``)."""
    if not batch.num_rows:
        return
    rows = max(1, batch.num_rows * (limit or PIECE_BYTES) // max(1, batch.nbytes))
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def json_tokenizer(data: bytes, special_as_text: bool) -> Tokenizer:
    """A tokenizer from the bytes of its file; Spark's tasks are the only parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


def encode_words(tokenizer: Tokenizer, words: list[str], glue: str, edge: np.ndarray, ends: bool, kind: np.dtype) -> list[bytes]:
    """The packed ids of every word, by giving the library many words as one text.

    Joined by ``glue``, each word must be a pre-token of its own with exactly
    one token that ``edge`` marks (by id): its last (``ends``) or its first.
    Where the marks do not count up, words are encoded one by one.
    """
    out: list[bytes] = []
    runs = [words[a : a + TOGETHER] for a in range(0, len(words), TOGETHER)]
    coded = tokenizer.encode_batch_fast([glue.join(run) for run in runs], add_special_tokens=False)
    for run, whole in zip(runs, coded, strict=True):
        ids = np.array(whole.ids, kind)
        at = np.flatnonzero(edge[ids])
        if len(at) == len(run) and (at[-1] == len(ids) - 1 if ends else at[0] == 0):
            stops = (at + 1 if ends else np.append(at[1:], len(ids))) * kind.itemsize
            packed, last = ids.tobytes(), 0
            for stop in stops.tolist():
                out.append(packed[last:stop])
                last = stop
        else:
            out += [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(run, add_special_tokens=False)]
    return out


def encode_texts(tokenizer: Tokenizer, texts: list[str], kind: np.dtype) -> list[bytes]:
    """The packed ids of every text."""
    return [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


def by_kind(items: list, is_word: Callable[[object], bool], words: Callable[[list], list], others: Callable[[list], list]) -> list:
    """``words`` of the items that are words and ``others`` of the rest, in the items' order."""
    chosen = list(map(is_word, items))
    one, two = iter(words([i for i, w in zip(items, chosen, strict=True) if w])), iter(others([i for i, w in zip(items, chosen, strict=True) if not w]))
    return [next(one) if w else next(two) for w in chosen]
