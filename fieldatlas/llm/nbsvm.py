"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed character n-grams of a text, present or absent. On a
bounded labelled sample each feature gets the log ratio of its smoothed
document shares in the two classes; a logistic regression is then fitted on the
features scaled by that ratio. What is shipped to the tasks is one weight per
hash bucket (ratio times coefficient), so scoring is a sum of looked-up weights
over a text's distinct n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fieldatlas.llm.text import free_name, held_out, numbered, ready_workers, whole

SIZES = (4, 6)
BITS = 18
PIECE = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str, sizes=SIZES, bits: int = BITS) -> np.ndarray:
    """Hash buckets of the n-grams of every size, repeated as they occur.

    Letters are lower-cased; the text stands between two spaces, so a text
    shorter than a size still has its own grams of the other sizes.
    """
    return _grams(f" {text.lower()} ", sizes, bits)


def _grams(padded: str, sizes, bits: int) -> np.ndarray:
    points = np.frombuffer(padded.encode("utf-32-le"), np.uint32).astype(np.uint64)
    out = []
    for n in sizes:
        if len(points) < n:
            continue
        key = np.full(len(points) - n + 1, n, np.uint64)
        for k in range(n):
            key = (key + points[k : len(points) - n + 1 + k]) * _MIX
            key ^= key >> np.uint64(29)
        out.append((key * _MIX) >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int32) if out else np.empty(0, np.int32)


def distinct(text: str, sizes, bits: int, scratch: np.ndarray) -> np.ndarray:
    """The distinct buckets of a text; in ``scratch`` the last writer of each bucket wins."""
    if len(text) > PIECE:  # long texts in pieces that overlap by the longest n-gram
        seen = np.zeros(1 << bits, bool)
        padded = f" {text.lower()} "
        for a in range(0, len(padded), PIECE):
            seen[_grams(padded[a : a + PIECE + max(sizes) - 1], sizes, bits)] = True
        return np.flatnonzero(seen).astype(np.int32)
    found = features(text, sizes, bits)
    place = np.arange(len(found), dtype=np.int32)
    scratch[found] = place
    return found[scratch[found] == place]


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...] = SIZES
    bits: int = BITS

    def score(self, texts: list[str | None]) -> np.ndarray:
        scratch = np.empty(1 << self.bits, np.int32)
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            own = distinct(text or "", self.sizes, self.bits, scratch)
            out[k] = self.bias + self.weights[own].sum(dtype=np.float64)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def fit(texts: list[str], toxic: np.ndarray, sizes=SIZES, bits: int = BITS, alpha: float = 1.0, ridge: float = 1e-3, rate: float = 0.1, steps: int = 200, least_z: float = 3.0) -> Classifier:
    """Fits the classifier. With one class only (or no rows) the score is that class's smoothed share."""
    toxic = np.asarray(toxic, np.float64)
    n = len(texts)
    prior = (toxic.sum() + 1.0) / (n + 2.0)
    if n == 0 or toxic.min() == toxic.max():
        return Classifier(np.zeros(1 << bits, np.float32), float(np.log(prior / (1 - prior))), sizes, bits)
    scratch = np.empty(1 << bits, np.int32)
    rows = [distinct(t, sizes, bits, scratch) for t in texts]
    length = np.array([len(r) for r in rows])
    column = np.concatenate(rows)
    row = np.repeat(np.arange(n), length)
    # Document shares of each feature by class, smoothed; their log ratio scales the feature.
    yes = np.bincount(column, toxic[row], 1 << bits) + alpha
    no = np.bincount(column, 1 - toxic[row], 1 << bits) + alpha
    ratio = np.log(yes / (toxic.sum() + 2 * alpha)) - np.log(no / (n - toxic.sum() + 2 * alpha))
    ratio[yes + no == 2 * alpha] = 0.0
    # Only ratios that stand out from their sampling error take part; the others would be noise in long texts.
    kept = np.abs(ratio) >= least_z * np.sqrt(1 / yes + 1 / no)
    used = kept[column]
    place = np.cumsum(kept) - 1
    column, row = place[column[used]], row[used]
    value = ratio[kept][column]
    starts = np.searchsorted(row, np.arange(n))
    empty = starts == np.append(starts[1:], len(row))

    def times(w: np.ndarray) -> np.ndarray:
        if not len(row):
            return np.zeros(n)
        sums = np.add.reduceat(np.append(value * w[column], 0.0), starts)
        return np.where(empty, 0.0, sums)

    # Full-batch Adam steps on the logistic loss; the rarer class weighs more (square root of the odds).
    weigh = np.where(toxic > 0, np.sqrt((n - toxic.sum()) / toxic.sum()), 1.0)
    weigh /= weigh.sum()
    w = np.zeros(int(kept.sum()) + 1)  # the last one is the bias
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        error = weigh * (1.0 / (1.0 + np.exp(-np.clip(times(w[:-1]) + w[-1], -500, 500))) - toxic)
        grad = np.append(np.bincount(column, value * error[row], len(w) - 1) + ridge * w[:-1], error.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    w, bias = w[:-1], w[-1]
    weights = np.zeros(1 << bits)
    weights[kept] = w * ratio[kept]
    return Classifier(weights.astype(np.float32), float(bias), sizes, bits)


def training_rows(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", most: int = 2000) -> DataFrame:
    """At most ``most`` clean and ``most`` / 2 toxic rows (text, toxic) that are not held out, chosen by hash of the id.

    A document with several labels is toxic if one of them says so; null
    labels say nothing.
    """
    named = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    one = named.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    some = [
        one.where(F.col("toxic") == kind).orderBy(F.xxhash64(F.lit("labels"), F.col("id")), "id").limit(count)
        for kind, count in ((1, most // 2), (0, most))
    ]
    chosen = F.broadcast(some[0].union(some[1]))  # at most 1.5 x ``most`` rows of two numbers
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    # An id that several rows hold gives one of them, chosen by a hash of its text.
    first = F.min(F.struct(F.xxhash64("text").alias("at"), "text"))["text"].alias("text")
    return rows.join(chosen, "id").groupBy("id", "toxic").agg(first).select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", most: int = 2000) -> Classifier:
    """The classifier of a bounded sample of labelled rows."""
    rows = sorted((r[0], r[1]) for r in training_rows(docs, labels, id_col, text_col, label_col, most).collect())
    return fit([r[0] for r in rows], np.array([r[1] for r in rows]))


def classify(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and score (0 to 1; underscored where taken).

    Null and empty texts are scored like any other: by the bias and the grams of
    the empty text. Repeated rows get the same score; an empty table gives an
    empty result.
    """
    name = free_name("score", docs.columns)
    ready_workers(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(classifier)  # one weight per hash bucket

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = held.value.score(batch.column(batch.num_columns - 1).to_pylist())
            columns = [*batch.columns[:-1], pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema)]).add("s", "double")
    text = whole(f"c{docs.columns.index(text_col)}").alias("text")
    return numbered(docs).select("*", text).mapInArrow(answer, schema).toDF(*docs.columns, name)
