"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits or of punctuation, as they are written. Features are the hashes of tokens, of pairs
of neighbouring tokens, and one for a pair of equal tokens, in 2**BITS columns; a text's value in a column is the share of
its features that fall there, times SCALE. A score is a sparse dot product through the logistic function, and an empty
text has the bias alone.

Training takes at most `max_rows` labelled rows, chosen by a hash of their id; their features, not their texts, come to the
driver, and per-coordinate FTRL-proximal steps run there. All documents are scored, whole, from weights of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import textkit as K
from skyloom.llm.common import given_back

BITS = 18
SCALE = 32.0
MAX_ROWS = 6000
PAIRED, SAME = np.uint64(0xC2B2AE3D27D4EB4F), 1
_KIND = np.full(256, 1, np.uint8)
_KIND[33:128] = 2
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _KIND[_a:_b] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Column numbers of all rows' features, and where each row's begin."""
    raw, offsets = K.utf8(column)
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = _KIND[raw]
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1][offsets[:-1] < n]] = True
    first = np.flatnonzero(change)
    ends = np.append(first[1:], n)
    solid = kind[first] > 0
    starts, ends = first[solid], ends[solid]
    rows = np.searchsorted(starts, offsets)
    one = K.span_hashes(raw, starts, ends)
    follows = np.ones(len(one), bool)
    follows[rows[1:][rows[1:] > 0] - 1] = False
    at = np.flatnonzero(follows[: len(one)])
    at = at[at + 1 < len(one)]
    pair = K.mix64(one[at] * PAIRED + one[at + 1])
    pair[one[at] == one[at + 1]] = np.uint64(SAME)
    every = np.concatenate([one, pair])
    where = np.concatenate([np.arange(len(one)), at])
    order = np.argsort(where, kind="stable")
    return (K.mix64(every[order]) >> np.uint64(64 - BITS)).astype(np.int64), np.searchsorted(where[order], rows)


@dataclass
class Ftrl:
    """FTRL-proximal for logistic loss; the bias is the last coordinate."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1
    z: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))
    n: np.ndarray = field(default_factory=lambda: np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> float:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        return float(p)


def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct columns and values of each row, the bias last."""
    for start, stop in K.slices(column):
        at, rows = features(column.slice(start, stop - start))
        for i in range(stop - start):
            own, count = np.unique(at[rows[i] : rows[i + 1]], return_counts=True)
            yield np.append(own, 1 << BITS), np.append(count * (SCALE / max(1, rows[i + 1] - rows[i])), 1.0)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = list(vectors(batch.column(2)))
        packed = ([m[0].astype("<i4").tobytes() for m in made], [m[1].astype("<f4").tobytes() for m in made])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(p, pa.binary()) for p in packed)], names=["doc_id", "label", "at", "x"])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = 4) -> np.ndarray:
    """labels(doc_id, label): weights of all columns and the bias. Labels without a document, and nulls, are left out.

    The chosen labels, max_rows at most, are broadcast to the documents. Of rows that share a doc_id one text stands for each label, the least by
    its features, so no more than max_rows vectors of 2**BITS columns at most come to the driver, as packed numbers. Rows are
    trained in an order that the ids and labels alone decide, so equal tables give equal weights.
    """
    given = labels.where("label is not null").select(F.xxhash64("doc_id").alias("h"), "doc_id", F.col("label").cast("int").alias("label"))
    chosen = given.orderBy("h", "doc_id", "label").limit(max_rows).select("doc_id", "label").distinct()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    chosen = texts.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long"), "label", "text")
    rows = chosen.mapInArrow(_vectors, "doc_id long, label int, at binary, x binary")
    found = rows.groupBy("doc_id", "label").agg(F.min(F.struct("at", "x")).alias("f")).select("doc_id", "label", "f.at", "f.x").toArrow().combine_chunks()
    key, y = found["doc_id"].to_numpy(), found["label"].to_numpy()
    at, x = (found[c].combine_chunks() if found.num_rows else pa.array([], pa.binary()) for c in ("at", "x"))
    model, order = Ftrl(), np.lexsort((y, key))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order[rng.permutation(len(order))]:
            model.learn(np.frombuffer(at[int(k)].as_buffer(), "<i4"), np.frombuffer(x[int(k)].as_buffer(), "<f4").astype(np.float64), int(y[k]))
    return model.weights()


def _score(weights: np.ndarray) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in K.slices(batch.column(1)):
                at, rows = features(batch.column(1).slice(start, stop - start))
                sums = np.zeros(len(at) + 1)
                np.cumsum(weights[at], out=sums[1:])
                total = (sums[rows[1:]] - sums[rows[:-1]]) * (SCALE / np.maximum(1, np.diff(rows))) + weights[-1]
                score = 1 / (1 + np.exp(-np.clip(np.round(total, 9), -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(score)], names=["doc_id", "score"])

    return run


def scores(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(weights), "doc_id long, score double")


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs with a column `score` (one that docs brings along is replaced): the same weights as a function of the text, so all columns stay beside it.

    The function is marked as one that isn't repeatable, so that a filter on the score doesn't evaluate it a second time.
    """

    @F.pandas_udf("double")
    def of(texts):
        import pandas as pd

        column = pa.array(texts, pa.string(), from_pandas=True)
        batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(column), np.int64)), column], names=["doc_id", "text"])
        return pd.Series(np.concatenate([b.column(1).to_numpy() for b in _score(weights)(iter([batch]))]) if len(column) else np.zeros(0))

    return docs.withColumn("score", of.asNondeterministic()(F.col("text").cast("string")))
