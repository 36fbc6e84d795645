"""Byte-level BPE with a two-tier lookup, and its inverse.

Tier one: a minimal perfect hash (hash and displace) over the vocabulary resolves every pre-token that is itself a
vocabulary entry: one displacement, one slot, one comparison of the bytes. Tier two, for the misses: a heap of
mergeable neighbours over a doubly linked list of the pre-token's bytes; the least rank goes first, the leftmost of equals.

Ids travel as binaries of little-endian unsigned 32-bit integers. Null and empty texts have no ids and decode to an
empty binary. Any text length is taken whole; rows are handled in slices of about a MiB.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import pretokens
from skyloom.llm import textkit as K
from skyloom.llm.common import given_back

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
#: Slots of the table of pre-tokens seen (12 MiB, and a task starts anew): in a pipeline its worker comes on top of what earlier stages left.
SLOT_BITS = 19


def load_ranks(path: str) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Maps each of n keys, given by its 64-bit hash, to a slot of its own below n."""

    def __init__(self, hashes: np.ndarray, per_bucket: int = 4) -> None:
        n = len(hashes)
        self.n, self.buckets = n, max(1, -(-n // per_bucket))
        self.shift = np.zeros(self.buckets, np.int64)
        bucket = (hashes % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        count = np.bincount(bucket, minlength=self.buckets)
        begin = np.cumsum(count) - count
        free = np.ones(n, bool)
        for b in np.argsort(-count, kind="stable").tolist():
            keys = hashes[order[begin[b] : begin[b] + count[b]]]
            if len(keys) < 2:
                break
            d = 0
            while True:
                at = self._slot(keys[None, :], np.arange(d, d + 64)[:, None])
                fits = free[at].all(axis=1) & (np.diff(np.sort(at, axis=1), axis=1) > 0).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    self.shift[b] = d + k
                    free[at[k]] = False
                    break
                d += 64
        single = np.flatnonzero(count == 1)
        self.shift[single] = -1 - np.flatnonzero(free)  # a bucket of one names its slot

    def _slot(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (K.mix64(hashes + shift.astype(U64) * _STEP) % U64(self.n)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % U64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, self._slot(hashes, np.maximum(shift, 0)))


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: merges by a heap over linked bytes. A node is a start; `end` links to the next one."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if end[i] != j or end[j] != e:
            continue
        end[i], end[j] = e, -1
        if e < n:
            before[e] = i
            if (r := ranks.get(piece[i : end[e]])) is not None:
                heapq.heappush(heap, (r, i, e, end[e]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:e])) is not None:
            heapq.heappush(heap, (r, p, i, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Coder:
    """Both tiers and the way back, for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        tokens = sorted(ranks, key=ranks.get)
        ids = np.array([ranks[t] for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        size = np.array([len(t) for t in tokens], np.int64)
        ends = np.cumsum(size)
        hashes = K.span_hashes(self.bytes, ends - size, ends)
        self.table = PerfectHash(hashes)
        self.slot_id = np.zeros(len(tokens), np.int64)
        self.slot_id[self.table.slots(hashes)] = ids
        self.begin, self.size = np.zeros(int(ids.max()) + 1, np.int64), np.zeros(int(ids.max()) + 1, np.int64)
        self.begin[ids], self.size[ids] = ends - size, size
        self.vocabulary = pretokens.Vocabulary(self.resolve, SLOT_BITS)

    def resolve(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        if not pieces:
            return []
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(size)
        guess = self.slot_id[self.table.slots(K.span_hashes(raw, ends - size, ends))]
        text = self.bytes.tobytes()
        out = []
        for piece, i, a, n in zip(pieces, guess.tolist(), self.begin[guess].tolist(), self.size[guess].tolist(), strict=True):
            out.append((i,) if text[a : a + n] == piece else tuple(merged(piece, self.ranks)))
        return out

    def decode(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all rows' ids, and where each row's begin."""
        size = self.size[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.bytes[np.repeat(self.begin[ids] - total[:-1], size) + np.arange(total[-1])], total[rows]


_coders: dict[int, Coder] = {}


def coder_of(ranks: dict[bytes, int]) -> Coder:
    """The coder of a vocabulary, built once in a Python worker."""
    key = hash(frozenset(ranks.items()))
    if key not in _coders or _coders[key].ranks != ranks:
        _coders.clear()
        _coders[key] = Coder(ranks)
    return _coders[key]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def _encode(ranks: dict[bytes, int]) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks)
        for batch in batches:
            for start, stop in K.slices(batch.column(1)):
                ids, rows = coder.vocabulary.ids(batch.column(1).slice(start, stop - start))
                packed = _binary(ids.astype("<u4").view(np.uint8), rows * 4)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), packed], names=["doc_id", "ids"])
        coder.vocabulary.clear()  # a worker that lives on keeps the perfect hash alone

    return run


def _decode(ranks: dict[bytes, int]) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(ranks)
        for batch in batches:
            ids = batch.column(1).fill_null(b"").cast(pa.large_binary())
            for at in range(0, len(ids), 256):
                part = ids.slice(at, 256)
                offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
                data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
                text, rows = coder.decode(data.view("<u4").astype(np.int64), (offsets - offsets[0]) // 4)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), part.cast(pa.binary()), _binary(text, rows)], names=["doc_id", "ids", "decoded"])

    return run


def _both(ranks: dict[bytes, int]) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decode(ranks)(_encode(ranks)(batches))

    return run


def encode_and_decode(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids, decoded of every row's text: `decode` of `encode`, both in one Python worker of a task."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_both(ranks), "doc_id long, ids binary, decoded binary")


def encode(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids of every row's text. The ranks (half a MB) go to the executors with the task's code."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_encode(ranks), "doc_id long, ids binary")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, ids, decoded: the bytes that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, ids binary, decoded binary")
