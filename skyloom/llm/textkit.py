"""Vectorised text work on Arrow string columns: words, their hashes, shingles.

Words follow `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased. All of it works on the UTF-8 bytes of a slice of
rows at once, so Python touches no single word. A slice holds about 256 KiB of text, which keeps its arrays in the
caches, or one longer row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
LONG_SPAN = 1024
#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SOLID = bytes(b not in (0x20, *range(0x09, 0x0E)) for b in range(256))
_powers: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, dtype=U64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows in one array, and len+1 offsets; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def mapped(raw: np.ndarray, table: bytes) -> np.ndarray:
    """Each byte's entry in a table of 256."""
    return np.frombuffer(raw.tobytes().translate(table), np.uint8)


def lowered(raw: np.ndarray) -> np.ndarray:
    return mapped(raw, _LOWER)


def slices(column: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes of text each; at least one row."""
    _, offsets = utf8(column)
    start, n = 0, len(column)
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield start, stop
        start = stop


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from its length and its eight-byte pieces in order.

    Spans beyond LONG_SPAN bytes are hashed by a polynomial instead, so one very long word costs no loop over its pieces.
    """
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    out = mix64((eight.take(starts) & _FIRST_BYTES.take(np.minimum(size, 8))) + size.astype(U64) * U64(0xD6E8FEB86659FD93))
    rest, done = np.flatnonzero(size > 8), 8
    while len(rest) and done < LONG_SPAN:
        left = np.minimum(size[rest] - done, 8)
        out[rest] = mix64((out[rest] * U64(BASE)) ^ (eight.take(starts[rest] + done) & _FIRST_BYTES.take(left)))
        done += 8
        rest = rest[size[rest] > done]
    for k in rest.tolist():
        piece = raw[starts[k] : ends[k]].astype(U64) + U64(1)
        out[k] = mix64(np.array([(piece * powers(BASE, len(piece))).sum() + U64(len(piece))]))[0]
    return out


def first_eight(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span, or all of it, as a number."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    return eight.take(starts) & _FIRST_BYTES.take(np.minimum(ends - starts, 8))


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row where its words begin (len+1 positions in the former)."""
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = mapped(raw, _SOLID).view(bool)
    turns = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = turns[::2], turns[1::2]
    edges = np.unique(offsets[1:-1])
    edges = edges[(edges > 0) & (edges < n)]
    glued = edges[solid[edges] & solid[edges + 1]]  # a row ends in a word and the next begins with one
    if len(glued):
        starts, ends = (np.sort(np.concatenate([x, glued]), kind="stable") for x in (starts, ends))
    return starts, ends, np.searchsorted(starts, offsets)


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, in order, and len+1 positions where each row's words begin."""
    raw, offsets = utf8(column)
    starts, ends, rows = word_spans(raw, offsets)
    return span_hashes(lowered(raw), starts, ends), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row (a shorter row: all its words as one), and where each row's begin."""
    counts = np.diff(rows)
    made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.zeros(len(rows), np.int64)
    np.cumsum(made, out=begin[1:])
    first = np.repeat(rows[:-1] - begin[:-1], made) + np.arange(begin[-1])
    out = np.zeros(len(first), U64)
    length = np.repeat(np.minimum(counts, k), made)
    padded = np.concatenate([hashes, np.zeros(k, U64)])
    factor = 1
    for j in range(k):
        factor = factor * BASE % (1 << 64)
        out += np.where(length > j, padded[first + j], U64(0)) * U64(factor)
    return mix64(out + length.astype(U64)), begin
