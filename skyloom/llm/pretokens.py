"""Splits whole columns of text into the pre-tokens of the public byte-level pattern, without a regex per row.

The pattern, as the tokenizers' files give it: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
It is applied to the code points of a slice of rows at once: a class per code point, starts where the class changes,
one blank before a run belongs to it, the last white-space character before a run stands alone otherwise.
`fits(pattern)` says whether a tokenizer's pattern is this one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from skyloom.llm import textkit as K

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, OTHER, WHITE = 0, 1, 2, 3


def fits(pattern: str) -> bool:
    return pattern == PATTERN


@cache
def _classes() -> np.ndarray:
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], dtype=np.uint32)
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[points[m.start() : m.end()]] = kind
    return out


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all pre-tokens, and where each row's begin (len(offsets) positions)."""
    if len(raw) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    point = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(point)
    kind = _classes()[point]
    edge = np.zeros(n, bool)
    row = np.searchsorted(at, offsets[:-1])
    edge[row[row < n]] = True
    begin = edge.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    white = kind == WHITE
    after = np.flatnonzero(begin[1:] & ~edge[1:] & white[:-1] & ~white[1:]) + 1  # a run that follows white space
    begin[after] = point[after - 1] != 32
    begin[after - 1] = True
    mark = np.flatnonzero(begin & (point == 39))
    if len(mark):
        _contractions(point, edge, begin, mark)
    first = np.flatnonzero(begin)
    starts = at[first]
    ends = np.append(starts[1:], len(raw))
    return starts, ends, np.searchsorted(starts, offsets)


def _contractions(point: np.ndarray, edge: np.ndarray, begin: np.ndarray, mark: np.ndarray) -> None:
    n = len(point)
    inside = lambda i: (i < n) & ~edge[np.minimum(i, n - 1)]
    char = lambda i: np.where(inside(i), point[np.minimum(i, n - 1)], 0)
    one, two = char(mark + 1), np.where(inside(mark + 1), char(mark + 2), 0)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ~short & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
    begin[mark[short | long] + 1] = False
    ends = np.concatenate([mark[short] + 2, mark[long] + 3])
    begin[ends[ends < n]] = True


class Vocabulary:
    """Resolves pre-tokens to ids and remembers them in a hash table of fixed size, for as long as the Python worker lives.

    An entry is found by the pre-token's 64-bit hash and confirmed by its first eight bytes, so pre-tokens of up to eight bytes are
    told apart by their bytes and longer ones by 128 bits. The table starts anew when three quarters of it are full.
    """

    SLOT_BITS = 21

    def __init__(self, resolve, slot_bits: int = SLOT_BITS) -> None:
        self.resolve, self.SLOT_BITS = resolve, slot_bits
        self.clear()

    def clear(self) -> None:
        n = 1 << self.SLOT_BITS
        self.name, self.head = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.begin, self.size = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.flat, self.used, self.entries = np.zeros(1 << 16, np.uint32), 0, 0

    def _find(self, name: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Slots of the given pre-tokens, -1 where they aren't known."""
        mask = np.uint64((1 << self.SLOT_BITS) - 1)
        slot = (name & mask).astype(np.int64)
        right = (self.name.take(slot) == name) & (self.head.take(slot) == head)
        rest = np.flatnonzero(~right)
        while len(rest):
            at = slot[rest]
            empty = self.size[at] == 0
            slot[rest[empty]] = -1
            rest = rest[~empty]
            at = at[~empty] + 1 & int(mask)
            slot[rest] = at
            rest = rest[(self.name[at] != name[rest]) | (self.head[at] != head[rest])]
        return slot

    def _add(self, name: np.ndarray, head: np.ndarray, found: list[Sequence[int]]) -> None:
        size = np.fromiter(map(len, found), np.int64, len(found))
        total = int(size.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), total), np.uint32)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        self.entries += len(found)
        rest, slot = np.arange(len(name)), (name & np.uint64((1 << self.SLOT_BITS) - 1)).astype(np.int64)
        while len(rest):
            free = np.flatnonzero(self.size[slot] == 0)
            at, first = np.unique(slot[free], return_index=True)
            own = rest[free[first]]
            self.name[at], self.head[at], self.begin[at], self.size[at] = name[own], head[own], begin[own], size[own]
            left = np.ones(len(rest), bool)
            left[free[first]] = False
            rest, slot = rest[left], slot[left] + 1 & (1 << self.SLOT_BITS) - 1

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """uint32 ids of all rows, and where each row's begin."""
        raw, offsets = K.utf8(column)
        starts, ends, rows = spans(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        name, head = K.span_hashes(raw, starts, ends), K.first_eight(raw, starts, ends)
        slot = self._find(name, head)
        new = np.flatnonzero(slot < 0)
        if len(new):
            new = new[np.lexsort((head[new], name[new]))]
            other = (np.diff(name[new]) != 0) | (np.diff(head[new]) != 0)
            new = new[np.append(True, other)]
            if self.entries + len(new) > 3 << self.SLOT_BITS - 2:
                if len(new) > 3 << self.SLOT_BITS - 2:  # one very long text
                    self.SLOT_BITS = len(new).bit_length() + 1
                self.clear()
                return self.ids(column)
            data = raw.tobytes()
            self._add(name[new], head[new], self.resolve([data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]))
            missing = np.flatnonzero(slot < 0)
            slot[missing] = self._find(name[missing], head[missing])
        size = self.size.take(slot)
        total = np.zeros(len(slot) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.flat.take(np.repeat(self.begin.take(slot) - total[:-1], size) + np.arange(total[-1])), total[rows]
