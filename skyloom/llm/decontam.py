"""Benchmark decontamination by the q-gram lemma.

Benchmark texts are cut into overlapping segments: SEGMENT characters every half segment, and SHORT characters every STRIDE. A passage within e edits of a segment of w
characters shares at least w - q + 1 - q*e of its q-grams, all on diagonals that differ by at most e from each other's. So:

1. a hashed bit table finds the positions in a document whose q-gram occurs in the benchmark at all;
2. hits meet the places of their q-gram in the benchmark and are counted per segment in overlapping bands of diagonals; bands that reach the bound are kept;
3. each kept region is verified: by comparing the characters on the first hit's diagonal, else by banded alignment of the segment against
   the document with free ends, at most e edits. Short segments are aligned only for items that no other segment has found in the document.

Texts are compared after A-Z are lower-cased and runs of white space are one blank. e is a tenth of the segment's length,
or less where the lemma needs it. An exact excerpt of at least SHORT + STRIDE - 1 = 55 characters of any item holds a whole
short segment, wherever it begins, so it's found; of an item shorter than SHORT the whole is looked for. Items shorter than q characters have no q-gram: they're found where they
stand as they are between blanks or the text's ends. Null and
empty documents match nothing; null, empty and white benchmark texts are left out; repeated rows and equal items give repeated rows of the benchmark but no repeated work.

Memory is bounded whatever the texts repeat. Segments with equal texts are one (with several owners), and only the places they cover are indexed. A run of one
character is shortened to twice RUN_KEPT in documents, more than any alignment spans, so what is found and where it begins and ends stays the same.
Hits are worked through in portions of about PORTION hit places, each with the OVERLAP of positions that a segment spans.

The benchmark goes to the tasks in blocks of about BLOCK_CHARS characters (a longer item in pieces that overlap), one pass over the
documents for each. A block's hits are written before the next block is read, so a larger benchmark costs passes, not memory. Documents aren't shuffled; only hits are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import textkit as K
from skyloom.llm.common import given_back, written

Q, SEGMENT, EDIT_SHARE = 8, 96, 0.1
SHORT, STRIDE = 48, 8
BLOCK_CHARS, PIECE_OVERLAP = 4_000_000, 2 * SEGMENT
MOST_TABLE_BITS = 24
RUN_KEPT = 2 * SEGMENT
PORTION, OVERLAP, ROW_GAP = 1 << 19, 2 * SEGMENT, 4 * SEGMENT
NO_ITEM = -(1 << 63)
U64 = np.uint64


def normal(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points of all rows, and where each row's begin."""
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    point = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).copy()
    point[(point >= 65) & (point <= 90)] += 32
    blank = (point == 32) | ((point >= 9) & (point <= 13))
    point[blank] = 32
    rows = np.searchsorted(at, offsets)
    keep = np.ones(len(point), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    first = rows[:-1][rows[:-1] < len(point)]
    keep[first] = True
    total = np.zeros(len(point) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return point[keep], total[rows]


def grams(point: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q characters from each position on; q - 1 fewer than positions."""
    if len(point) < Q:
        return np.zeros(0, U64)
    half = Q // 2
    wide = point.astype(U64)
    four = np.zeros(len(wide) - half + 1, U64)
    for k in range(half):
        four = four * U64(0x1_0003) + wide[k : len(wide) - half + 1 + k] * U64(0x9E3779B1)
    return K.mix64(four[:-half] * U64(0x9E3779B97F4A7C15) + four[half:])


def shortened(point: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """The texts with the middle of long runs of one character left out, where each row begins, and the former place of each character."""
    if len(point) <= 2 * RUN_KEPT:
        return point, rows, None
    edge = np.ones(len(point) + 1, bool)
    edge[1:-1] = point[1:] != point[:-1]
    edge[rows] = True
    begin = np.flatnonzero(edge)
    long = np.flatnonzero(np.diff(begin) > 2 * RUN_KEPT)
    if not len(long):
        return point, rows, None
    change = np.zeros(len(point) + 1, np.int32)
    change[begin[long] + RUN_KEPT] += 1
    change[begin[long + 1] - RUN_KEPT] -= 1
    keep = np.cumsum(change[:-1]) == 0
    total = np.append(0, np.cumsum(keep))
    return point[keep], total[rows], np.flatnonzero(keep)


class Index:
    """Segments of a block of benchmark texts with the places of their q-grams.

    text: all different items one after the other. A segment is `width` characters from `start` on, the first of those with its
    text; `item` is one that has it, and owner_begin and owners name all of them.
    """

    def __init__(self, items: list[tuple[int, str]]) -> None:
        owners_of: dict[bytes, list[int]] = {}
        for item, raw in items:
            data = np.frombuffer(raw.encode(), np.uint8)
            point, _ = normal(data, np.array([0, len(data)]))
            point = point[np.cumsum(point != 32) > 0]
            point = point[: len(point) - int(np.argmax(point[::-1] != 32))] if len(point) else point
            if len(point):
                owners_of.setdefault(point.tobytes(), []).append(item)
        texts = [np.frombuffer(t, np.uint32) for t in owners_of]
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size) - size
        self.text = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
        start, width, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for most, step in ((SEGMENT, SEGMENT // 2), (SHORT, STRIDE)):
            w = np.minimum(size, most)
            if most == SHORT:
                w = np.where(size > SHORT, w, 0)  # such items are whole segments already
            last = size - w
            n = np.where(w > 0, last // step + 1 + (last % step > 0), 0)
            own = np.repeat(np.arange(len(size)), n)
            at = np.minimum((np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step, last[own])
            start.append(begin[own] + at)
            width.append(w[own])
            of.append(own)
        self._unique(np.concatenate(start), np.concatenate(width), np.concatenate(of), [np.array(v, np.int64) for v in owners_of.values()])
        fits = np.maximum(self.width - Q, 0) // Q
        self.budget = np.minimum((self.width * EDIT_SHARE).astype(np.int64), fits)
        self.bound = self.width - Q + 1 - Q * self.budget
        self.tiny = np.flatnonzero(self.width < Q)
        self.tiny_sizes = np.unique(self.width[self.tiny]).tolist()
        codes = np.array([self._code(self.text[a : a + w][None])[0] for a, w in zip(self.start[self.tiny], self.width[self.tiny], strict=True)], U64)
        order = np.argsort(codes, kind="stable")
        self.tiny, self.tiny_code = self.tiny[order], codes[order]
        #: Segments by the width of their bands, each with the places in the text that they cover.
        self.groups = []
        whole = np.flatnonzero(self.width >= Q)
        used = np.zeros(len(self.text), bool)
        for wide in np.unique(self.budget[whole] + 1).tolist():
            own = whole[self.budget[whole] + 1 == wide]
            own = own[np.argsort(self.start[own], kind="stable")]
            turn = np.zeros(len(self.text) + 1, np.int32)
            np.add.at(turn, self.start[own], 1)
            np.add.at(turn, self.start[own] + self.width[own] - Q + 1, -1)
            covered = np.cumsum(turn[:-1]) > 0
            used |= covered
            self.groups.append((wide, own, self.start[own], int((self.width[own] - Q).max()), int(self.bound[own].min()), covered))
        places = np.flatnonzero(used)
        g = grams(self.text)[places] if len(places) else np.zeros(0, U64)
        order = np.argsort(g, kind="stable")
        self.place = places[order].astype(np.int32)
        self.gram, first, count = np.unique(g[order], return_index=True, return_counts=True)
        self.first, self.count = first.astype(np.int32), count.astype(np.int32)
        self.bits = min(MOST_TABLE_BITS, max(16, (16 * len(self.gram)).bit_length()))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.gram >> U64(64 - self.bits)] = True

    @staticmethod
    def _code(rows: np.ndarray) -> np.ndarray:
        """A hash of each row of characters."""
        out = np.zeros(len(rows), U64)
        for k in range(rows.shape[1]):
            out = out * U64(K.BASE) + rows[:, k] + U64(1)
        return K.mix64(out)

    def _unique(self, start: np.ndarray, width: np.ndarray, of: np.ndarray, owners: list[np.ndarray]) -> None:
        """Keeps the first segment of each text; their owners are the owners of all items that hold it."""
        first = np.arange(len(start))
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            code = np.concatenate([self._code(self.text[start[own[a : a + 4096], None] + np.arange(w)]) for a in range(0, len(own), 4096)])
            _, at, back = np.unique(code, return_index=True, return_inverse=True)
            first[own] = own[at[back]]
        for a in range(0, len(start), 4096):  # whether equal hashes are equal texts
            part = slice(a, a + 4096)
            same = self.texts_at(start[part], width[part]) == self.texts_at(start[first[part]], width[part])
            first[part] = np.where(same.all(axis=1), first[part], np.arange(len(start))[part])
        kept, back = np.unique(first, return_inverse=True)
        self.start, self.width = start[kept], width[kept]
        pair = np.unique(np.stack([back, of]), axis=1) if len(back) else np.zeros((2, 0), np.int64)
        n = np.array([len(o) for o in owners], np.int64)
        self.owners = np.concatenate([owners[k] for k in pair[1].tolist()]) if pair.size else np.zeros(0, np.int64)
        self.owner_begin = np.append(0, np.cumsum(np.bincount(pair[0], weights=n[pair[1]], minlength=len(kept)).astype(np.int64))) if pair.size else np.zeros(1, np.int64)
        self.item = self.owners[self.owner_begin[:-1]]

    def texts_at(self, start: np.ndarray, width: np.ndarray) -> np.ndarray:
        """The segments' characters side by side, padded with 0."""
        at = np.arange(int(width.max()) if len(width) else 0)
        inside = at < width[:, None]
        return np.where(inside, self.text[np.minimum(start[:, None] + at, max(0, len(self.text) - 1))], 0) if len(self.text) else np.zeros((len(width), len(at)), np.uint32)

    def texts_of(self, which: np.ndarray) -> np.ndarray:
        return self.texts_at(self.start[which], self.width[which])

    def hits(self, point: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose q-gram is one of the benchmark's and lies in one row; which q-gram; the row."""
        g = grams(point)
        hit = np.flatnonzero(self.table[(g >> U64(64 - self.bits)).astype(np.int64)]) if len(self.gram) else np.zeros(0, np.int64)
        k = np.minimum(np.searchsorted(self.gram, g[hit]), len(self.gram) - 1)
        same = self.gram[k] == g[hit]
        hit, k = hit[same], k[same]
        row = np.searchsorted(rows, hit, side="right") - 1
        inside = hit + Q <= rows[row + 1]
        return hit[inside], k[inside], row[inside]

    def regions(self, point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Segment, row, lowest diagonal and the first hit's, of each band that reaches the segment's bound. A diagonal is where the segment would begin."""
        hit, k, row = self.hits(point, rows)
        out = [np.zeros((4, 0), np.int64)]
        if len(hit):
            until = np.cumsum(self.count[k], dtype=np.int64)
            at = 0
            while at < len(hit):
                stop = max(at + 1, int(np.searchsorted(until, until[at] - self.count[k[at]] + PORTION, side="right")))
                beyond = int(np.searchsorted(hit, hit[stop - 1] + OVERLAP, side="right"))
                out.append(self._portion(hit[at:beyond], k[at:beyond], row[at:beyond]))
                at = stop
        return np.unique(np.concatenate(out, axis=1), axis=1)

    def _portion(self, hit: np.ndarray, k: np.ndarray, row: np.ndarray) -> np.ndarray:
        n = self.count[k].astype(np.int64)
        back = np.repeat(np.arange(len(hit)), n)
        place = self.place[np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64)
        low = int(hit[0]) + ROW_GAP * int(row[0])
        diagonal = (hit + ROW_GAP * row - low)[back] - place + len(self.text)  # rows lie so far apart that no band holds hits of two on a segment
        out = [np.zeros((4, 0), np.int64)]
        for wide, own, start, reach, least, covered in self.groups:
            some = np.flatnonzero(covered[place])
            if len(some) < least:
                continue
            for shift in (0, 1):  # bands of twice the width that overlap by half, so any run of `wide` diagonals lies in one
                band = (diagonal[some] + shift * wide) // (2 * wide)
                key, at = np.unique(band * len(self.text) + place[some], return_index=True)  # a place counts once in a band
                if len(key) < least:
                    continue
                # places of which so many lie within a segment's reach that one can get to the least bound
                dense = np.flatnonzero(key[least - 1 :] - key[: len(key) - least + 1] <= reach)
                if not len(dense):
                    continue
                turn = np.zeros(len(key) + 1, np.int32)
                np.add.at(turn, dense, 1)
                np.add.at(turn, dense + least, -1)
                near = np.flatnonzero(np.cumsum(turn[:-1]) > 0)
                at = some[at[near]]
                p, b = place[at], key[near] // len(self.text)
                lo, hi = np.searchsorted(start, p - reach), np.searchsorted(start, p, side="right")
                of = np.repeat(np.arange(len(at)), hi - lo)
                seg = own[np.repeat(lo - (np.cumsum(hi - lo) - (hi - lo)), hi - lo) + np.arange((hi - lo).sum())]
                holds = self.start[seg] + self.width[seg] - Q >= p[of]
                of, seg = of[holds], seg[holds]
                _, first, count = np.unique(b[of] * len(self.start) + seg, return_index=True, return_counts=True)
                enough = first[count >= self.bound[seg[first]]]
                if len(enough):
                    seg, at, b = seg[enough], at[of[enough]], b[of[enough]]
                    shifted = self.start[seg] - len(self.text) + low - ROW_GAP * row[back[at]]
                    out.append(np.stack([seg, row[back[at]], b * 2 * wide - shift * wide + shifted, diagonal[at] + shifted]))
        return np.concatenate(out, axis=1)

    def tiny_places(self, point: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Segment, row and start of items shorter than q that stand between blanks or ends of a text."""
        out = [np.zeros((3, 0), np.int64)]
        if len(self.tiny) and len(point):
            opens, closes = np.zeros(len(point) + 1, bool), np.zeros(len(point) + 1, bool)
            opens[1:] = point == 32
            closes[:-1] = point == 32
            opens[rows], closes[rows] = True, True
            begin = np.flatnonzero(opens[:-1])
            of = np.searchsorted(rows, begin, side="right") - 1
            for w in self.tiny_sizes:
                fits = (begin + w <= rows[of + 1]) & closes[np.minimum(begin + w, len(point))]
                at, row = begin[fits], of[fits]
                code = self._code(point[at[:, None] + np.arange(w)])
                k = np.minimum(np.searchsorted(self.tiny_code, code), len(self.tiny) - 1)
                seg = self.tiny[k]
                same = (self.tiny_code[k] == code) & (self.width[seg] == w)
                seg, row, at = seg[same], row[same], at[same]
                same = self.same(seg, row, at, point, rows) if len(seg) else np.zeros(0, bool)
                out.append(np.stack([seg[same], row[same], at[same]]))
        return tuple(np.concatenate(out, axis=1))

    def same(self, which: np.ndarray, row: np.ndarray, start: np.ndarray, point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whether the segments stand at these places as they are."""
        w = self.width[which]
        at = start[:, None] + np.arange(int(w.max()))
        inside = (start >= rows[row]) & (start + w <= rows[row + 1])
        equal = (point[np.clip(at, 0, len(point) - 1)] == self.texts_of(which)) | (np.arange(at.shape[1]) >= w[:, None])
        return inside & equal.all(axis=1)

    def aligned(self, which: np.ndarray, row: np.ndarray, low: np.ndarray, point: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of segments against a band of diagonals from `low` on: the fewest edits, and where that part starts and stops."""
        e, w = self.budget[which], self.width[which]
        diagonals = int((4 * e + 2).max())  # the hits' band of 2 * (e + 1) and e more to either side
        base = low - e
        at = base[:, None] + np.arange(int(w.max()) + diagonals)
        texts = np.where((at >= rows[row][:, None]) & (at < rows[row + 1][:, None]), point[np.clip(at, 0, len(point) - 1)], 0)
        edits, begin, end = banded(self.texts_of(which), w, texts, diagonals)
        return edits, np.maximum(base + begin, rows[row]), np.minimum(base + end, rows[row + 1])


def banded(segments: np.ndarray, widths: np.ndarray, texts: np.ndarray, diagonals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row: the fewest edits between the first `widths` characters of the segment and a part of the text that starts on one
    of the first `diagonals` places and stays on these diagonals; where that part starts and ends.

    Cells hold edits * 2**12 plus the diagonal that the alignment started on. Text is padded with 0, which equals nothing.
    """
    m = len(segments)
    step = 1 << 12
    place = np.arange(diagonals, dtype=np.int32) * step
    cells = np.tile(np.arange(diagonals, dtype=np.int32), (m, 1))
    edits, begin, end = (np.zeros(m, np.int64) for _ in range(3))
    for i in range(segments.shape[1]):
        new = cells + (texts[:, i : i + diagonals] != segments[:, i : i + 1]).astype(np.int32) * step
        np.minimum(new[:, :-1], cells[:, 1:] + step, out=new[:, :-1])  # a character of the segment has none in the text
        new -= place
        np.minimum.accumulate(new, axis=1, out=new)  # characters of the text have none in the segment
        new += place
        cells = new
        done = np.flatnonzero(widths == i + 1)
        if len(done):
            on = cells[done].argmin(axis=1)
            best = cells[done, on]
            edits[done], begin[done], end[done] = best >> 12, best & step - 1, i + 1 + on
    return edits, begin, end


AT_ONCE = 512


def found(index: Index, point: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segment, row, start, stop and edits of the segments that are in the texts."""
    point, rows, former = shortened(point, rows)
    segment, row, low, first = index.regions(point, rows)
    out = [np.zeros((5, 0), np.int64)]
    known: set[tuple[int, int]] = set()  # row and item

    def owners(s: int) -> list[int]:
        return index.owners[index.owner_begin[s] : index.owner_begin[s + 1]].tolist()

    def keep(ok: np.ndarray, which: np.ndarray, own: np.ndarray, *places: np.ndarray) -> None:
        made = np.stack([which, own, *places])[:, ok]
        # of a segment in a row: the first start, the last stop, the fewest edits
        key, back = np.unique(made[0] * len(rows) + made[1], return_inverse=True)
        least = np.full((5, len(key)), np.iinfo(np.int64).max)
        for k, sign in enumerate((1, 1, 1, -1, 1)):
            np.minimum.at(least[k], back, sign * made[k])
        least[3] *= -1
        out.append(least)
        known.update((int(r), i) for s, r in zip(least[0].tolist(), least[1].tolist(), strict=True) for i in owners(s))

    tiny, own, begin = index.tiny_places(point, rows)
    keep(np.ones(len(tiny), bool), tiny, own, begin, begin + index.width[tiny], np.zeros(len(tiny), np.int64))
    copy = np.zeros(len(segment), bool)
    for at in range(0, len(segment), AT_ONCE):
        which, own, begin = (x[at : at + AT_ONCE] for x in (segment, row, first))
        ok = copy[at : at + AT_ONCE] = index.same(which, own, begin, point, rows)
        keep(ok, which, own, begin, begin + index.width[which], np.zeros(len(which), np.int64))
    for width in np.unique(index.width[segment[~copy]])[::-1].tolist():  # the longest first
        some = np.flatnonzero(~copy & (index.width[segment] == width))
        some = some[np.unique(np.stack([segment[some], row[some], low[some]]), axis=1, return_index=True)[1]]
        if width <= SHORT:
            some = np.array([k for k in some.tolist() if any((int(row[k]), i) not in known for i in owners(int(segment[k])))], np.int64)
        for at in range(0, len(some), AT_ONCE):
            which, own, base = (x[some[at : at + AT_ONCE]] for x in (segment, row, low))
            edits, begin, end = index.aligned(which, own, base, point, rows)
            keep(edits <= index.budget[which], which, own, begin, end, edits)
    segment, row, begin, end, edits = np.concatenate(out, axis=1)
    if former is not None and len(begin):
        begin, end = former[begin], former[end - 1] + 1
    return segment, row, begin, end, edits


def _find(index: Index, block: int) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in K.slices(batch.column(1)):
                part = batch.slice(start, stop - start)
                point, rows = normal(*K.utf8(part.column(1)))
                segment, row, begin, end, edits = found(index, point, rows)
                n = index.owner_begin[segment + 1] - index.owner_begin[segment]
                of = np.repeat(np.arange(len(segment)), n)
                item = index.owners[np.repeat(index.owner_begin[segment] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                columns = [part.column(0).take(pa.array(row[of])), part.column(2).take(pa.array(row[of])), pa.array(item), pa.array((begin - rows[row])[of]), pa.array((end - rows[row])[of]), pa.array(edits[of].astype(np.int32)), pa.array(segment[of] + (block << 32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "tag", "item_id", "start", "stop", "edits", "segment"])

    return run


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's texts, block by block; no more than one block is on the driver. A very long text comes in pieces that overlap."""
    block, size = [], 0
    for row in benchmark.where("text is not null").select("item_id", "text").toLocalIterator():
        for at in range(0, max(1, len(row["text"]) - PIECE_OVERLAP), BLOCK_CHARS):
            piece = row["text"][at : at + BLOCK_CHARS + PIECE_OVERLAP]
            block.append((row["item_id"], piece))
            size += len(piece)
            if size >= BLOCK_CHARS:
                yield block
                block, size = [], 0
    yield block


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tag (the text's xxhash64), item_id, start, stop, edits, segment: one row for each row of docs and segment of a benchmark text it holds."""
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ITEM)).alias("item_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, tag long, item_id long, start long, stop long, edits int, segment long"
    every = reduce(DataFrame.union, (written(texts.mapInArrow(_find(Index(b), k), kind)) for k, b in enumerate(blocks(bench))))
    return every.withColumn("item_id", F.nullif("item_id", F.lit(NO_ITEM)))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, stop, edits, segments: one row for each document and benchmark text it holds a part of.

    start and stop are positions in the normalised text, around all segments that were found; edits the fewest of any segment; segments how
    many different ones were found. Rows that share a doc_id count together; equal items give a row each, and so do items of a null id together. An empty table gives an empty one.
    """
    return passages(docs, benchmark).groupBy("doc_id", "item_id").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("edits").alias("edits"), F.count_distinct("segment").cast("int").alias("segments"))
