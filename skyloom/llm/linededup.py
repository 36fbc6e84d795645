"""Line dedup: an exact set-similarity join of lines over all documents, removing later matches.

A line is the set of its lower-cased words. Lines are in order of doc_id, text hash and place in the text; a line is removed if an
earlier line, kept or not, has a Jaccard similarity of at least 3/4 with it. Every line that holds a word is judged; lines
without one (empty or white space alone) have no set to compare and stay.

1. Words are counted over all texts in a hashed table of fixed size: the rarity order. It needs to be the same for all
   lines, not exact, so hashing costs no result.
2. Lines with equal sets (by 128 bits) are one: they meet by the set's hash, the first stands for all, and the later ones go. A sending
   task keeps back the lines that it knows an earlier one of the same set for, so a line that stands everywhere meets once a task or so.
3. Sets of one or two words match equal ones alone. Each other distinct set sends one row per word of its prefix (the
   rarest quarter of its words and one more): two sets that are similar enough share one of them. Rows of a word meet, sorted
   by set size, and are compared by length, by the position of the shared word, and by a 128-bit parity map of their words, whose
   differing bits are never more than the differing words. A word with very many rows is split into blocks that meet pairwise.
   Each later line passes on its best candidates of a word only, so a group of near copies doesn't give all its pairs.
4. Candidates are verified on the full sets: first the best of each line, then the others of lines without a match. For lines still
   without a match that had more candidates than were passed on, the lines of those words meet again, with their
   full sets, and all their pairs are counted out inside the task, which passes on one row per matched line.
5. Documents that lose lines are joined with their line numbers; a bit table keeps most of the rest from being moved.

Null texts stay null, empty ones empty. Rows that share a doc_id are rows of their own, in the order of their texts' hashes; rows
that share doc_id and text are one row given several times and get one result. A null doc_id comes first. Very long texts and lines
are taken whole. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import packed
from skyloom.llm import textkit as K
from skyloom.llm.common import bit_table, bit_tests, given_back, written

LEAST_UNEQUAL = 3  # the smallest set that an unequal one can match: 3 of 4 words
FIRST_EQUAL = 7  # the least size at which two different sets of that size can match: 6 of 8 words
COUNT_BITS = 20
BLOCK_ROWS = 200_000
PASSED_ON, DOUBTFUL, MOST_PASSED_ON = 2, 4, 16
PAIRS_AT_ONCE = 200_000
SENT_AT_ONCE = 150_000
SETS_AT_ONCE, MOST_KNOWN = 1 << 14, 1 << 15
FIRST = -(1 << 63)
ID, EARLY = ["doc", "tag", "line"], ["early_doc", "early_tag", "early_line"]
U64 = np.uint64
LINE_TYPES, WORD_TYPES, FULL_TYPES = ["u8", "u8", "i8", "i8", "i4", "i4", "u8", "u8"], ["u4", "u4", "u2", "i4", "i4", "i8", "i8", "i4", "u8", "u8"], ["u4", "u2", "i8", "i8", "i4", "u1"]


class Lines:
    """The lines of a slice of texts, each with its distinct words, in rarity order where counts are given."""

    def __init__(self, column: pa.Array, counts: np.ndarray | None = None, wanted: Callable | None = None) -> None:
        """wanted: takes row numbers and line numbers, says which lines are to be looked at; the others have no words."""
        raw, offsets = K.utf8(column)
        breaks = np.flatnonzero(raw == 10)
        doc = np.searchsorted(offsets, breaks, side="right") - 1
        first = np.arange(len(column)) + np.searchsorted(breaks, offsets[:-1])
        n = len(column) + len(breaks)
        self.doc, start = np.empty(n, np.int64), np.empty(n, np.int64)
        after = np.arange(len(breaks)) + doc + 1  # where the line behind each break comes in order
        self.doc[first], start[first] = np.arange(len(column)), offsets[:-1]
        self.doc[after], start[after] = doc, breaks + 1
        self.number = np.arange(n) - first[self.doc]
        low = K.lowered(raw)
        if wanted is not None:
            keep = wanted(self.doc, self.number)
            self.doc, self.number = self.doc[keep], self.number[keep]
            until = np.append(start[1:], len(raw))[keep]
            start = start[keep]
            low, start = _picked(low, start, until)
            n = len(start)
            offsets = np.append(start, len(low))
        w_start, w_end, _ = K.word_spans(low, offsets)
        word = K.span_hashes(low, w_start, w_end)
        line = np.repeat(np.arange(n), np.diff(np.append(np.searchsorted(w_start, start), len(w_start))))
        rarity = U64(0) if counts is None else _rarity(counts, word)
        room = 64 - n.bit_length()  # bits below the line's number: a class of rarity, then as much of the hash as fits
        order = np.argsort((line.astype(U64) << U64(room)) | (rarity << U64(room - 8)) | (word >> U64(72 - room)))
        word, line = word[order], line[order]
        keep = np.ones(len(word), bool)
        keep[1:] = (word[1:] != word[:-1]) | (line[1:] != line[:-1])
        self.word, self.line = word[keep], line[keep]
        self.begin = np.searchsorted(self.line, np.arange(n + 1))
        self.size = np.diff(self.begin)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(values, out=total[1:])
        return total[self.begin[1:]] - total[self.begin[:-1]]

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set."""
        mixed = K.mix64(self.word)
        one, two = self._sums(mixed), self._sums(K.mix64(mixed + U64(K.BASE)))
        return K.mix64(one + self.size.astype(U64)), K.mix64(two)

    def maps(self) -> list[np.ndarray]:
        """Two words of 64 bits per line: the parity of the words that fall on each bit."""
        bit = U64(1) << (self.word & U64(63))
        upper = (self.word >> U64(6) & U64(1)).astype(bool)
        out = []
        for half in (bit * ~upper, bit * upper):
            own = np.zeros(len(self.size), U64)
            some = np.flatnonzero(self.size)
            if len(some):
                own[some] = np.bitwise_xor.reduceat(half, self.begin[some])
            out.append(own)
        return out

    def heads(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The first `length` words of the lines `at`, one line after the other."""
        until = np.append(0, np.cumsum(length))
        return self.word[np.repeat(self.begin[at] - until[:-1], length) + np.arange(until[-1])]


def _picked(low: np.ndarray, start: np.ndarray, until: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some lines, each with the break that ends it, and where they begin now."""
    size = until - start
    begin = np.cumsum(size) - size
    return low[np.repeat(start - begin, size) + np.arange(size.sum())], begin


#: The class of a slot that one word falls on, once.
ONCE = 4


def _slot(word: np.ndarray) -> np.ndarray:
    return (word >> U64(64 - COUNT_BITS)).astype(np.int64)


def _rarity(counts: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A class of 8 bits: how often a word's slot occurs, in steps of about a quarter."""
    return counts.take(_slot(word)).astype(U64)


#: Sizes of sets by steps of 4/3: sets that match are in one class or in neighbouring ones.
_CLASSES = np.array([(4 / 3) ** k for k in range(1, 110)])


def size_class(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(_CLASSES, n, side="right")


def word_and_class(word: np.ndarray, step: np.ndarray) -> np.ndarray:
    return K.mix64(word.astype(U64) << U64(8) | step.astype(U64))


def _prefix_length(size: np.ndarray) -> np.ndarray:
    return np.where(size < LEAST_UNEQUAL, 0, size - (3 * size + 3) // 4 + 1)


def _count(pids: int) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for start, stop in K.slices(batch.column(0), 4 << 20):
                some = [K.words(batch.column(0).slice(start + a, b - a))[0] for a, b in K.slices(batch.column(0).slice(start, stop - start))]
                total += np.bincount(_slot(np.concatenate(some)), minlength=1 << COUNT_BITS)
        at = np.flatnonzero(total)
        if len(at):
            yield packed.pack(at * pids >> COUNT_BITS, [at.astype(np.uint32), total[at]])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if blobs := packed.gathered(batches):
        slot, n = packed.unpack(blobs.pop(0), ["u4", "i8"])
        at, back = np.unique(slot, return_inverse=True)
        total = np.zeros(len(at), np.int64)
        np.add.at(total, back, n)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total)], names=["slot", "n"])


def word_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of 2**COUNT_BITS hashed slots, whatever the corpus: each one's class of rarity, and the number of blocks its rows go in."""
    counted = packed.dealt(texts.select("text").mapInArrow(_count(packed.groups(texts)), packed.KIND))
    found = counted.mapInArrow(_summed, "slot int, n long").toArrow()
    n = np.zeros(1 << COUNT_BITS, np.int64)
    n[found["slot"].to_numpy()] = found["n"].to_numpy()
    return np.minimum(255, np.log2(n + 1) * 4).astype(np.uint8), (np.minimum(n // BLOCK_ROWS, 32766) + 1).astype(np.uint16)


class Rows:
    """Reads batches of (key, hash of the key, hash of the text, text): slices with each row's key and tag.

    The tag tells rows of one doc_id apart: the text's hash where the id may be repeated, else 0.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch], repeated: np.ndarray) -> None:
        self.batches, self.again = batches, bit_tests(repeated)

    def __iter__(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in self.batches:
            keys, named, tags = (batch.column(k).to_numpy() for k in range(3))
            tags = np.where(self.again(named), tags, 0)
            for start, stop in K.slices(batch.column(3)):
                yield batch.column(3).slice(start, stop - start), keys[start:stop], tags[start:stop]


def line_hash(doc: np.ndarray, tag: np.ndarray, line: np.ndarray) -> np.ndarray:
    return K.mix64(K.mix64(doc.astype(U64) + tag.astype(U64) * U64(K.BASE)) + line.astype(U64))


class Firsts(packed.Sender):
    """Sends lines by their set's hash, but those that an earlier line of the task has the set of, as exact repeats (kind 1), anywhere.

    It knows the first lines of the portion at hand, and of up to MOST_KNOWN sets that portions before repeated.
    """

    def __init__(self, at_once: int, pids: int) -> None:
        super().__init__(at_once)
        self.pids = pids
        self.known = [np.zeros(0, t) for t in (U64, U64, np.int64, np.int64, np.int32)]  # one, two, doc, tag, line; by one, two

    def made(self, pid: np.ndarray, columns: list[np.ndarray], lists: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        ids = [np.concatenate([k, c]) for k, c in zip(self.known, columns[:5], strict=True)]
        held, n = len(self.known[0]), len(pid)
        by = np.argsort(ids[0], kind="stable")
        alike = ids[0][by[1:]] == ids[0][by[:-1]]
        some = by[np.append(alike, False) | np.append(False, alike)] if n else by  # the rest are alone with their set here
        some = some[np.lexsort([ids[k][some] for k in (4, 3, 2, 1, 0)])]
        one, two, doc, tag, line = (x[some] for x in ids)
        new = np.ones(len(some), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        same = (doc == doc[first]) & (tag == tag[first]) & (line == line[first])  # as the first, or a row given several times
        mine = some >= held
        dropped = np.zeros(n, bool)
        dropped[some[mine & ~(new & mine)] - held] = True
        late = some[mine & ~same] - held
        count = np.bincount(np.cumsum(new) - 1)[: new.sum()] if len(some) else np.zeros(0, np.int64)
        keep = some[new][count > 1]
        alone = np.setdiff1d(np.arange(held), some)  # known sets that this portion doesn't have
        keep = np.concatenate([keep, alone])[:MOST_KNOWN]
        self.known = [x[keep] for x in ids]
        if len(late):
            row = [columns[k][late] for k in (2, 3, 4)]
            yield packed.pack((line_hash(*row) % U64(self.pids)).astype(np.int64), row, 1)
        left = np.flatnonzero(~dropped)
        if len(left):
            if lists and dropped.any():
                length = lists[0]
                lists = (length[left], lists[1][np.repeat(~dropped, length)])
            yield packed.pack(pid[left], [c[left] for c in columns], 0, lists)


def _sets(rarity: np.ndarray, repeated: np.ndarray, pids: int) -> Callable:
    """Every judged line, packed by its set's hash."""

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = Firsts(SENT_AT_ONCE, pids)
        for column, doc, tag in Rows(batches, repeated):
            lines = Lines(column, rarity)
            at = np.flatnonzero(lines.size)
            length = _prefix_length(lines.size[at])
            one, two = (x[at] for x in lines.ids())
            m = lines.maps()
            own = lines.doc[at]
            columns = [one, two, doc[own], tag[own], lines.number[at].astype(np.int32), lines.size[at].astype(np.int32), m[0][at], m[1][at]]
            yield from sender.take((one % U64(pids)).astype(np.int64), columns, (length, (lines.heads(at, length) >> U64(32)).astype(np.uint32)))
        yield from sender.rest()

    return run


def _prefixes(rarity: np.ndarray, blocks: np.ndarray, pids: int) -> Callable:
    """Groups of sets: the first of each sends its prefix words (kind 0), the others are exact repeats (kind 1), as some are already."""

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = packed.gathered(batches)
        if repeats := blobs.pop(1, []):
            doc, tag, line = packed.unpack(repeats, ["i8", "i8", "i4"])
            yield packed.pack((line_hash(doc, tag, line) % U64(pids)).astype(np.int64), [doc, tag, line], 1)
        if blobs:
            one, two, doc, tag, line, n, m0, m1, length, words = packed.unpack(blobs.pop(0), LINE_TYPES, "u4")
            order = np.lexsort((line, tag, doc, two, one))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
            same = np.zeros(len(order), bool)  # a row that is given several times
            same[1:] = ~new[1:] & (np.diff(doc[order]) == 0) & (np.diff(tag[order]) == 0) & (np.diff(line[order]) == 0)
            late, first = order[~new & ~same], order[new]
            if len(late):
                yield packed.pack((line_hash(doc[late], tag[late], line[late]) % U64(pids)).astype(np.int64), [doc[late], tag[late], line[late]], 1)
            begin, length = (np.cumsum(length, dtype=np.int64) - length)[first], length[first].astype(np.int64)
            sender = packed.Sender(SENT_AT_ONCE)
            for a in range(0, len(first), SETS_AT_ONCE):
                some = slice(a, a + SETS_AT_ONCE)
                yield from sent(sender, first[some], begin[some], length[some], words, n, doc, tag, line, m0, m1)
            yield from sender.rest()

    def sent(sender, first, begin, length, words, n, doc, tag, line, m0, m1) -> Iterator[pa.RecordBatch]:
        until = np.append(0, np.cumsum(length))
        if not until[-1]:
            return
        place = np.arange(until[-1]) - np.repeat(until[:-1], length)
        word = words[np.repeat(begin, length) + place]
        row = np.repeat(first, length)
        met = np.flatnonzero(rarity.take(word >> np.uint32(32 - COUNT_BITS)) > ONCE)  # what occurs once in all texts meets nothing
        word, row, place = word[met], row[met], place[met]
        parts = blocks.take(word >> np.uint32(32 - COUNT_BITS)).astype(np.int64)
        part = np.where(parts > 1, line_hash(doc[row], tag[row], line[row]).view(np.int64) & 0x7FFFFFFF, 0) % parts
        other, back = np.zeros(len(row), np.int64), np.arange(len(row))
        if (parts > 1).any():
            back = np.repeat(back, parts)
            other = np.arange(len(back)) - np.repeat(np.cumsum(parts) - parts, parts)
        word, row, place, part = word[back], row[back], place[back], part[back]
        ab = np.minimum(part, other) << 15 | np.maximum(part, other)
        pid = (K.mix64(word.astype(U64) << U64(30) | ab.astype(U64)) % U64(pids)).astype(np.int64)
        order = np.argsort(word)
        yield from sender.take(pid[order], [c[order] for c in (word, ab.astype(np.uint32), part.astype(np.uint16), n[row], place.astype(np.int32), doc[row], tag[row], line[row], m0[row], m1[row])])

    return run


FOUND = "doc long, tag long, line int, early_doc long, early_tag long, early_line int, distance int, word long, h long, early_h long"


def _found(late: tuple, early: tuple | None, distance: np.ndarray, word: pa.Array) -> pa.RecordBatch:
    """early None: exact repeats. h and early_h are the lines' hashes."""
    none = np.ones(len(distance), bool)
    columns = [pa.array(c, mask=None if early else none) for c in early or late]
    h = [pa.array(line_hash(*x).view(np.int64)) for x in (late, early or late)]
    return pa.RecordBatch.from_arrays([*map(pa.array, late), *columns, pa.array(distance.astype(np.int32)), word, *h], names=[f.split()[0] for f in FOUND.split(", ")])


class Meeting:
    """Compares the rows of each word and pair of blocks.

    Rows come sorted by group and set size n; place is the shared word's, and earlier(i, j) tells which line comes first.
    """

    def __init__(self, group: np.ndarray, n: np.ndarray, place: np.ndarray, own_block: np.ndarray, part: np.ndarray, maps: list[np.ndarray], doc, tag, line) -> None:
        self.n, self.place, self.own_block, self.part, self.maps, self.doc, self.tag, self.line = n, place, own_block, part, maps, doc, tag, line
        span = int(n.max()) + 2
        level = group * span + n
        until = np.searchsorted(level, group * span + np.minimum(n * 4 // 3, span - 1), side="right")
        self.first = np.where(n < FIRST_EQUAL, np.searchsorted(level, level, side="right"), np.arange(len(n)) + 1)
        self.partners = np.maximum(0, until - self.first)

    def candidates(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Later row, earlier row, least number of differing words, how many more there may be; a bounded number of pairs at once."""
        total = np.cumsum(self.partners)
        at = 0
        while at < len(total):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            partners = self.partners[at:stop]
            i = np.repeat(np.arange(at, stop), partners)
            j = np.arange(len(i)) + np.repeat(self.first[at:stop] - (np.cumsum(partners) - partners), partners)
            at = stop
            n, place = self.n, self.place
            both = n[i] + n[j]
            need = -(-3 * both // 7)
            ok = np.flatnonzero((np.minimum(n[i] - place[i], n[j] - place[j]) >= need) & (self.own_block[i] | (self.part[i] != self.part[j])))
            i, j, most = i[ok], j[ok], (both - 2 * need)[ok]
            distance = sum(np.bitwise_count(m[i] ^ m[j]).astype(np.int64) for m in self.maps)
            ok = np.flatnonzero(distance <= most)
            i, j, distance, margin = i[ok], j[ok], distance[ok], (most - distance)[ok]
            swap = (self.doc[i] > self.doc[j]) | ((self.doc[i] == self.doc[j]) & ((self.tag[i] > self.tag[j]) | ((self.tag[i] == self.tag[j]) & (self.line[i] > self.line[j]))))
            yield np.where(swap, i, j), np.where(swap, j, i), distance, margin


@given_back
def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if blobs := packed.gathered(batches):
        if 1 in blobs:
            late = packed.unpack(blobs.pop(1), ["i8", "i8", "i4"])
            yield _found(tuple(late), None, np.full(len(late[0]), -1), pa.nulls(len(late[0]), pa.int64()))
        if 0 in blobs:
            word, ab, part, n, place, doc, tag, line, m0, m1 = packed.unpack(blobs.pop(0), WORD_TYPES)
            key = word.astype(np.int64) << 30 | ab
            _, back, count = np.unique(key, return_inverse=True, return_counts=True)
            several = np.flatnonzero(count[back] > 1)
            order = several[np.lexsort((n[several], back[several]))]
            if not len(order):
                return
            n = n[order].astype(np.int64)
            doc, tag, line, key, ab = doc[order], tag[order], line[order], key[order], ab[order]
            meeting = Meeting(np.cumsum(np.append(0, key[1:] != key[:-1])), n, place[order].astype(np.int64), (ab >> 15) == (ab & 0x7FFF), part[order], [m0[order], m1[order]], doc, tag, line)
            best = _Best()
            for pairs in meeting.candidates():
                best.take(*pairs)
            late, early, distance, _, more = best.held
            if len(late):
                yield _found((doc[late], tag[late], line[late]), (doc[early], tag[early], line[early]), distance, pa.array(word_and_class(key[late] >> 30, size_class(n[late])).view(np.int64), mask=~more))


class _Best:
    """The closest PASSED_ON earlier rows of each later row, and whether it had more.

    Where the closest has nearly as many differing words as may be (all but DOUBTFUL), MOST_PASSED_ON are kept.
    """

    def __init__(self) -> None:
        self.held = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]

    def take(self, late: np.ndarray, early: np.ndarray, distance: np.ndarray, margin: np.ndarray) -> None:
        late, early, distance, margin, more = (np.concatenate(x) for x in zip(self.held, (late, early, distance, margin, np.zeros(len(late), bool)), strict=True))
        order = np.lexsort((early, distance, late))
        late, early, distance, margin, more = late[order], early[order], distance[order], margin[order], more[order]
        begin = np.searchsorted(late, late, side="left")
        count = np.searchsorted(late, late, side="right") - begin
        most = np.where(margin[begin] < DOUBTFUL, MOST_PASSED_ON, PASSED_ON)
        keep = np.arange(len(late)) - begin < most
        self.held = [late[keep], early[keep], distance[keep], margin[keep], (more | (count > most))[keep]]


def _full(bits: np.ndarray, repeated: np.ndarray) -> Callable:
    """doc, tag, line, size and the distinct words (48 bits each, packed) of the lines that a bit table lets through."""
    test = bit_tests(bits)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for column, doc, tag in Rows(batches, repeated):
            lines = Lines(column, None, lambda row, number: test(line_hash(doc[row], tag[row], number)))
            at = np.flatnonzero(lines.size)
            data = np.ascontiguousarray(lines.word[lines.begin[at[0]] : ].view(np.uint8).reshape(-1, 8)[:, :6]) if len(at) else np.zeros((0, 6), np.uint8)
            offsets = np.append(0, np.cumsum(lines.size[at])) * 6
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(doc[lines.doc[at]]), pa.array(tag[lines.doc[at]]), pa.array(lines.number[at].astype(np.int32)), words], names=[*ID, "words"])

    return run


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """48-bit words of all rows and their number in each."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].reshape(-1, 6)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, :6] = data
    return wide.view(U64).ravel(), np.diff(offsets) // 6


def shared_words(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """How many words each pair of sets has in common; below 65536 pairs, words of 48 bits."""
    rows = np.arange(len(size_a), dtype=U64) << U64(48)
    every = np.sort(np.concatenate([np.repeat(rows, size_a) | a, np.repeat(rows, size_b) | b]))
    return np.bincount((every[1:][every[1:] == every[:-1]] >> U64(48)).astype(np.int64), minlength=len(size_a))


@given_back
def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            own = batch.slice(at, 4096)
            (a, size_a), (b, size_b) = _words(own.column(3)), _words(own.column(4))
            common = shared_words(a, size_a, b, size_b)
            yield own.select(ID).filter(pa.array(4 * common >= 3 * (size_a + size_b - common)))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The later lines of pairs whose full sets are similar enough."""
    early = sets.withColumnsRenamed({"doc": "early_doc", "tag": "early_tag", "line": "early_line", "words": "early"})
    both = pairs.select(*ID, *EARLY).join(sets.hint("merge"), ID).join(early.hint("merge"), EARLY)
    return written(both.select(*ID, "words", "early").mapInArrow(_alike, "doc long, tag long, line int").distinct())


def _members(rarity: np.ndarray, blocks: np.ndarray, words: np.ndarray, ids: np.ndarray, repeated: np.ndarray, pids: int) -> Callable:
    """Lines that have one of the given words in their prefix, with their full sets, packed by word; `open` marks the ones in question."""
    has_word, is_open = bit_tests(words), bit_tests(ids)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = packed.Sender(SENT_AT_ONCE)
        for column, doc, tag in Rows(batches, repeated):
            lines = Lines(column, rarity)
            at = np.flatnonzero(lines.size)
            length = _prefix_length(lines.size[at])
            word = (lines.heads(at, length) >> U64(32)).astype(np.int64)
            row = np.repeat(at, length)
            step = size_class(lines.size[row])
            hit = has_word(word_and_class(word, step)) | has_word(word_and_class(word, step + 1)) | has_word(word_and_class(word, np.maximum(step, 1) - 1))
            word, row = word[hit], row[hit]
            if not len(row):
                continue
            own = lines.doc[row]
            name = line_hash(doc[own], tag[own], lines.number[row])
            opened = is_open(name)
            parts = blocks.take(word >> (32 - COUNT_BITS)).astype(np.int64)
            part = (name & U64(0x7FFFFFFF)).astype(np.int64) % parts
            copies = np.where(opened, parts, 1)  # an open line meets every part of the word
            back = np.repeat(np.arange(len(row)), copies)
            part = np.where(opened[back], np.arange(len(back)) - np.repeat(np.cumsum(copies) - copies, copies), part[back])
            word, row, own, opened = word[back], row[back], own[back], opened[back]
            columns = [word.astype(np.uint32), part.astype(np.uint16), doc[own], tag[own], lines.number[row].astype(np.int32), opened.astype(np.uint8)]
            yield from sender.take((K.mix64(word.astype(U64) << U64(16) | part.astype(U64)) % U64(pids)).astype(np.int64), columns, (lines.size[row], lines.heads(row, lines.size[row])))
        yield from sender.rest()

    return run


@given_back
def _counted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open lines that an earlier line of the same word matches, by their full sets."""
    if blobs := packed.gathered(batches):
        word, part, doc, tag, line, opened, size, values = packed.unpack(blobs.pop(0), FULL_TYPES, "u8")
        key = word.astype(np.int64) << 16 | part
        begin = np.cumsum(size, dtype=np.int64) - size
        size = size.astype(np.int64)
        matched = []
        order = np.lexsort((line, tag, doc, key))
        cuts = np.append(np.flatnonzero(np.diff(key[order], prepend=-1)), len(order))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            group = order[lo:hi]
            for k in np.flatnonzero(opened[group]):
                x = group[k]
                near = group[:k]
                near = near[(doc[near] != doc[x]) | (tag[near] != tag[x]) | (line[near] != line[x])]
                near = near[4 * np.minimum(size[near], size[x]) >= 3 * np.maximum(size[near], size[x])]
                own = np.sort(values[begin[x] : begin[x] + size[x]])
                for a in range(0, len(near), 1024):
                    some = near[a : a + 1024]
                    until = np.append(0, np.cumsum(size[some]))
                    theirs = values[np.repeat(begin[some] - until[:-1], size[some]) + np.arange(until[-1])]
                    same = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                    common = np.add.reduceat(same, until[:-1], dtype=np.int64)
                    if (4 * common >= 3 * (size[some] + size[x] - common)).any():
                        matched.append(x)
                        break
        yield pa.RecordBatch.from_arrays([pa.array(doc[matched]), pa.array(tag[matched]), pa.array(line[matched])], names=ID)


def keyed(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """docs with `_doc` (doc_id, the least long for null) and its hash `_key`; a bit table of the ids that occur more than once."""
    docs = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST))).withColumn("_key", F.xxhash64("_doc"))
    return docs, bit_table(docs.groupBy("_key").count().where("count > 1").select(F.col("_key").alias("h")))


def removed_lines(docs: DataFrame, repeated: np.ndarray) -> DataFrame:
    """docs(_doc, _key, text) -> doc, tag, line: the lines that an earlier one matches, from 0 in each text."""
    text = F.col("text").cast("string")
    rows = docs.select("_doc", "_key", F.xxhash64(text).alias("_text"), text.alias("text"))
    rarity, blocks = word_counts(rows)
    pids = packed.groups(rows)
    sets = packed.dealt(rows.mapInArrow(_sets(rarity, repeated, pids), packed.KIND))
    met = packed.dealt(sets.mapInArrow(_prefixes(rarity, blocks, pids), packed.KIND)).mapInArrow(_met, FOUND)
    found = written(met)
    gone = found.where("distance < 0").select(*ID)
    near = found.where("distance >= 0")
    ends = bit_table(near.select("h").union(near.select("early_h")))
    full = written(rows.mapInArrow(_full(ends, repeated), "doc long, tag long, line int, words binary"))
    full = full.where("tag = 0").union(full.where("tag <> 0").dropDuplicates(ID))  # only a row with a tag may be given twice
    best = near.groupBy(*ID).agg(F.min(F.struct("distance", F.struct(*EARLY).alias("e"))).alias("b"))
    best = written(best.select(*ID, "b.e.*"))
    similar = _verified(best, full)
    others = near.join(similar, ID, "left_anti").select(*best.columns).distinct()
    others = written(others.join(best, [*ID, *EARLY], "left_anti"))
    if not others.isEmpty():
        similar = similar.union(_verified(others, full))
    left = written(near.where("word is not null").select(*ID, "h", "word").join(similar, ID, "left_anti").distinct())
    if not left.isEmpty():
        words, ids = (bit_table(left.select(F.col(c).alias("h")), 4096) for c in ("word", "h"))
        members = rows.mapInArrow(_members(rarity, blocks, words, ids, repeated, pids), packed.KIND)
        similar = similar.union(packed.dealt(members).mapInArrow(_counted_out, "doc long, tag long, line int"))
    return gone.union(similar).distinct()


def deduplicated(docs: DataFrame) -> DataFrame:
    """All rows and columns of docs with `text` cut, `n_lines` as it was and `removed`: the numbers of the lines that went.

    Columns of these two names that docs brings along are replaced, and so are those of the names `_doc`, `_key`, `_again`, `_tag`, `_listed`, `_flag` and `_cut`.
    """
    rows, repeated = keyed(docs.drop("removed", "n_lines", "_doc", "_key", "_again", "_tag", "_listed", "_flag", "_cut"))
    gone = removed_lines(rows, repeated)
    per_row = written(gone.groupBy("doc", "tag").agg(F.sort_array(F.collect_set("line")).alias("removed")))

    @F.arrow_udf("struct<n_lines:int,text:string>")
    def cut(texts: pa.Array, removed: pa.Array) -> pa.Array:
        counts, out = [], []
        for text, gone in zip(texts.to_pylist(), removed.to_pylist(), strict=True):
            every, gone = text.split("\n") if text is not None else [], set(gone or ())
            counts.append(len(every))
            out.append("\n".join(x for k, x in enumerate(every) if k not in gone) if gone else text)
        return pa.StructArray.from_arrays([pa.array(counts, pa.int32()), pa.array(out, pa.string())], names=["n_lines", "text"])

    loses, again = bit_tests(bit_table(per_row.select(F.xxhash64("doc").alias("h")))), bit_tests(repeated)

    @F.arrow_udf("int")
    def flags(named: pa.Array) -> pa.Array:
        h = named.to_numpy()
        return pa.array(loses(h).astype(np.int32) + 2 * again(h).astype(np.int32))

    flag = flags.asNondeterministic()(F.col("_key")).alias("_flag")  # so that it's evaluated once a row
    marked = rows.select("*", flag).withColumns({"_listed": F.col("_flag") % 2 == 1, "_again": F.col("_flag") >= 2}).drop("_flag")
    some = marked.where("_listed").withColumn("_tag", F.when(F.col("_again"), F.xxhash64(F.col("text").cast("string"))).otherwise(F.lit(0).cast("long")))
    # nothing bounds the lists' size, so the join is a merge join at every size
    some = some.join(per_row.withColumnsRenamed({"doc": "_doc", "tag": "_tag"}).hint("merge"), ["_doc", "_tag"], "left").withColumn("_cut", cut(F.col("text").cast("string"), F.col("removed")))
    some = some.withColumns({"n_lines": F.col("_cut.n_lines"), "text": F.col("_cut.text")}).drop("_cut", "_tag")
    breaks = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n")))
    rest = marked.where("NOT _listed").withColumns({"removed": F.lit(None).cast("array<int>"), "n_lines": F.coalesce(breaks + 1, F.lit(0))})
    return some.unionByName(rest).withColumn("removed", F.coalesce("removed", F.array().cast("array<int>"))).drop("_doc", "_key", "_again", "_listed")
