"""Adaptive context-mixing range coder for token ids, over many blocks at once.

A block is coded alone: its model starts empty and its ids have their own CRC-32, so one damaged block spoils no other.
Blocks of equal length are lanes of the same arrays, and step t codes the t-th id of every lane.

Inside a block an id goes by the step at which it first occurred, its number. The model mixes three predictions of the next number:
order 2 and order 1 each keep the number that followed last in a hashed context; order 0 is the histogram of all numbers
so far, refreshed when the position doubles. What each prediction may claim of the 65536 parts of an interval is learnt per
block, and anew every CHUNK steps, for each class of agreement between the two contexts; what is left stands for an id that
order 0 doesn't know yet, which is then coded evenly: its step since the refresh, or its place among the ids of the segment.
A range coder of 52 bits, in whole numbers that double precision holds exactly, takes the intervals and gives words of 24 bits.
Encoder and decoder run the same arithmetic.
"""

from __future__ import annotations

import zlib

import numpy as np

PARTS, TOP, LOW = 65536, 2.0**52, 2.0**28
WORD, LEAST = 2.0**24, 48
BITS1, BITS2, CHUNK, CLASSES = 10, 11, 64, 4
#: A block has at most so many steps; order 0 always has as many parts as its histogram may have places.
STEP_BITS = 11
MOST_STEPS = PLACES = 1 << STEP_BITS
#: How many different ids a segment may have.
MOST_IDS = (1 << 24) - MOST_STEPS


class Contexts:
    """The numbers that followed last in each lane's hashed contexts of order 1 and 2."""

    def __init__(self, lanes: int) -> None:
        lane = np.arange(lanes)
        self.one, self.two = np.full(lanes << BITS1, -1, np.int16), np.full(lanes << BITS2, -1, np.int16)
        self.base1, self.base2 = lane << BITS1, lane << BITS2
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        last = self.last * 40503
        self.at1 = self.base1 + (last >> 4 & (1 << BITS1) - 1)
        self.at2 = self.base2 + (self.before * 30011 + last >> 4 & (1 << BITS2) - 1)
        return self.one.take(self.at1), self.two.take(self.at2)

    def learn(self, number: np.ndarray) -> None:
        self.one[self.at1] = number
        self.two[self.at2] = number
        self.before, self.last = self.last, number.astype(np.int64)


class Shares:
    """Of 65536 parts, where the parts of order 2, order 1, order 0 and of unknown ids begin in each lane and class.

    `bounds` holds five rows (0, three ends, 65536) of a number for each lane and class.
    """

    def __init__(self, lanes: int) -> None:
        self.seen = np.tile(np.array([[1, 1, 8, 24], [1, 8, 12, 16], [10, 6, 12, 12], [24, 1, 8, 8]], np.int64), (lanes, 1, 1))
        self.stride = lanes * CLASSES
        self.lane = np.arange(lanes) * CLASSES
        self.bounds = np.zeros(5 * self.stride)
        self.bounds[4 * self.stride :] = PARTS
        self.refresh()

    def refresh(self) -> None:
        total = np.cumsum(self.seen, axis=2)
        room = PARTS - 3 * LEAST - PLACES
        ends = total[:, :, :3] * room // total[:, :, 3:] + np.array([LEAST, 2 * LEAST, 2 * LEAST + PLACES])
        ends[:, 0, 0] = 0  # neither context is known
        ends[:, 1, 0] = 0
        ends[:, 0, 1] = 0
        ends[:, 3, 1] = ends[:, 3, 0]  # both say the same
        self.bounds[self.stride : 4 * self.stride] = ends.reshape(-1, 3).T.ravel()

    def learn(self, classes: np.ndarray, kinds: np.ndarray) -> None:
        """What CHUNK steps were coded by: 0 order 2, 1 order 1, 2 order 0, 3 unknown. Older steps count for half."""
        spot = (self.lane + classes) * 4 + kinds
        self.seen = (self.seen + 1 >> 1) + 2 * np.bincount(spot.ravel(), minlength=self.seen.size).reshape(self.seen.shape)
        self.refresh()


def class_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """0: neither context is known, 1: order 1 alone, 2: both and they differ, 3: both and they agree."""
    first = one >= 0
    known = (two >= 0) & first
    return first.view(np.int8) + known.view(np.int8) + (known & (one == two)).view(np.int8)


class Histogram:
    """Order 0 of each lane: numbers below `size` steps, by how often they occurred."""

    def __init__(self, numbers: np.ndarray) -> None:
        """numbers: a row per step, a column per lane; as many steps as a power of two."""
        self.size, lanes = numbers.shape
        self.shift = self.size.bit_length() - 1
        spot = numbers.astype(np.int64) + (np.arange(lanes) * self.size)
        count = np.bincount(spot.ravel(), minlength=lanes * self.size).reshape(lanes, self.size)
        cum = np.zeros((lanes, self.size + 1), np.int16)
        np.cumsum(count, axis=1, out=cum[:, 1:])
        self.cum, self.count = cum.ravel(), count
        self.row = np.arange(lanes) * (self.size + 1)

    def slots(self) -> np.ndarray:
        """The numbers of each lane in order, each as often as it occurred."""
        lanes = len(self.count)
        return np.repeat(np.tile(np.arange(self.size, dtype=np.int16), lanes), self.count.ravel())

    def part(self, at: np.ndarray, before: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """at: row + number. Where the number's part begins and how long it is, of `width` parts from `before` on."""
        scaled = width * (1 / self.size)  # size is a power of two, so this is exact
        low = np.floor(self.cum.take(at) * scaled)
        return before + low, np.floor(self.cum.take(at + 1) * scaled) - low


#: Lanes whose ids are numbered at once: their arrays stay in the caches.
LANES_AT_ONCE = 32


def numbered(blocks: np.ndarray) -> np.ndarray:
    """The step at which the id of each place first occurred in its lane."""
    steps, lanes = blocks.shape
    out = np.empty((steps, lanes), np.int16)
    kind = np.int32 if blocks.size and int(blocks.max()) < 1 << 31 - STEP_BITS else np.int64
    t = np.arange(steps, dtype=kind)
    for a in range(0, lanes, LANES_AT_ONCE):
        some = blocks[:, a : a + LANES_AT_ONCE].T.astype(kind)
        order = some << STEP_BITS
        order += t
        order.sort(axis=1)
        group = order >> STEP_BITS
        new = np.ones(order.shape, bool)
        np.not_equal(group[:, 1:], group[:, :-1], out=new[:, 1:])
        step = order & (1 << STEP_BITS) - 1
        begin = np.flatnonzero(new)
        first = np.repeat(step.ravel()[begin].astype(np.int16), np.diff(np.append(begin, new.size)))
        own = np.empty(order.shape, np.int16)
        np.put_along_axis(own, step, first.reshape(order.shape), axis=1)
        out[:, a : a + LANES_AT_ONCE] = own.T
    return out


class Writer:
    """Narrows the interval of every lane and collects the words that are settled; carries are added at the end."""

    def __init__(self, lanes: int, room: int) -> None:
        self.low, self.span = np.zeros(lanes), np.full(lanes, TOP)
        self.out = np.zeros((lanes, room), np.uint32)
        self.flat, self.at = self.out.reshape(-1), np.arange(lanes) * room
        self.start = self.at.copy()

    def narrow(self, cum: np.ndarray, freq: np.ndarray) -> None:
        """All lanes, by parts of 65536."""
        unit = np.floor(self.span * (1 / PARTS))
        self.low += unit * cum
        np.multiply(unit, freq, out=self.span)
        self._settle(self.low, self.span, self.at)

    def narrow_some(self, lanes: np.ndarray, symbol: np.ndarray, total: int) -> None:
        """Some lanes, evenly by `total`."""
        low, span, at = self.low.take(lanes), self.span.take(lanes), self.at.take(lanes)
        np.floor(span * (1 / total), out=span)
        low += span * symbol
        self._settle(low, span, at)
        self.low[lanes], self.span[lanes], self.at[lanes] = low, span, at

    def _settle(self, low: np.ndarray, span: np.ndarray, at: np.ndarray) -> None:
        word = np.floor(low * (1 / LOW))
        self.flat[at] = word
        small = span < LOW
        scale = small * (WORD - 1)
        scale += 1
        word *= small
        word *= LOW
        low -= word
        low *= scale
        span *= scale
        at += small

    def codes(self) -> list[bytes]:
        for _ in range(3):
            word = np.floor(self.low * (1 / LOW))
            self.flat[self.at] = word
            self.low = (self.low - word * LOW) * WORD
            self.at += 1
        size = self.at - self.start
        words = np.where(np.arange(int(size.max())) < size[:, None], self.out[:, : int(size.max())], 0)
        while (carry := words >> 24).any():
            words &= 0xFFFFFF
            words[:, :-1] += carry[:, 1:]
        packed = words.astype("<u4").view(np.uint8).reshape(*words.shape, 4)[:, :, :3]
        return [packed[k, : size[k]].tobytes() for k in range(len(size))]


def encode(blocks: np.ndarray, ids: int) -> list[bytes]:
    """blocks: a row per step, a column per block, all below `ids`. Returns each block's code."""
    steps, lanes = blocks.shape
    if steps > MOST_STEPS or ids > MOST_IDS:
        raise ValueError("the block is too long or has too many different ids")
    number = numbered(blocks)
    contexts, shares, writer = Contexts(lanes), Shares(lanes), Writer(lanes, steps * 2 + 8)
    histogram, known = None, 0
    one, two = np.empty((CHUNK, lanes), np.int16), np.empty((CHUNK, lanes), np.int16)
    for start in range(0, steps, CHUNK):
        if start and start & start - 1 == 0:
            known, histogram = start, Histogram(number[:start])
        size = min(CHUNK, steps - start)
        for k in range(size):
            one[k], two[k] = contexts.predict()
            contexts.learn(number[start + k])
        x, p1, p2 = number[start : start + size], one[:size], two[:size]
        classes = class_of(p1, p2)
        hit2 = (p2 == x) & (classes >= 2)
        hit1 = (p1 == x) & (classes >= 1) & ~hit2
        told = hit2 | hit1
        kinds = 3 - (x < known).view(np.int8)
        kinds[told] = hit1[told].view(np.int8)
        spot = kinds * np.int64(shares.stride) + (shares.lane + classes)
        cum = shares.bounds.take(spot)
        freq = shares.bounds.take(spot + shares.stride) - cum
        if histogram is not None:
            at = np.flatnonzero(kinds == 2)
            cum.ravel()[at], freq.ravel()[at] = histogram.part(histogram.row[at % lanes] + x.ravel()[at], cum.ravel()[at], freq.ravel()[at])
        rest = np.flatnonzero(kinds == 3)
        step, rest = rest // lanes, rest % lanes
        until = np.searchsorted(step, np.arange(size + 1))
        recent, own = step + start - known, x[step, rest]
        symbol = np.where(own == step + start, recent + blocks[step + start, rest].astype(np.float64), own - known)
        for k in range(size):
            writer.narrow(cum[k], freq[k])
            if until[k] < until[k + 1]:
                part = slice(until[k], until[k + 1])
                writer.narrow_some(rest[part], symbol[part], start + k - known + ids)
        shares.learn(classes, kinds)
    return writer.codes()


class Reader:
    """Follows the writer's intervals."""

    def __init__(self, codes: list[bytes]) -> None:
        lanes, room = len(codes), max(map(len, codes)) // 3 + 4
        words = np.zeros((lanes, room))
        for k, code in enumerate(codes):
            wide = np.zeros((len(code) // 3, 4), np.uint8)
            wide[:, :3] = np.frombuffer(code, np.uint8).reshape(-1, 3)
            words[k, : len(wide)] = wide.view("<u4").ravel()
        # 52 bits: two words and the upper four bits of the third, whose rest follows with the next word's upper bits
        self.code, self.span = words[:, 0] * LOW + words[:, 1] * 16 + np.floor(words[:, 2] * 2.0**-20), np.full(lanes, TOP)
        rest = words - np.floor(words * 2.0**-20) * 2.0**20
        words[:, :-1] = rest[:, :-1] * 16 + np.floor(words[:, 1:] * 2.0**-20)
        self.flat, self.at = words.reshape(-1), np.arange(lanes) * room + 2

    def part(self) -> tuple[np.ndarray, np.ndarray]:
        """The unit of 65536 and the part that the code lies in."""
        unit = np.floor(self.span * (1 / PARTS))
        return unit, np.minimum(np.floor(self.code / unit), PARTS - 1)

    def narrow(self, cum: np.ndarray, freq: np.ndarray, unit: np.ndarray) -> None:
        self.code -= unit * cum
        np.multiply(unit, freq, out=self.span)
        self._settle(self.code, self.span, self.at)

    def even(self, lanes: np.ndarray, total: int) -> np.ndarray:
        code, span, at = self.code.take(lanes), self.span.take(lanes), self.at.take(lanes)
        np.floor(span * (1 / total), out=span)
        symbol = np.minimum(np.floor(code / span), total - 1)
        code -= span * symbol
        self._settle(code, span, at)
        self.code[lanes], self.span[lanes], self.at[lanes] = code, span, at
        return symbol

    def _settle(self, code: np.ndarray, span: np.ndarray, at: np.ndarray) -> None:
        small = span < LOW
        scale = small * (WORD - 1)
        scale += 1
        code *= scale
        code += self.flat.take(at, mode="clip") * small
        span *= scale
        at += small


def decode(codes: list[bytes], steps: int, ids: int) -> np.ndarray:
    lanes = len(codes)
    reader, contexts, shares, lane = Reader(codes), Contexts(lanes), Shares(lanes), np.arange(lanes)
    number, fresh = np.zeros((steps, lanes), np.int16), np.zeros((steps, lanes), np.uint32)
    histogram, slots, known, stride = None, None, 0, shares.stride
    classes, kinds = np.zeros((CHUNK, lanes), np.int8), np.zeros((CHUNK, lanes), np.int8)
    for t in range(steps):
        if t >= CHUNK and t & t - 1 == 0:
            known, histogram = t, Histogram(number[:t])
            slots = histogram.slots()
        one, two = contexts.predict()
        c, kind = classes[t % CHUNK], kinds[t % CHUNK]
        c[:] = class_of(one, two)
        spot = shares.lane + c
        unit, v = reader.part()
        kind[:] = (v >= shares.bounds.take(spot + stride)).view(np.int8)
        kind += (v >= shares.bounds.take(spot + 2 * stride)).view(np.int8)
        kind += (v >= shares.bounds.take(spot + 3 * stride)).view(np.int8)
        spot += kind * np.int64(stride)
        cum = shares.bounds.take(spot)
        freq = shares.bounds.take(spot + stride) - cum
        x = np.where(kind == 0, two, one)
        seen = np.flatnonzero(kind == 2)
        if len(seen) and histogram is not None:
            low, width = cum.take(seen), freq.take(seen)
            place = np.floor(((v.take(seen) - low + 1) * histogram.size - 1) / width).astype(np.int64)
            own = slots.take(seen * histogram.size + place)
            x[seen] = own
            cum[seen], freq[seen] = histogram.part(histogram.row.take(seen) + own, low, width)
        reader.narrow(cum, freq, unit)
        rest = np.flatnonzero(kind == 3)
        if len(rest):
            recent = t - known
            symbol = reader.even(rest, recent + ids)
            new = symbol >= recent
            x[rest] = np.where(new, t, symbol + known)
            fresh[t, rest[new]] = symbol[new] - recent
        number[t] = x
        contexts.learn(x)
        if t % CHUNK == CHUNK - 1:
            shares.learn(classes, kinds)
    return fresh[number.astype(np.int64), lane]


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
