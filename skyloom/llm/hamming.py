"""SimHash near-dedup: fingerprints of word shingles, links by a byte-position inverted index with count filtering.

1. A text's terms are its runs of four words (lower-cased A-Z, joined by one blank, repeats included; fewer words: all of them as
   one term). Each term's XXH64 (seed 42) votes on 64 bits; a bit is set where over half of the votes are for it.
2. A fingerprint is eight bytes in eight positions. Two that differ in r <= 4 bits share at least 8 - r >= 4 positional bytes.
   The index's lists are those of three positional bytes at once: LISTS names 20 triples of positions such that any four
   positions hold one of them whole, so a pair that is to be found is in one list at least, of 2**24 for each triple
   instead of 2**8 for each byte. A list of more than MOST fingerprints is intersected with the lists of each of the other
   five positions (the pair shares a fourth byte), and one that is still longer is dealt in blocks that meet pairwise.
3. Fingerprints of a list meet in one task: shared positional bytes are tallied for each pair, pairs that reach the guaranteed number
   are verified by their differing bits. A task passes on a link only where it joins two groups of its list, so a large
   group of near copies gives no pairs. Links become components.

Only different fingerprints are indexed, so copies cost one row. Null and empty texts and texts of white space have no terms and the
fingerprint zero, which is linked like any other. A tie of votes is no majority. Repeated rows and rows that share a doc_id are rows of
their own; a null doc_id is nobody's smallest. Very long texts are taken whole, an empty table gives an empty one, further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import textkit as K
from skyloom.llm.common import given_back, input_partitions, written
from skyloom.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BYTES = 8
#: Fingerprints of a list that one task compares without dealing it further.
MOST = 4096
#: Rows whose lists are compared at once.
AT_ONCE = 1 << 17
U64 = np.uint64
# The primes of XXH64.
P1, P2, P3, P4, P5 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
LONGEST = 512


def _triples() -> list[tuple[int, ...]]:
    """Triples within a third of the positions, or two of a third with one of the next: four positions always hold one."""
    third = [p % 3 for p in range(BYTES)]
    rank = lambda t: tuple(sorted(third[p] for p in t))
    good = {*((g, g, g) for g in range(3)), *(tuple(sorted((g, g, (g + 1) % 3))) for g in range(3))}
    return [t for t in combinations(range(BYTES), 3) if rank(t) in good]


LISTS = _triples()


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


def _lane(x: np.ndarray) -> np.ndarray:
    return _turned(x * U64(P2), 31) * U64(P1)


def xxh64(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each byte span, all spans at once; the few of more than LONGEST bytes one by one."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    out = np.full(len(size), (seed + P5) % (1 << 64), U64)
    at = starts.copy()
    wide = np.flatnonzero((size >= 32) & (size <= LONGEST))
    if len(wide):
        state = [np.full(len(wide), s % (1 << 64), U64) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        live = np.arange(len(wide))
        while len(live):
            for k in range(4):
                state[k][live] = _turned(state[k][live] + eight.take(at[wide[live]] + 8 * k) * U64(P2), 31) * U64(P1)
            at[wide[live]] += 32
            live = live[ends[wide[live]] - at[wide[live]] >= 32]
        mixed = sum(_turned(s, r) for s, r in zip(state, (1, 7, 12, 18), strict=True))
        for s in state:
            mixed = (mixed ^ _lane(s)) * U64(P1) + U64(P4)
        out[wide] = mixed
    out += size.astype(U64)
    rest = np.flatnonzero((ends - at >= 8) & (size <= LONGEST))
    while len(rest):
        out[rest] = _turned(out[rest] ^ _lane(eight.take(at[rest])), 27) * U64(P1) + U64(P4)
        at[rest] += 8
        rest = rest[ends[rest] - at[rest] >= 8]
    rest = np.flatnonzero((ends - at >= 4) & (size <= LONGEST))
    out[rest] = _turned(out[rest] ^ ((eight.take(at[rest]) & U64(0xFFFFFFFF)) * U64(P1)), 23) * U64(P2) + U64(P3)
    at[rest] += 4
    rest = np.flatnonzero((at < ends) & (size <= LONGEST))
    while len(rest):
        out[rest] = _turned(out[rest] ^ (padded[at[rest]].astype(U64) * U64(P5)), 11) * U64(P1)
        at[rest] += 1
        rest = rest[at[rest] < ends[rest]]
    for shift, prime in ((33, P2), (29, P3)):
        out = (out ^ (out >> U64(shift))) * U64(prime)
    out ^= out >> U64(32)
    for k in np.flatnonzero(size > LONGEST).tolist():
        out[k] = xxhash.xxh64_intdigest(raw[starts[k] : ends[k]].tobytes(), seed)
    return out


def prints(column: pa.Array) -> np.ndarray:
    """The fingerprint of every text of an Arrow column."""
    out = np.zeros(len(column), U64)
    for start, stop in K.slices(column):
        raw, offsets = K.utf8(column.slice(start, stop - start))
        begin, end, rows = K.word_spans(raw, offsets)
        if not len(begin):
            continue
        low, solid = K.lowered(raw), K.mapped(raw, K._SOLID).view(bool)
        keep = solid.copy()
        keep[1:] |= solid[:-1]  # one blank behind each word
        place = np.cumsum(keep, dtype=np.int64) - 1
        text = np.where(solid[keep], low[keep], np.uint8(32))
        begin, end = place[begin], place[end - 1] + 1
        counts = np.diff(rows)
        made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
        edge = np.append(0, np.cumsum(made))
        own = np.flatnonzero(made)
        first = np.repeat(rows[:-1] - edge[:-1], made) + np.arange(edge[-1])
        last = first + np.repeat(np.minimum(counts, SHINGLE), made) - 1
        votes = np.zeros((len(own), 64), np.int64)
        for at in range(0, edge[-1], AT_ONCE):  # a very long text in portions
            h = xxh64(text, begin[first[at : at + AT_ONCE]], end[last[at : at + AT_ONCE]])
            bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            a, b = np.searchsorted(edge[own], at, side="right") - 1, np.searchsorted(edge[own], at + len(h))
            votes[a:b] += np.add.reduceat(bits, np.maximum(edge[own[a:b]] - at, 0), axis=0, dtype=np.int64)
        out[start + own] = np.packbits(2 * votes > made[own][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


@given_back
def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints(batch.column(1)).view(np.int64))], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, bits of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprint, "doc_id long, bits long")


def shared_bytes(differing: np.ndarray) -> np.ndarray:
    """How many positional bytes two fingerprints share, from their exclusive or."""
    sevens = U64(0x7F7F7F7F7F7F7F7F)
    return BYTES - np.bitwise_count((((differing & sevens) + sevens) | differing) & ~sevens).astype(np.int64)


def joined(group: np.ndarray, bits: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of one list (equal `group`, side by side), as few as join what belongs together and some more."""
    n = len(bits)
    last = np.append(np.flatnonzero(group[1:] != group[:-1]), n - 1)
    until = last[np.searchsorted(last, np.arange(n))]
    root = np.arange(n)
    found_a, found_b = [np.zeros(0, U64)], [np.zeros(0, U64)]
    live, step = np.flatnonzero(until > np.arange(n)), 1
    while len(live):
        x = bits[live] ^ bits[live + step]
        enough = np.flatnonzero(shared_bytes(x) >= BYTES - radius)
        near = live[enough[np.bitwise_count(x[enough]) <= radius]]
        a, b = near, near + step
        fresh = root[a] != root[b]
        a, b = a[fresh], b[fresh]
        found_a.append(bits[a])
        found_b.append(bits[b])
        while len(a):
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            np.minimum.at(root, high, low)
            while (root[root] != root).any():
                root = root[root]
            open_ = root[a] != root[b]
            a, b = a[open_], b[open_]
        step += 1
        live = live[live + step <= until[live]]
    return np.concatenate(found_a), np.concatenate(found_b)


def _compared(radius: int) -> Callable:
    """Rows: at, ab, bits, sorted by at and ab. Gives links a, b."""

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(at: np.ndarray, ab: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            group = np.cumsum(np.append(0, (at[1:] != at[:-1]) | (ab[1:] != ab[:-1])))
            a, b = joined(group, bits.view(U64), radius)
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a.view(np.int64), b.view(np.int64))), pa.array(np.maximum(a.view(np.int64), b.view(np.int64)))], names=["a", "b"])

        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(k).to_numpy().astype(np.int64)]) for k, h in enumerate(held)]
            if len(held[0]) >= AT_ONCE:
                same = (held[0] == held[0][-1]) & (held[1] == held[1][-1])  # the last list may go on
                cut = int(np.argmax(same))
                if cut:
                    yield links(*(h[:cut] for h in held))
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield links(*held)

    return run


def _byte(bits: Column, p: int) -> Column:
    return F.shiftrightunsigned(bits, 8 * p).bitwiseAND(F.lit(0xFF))


def linked(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """distinct(bits), each once -> a, b: links that join all fingerprints within the radius, directly or over others."""
    if not 0 <= radius <= 4:
        raise ValueError("the lists' triples guarantee four shared positional bytes, so a radius of four bits at most")
    bits = F.col("bits")
    place = lambda p, t: F.shiftleft(_byte(bits, p), 8 * t)
    keys = [place(a, 0).bitwiseOR(place(b, 1)).bitwiseOR(place(c, 2)).bitwiseOR(F.lit(t << 24)) for t, (a, b, c) in enumerate(LISTS)]
    rows = distinct.select("bits", F.explode(F.array(*keys)).alias("at"))
    counts = written(rows.groupBy("at").agg(F.count("*").alias("n")).where("n > 1"))
    short = rows.join(counts.where(F.col("n") <= MOST), "at").select("at", F.lit(0).alias("ab"), "bits")
    member = F.shiftrightunsigned("at", 24)
    others = F.array(*[F.array(*[F.lit(p) for p in range(BYTES) if p not in t]) for t in LISTS])
    fourth = F.expr("shiftrightunsigned(bits, 8 * p) & 255")
    finer = F.shiftleft("at", 11).bitwiseOR(F.shiftleft(F.col("p").cast("long"), 8)).bitwiseOR(fourth).bitwiseOR(F.lit(1 << 60))
    long = rows.join(counts.where(F.col("n") > MOST).select("at"), "at").select("at", "bits", F.explode(others[member.cast("int")]).alias("p")).select("bits", finer.alias("at"))
    sizes = written(long.groupBy("at").agg(F.count("*").alias("n")).where("n > 1").select("at", F.ceil(F.col("n") / MOST).cast("int").alias("parts")))
    pair = F.expr("CASE WHEN parts = 1 THEN array(0) ELSE transform(filter(sequence(0, parts - 1), q -> q <> part), q -> least(q, part) * 1048576 + greatest(q, part)) END")
    dealt = long.join(sizes, "at").withColumn("part", F.expr("cast(pmod(xxhash64(bits), parts) AS int)")).select("at", F.explode(pair).alias("ab"), "bits")
    met = short.unionByName(dealt).repartition(input_partitions(distinct.sparkSession), "at", "ab").sortWithinPartitions("at", "ab")
    return met.mapInArrow(_compared(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row: the smallest doc_id that links reach, its own included."""
    every = written(fingerprints(docs))
    distinct = written(every.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    comps = components(written(linked(distinct.select("bits"), radius)))
    named = distinct.join(comps, distinct.bits == comps.node, "left").withColumn("comp", F.coalesce("comp", "bits"))
    named = written(named.select("bits", "comp", "first_id"))
    least = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    ids = named.join(least, "comp").select("bits", "component_id")
    return every.join(ids, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
