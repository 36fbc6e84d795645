from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from skyloom.llm import hamming
from tests.llm.helpers import ODD, docs_of, words


def fingerprint(text) -> int:
    w = words(text)
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(pairs, radius=4):
    """pairs (doc_id, print) -> the least id of each one's component."""
    parent = list(range(len(pairs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc, _) in enumerate(pairs):
        ids.setdefault(find(i), []).append(doc)
    return [min((d for d in ids[find(i)] if d is not None), default=None) for i in range(len(pairs))]


def texts(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = ["Ab", "c", "dÉ", "x\ty", "zz" * 30, "q", "r", "s"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 60))] for _ in range(20)]
    rows = []
    for i in range(150):
        t = list(rng.choice(base))
        if t and rng.random() < 0.5:
            t[rng.randrange(len(t))] = rng.choice(vocabulary)
        rows.append((i * 7 % 150, rng.choice([" ", "  ", "\n"]).join(t)))
    return rows


@pytest.mark.parametrize("rows", [texts(1), ODD, ODD + texts(2)])
def test_equal_brute_force(spark, rows):
    got = hamming.near_duplicates(docs_of(spark, rows, clash=True)).collect()
    pairs = [(i, fingerprint(t)) for i, t in rows]
    want = [(i, f"{p:016x}", c) for (i, p), c in zip(pairs, classes(pairs), strict=True)]
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table(spark):
    assert hamming.near_duplicates(docs_of(spark, [])).count() == 0


def test_any_four_positions_hold_a_list():
    assert len(hamming.LISTS) == 20
    assert all(any({*t} <= {*four} for t in hamming.LISTS) for four in combinations(range(8), 4))


def clouds(seed: int, centres: int, each: int, flips: int) -> list[int]:
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("most", "at_once"), [(4096, 1 << 17), (16, 50), (3, 7)])
def test_links_join_what_brute_force_joins(spark, monkeypatch, most, at_once):
    """Tight and loose clouds of fingerprints; with small limits every list is long, intersected and dealt in blocks."""
    monkeypatch.setattr(hamming, "MOST", most)
    monkeypatch.setattr(hamming, "AT_ONCE", at_once)
    bits = clouds(1, 6, 40, 3) + clouds(2, 3, 60, 9) + clouds(3, 80, 2, 5)
    bits = sorted({*bits})
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    for radius in (4, 2, 0):
        links = hamming.linked(spark.createDataFrame([(s,) for s in signed], "bits long"), radius).collect()
        at = {s: i for i, s in enumerate(signed)}
        assert all((bits[at[r.a]] ^ bits[at[r.b]]).bit_count() <= radius for r in links)
        parent = list(range(len(bits)))

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for r in links:
            parent[max(find(at[r.a]), find(at[r.b]))] = min(find(at[r.a]), find(at[r.b]))
        want = classes([(i, b) for i, b in enumerate(bits)], radius)
        assert [find(i) for i in range(len(bits))] == want


def test_a_group_passes_on_few_links():
    """All pairs of a tight cloud are near; the task gives about one link a fingerprint."""
    rng = random.Random(7)
    bits = np.array(sorted({(1 << a) | (1 << b) for a, b in (rng.sample(range(64), 2) for _ in range(900))}), np.uint64)
    a, _ = hamming.joined(np.zeros(len(bits), np.int64), bits, 4)
    assert len(bits) - 1 <= len(a) < 3 * len(bits)


def test_lists_in_portions(monkeypatch):
    """Lists that go on over portions are compared whole."""
    rng = random.Random(11)
    bits = np.array(clouds(5, 3, 30, 4), np.uint64)
    at = np.sort(np.array([rng.randrange(6) for _ in bits]))
    batch = pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.zeros(len(bits), np.int32)), pa.array(bits.view(np.int64))], names=["at", "ab", "bits"])
    ends = []
    for size in (1 << 17, 5):
        monkeypatch.setattr(hamming, "AT_ONCE", size)
        out = pa.Table.from_batches(hamming._compared(4)(iter([batch.slice(k, 7) for k in range(0, len(bits), 7)])))
        ends.append({*zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)})
    assert ends[0] == ends[1] and ends[0]


def test_radius_beyond_the_guarantee(spark):
    with pytest.raises(ValueError):
        hamming.linked(spark.createDataFrame([], "bits long"), 5)


def test_hashes_and_long_texts_in_portions(monkeypatch):
    rng = random.Random(3)
    blob = bytes(rng.randrange(256) for _ in range(4000))
    start = np.array([rng.randrange(3000) for _ in range(800)])
    end = np.minimum(start + np.array([rng.randrange(0, 120) if i % 9 else rng.randrange(900) for i in range(800)]), 4000)
    assert hamming.xxh64(np.frombuffer(blob, np.uint8), start, end).tolist() == [xxhash.xxh64_intdigest(blob[a:b], 42) for a, b in zip(start, end, strict=True)]
    rows = [t for _, t in texts(4) + ODD]
    monkeypatch.setattr(hamming, "AT_ONCE", 100)
    assert hamming.prints(pa.array(rows)).tolist() == [fingerprint(t) for t in rows]


def test_native_hash_is_the_same(spark):
    """Spark's own xxhash64 has the seed."""
    h = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)
