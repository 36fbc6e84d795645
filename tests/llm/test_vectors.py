from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from skyloom.llm import centroids, entries, vectorcodes, vectors

KIND = "vec_id long, embedding array<float>, label int"


def floors(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def good(v, dims=64):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def rows_of(seed: int, n: int = 150, spread: float = 0.2, copies: bool = True):
    rng = random.Random(seed)
    homes = [[rng.gauss(0, 0.3) for _ in range(64)] for _ in range(6)]
    rows = [(i * 7 % 1009, [x + rng.gauss(0, spread) for x in rng.choice(homes)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    if copies:
        rows += [(2000 + i, rows[3][1], 1) for i in range(40)] + rows[:5] + [(rows[6][0], rows[7][1], 2)]
        rows += [(3000, None, 1), (3001, [], 1), (3002, [0.5] * 63, 1), (3003, [0.5] * 65, None), (3004, [0.1] * 63 + [None], 2), (3005, [0.1] * 63 + [float("nan")], 2), (3006, [float("inf")] + [0.0] * 63, 2), (3007, [-0.0] * 64, None), (3008, [-1e-9] * 64, 9)]
    rng.shuffle(rows)
    return rows


def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, floors(v)) for i, v, _ in rows if good(v)]
    begun = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))[:k]
    at = [v for _, v in begun]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [min((square(v, c), j) for j, c in enumerate(at)) for _, v in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(at)):
            own = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if own:
                at[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = {j: sum(d for d, c in near if c == j) for j in range(len(at))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return [(i, c, d, inertia[c], sum(inertia.values()), sha[c]) for (i, _), (d, c) in zip(kept, near)]


def brute_codes(rows, entries_=64, rounds=2, parts=16):
    kept = [(i, floors(v), label) for i, v, label in rows if good(v)]
    w = 64 // parts
    first = sorted(kept, key=lambda r: (r[0], np.array(r[1], "<i4").tobytes()))[:entries_]
    books = [[r[1][p * w : p * w + w] for r in first] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    code = lambda: [[min((square(v[p * w : p * w + w], c), j) for j, c in enumerate(books[p])) for p in range(parts)] for _, v, _ in kept]
    for _ in range(rounds):
        near = code()
        for p in range(parts):
            for j in range(len(first)):
                own = [r[1][p * w : p * w + w] for r, n in zip(kept, near) if n[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    near = code()
    error = [sum(d for d, _ in n) for n in near]
    by = {}
    for (_, _, label), e in zip(kept, error):
        by[label] = by.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for _, j in n), e, by[label], sha) for (i, _, label), n, e in zip(kept, near, error)]


@pytest.mark.parametrize("rows", [rows_of(1), rows_of(2, 60, 0.01), rows_of(3, 12, copies=False)])
def test_equal_brute_force(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, KIND).repartition(5).withColumns({"cluster": F.lit("x"), "ints": F.lit(1), "error": F.lit(2.0)})
    assert sorted(map(tuple, centroids.clustered(df).collect())) == sorted(brute_clusters(rows))
    assert sorted(map(tuple, vectorcodes.compressed(df).collect())) == sorted(brute_codes(rows))


def test_empty_tables_null_ids_and_wide_vectors(spark):
    none = spark.createDataFrame([], KIND)
    assert centroids.clustered(none).count() == vectorcodes.compressed(none).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1), (2, [0.0] * 3, 1)], KIND)
    assert centroids.clustered(only_bad).count() == vectorcodes.compressed(only_bad).count() == 0
    wide = spark.createDataFrame([(1, [3e38] + [0.0] * 63, 1), (None, [0.5] * 64, 1), (3, [0.25] * 64, None)], KIND)
    got = {r.vec_id: r for r in centroids.clustered(wide).collect()}
    assert len(got) == 3 and got[1].cluster is None and got[1].distance is None and got[1].inertia is None
    assert got[3].distance == got[None].distance == 0 and got[3].cluster != got[None].cluster
    codes = {r.vec_id: r for r in vectorcodes.compressed(wide.drop("label")).collect()}
    assert codes[1].code is None and codes[1].error is None and codes[1].label_error == 0 and codes[3].code == "00" * 16 and codes[None].code == "01" * 16
    all_wide = wide.where("vec_id = 1")
    assert [r.cluster for r in centroids.clustered(all_wide).collect()] == [None] and [r.code for r in vectorcodes.compressed(all_wide).collect()] == [None]


def test_threshold_walk_stops_early_and_never_wrongly():
    rng = np.random.default_rng(4)
    for spread, reach in ((3, 40), (60, 400), (1 << 20, 1 << 27)):
        c = rng.integers(-reach, reach, (40, 64)).astype(np.int64)
        c[7] = c[3]  # as near, with a larger number
        x = np.concatenate([c[rng.integers(0, 40, 200)] + rng.integers(-spread, spread + 1, (200, 64)), rng.integers(-reach, reach, (50, 64))])
        who, least, computed = centroids.Lists(c).nearest(x)
        every = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        assert (who == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()
        assert computed <= every.size
    c = np.arange(40)[:, None] * np.full((1, 64), 1000)
    _, _, computed = centroids.Lists(c).nearest(c + 1)
    assert computed < 3 * 40  # of 1600: the lists agree, so a walk ends after a step or two


def test_limb_products_are_exact():
    rng = np.random.default_rng(5)
    for reach in (200, 1 << 23, (1 << 23) + 1, 1 << 27):
        x, c = rng.integers(-reach, reach + 1, (16, 300, 4)), rng.integers(-reach, reach + 1, (16, 64, 4))
        x[0, 0], c[0, 0] = reach, -reach
        want = (x[:, :, None, :] * c[:, None]).sum(axis=3)
        assert (vectorcodes.products(x, c) == want).all()
        back = sum(limb.astype(np.int64) << (vectorcodes.LIMB * i) for i, limb in enumerate(vectorcodes.limbs(x)))
        assert (back == x).all() and all(np.abs(limb).max() <= 1 << vectorcodes.LIMB - 1 for limb in vectorcodes.limbs(x))
    with pytest.raises(ValueError):
        vectorcodes.products(np.zeros((1, 1, 1 << 8), np.int64), np.zeros((1, 1, 1 << 8), np.int64))


def test_integers_of_sliced_columns():
    column = pa.array([[9.0] * 64, None, [0.5] * 64, [1.0], [-0.001] * 64], pa.list_(pa.float64())).slice(1)
    kept, fits, ints = vectors.integers(column)
    assert kept.tolist() == fits.tolist() == [False, True, False, True] and ints[:, 0].tolist() == [128, -1]


@pytest.mark.parametrize("name", ["op12_centroid_clusters", "op13_vector_codes"])
def test_equal_sql(spark, sf_dir, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf_dir}/embeddings.parquet')")
    theirs = c.sql(entries.ORACLE_SQL[name])
    mine = entries.QUERIES[name](spark, sf_dir)
    assert theirs.columns == mine.columns
    assert sorted(map(tuple, mine.collect())) == sorted(theirs.fetchall())
