"""Vector codes: product quantisation on exact integers, distances by limb-split matrix products.

A vector is cut into equal consecutive parts; each part position has a codebook, and a vector's code is the index of the nearest entry for
each part. Squared distances are |x|^2 - 2 x.c + |c|^2. The dot products of all parts with all entries are matrix products in
float64: integers are broken into limbs of LIMB bits (rounded, so from -2**(LIMB-1) on), whose products summed over a part stay below
2**53 and so are exact in whatever order the library adds them; they're recombined in int64. The first of the least distances is
taken. A limb that is zero throughout costs no product.

Rounds read one written table; a task adds up its parts by entry, so a round shuffles and gives the driver parts * entries sums a task. The
codebooks (parts * entries * width integers) go to the tasks.

Null and non-finite vectors are left out, and so are those of another length than `dims`, which have no such parts. Wide ones (see vectors.py)
keep their row with null code and error. Vectors with equal ids are rows of their own, ordered by their components where they compete for the start; null ids
come last there. Fewer vectors than entries give smaller codebooks; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import vectors as V
from skyloom.llm.common import given_back, written

PARTS, ENTRIES, ROUNDS = 16, 64, 2
LIMB = 24


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x = sum of limb[i] << (LIMB * i), each limb from -2**(LIMB-1) to 2**(LIMB-1) - 1, as float64."""
    out = []
    rest, half = x.astype(np.int64), 1 << LIMB - 1
    while True:
        above = (rest + half) >> LIMB
        out.append((rest - (above << LIMB)).astype(np.float64))
        if not above.any():
            return out
        rest = above


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact dot products of rows of x (parts, n, width) with rows of c (parts, entries, width), as int64."""
    if x.shape[2] << (2 * LIMB - 2) >= 1 << 53:
        raise ValueError("parts too wide for exact products of these limbs")
    out = np.zeros((x.shape[0], x.shape[1], c.shape[1]), np.int64)
    for i, a in enumerate(limbs(x)):
        if a.any():
            for j, b in enumerate(limbs(c)):
                out += np.matmul(a, b.transpose(0, 2, 1)).astype(np.int64) << (LIMB * (i + j))
    return out


def nearest(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and squared distance: x (n, dims), books (parts, entries, width) -> two of (n, parts)."""
    parts, _, width = books.shape
    cut = np.ascontiguousarray(x.reshape(len(x), parts, width).transpose(1, 0, 2))
    short = (books**2).sum(axis=2)[:, None, :] - 2 * products(cut, books)  # without |x|^2, which is the same for all entries
    index = short.argmin(axis=2)
    least = np.take_along_axis(short, index[:, :, None], axis=2)[:, :, 0] + (cut**2).sum(axis=2)
    return index.T, least.T


def _sums(books: np.ndarray) -> Callable:
    parts, entries, width = books.shape

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        for _, _, x in V.portions(batches, parts * width):
            flat = (nearest(x, books)[0] + np.arange(parts) * entries).ravel()
            count += np.bincount(flat, minlength=len(count))
            np.add.at(sums, flat, x.reshape(-1, width))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], names=["entry", "n", "sums"])

    return run


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: floors of their parts' means; unused entries stay."""
    parts = rows.select("vec_id", "ints").mapInArrow(_sums(books), "entry int, n long, sums array<long>")
    added = parts.select("entry", "n", F.posexplode("sums").alias("at", "s")).groupBy("entry", "at").agg(V.total("n").alias("n"), V.total("s").alias("s"))
    out = books.copy()
    flat = out.reshape(-1, books.shape[2])
    for r in added.collect():  # parts * entries * width rows at most
        flat[r["entry"], r["at"]] = int(r["s"]) // int(r["n"])
    return out


def fitted(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, dims: int = V.DIMS) -> np.ndarray:
    """The codebooks (parts, entries, width) of kept vectors: they start as the vectors with the smallest ids."""
    first = V.narrow(rows).select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    first.sort(key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0, bytes(r["ints"])))
    books = V.unpacked(pa.array([r["ints"] for r in first], pa.binary()), dims).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        books = moved(V.narrow(rows), books)
    return books


def _coded(books: np.ndarray) -> Callable:
    parts, _, width = books.shape

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, fits, x in V.portions(batches, parts * width):
            place, error = np.full(part.num_rows, -1), np.zeros(part.num_rows, np.int64)
            codes: list[bytes] = []
            if len(fits):
                index, least = nearest(x, books)
                place[fits], error[fits] = np.arange(len(fits)), least.sum(axis=1)
                codes = [r.tobytes() for r in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(codes, pa.binary()).take(pa.array(place, mask=place < 0)), pa.array(error, mask=place < 0), part.column(2)], names=["vec_id", "code", "error", "label"])

    return run


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, code (one byte a part), error, label of every kept vector."""
    return rows.select("vec_id", "ints", "label").mapInArrow(_coded(books), "vec_id long, code binary, error long, label long")


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, dims: int = V.DIMS) -> DataFrame:
    """vec_id, code (hex), error, label_error, codebooks_sha256 of every kept vector. Nulls are one label."""
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("a vector is cut into equal parts, and an index is one byte")
    rows = V.kept(embeddings, dims)
    books = fitted(rows, parts, entries, rounds, dims)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    every = written(coded(rows, books))
    by = every.groupBy("label").agg(V.as_long(V.total("error")).alias("label_error")).withColumnRenamed("label", "of")
    out = every.join(by, every.label.eqNullSafe(by.of))
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
