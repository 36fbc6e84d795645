"""Vectors as exact integers: what operators on embeddings read, in rounds, from one written table.

A component x becomes floor(256 * x) with x as a double. A vector is kept if it has `dims` components and none of them is null
or not finite. Integers beyond LIMIT have no exact 64-bit squared distances; a kept vector with one (a component of
2**19 or more) is `wide`: its row stays, with a null `ints`, and takes no part in the model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import given_back, written

DIMS, SCALE, LIMIT = 64, 256, 1 << 27
ROWS_AT_ONCE = 2048


def integers(column: pa.Array, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are kept, which of these are not wide, and the integers of the latter."""
    lists = column.cast(pa.list_(pa.float64()))
    length = np.where(lists.is_valid(), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), -1)
    right = np.flatnonzero(length == dims)
    flat = lists.take(pa.array(right)).flatten()
    with np.errstate(all="ignore"):
        x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
        whole = np.isfinite(x).all(axis=1)
        x = np.floor(SCALE * x[whole])
        narrow = (np.abs(x) <= LIMIT).all(axis=1)
    kept = np.zeros(len(column), bool)
    kept[right[whole]] = True
    fits = np.zeros(len(column), bool)
    fits[right[whole][narrow]] = True
    return kept, fits, x[narrow].astype(np.int32)


def packed(ints: np.ndarray) -> pa.Array:
    """Rows of 32-bit integers as one binary each."""
    return pa.array([r.tobytes() for r in np.ascontiguousarray(ints, "<i4")], pa.binary())


def unpacked(column: pa.Array, dims: int = DIMS) -> np.ndarray:
    """The same rows as 64-bit integers; none may be null."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def _pack(dims: int) -> Callable:
    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, fits, ints = integers(batch.column(1), dims)
            at = np.full(batch.num_rows, -1)
            at[fits] = np.arange(len(ints))
            place = pa.array(at[kept], mask=at[kept] < 0)
            rows = pa.array(np.flatnonzero(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), packed(ints).take(place), batch.column(2).take(rows)], names=["vec_id", "ints", "label"])

    return run


def kept(embeddings: DataFrame, dims: int = DIMS) -> DataFrame:
    """vec_id, ints, label of every kept vector, written once. label is null where the table has none."""
    label = F.col("label").cast("long") if "label" in embeddings.columns else F.lit(None).cast("long")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), label.alias("label"))
    return written(rows.mapInArrow(_pack(dims), "vec_id long, ints binary, label long"))


def narrow(rows: DataFrame) -> DataFrame:
    return rows.where("ints is not null")


def portions(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in portions that fit in caches: the rows, which of them have integers, and these."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            fits = np.flatnonzero(part.column(1).is_valid().to_numpy(zero_copy_only=False))
            yield part, fits, unpacked(part.column(1).take(pa.array(fits)), dims)


def as_long(exact: Column) -> Column:
    """A decimal sum as a long; null beyond its range."""
    return exact.try_cast("long")


def total(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(20,0)"))
