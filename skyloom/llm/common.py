"""Session helpers: table access, lineage cuts in the shared folder, Arrow plumbing."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Arrow batches of the session are kept at 4 MiB: both sides of a Python worker hold several copies of one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; a temporary folder only where that is unset and all runs on one machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/skyloom-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cuts the lineage: writes `df` as Parquet to the shared folder and reads it back.

    The files outlive lost executors, and what follows never repeats the work before.
    """
    path = shared_dir(df.sparkSession)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, each: int = 50_000) -> DataFrame:
    """As few partitions as so many rows need, for tables much smaller than what the session's shuffles are sized for."""
    return df.coalesce(max(1, min(input_partitions(df.sparkSession), rows // each + 1)))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def input_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle has: the session's own setting, sized by whoever runs the job."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


MOST_BITS = 26  # 8 MiB


def bit_table(hashes: DataFrame, room: int = 32) -> np.ndarray:
    """hashes(h long): a table with a bit set for each, `room` bits an entry up to 2**MOST_BITS bits in all.

    It only spares work: what it lets through by chance has to go in a join that follows.
    """
    spot = F.col("h").bitwiseAND(F.lit((1 << MOST_BITS) - 1))
    rows = hashes.select(spot.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("bits")).toArrow()
    words = np.zeros(1 << MOST_BITS - 6, np.uint64)
    words[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    bits = min(MOST_BITS, max(16, int(np.bitwise_count(words).sum() * room).bit_length()))
    return np.bitwise_or.reduce(words.reshape(-1, 1 << bits - 6), axis=0)


def bit_tests(table: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Says of 64-bit hashes whether the table has their bits."""

    def test(hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) & np.uint64(len(table) * 64 - 1)
        return ((table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)

    return test


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but for the rows that gone(doc_id, tag) names; tag is the xxhash64 of a row's text. A doc_id may be null.

    A bit table of bounded size says which rows may be named: only these are moved to meet the names, the others stay where they are.
    """
    tag = F.xxhash64(F.col("text").cast("string"))
    key = lambda t: F.xxhash64(F.coalesce("doc_id", F.lit(-1)), t)
    named = written(gone.select(F.col("doc_id").cast("long").alias("doc_id"), "tag").distinct())
    test = bit_tests(bit_table(named.select(key(F.col("tag")).alias("h"))))

    @F.arrow_udf("boolean")
    def may(hashes: pa.Array) -> pa.Array:
        return pa.array(test(hashes.to_numpy()))

    rows = docs.withColumn("_may", may.asNondeterministic()(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), tag)))
    some, rest = rows.where("_may").drop("_may"), rows.where("NOT _may").drop("_may")
    other = named.withColumnsRenamed({"doc_id": "_of", "tag": "_tag"}).hint("merge")  # nothing bounds their number
    return rest.unionByName(some.join(other, F.col("doc_id").cast("long").eqNullSafe(F.col("_of")) & (tag == F.col("_tag")), "left_anti"))


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


@cache
def _trim() -> Callable[[int], int] | None:
    """The C library's own way to give free memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


#: Bytes of a batch that a task hands to the JVM: it holds each in native memory of the next power of two, beside the one before.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows in batches of about PIECE_BYTES, at least one row each."""
    rows = max(1, batch.num_rows * PIECE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, in small batches; when they're done, memory that it freed goes back to the system.

    Python workers live on for other tasks, and what an earlier one freed would else stay theirs. So Arrow takes its memory
    from the C library too, whose free pages are given back wherever they lie.
    """

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for batch in run(batches):
            yield from pieces(batch)
        pa.default_memory_pool().release_unused()
        if trim := _trim():
            trim(0)

    return whole
