"""File arrivals as streams: ingestion, duplicate suppression, batches after a quiet time or when they're full, late frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyloom.streaming.detection import Seen

QUIET, MAX_BATCH = "5 seconds", 200


def image_files(spark: SparkSession, path: str, per_trigger: int = MAX_BATCH) -> DataFrame:
    """A stream of .fits and .fit files (any case) below a folder, the backlog first; use trigger(availableNow=True) for it alone."""
    kind = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(kind).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", per_trigger).load(path)
    return files.where(F.lower("path").rlike(r"\.(fits|fit)$"))


def without_repeats(arrivals: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Each path once within the watermark; state older than that is dropped. arrivals: path, arrived (timestamp)."""
    return arrivals.withWatermark("arrived", within).dropDuplicatesWithinWatermark(["path"])


def quiet_sessions(arrivals: DataFrame, by: str, gap: str = QUIET) -> DataFrame:
    """Batches that a quiet time ends, as session windows; in a stream the watermark closes them."""
    return arrivals.groupBy(F.col(by), F.session_window("arrived", gap).alias("s")).agg(F.count("*").alias("n_files")).select(by, F.col("s.start").alias("started"), F.col("s.end").alias("ended"), "n_files")


def numbered_batches(arrivals: DataFrame, by: str, gap: str = QUIET, size: int = MAX_BATCH) -> DataFrame:
    """The same as a batch operator over one `by` at a time, long sessions cut into chunks of `size`: session and chunk of every file."""
    order = Window.partitionBy(by).orderBy("arrived", "path")
    seconds = float(gap.split()[0])
    wait = (F.unix_micros("arrived") - F.unix_micros(F.lag("arrived").over(order))) / 1e6
    started = arrivals.withColumn("_new", F.coalesce((wait >= seconds).cast("long"), F.lit(1).cast("long")))
    held = started.withColumn("session", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(by, "session").orderBy("arrived", "path")
    return held.withColumn("chunk", F.floor((F.row_number().over(inside) - 1) / size)).drop("_new")


class _Flying(Seen):
    """Paths in flight, in buckets like observations seen."""

    @staticmethod
    def _spot(path: str) -> int:
        return crc32(path.encode())


class _Batcher(StatefulProcessor):
    """One key's batches. Rows wait in `early` until the watermark reaches them, so they're taken in the order of their times.

    A state call costs more than a row's work, so `size` says what there is to read, and each list and bucket is read and written at most once a call.
    """

    def __init__(self, gap_us: int, size: int) -> None:
        self.gap, self.most = gap_us, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.size = handle.getValueState("size", "batches long, buckets long, flying long, early long, pending long")
        self.early = handle.getListState("early", "at long, done boolean, path string")
        self.pending = handle.getListState("pending", "at long, path string")
        self.flying = handle.getMapState("flying", "bucket long", "path array<string>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [(int(at), bool(done), path) for part in rows for at, done, path in zip(part["at"].tolist(), part["done"].tolist(), part["path"].tolist(), strict=True)]
        yield self._advance(key, timerValues.getCurrentWatermarkInMs(), new)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(key, timerValues.getCurrentWatermarkInMs(), [])

    def _advance(self, key, watermark_ms: int, new: list[tuple]) -> pd.DataFrame:
        """Takes what the watermark has reached, and gives the batches that this closes."""
        now = watermark_ms * 1000
        size = self.size.get()
        number, buckets, count, n_early, n_pending = size or (0, 1, 0, 0, 0)
        held = sorted([*(tuple(r) for r in self.early.get()), *new] if n_early else new, key=lambda r: (r[0], not r[1], r[2]))
        ready = [r for r in held if r[0] <= now]
        pending = [(r[0], r[1]) for r in self.pending.get()] if n_pending else []
        before = list(pending)
        waiting = {path for _, path in pending}
        flying = _Flying(lambda n: list(self.flying.getValue((n,))[0]) if self.flying.containsKey((n,)) else None, buckets, count)
        out: list[tuple] = []

        def flush(at: int, reason: str) -> None:
            nonlocal number
            number += 1
            for seq, (came, path) in enumerate(pending):
                out.append((key[0], number, seq, path, came, at, reason))
                flying.add(path)
            pending.clear()
            waiting.clear()

        for at, done, path in ready:
            if pending and at - pending[-1][0] >= self.gap:
                flush(pending[-1][0] + self.gap, "quiet")
            if done:
                flying.remove(path)
            elif path not in waiting and not flying.holds(path):
                pending.append((at, path))
                waiting.add(path)
                if len(pending) == self.most:
                    flush(at, "full")
        if pending and pending[-1][0] + self.gap <= now:
            flush(pending[-1][0] + self.gap, "quiet")
        if not ready:
            if new:
                self.early.appendList(new)
        elif len(ready) < len(held):
            self.early.put(held[len(ready) :])
        elif n_early:
            self.early.clear()
        if pending != before:
            self.pending.put(pending) if pending else self.pending.clear()
        for n in flying.changed:
            self.flying.updateValue((n,), (sorted(flying.held[n]),))
        sizes = (number, flying.buckets, flying.count, len(held) - len(ready), len(pending))
        if sizes != size:
            self.size.update(sizes)
        due = [r[0] for r in held[len(ready) : len(ready) + 1]] + [at + self.gap for at, _ in pending[-1:]]
        if due:
            wanted = -(-min(due) // 1000)
            for t in list(self.handle.listTimers()) if size else []:
                if t != wanted:
                    self.handle.deleteTimer(t)
            self.handle.registerTimer(wanted)
        return pd.DataFrame(out, columns=["by", "batch", "seq", "path", "arrived", "flushed", "reason"])

    def close(self) -> None:
        pass


def stream_batches(events: DataFrame, by: str, gap: str = QUIET, size: int = MAX_BATCH, late: str = "10 seconds") -> DataFrame:
    """Batches of files as a stream: a batch is handed on when its key was quiet for the gap, or at once when it holds `size` files.

    events: the key, path, arrived (timestamp), done (boolean). A row with done says that the file's work has ended. A path that is
    pending, or in flight (handed on and not yet done), is left out and doesn't prolong the wait. Returns one row for each file handed on:
    the key, batch (from 1), seq (from 0), path, arrived, flushed (when the batch closed), reason: `quiet` or `full`.

    Time is the events' own: rows may come up to `late` behind the newest, and are taken in order of arrived, then done first, then
    path, once the watermark reaches them, so the batches don't depend on how the stream is cut. What is pending at the end waits in
    the state for later events, over restarts too. A row without key, path or time goes; a null `done` is false. State for each key: the
    files pending (at most `size`), those in flight, and the rows ahead of the watermark. Needs the RocksDB state store and sets it.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = events.where(F.col(by).isNotNull() & F.col("path").isNotNull() & F.col("arrived").isNotNull())
    rows = rows.select(F.col(by).cast("string").alias("by"), F.col("path").cast("string").alias("path"), F.col("arrived").cast("timestamp").alias("arrived"), F.coalesce("done", F.lit(False)).alias("done"))
    rows = rows.withWatermark("arrived", late).withColumn("at", F.unix_micros("arrived"))
    micros = int(pd.Timedelta(gap) / pd.Timedelta("1us"))
    out = rows.groupBy("by").transformWithStateInPandas(_Batcher(micros, size), "by string, batch long, seq long, path string, arrived long, flushed long, reason string", "Append", "EventTime")
    return out.select(F.col("by").alias(by), "batch", "seq", "path", F.timestamp_micros("arrived").alias("arrived"), F.timestamp_micros("flushed").alias("flushed"), "reason")


def each_batch(frames: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs `work` on every micro-batch until the backlog is done; work has to be the same when a batch is replayed."""
    return frames.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
