"""Incremental anomaly detection and light-curve state."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from skyloom.operators import classify, recompute
from skyloom.operators.matching import MOVING_CONE
from skyloom.sources.lineage import written
from skyloom.sources.skyhistory import SkyHistory, cells_near


FRAMES = StructType().add("frame_id", "string").add("obs_time", "timestamp_ntz").add("ra_center", "double").add("dec_center", "double").add("fov_deg", "double")
#: How far a tile's centre may be from a row in it, in arcseconds.
TILE_REACH = 300.0


def frames_of(rows: DataFrame) -> DataFrame:
    """The frames that rows with ra_center, dec_center and fov_deg belong to."""
    made = rows.groupBy("frame_id").agg(F.min("obs_time").alias("obs_time"), F.min("ra_center").alias("ra_center"), F.min("dec_center").alias("dec_center"), F.max("fov_deg").alias("fov_deg"))
    return made.select(*[F.col(f.name).cast(f.dataType) for f in FRAMES.fields])


class Survey:
    """Sources, frames and anomalies of a survey by sky cell, below one folder. schema: that of the source rows that come in."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, max_fov_deg: float) -> None:
        self.spark, self.max_fov = spark, max_fov_deg
        self.sources = SkyHistory(spark, f"{path}/sources", schema)
        self.frames = SkyHistory(spark, f"{path}/frames", FRAMES, "ra_center", "dec_center")
        empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        self.anomalies = SkyHistory(spark, f"{path}/anomalies", classify.anomalies(classify.described(empty)).schema, time=None)

    def take(self, batch: DataFrame) -> DataFrame:
        """Stores a batch of source rows by frame, and brings the anomalies of all frames that this touches up to date. Returns these frames (frame_id).

        The batch speaks for its frames: their former rows go. A frame without any source (or a demoted one) comes as one row with a null
        obs_id. Frames may come in any order: later ones that rest on the batch's are classified anew, and only those. All reads are of the
        cells around the changes; a replay writes the same.
        """
        ids = written(batch.select("frame_id").distinct())
        rows = written(batch.where("obs_id IS NOT NULL"))
        before = written(self.sources.read(self.sources.homes(ids)).join(ids, "frame_id", "left_semi"))
        fields_before = written(self.frames.read(self.frames.homes(ids)).join(ids, "frame_id", "left_semi"))
        self.sources.publish(rows, ids, only=True)
        self.frames.publish(frames_of(rows), ids, only=True)
        changed, fields = before.unionByName(rows), fields_before.unionByName(frames_of(rows))
        half = self.max_fov / 2 * 3600 + TILE_REACH
        around = cells_near(changed, MOVING_CONE) | cells_near(fields, half, "ra_center", "dec_center")
        others = self.sources.read(around).join(ids, "frame_id", "left_anti")  # the batch's own frames are touched in any case
        touched = written(recompute.affected_frames(others, changed, fields, self.max_fov).union(ids).distinct())
        current = written(self.sources.read(self.sources.homes(touched)).join(touched, "frame_id", "left_semi"))
        past = written(self.sources.read(cells_near(current, MOVING_CONE)))
        covering = written(self.frames.read(cells_near(current, half)))
        found = classify.anomalies(classify.classified(current, past, covering, self.max_fov))
        self.anomalies.publish(found, touched, only=True)
        return touched


def detect_batch(spark: SparkSession, path: str, schema: StructType, max_fov_deg: float):
    """Work for `arrivals.each_batch`: every micro-batch goes into the survey below `path`; read its tables by `Survey`."""

    def work(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            Survey(spark, path, schema, max_fov_deg).take(batch)

    return work


DAY_US = 86_400_000_000
#: Magnitudes that a block of the ordered state holds before it's split, and days that a block of the time index spans.
BLOCK_MAGS, BLOCK_DAYS = 512, 30
#: Identifiers that a bucket of seen observations holds on average before their number doubles.
SEEN_IDS = 256


class Magnitudes:
    """The magnitudes of one source and filter, ordered by value in blocks and by time in others. Blocks are read when they're needed and written back once.

    load(kind, block) gives a block's lists or None, and the index under block None. A value's block holds all equal ones.
    """

    def __init__(self, load: Callable[[str, int | None], tuple | None]) -> None:
        self.load, self.changed, self.dropped = load, set(), set()
        blocks, firsts, counts, times = load("index", None) or ([], [], [], [])
        self.blocks, self.firsts, self.counts, self.times = list(blocks), list(firsts), list(counts), list(times)
        self.held: dict[tuple[str, int], list[list]] = {}

    def index(self) -> tuple:
        return self.blocks, self.firsts, self.counts, self.times

    def block(self, kind: str, number: int) -> list[list]:
        if (kind, number) not in self.held:
            self.held[kind, number] = [list(x) for x in self.load(kind, number) or ((), (), ())]
        return self.held[kind, number]

    def _at(self, mag: float) -> int:
        return max(0, bisect_right(self.firsts, mag) - 1)

    def add(self, obs_id: int, at: int, mag: float) -> None:
        k = self._at(mag)
        if not self.blocks:
            self.blocks, self.firsts, self.counts = [0], [mag], [0]
            self.held["mags", 0] = [[], [], []]
        number = self.blocks[k]
        mags = self.block("mags", number)[0]
        insort(mags, mag)
        self.firsts[k] = mags[0]
        self.counts[k] += 1
        self.changed.add(("mags", number))
        if len(mags) > BLOCK_MAGS and mags[0] != mags[-1]:
            middle = mags[len(mags) // 2]
            cut = bisect_left(mags, middle) or bisect_right(mags, middle)  # equal values stay together
            new = max(self.blocks) + 1
            self.held["mags", new] = [mags[cut:], [], []]
            del mags[cut:]
            self.blocks.insert(k + 1, new)
            self.firsts.insert(k + 1, self.held["mags", new][0][0])
            self.counts[k : k + 1] = [len(mags), len(self.held["mags", new][0])]
            self.changed.add(("mags", new))
        day = at // (BLOCK_DAYS * DAY_US)
        if day not in self.times:
            insort(self.times, day)
            self.held["times", day] = [[], [], []]
        for column, value in zip(self.block("times", day), (at, mag, obs_id), strict=True):
            column.append(value)
        self.changed.add(("times", day))

    def not_before(self, at: int) -> list[float]:
        """Magnitudes held of that time and later: only blocks from that time on are read."""
        day = at // (BLOCK_DAYS * DAY_US)
        return sorted(m for d in self.times[bisect_left(self.times, day) :] for t, m in zip(*self.block("times", d)[:2], strict=True) if t >= at)

    def median_before(self, at: int) -> float | None:
        later = self.not_before(at)
        n = sum(self.counts) - len(later)
        if n <= 0:
            return None
        edge = [bisect_left(later, f) for f in self.firsts[1:]] + [len(later)]
        return 0.5 * self._smallest((n - 1) // 2, later, edge) + 0.5 * self._smallest(n // 2, later, edge)

    def _smallest(self, k: int, later: list[float], edge: list[int]) -> float:
        """The k-th smallest of what is held but for `later`, whose part in each block ends at edge."""
        begin = 0
        for number, count, end in zip(self.blocks, self.counts, edge, strict=True):
            left = count - (end - begin)
            if k < left:
                mags, gone, out = self.block("mags", number)[0], later[begin:end], 0
                for m in mags:
                    if out < len(gone) and gone[out] == m:
                        out += 1
                    elif k == 0:
                        return m
                    else:
                        k -= 1
            k -= left
            begin = end
        raise AssertionError("fewer magnitudes than counted")

    def expire(self, before: int) -> list[int]:
        """Drops the time blocks that end before a time; returns the observations in them."""
        gone = []
        while self.times and (self.times[0] + 1) * BLOCK_DAYS * DAY_US <= before:
            day = self.times.pop(0)
            _, mags, ids = self.block("times", day)
            gone += ids
            for m in mags:
                k = self._at(m)
                block = self.block("mags", self.blocks[k])[0]
                del block[bisect_left(block, m)]
                self.counts[k] -= 1
                self.changed.add(("mags", self.blocks[k]))
                if block:
                    self.firsts[k] = block[0]
                else:
                    self.dropped.add(("mags", self.blocks[k]))
                    del self.blocks[k], self.firsts[k], self.counts[k]
            self.dropped.add(("times", day))
        return gone


class Seen:
    """The observations of one source in buckets by hash, each read when it's needed and written back once; their number doubles as they fill.

    load(bucket) gives a bucket's identifiers or None.
    """

    def __init__(self, load: Callable[[int], list[int] | None], buckets: int = 1, count: int = 0) -> None:
        self.load, self.buckets, self.count = load, buckets, count
        self.held: dict[int, set[int]] = {}
        self.changed: set[int] = set()

    @staticmethod
    def _spot(obs_id: int) -> int:
        return obs_id * 0x9E3779B97F4A7C15 % (1 << 64) >> 32

    def _bucket(self, obs_id: int) -> tuple[int, set[int]]:
        number = self._spot(obs_id) % self.buckets
        if number not in self.held:
            self.held[number] = set(self.load(number) or ()) if self.count else set()
        return number, self.held[number]

    def add(self, obs_id: int) -> bool:
        """Whether it's new."""
        number, known = self._bucket(obs_id)
        if obs_id in known:
            return False
        known.add(obs_id)
        self.changed.add(number)
        self.count += 1
        if self.count > SEEN_IDS * self.buckets:
            every = [i for n in range(self.buckets) for i in (self.held[n] if n in self.held else self.load(n) or ())]
            self.buckets *= 2
            self.held = {n: set() for n in range(self.buckets)}
            self.changed = set(range(self.buckets))
            for i in every:
                self._bucket(i)[1].add(i)
        return True

    def holds(self, obs_id: int) -> bool:
        return obs_id in self._bucket(obs_id)[1]

    def remove(self, obs_id: int) -> None:
        number, known = self._bucket(obs_id)
        if obs_id in known:
            known.discard(obs_id)
            self.changed.add(number)
            self.count -= 1


class _LightCurve(StatefulProcessor):
    """Magnitudes seen per source and filter, and the median before each new one."""

    def __init__(self, keep_us: int | None) -> None:
        self.keep = keep_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.size = handle.getValueState("size", "buckets long, count long")
        self.seen = handle.getMapState("seen", "bucket long", "obs_id array<long>")
        self.index = handle.getMapState("index", "filter string", "blocks array<long>, firsts array<double>, counts array<long>, times array<long>")
        self.mags = handle.getMapState("mags", "filter string, block long", "mags array<double>")
        self.times = handle.getMapState("times", "filter string, block long", "at array<long>, mag array<double>, obs_id array<long>")

    def _loader(self, name: str):
        def load(kind: str, block: int | None) -> tuple | None:
            if kind == "index":
                return self.index.getValue((name,)) if self.index.containsKey((name,)) else None
            state = self.mags if kind == "mags" else self.times
            if not state.containsKey((name, block)):
                return None
            value = tuple(state.getValue((name, block)))
            return value if kind == "times" else (*value, (), ())

        return load

    def _store(self, name: str, held: Magnitudes) -> None:
        for kind, block in held.changed - held.dropped:
            lists = held.block(kind, block)
            (self.mags if kind == "mags" else self.times).updateValue((name, block), tuple(lists[:1] if kind == "mags" else lists))
        for kind, block in held.dropped:
            state = self.mags if kind == "mags" else self.times
            if state.containsKey((name, block)):
                state.removeKey((name, block))
        self.index.updateValue((name,), held.index())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        median: list[float | None] = [None] * len(new)
        size = self.size.get()
        seen = Seen(lambda n: list(self.seen.getValue((n,))[0]) if self.seen.containsKey((n,)) else None, *(size or ()))
        known = new[new["at"].notna() & new["filter"].notna()]
        # plain tuples in order of filter, time and arrival: groups of a few rows each cost more than their work as data frames
        line = sorted(zip(known["filter"].tolist(), map(int, known["at"].tolist()), known.index.tolist(), known["obs_id"].tolist(), known["mag"].tolist(), strict=True), key=lambda r: r[:3])
        for name, own in groupby(line, key=lambda r: r[0]):
            # a source that comes for the first time has no state to read
            held, newest = Magnitudes(self._loader(name) if size else lambda *_: None), 0
            for at, group in groupby(own, key=lambda r: r[1]):  # a row meets what is before its own time
                value, newest = held.median_before(at), at
                for _, _, i, obs_id, mag in group:
                    median[i] = value
                    if not pd.isna(mag) and seen.add(int(obs_id)):
                        held.add(int(obs_id), at, float(mag))
            if self.keep is not None:
                for obs_id in held.expire(newest - self.keep):
                    seen.remove(obs_id)
            self._store(name, held)
        for n in seen.changed:
            self.seen.updateValue((n,), (sorted(seen.held[n]),))
        if len(line):
            self.size.update((seen.buckets, seen.count))
        yield pd.DataFrame({"source_id": key[0], "obs_id": new["obs_id"], "median_mag": pd.Series(median, index=new.index, dtype=object)})

    def close(self) -> None:
        pass


def light_curves(observations: DataFrame, keep_days: float | None = None) -> DataFrame:
    """source_id, obs_id, median_mag: the median of magnitudes of the same source and filter at strictly earlier times, as a stream.

    The state of a source is ordered: magnitudes in blocks by value with a count for each block, and in blocks by time. A row in the order of time reads the
    counts and a block or two, whatever was seen before; a late row also reads the blocks from its time on, to leave out what is later. So a late row is
    compared with what was before its own time; what came earlier in the stream but is later in time isn't judged anew. A repeated obs_id
    adds nothing to the state. Rows without a source go; without a time, a filter or earlier magnitudes the median is null. keep_days: how much of a
    source's own time is kept at least before its newest row (blocks of BLOCK_DAYS days are forgotten whole); null keeps everything. Needs the
    RocksDB state store and sets it.
    """
    observations.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    at = F.unix_micros(F.col("obs_time").cast("timestamp")).alias("at")
    rows = observations.where("source_id IS NOT NULL").select("source_id", F.col("obs_id").cast("long").alias("obs_id"), at, "filter", F.col("mag").cast("double").alias("mag"))
    keep = None if keep_days is None else int(keep_days * DAY_US)
    return rows.groupBy("source_id").transformWithStateInPandas(_LightCurve(keep), "source_id string, obs_id long, median_mag double", "Append", "None")
