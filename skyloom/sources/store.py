"""The survey's tables as snapshots: upserts, reconciling writes, deletion cascades, reads.

Every write is a function from snapshots to snapshots and is the same when it is repeated, so a replayed batch changes
nothing. `publish` writes a snapshot in a new folder and puts the pointer to it last; `load` reads what the newest pointer names. Tables that
are replaced frame by frame and read by place are in `skyhistory`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.sources.manifest import Manifest

KEEP_FIRST = ("pointing_error_arcsec", "pointing_error_ra_arcsec", "pointing_error_dec_arcsec")
MAX_PAGE = 1000


def upsert_frames(stored: DataFrame, new: DataFrame, keep_first: tuple[str, ...] = KEEP_FIRST) -> DataFrame:
    """By filename: new values win where they aren't null, some keep the value stored first; frame_id is the name's hash."""
    columns = [c for c in stored.columns if c not in ("filename", "frame_id")]
    n = new.select(F.col("filename").alias("n_filename"), *[F.col(c).alias(f"n_{c}") for c in columns])
    both = stored.join(n, F.col("filename") == F.col("n_filename"), "full_outer")
    merged = [(F.coalesce(c, f"n_{c}") if c in keep_first else F.coalesce(f"n_{c}", c)).alias(c) for c in columns]
    name = F.coalesce("filename", "n_filename")
    return both.select(name.alias("filename"), F.coalesce("frame_id", F.sha2(name, 256)).alias("frame_id"), *merged)


def to_wire(sources: DataFrame) -> DataFrame:
    """Private columns leave; the subtraction flag is public."""
    return sources.withColumnRenamed("_from_subtraction", "from_subtraction").select(*[c for c in sources.columns if not c.startswith("_")], *(["from_subtraction"] if "_from_subtraction" in sources.columns else []))


def from_wire(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Null elongation is 0, null flags are false, and each row gets its frame's filter."""
    flags = {c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in ("saturated", "near_edge", "from_subtraction") if c in rows.columns}
    kept = rows.drop("filter").withColumns({"elongation": F.coalesce("elongation", F.lit(0e0)), **flags})
    return kept.join(frames.select("frame_id", "filter"), "frame_id", "left")


def reconcile(stored: DataFrame, batch: DataFrame, affected: DataFrame) -> dict[str, DataFrame]:
    """stored and batch: frame_id, source_id and more; affected: the frame_ids that the batch speaks for, empty ones included.

    observations: the new snapshot. retracted: rows that their frame no longer has. purged: sources left without any
    observation. counts: new, matched, retracted, purged in one row.
    """
    keys = ["frame_id", "source_id"]
    mine = batch.join(affected, "frame_id", "left_semi")
    rest = stored.join(affected, "frame_id", "left_anti")
    old = stored.join(affected, "frame_id", "left_semi")
    observations = rest.unionByName(mine)
    retracted = old.join(mine, keys, "left_anti")
    purged = retracted.select("source_id").distinct().join(observations.select("source_id").distinct(), "source_id", "left_anti")
    known = stored.select("source_id").distinct().withColumn("known", F.lit(True))
    seen = mine.join(known, "source_id", "left").agg(F.count_if(F.col("known").isNull()).alias("new"), F.count_if("known").alias("matched"))
    counts = seen.crossJoin(retracted.agg(F.count("*").alias("retracted"))).crossJoin(purged.agg(F.count("*").alias("purged")))
    return {"observations": observations, "retracted": retracted, "purged": purged, "counts": counts}


def replace_anomalies(stored: DataFrame, new: DataFrame, affected: DataFrame) -> DataFrame:
    """The anomalies of the affected frames are exactly the new ones; none is valid."""
    return stored.join(affected, "frame_id", "left_anti").unionByName(new.join(affected, "frame_id", "left_semi"))


def delete_frames(frames: DataFrame, observations: DataFrame, anomalies: DataFrame, gone: DataFrame) -> dict[str, DataFrame]:
    """Frames, their observations and anomalies, and the sources and anomalies left without observations."""
    left = observations.join(gone, "frame_id", "left_anti")
    orphans = observations.select("source_id").distinct().join(left.select("source_id").distinct(), "source_id", "left_anti")
    kept = anomalies.join(gone, "frame_id", "left_anti").join(orphans, "source_id", "left_anti")
    return {"frames": frames.join(gone, "frame_id", "left_anti"), "observations": left, "anomalies": kept, "orphans": orphans}


def list_frames(frames: DataFrame, obj: str | None = None, date_from: str | None = None, date_to: str | None = None, limit: int = 100, offset: int = 0, newest_first: bool = False) -> DataFrame:
    """A page: exact object, from (inclusive), to (exclusive); at most 1000 rows, ordered by time and id."""
    out = frames if obj is None else frames.where(F.col("object") == obj)
    out = out if date_from is None else out.where(F.col("obs_time") >= F.lit(date_from).cast("timestamp_ntz"))
    out = out if date_to is None else out.where(F.col("obs_time") < F.lit(date_to).cast("timestamp_ntz"))
    time = F.col("obs_time").desc() if newest_first else F.col("obs_time")
    return out.orderBy(time, "frame_id").offset(offset).limit(min(limit, MAX_PAGE))


def frame_sources(frames: DataFrame, observations: DataFrame, frame_id: str | None = None) -> DataFrame:
    """One frame's sources beside the frame's own columns, or every frame's; a column that both have is the frame's."""
    if frame_id is not None:
        frames, observations = (t.where(F.col("frame_id") == frame_id) for t in (frames, observations))
    return frames.join(observations.select("frame_id", *[c for c in observations.columns if c not in frames.columns]), "frame_id")


def with_source_ids(rows: DataFrame, answered: DataFrame) -> DataFrame:
    """rows(frame_id, seq, ...) with the source_id that was answered for the frame and place; answered: frame_id, seq, source_id.

    Only where a frame has as many answers as rows: else all its rows get null. A source_id that rows bring along is replaced.
    """
    rows = rows.drop("source_id")
    sent, got = (t.groupBy("frame_id").agg(F.count("*").alias(c)) for t, c in ((rows, "n_sent"), (answered, "n_got")))
    whole = sent.join(got, "frame_id").where("n_sent = n_got").select("frame_id")
    return rows.join(answered.join(whole, "frame_id", "left_semi").select("frame_id", "seq", "source_id"), ["frame_id", "seq"], "left")


def observation_counts(observations: DataFrame) -> DataFrame:
    return observations.where("source_id IS NOT NULL").groupBy("source_id").agg(F.count("*").alias("n_observations"))


def publish(make: Callable[[DataFrame | None], DataFrame], spark: SparkSession, path: str) -> int:
    """Writes make(the current snapshot, or None) as the next one, and returns its version.

    Readers see the old snapshot or the new one, never a part. Where another writer was first, `make` is asked again with what that one wrote, so no write
    is lost. A crash before the pointer is put changes nothing.
    """
    pointer = Manifest(spark, path)

    def change(state: dict) -> dict:
        name, folder = pointer.folder()
        make(_snapshot(spark, pointer, state) if state else None).write.parquet(folder)
        return {"snapshot": name}

    return pointer.commit(change)


def _snapshot(spark: SparkSession, pointer: Manifest, state: dict) -> DataFrame:
    return spark.read.parquet(f"{pointer.path}/parts/{state['snapshot']}")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The current snapshot."""
    pointer = Manifest(spark, path)
    number, state = pointer.current()
    if not number:
        raise ValueError(f"nothing was published at {path}")
    return _snapshot(spark, pointer, state)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Deletes all but the newest `keep` snapshots; only while no writer is at work."""
    return Manifest(spark, path).vacuum(lambda state: {state["snapshot"]}, keep)
