"""Light curves and tracks of sources, their presentation, and the choice of reference frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions import names, sky

MAX_EPOCHS = 12
MIN_REFERENCES, MAX_REFERENCES, RANKED = 3, 10, 30


def epochs(observations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Epochs in time order with their number and count; with ids only those sources, and an unknown id has no rows."""
    rows = observations if ids is None else observations.join(ids.select("source_id").distinct(), "source_id", "left_semi")
    order = Window.partitionBy("source_id").orderBy("obs_time", "obs_id")
    every = Window.partitionBy("source_id")
    return rows.where("source_id IS NOT NULL").withColumns({"epoch": F.row_number().over(order).cast("long"), "n_epochs": F.count("*").over(every)})


def last_epochs(track: DataFrame, n: int = MAX_EPOCHS) -> DataFrame:
    """The last n epochs of each source, in time order."""
    return track.where(F.col("epoch") > F.col("n_epochs") - n)


def kinematics(track: DataFrame) -> DataFrame:
    """Separation, gap in hours and velocity from the epoch before; no velocity where the gap is 0 or unknown."""
    order = Window.partitionBy("source_id").orderBy("epoch")
    back = F.lag(F.struct("ra", "dec", "obs_time")).over(order)
    rows = track.withColumn("_b", back)
    sep = sky.separation_arcsec(F.col("_b.ra"), F.col("_b.dec"), F.col("ra"), F.col("dec"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    hours = F.abs(micros(F.col("obs_time")) - micros(F.col("_b.obs_time"))) / F.lit(3.6e9)
    rows = rows.withColumns({"shift_arcsec": sep, "gap_hours": hours}).drop("_b")
    return rows.withColumn("velocity", F.when(F.col("gap_hours") > 0, F.col("shift_arcsec") / F.when(F.col("gap_hours") > 0, F.col("gap_hours"))))


def previous_frame(frames: DataFrame, of: DataFrame) -> DataFrame:
    """For each row of `of` (frame_id, object, obs_time): the nearest earlier frame of its object (strictly earlier).

    Of frames with one time the last by id. Rows without an object, a time or an earlier frame have none. No pairs are made:
    an object's months are windows of their own, so one that is observed all the time isn't one task, and a month's last
    frame is handed on to the later ones.
    """
    frame = F.when(F.col("archived"), F.struct(F.col("obs_time").alias("previous_time"), F.col("frame_id").alias("previous_id")))
    both = of.select("frame_id", "object", "obs_time", F.lit(False).alias("archived")).unionByName(frames.select("frame_id", "object", "obs_time", F.lit(True).alias("archived")))
    rows = both.where("object IS NOT NULL AND obs_time IS NOT NULL").withColumns({"month": F.date_trunc("month", "obs_time"), "p": frame})
    months = Window.partitionBy("object").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("object", "month").agg(F.max("p").alias("last")).withColumn("before", F.max("last").over(months)).drop("last")
    order = Window.partitionBy("object", "month").orderBy("obs_time", "archived", "frame_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("own", F.last("p", ignorenulls=True).over(order)).where("NOT archived").join(before, ["object", "month"])
    return found.withColumn("p", F.coalesce("own", "before")).where("p IS NOT NULL").select("frame_id", "p.previous_id", "p.previous_time")


def types_of_sources(anomalies: DataFrame) -> DataFrame:
    """Per source: its types, each once in order of first occurrence, and the first that is known."""
    first = anomalies.groupBy("source_id", "anomaly_type").agg(F.min("seq").alias("seq"))
    listed = F.array_sort(F.collect_list(F.struct("seq", "anomaly_type")))
    known = F.min(F.when(F.col("anomaly_type").isNotNull(), F.struct("seq", "anomaly_type")))
    return first.groupBy("source_id").agg(F.transform(listed, lambda s: s["anomaly_type"]).alias("types"), known["anomaly_type"].alias("representative"))


def with_ephemerides(anomalies: DataFrame, ephemeris: DataFrame) -> DataFrame:
    """Adds a struct `ephemeris` to asteroids and comets by designation and time; null where there is none."""
    e = ephemeris.select(F.col("designation").alias("e_designation"), F.col("obs_time").alias("e_time"), F.struct("predicted_ra", "predicted_dec", "predicted_mag", "distance_au", F.hypot("ra_rate", "dec_rate").alias("angular_velocity_arcsec_per_hour")).alias("ephemeris"))
    moving = F.col("anomaly_type").isin("ASTEROID", "COMET")
    return anomalies.join(e, moving & (F.col("mpc_designation") == F.col("e_designation")) & (F.col("obs_time") == F.col("e_time")), "left").drop("e_designation", "e_time")


def designations(anomalies: DataFrame, sources: DataFrame) -> DataFrame:
    """source_id, designation: an anomaly's own first, else that of the matched source (which needs a catalogue and an id)."""
    own = anomalies.where("mpc_designation IS NOT NULL").groupBy("source_id").agg(F.min_by("mpc_designation", "seq").alias("own"))
    theirs = sources.where("catalog_name IS NOT NULL AND catalog_id IS NOT NULL").groupBy("source_id").agg(F.min("catalog_id").alias("theirs"))
    rows = anomalies.select("source_id").distinct().join(own, "source_id", "left").join(theirs, "source_id", "left")
    return rows.select("source_id", F.coalesce("own", "theirs").alias("designation"))


def track_report(anomalies: DataFrame, sources: DataFrame, observations: DataFrame) -> DataFrame:
    """The rows behind a chart: label, presentation, and each of the last epochs with its motion."""
    kinds = types_of_sources(anomalies).join(designations(anomalies, sources), "source_id")
    track = kinematics(last_epochs(epochs(observations, kinds)))
    rows = track.join(kinds, "source_id")
    motion = F.when(F.col("shift_arcsec").isNotNull(), sky.motion_label(F.col("shift_arcsec"), F.col("gap_hours")))
    return rows.select("source_id", "epoch", "n_epochs", "obs_id", "frame_id", "shift_arcsec", "gap_hours", "velocity", motion.alias("motion"), names.moving_label(F.col("representative"), F.col("designation"), F.col("source_id")).alias("label"), names.presentation(F.col("n_epochs"), F.col("representative")).alias("presentation"))


def _newest(archive: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the newest RANKED frames in order, and how many there are in all; a task keeps no more than that of a key."""
    order = Window.partitionBy(*keys).orderBy(F.col("obs_time").desc(), "frame_id")
    top = archive.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= RANKED)
    refs = F.array_sort(F.collect_list(F.struct("nth", F.col("frame_id").alias("reference_id"), F.col("position_angle").alias("pa"))))
    return top.groupBy(*keys).agg(refs.alias("refs")).join(archive.groupBy(*keys).agg(F.count("*").alias("n")), keys)


def reference_frames(new: DataFrame, archive: DataFrame) -> DataFrame:
    """frame_id, reference_id, place: frames to subtract from each new one.

    Same object, newest first; those of the same filter if there are three, else all. More than ten and a known position
    angle: the newest thirty by circular distance of the angle (unknown counts as 180). The frame itself leaves after the
    cut to ten; fewer than three left means none. The archive is ranked once, and a new frame meets thirty rows of it.
    """
    a = archive.select("object", "filter", "frame_id", "obs_time", "position_angle").where("object IS NOT NULL")
    every = _newest(a, ["object"]).select("object", F.struct("n", "refs").alias("every"))
    same = _newest(a.where("filter IS NOT NULL"), ["object", "filter"]).where(F.col("n") >= MIN_REFERENCES).select("object", "filter", F.struct("n", "refs").alias("same"))
    rows = new.select("frame_id", "object", "filter", "position_angle").join(every, "object").join(same, ["object", "filter"], "left")
    pool = rows.select("frame_id", "position_angle", F.coalesce("same", "every").alias("pool"))
    by_angle = (F.col("pool.n") > MAX_REFERENCES) & F.col("position_angle").isNotNull()

    def ranked(r: Column) -> Column:
        off = F.coalesce(F.abs(sky.wrap180(r["pa"] - F.col("position_angle"))), F.lit(180e0))
        return F.struct(F.when(by_angle, off).otherwise(0e0).alias("off"), r["nth"], r["reference_id"])

    ten = F.slice(F.array_sort(F.transform("pool.refs", ranked)), 1, MAX_REFERENCES)
    placed = F.transform(ten, lambda r, at: F.struct(r["reference_id"].alias("reference_id"), (at + 1).cast("long").alias("place")))
    left = pool.select("frame_id", F.filter(placed, lambda r: r["reference_id"] != F.col("frame_id")).alias("left"))
    return left.where(F.size("left") >= MIN_REFERENCES).select("frame_id", F.inline("left"))
