"""What was seen before at a position: narrow and wide history, coverage, vacated positions, historical magnitudes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators.cone import cone_any, cone_pairs, renamed
from skyloom.operators.matching import MATCH_CONE, MOVING_CONE
from skyloom.sources.lineage import written


def history_pairs(current: DataFrame, past: DataFrame, radius: float = MOVING_CONE) -> DataFrame:
    """obs_id, frame_id of current rows with h_* of past rows within the radius (inclusive) and strictly before their frame."""
    now = current.select("obs_id", "frame_id", "obs_time", "ra", "dec", "filter")
    before = F.col("h_obs_time") < F.col("obs_time")
    return cone_pairs(now, renamed(past, "h_", "obs_id", "frame_id", "obs_time", "ra", "dec", "mag", "filter"), radius, inclusive=True, right_at=("h_ra", "h_dec"), condition=before, dense=True)


def narrow_history(pairs: DataFrame, radius: float = MATCH_CONE) -> DataFrame:
    """Per current row with any: n_history, and the median magnitude of the same known filter (null if none)."""
    same = F.col("filter") == F.col("h_filter")
    near = pairs.where(F.col("sep_arcsec") <= radius)
    return near.groupBy("obs_id").agg(F.count("*").alias("n_history"), F.median(F.when(same, F.col("h_mag"))).alias("median_mag"))


def coverage(current: DataFrame, frames: DataFrame, max_fov_deg: float, coverage_at: str = "tile") -> DataFrame:
    """obs_id, n_covering: earlier frames whose field holds the row's tile centre (or the row itself). Rows without any are left out.

    Frames with the same centre and field of view are one field, and fields are joined with places alone, whatever the times. Places within the same fields
    (told by two 64-bit hashes of these and their number) are one zone. Then frames and questions of a zone stand in one order of time, and a running count
    answers each question, so a zone asked n times with n frames takes 2n rows instead of n * n pairs.
    """
    at = {"tile": (sky.tile("ra"), sky.tile("dec")), "source": (F.col("ra"), F.col("dec"))}[coverage_at]
    rows = current.where(F.col("ra").isNotNull() & F.col("dec").isNotNull() & F.col("obs_time").isNotNull()).select("obs_id", "obs_time", at[0].alias("t_ra"), at[1].alias("t_dec"))
    place, field, zone = ["t_ra", "t_dec"], ["f_ra_center", "f_dec_center", "f_fov_deg"], ["z_ra", "z_dec"]
    times = renamed(frames, "f_", "obs_time", "ra_center", "dec_center", "fov_deg").where("f_obs_time IS NOT NULL").groupBy("f_obs_time", *field).agg(F.count("*").alias("n"))
    pairs = cone_pairs(rows.select(*place).distinct(), times.select(*field).distinct(), max_fov_deg / 2 * 3600, inclusive=True, left_at=("t_ra", "t_dec"), right_at=("f_ra_center", "f_dec_center"))
    pairs = written(pairs.where(F.col("sep_arcsec") <= F.col("f_fov_deg") / 2 * 3.6e3).select(*place, *field))
    sets = pairs.groupBy(*place).agg(F.bit_xor(F.xxhash64(*field)).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), *field)).alias("b"), F.count("*").alias("c"))
    zones = sets.groupBy("a", "b", "c").agg(F.min(F.struct(*place)).alias("z"))
    zoned = sets.join(zones, ["a", "b", "c"]).select(*place, F.col("z.t_ra").alias("z_ra"), F.col("z.t_dec").alias("z_dec"))
    zoned = written(zoned)
    fields = pairs.join(zoned.where("t_ra = z_ra AND t_dec = z_dec"), place).select(*zone, *field)
    came = fields.join(times, field).groupBy(*zone, F.col("f_obs_time").alias("obs_time")).agg(F.sum("n").alias("n"))
    rows = rows.join(zoned, place).select("obs_id", "obs_time", *zone)
    asked = rows.select(*zone, "obs_time").distinct()
    line = came.unionByName(asked.withColumn("n", F.lit(0).cast("long"))).groupBy(*zone, "obs_time").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(*zone).orderBy("obs_time").rowsBetween(Window.unboundedPreceding, -1)
    covered = line.withColumn("n_covering", F.sum("n").over(before)).where("n_covering > 0").select(*zone, "obs_time", "n_covering")
    return rows.join(covered, [*zone, "obs_time"]).select("obs_id", "n_covering")


def vacated(fresh: DataFrame, past: DataFrame, own: DataFrame, radius: float = MATCH_CONE, wide: float = MOVING_CONE) -> DataFrame:
    """obs_id of rows in `fresh`, which have no narrow history, with a wide history position at which their own frame has no source now.

    own: all sources of the rows' frames. No pairs of history are made: earlier rows at one position are one place with the earliest time, a row brings
    its frame's sources around it (as many as lie within the wide cone in one frame), and a semi join looks for a place that none of them is at.
    """
    rows = fresh.select("obs_id", "frame_id", "obs_time", "ra", "dec")
    places = past.groupBy(F.col("ra").alias("h_ra"), F.col("dec").alias("h_dec")).agg(F.min("obs_time").alias("h_first"))
    beside = cone_pairs(rows.drop("obs_time"), renamed(own, "c_", "frame_id", "ra", "dec"), wide + radius + 0.01, inclusive=True, on=[("frame_id", "c_frame_id")], right_at=("c_ra", "c_dec"))
    here = beside.groupBy("obs_id", "frame_id").agg(F.collect_set(F.struct("c_ra", "c_dec")).alias("here"))
    asked = rows.join(here, ["obs_id", "frame_id"], "left")
    close = lambda c: (F.abs(c["c_dec"] - F.col("h_dec")) <= radius / 3.6e3 + 1e-6) & (sky.separation_arcsec("h_ra", "h_dec", c["c_ra"], c["c_dec"]) <= radius)
    left = (F.col("h_first") < F.col("obs_time")) & ~F.coalesce(F.exists("here", close), F.lit(False))
    return cone_any(asked, places, wide, inclusive=True, right_at=("h_ra", "h_dec"), condition=left).select("obs_id").distinct()
