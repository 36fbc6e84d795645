"""Forced photometry from end to end: what the catalogue says is in a frame, wasn't found there, and can be measured at its place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import sky
from skyloom.operators import pixels as P

KEYS = ("frame_id", "catalog_name", "catalog_id")


def spots(field: DataFrame, matched: DataFrame, frames: DataFrame, mag_limit: float = 20.0, forced: bool = True) -> DataFrame:
    """The places to measure: field rows without a match in their frame, moved to the frame's epoch and put on its pixels.

    field: frame_id, catalog_name, catalog_id, ra, dec, pmra, pmdec, ref_epoch, catalog_mag, object_type. frames: frame_id, epoch (Julian years), wcs, fwhm_px,
    zero_point, zero_point_err. Gaia rows are moved by their proper motion; MPC rows are given for the frame's time. Adds spot_id, sx, sy (from 0); rows
    that don't project, and those of frames without a wcs, go. Without `forced` (a setting) there are none.
    """
    wanted = P.not_recovered(field, matched, mag_limit).join(frames, "frame_id").where(F.col("wcs").isNotNull() & F.lit(forced))
    ra, dec = sky.propagated("ra", "dec", "pmra", "pmdec", "epoch", "ref_epoch")
    star = F.col("catalog_name") == "Gaia DR3"
    moved = wanted.withColumns({"ra": F.when(star, ra).otherwise(F.col("ra")), "dec": F.when(star, dec).otherwise(F.col("dec"))})
    x, y = sky.sky_to_pixel("ra", "dec")
    placed = moved.withColumns({"sx": x - 1e0, "sy": y - 1e0, "spot_id": F.concat_ws("|", *[F.col(k).cast("string") for k in KEYS])})
    return placed.where("sx IS NOT NULL AND sy IS NOT NULL").dropDuplicates(["spot_id"])


def recovered(places: DataFrame, pixels: DataFrame, size: DataFrame, min_snr: float = 3.0, block: int = 64, margin: int = 1) -> DataFrame:
    """Source rows for the spots that hold a sure measurement; mag is null where the frame has no zero point."""
    measured = P.apertures(pixels, places.select("spot_id", "frame_id", "sx", "sy", "fwhm_px"), size, block, margin)
    rows = P.forced(measured, places, F.col("zero_point"), min_snr)
    about = places.select("spot_id", "catalog_name", "catalog_id", "catalog_mag", "object_type", "zero_point", "zero_point_err")
    return rows.join(about, "spot_id").drop("spot_id").withColumn("origin", F.lit("forced"))


def all_rows(detections: DataFrame, candidates: DataFrame, forced: DataFrame) -> DataFrame:
    """Detections, difference candidates (without catalogue columns) and forced measurements in one table, told apart by `origin`."""
    marked = detections.withColumn("origin", F.lit("detection")).unionByName(candidates.drop("catalog_name", "catalog_id", "catalog_mag", "object_type").withColumn("origin", F.lit("difference")), allowMissingColumns=True)
    return marked.unionByName(forced, allowMissingColumns=True)
