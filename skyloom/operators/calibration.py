"""Frame quality and photometric calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import names, photometry

# Default limits of the quality checks.
FWHM_MAX, ELONGATION_MAX, BACKGROUND_MAX, STARS, STARS_NARROW = 8.0, 2.0, 50_000.0, 10, 5
STAR_FWHM, STAR_ELONGATION, STAR_SNR = (2.5, 8.0), 1.5, 50.0
STREAK_ELONGATION, STREAK_ARCSEC, STREAK_PX = 5.0, 30.0, 200.0


def shapes(detections: DataFrame) -> DataFrame:
    """Adds fwhm_px, fwhm (arcseconds, null without a plate scale), elongation (the quality variant) and snr."""
    a, b = F.col("a"), F.col("b")
    px = photometry.fwhm_px(a, b)
    return detections.withColumns({"fwhm_px": px, "fwhm": px * F.col("scale"), "elongation": photometry.elongation(a, b, "quality"), "snr": photometry.ratio(F.col("flux"), F.col("err"))})


def is_star(loose: bool = False, small: float = STAR_FWHM[0], large: float = STAR_FWHM[1], elongation: float = STAR_ELONGATION) -> Column:
    """The star filter of the quality statistics; without a plate scale only elongation and flux count."""
    size = F.col("fwhm").isNull() | ((F.col("fwhm") >= small) & (F.lit(True) if loose else F.col("fwhm") <= large))
    return (F.col("elongation") < (5.0 if loose else elongation)) & size & (F.col("flux") > 0)


def strict_star(psf: Column) -> Column:
    """The star filter of extraction: bounds tighten around the frame's own width where that is known."""
    known = psf > 0
    high = F.when(known, F.least(F.lit(STAR_FWHM[1]), psf * 1.5)).otherwise(STAR_FWHM[1])
    low = F.when(known, F.greatest(F.lit(STAR_FWHM[0]), psf / 1.5)).otherwise(STAR_FWHM[0])
    return (F.col("elongation") < STAR_ELONGATION) & (F.col("fwhm") >= low) & (F.col("fwhm") <= high) & (F.col("snr") >= STAR_SNR) & (F.col("flux") > 0)


def is_streak(elongation: float = STREAK_ELONGATION, arcsec: float = STREAK_ARCSEC) -> Column:
    """A long thin detection: axes a and b, bounding box xmin, xmax, ymin, ymax, and the plate scale, without which 200 pixels count."""
    width, height = F.col("xmax").cast("double") - F.col("xmin"), F.col("ymax").cast("double") - F.col("ymin")
    least = F.when(F.col("scale") > 0, arcsec / F.col("scale")).otherwise(STREAK_PX)
    return (F.col("a") / F.when(F.col("b") > 0, F.col("b")).otherwise(1e-6) >= elongation) & (F.sqrt(width * width + height * height) >= least)


def difference_candidates(found: DataFrame, edge: float = photometry.EDGE_FRACTION) -> DataFrame:
    """Detections on a difference image that are no sensor defect and not near the edge, with fwhm_px.

    found: a, b, x, y, width, height, psf (the frame's own stellar width in arcseconds, null or 0: unknown) and scale. Where psf and
    scale are known, a candidate has at least two thirds of that width.
    """
    px = photometry.fwhm_px(F.col("a"), F.greatest(F.col("b"), F.lit(0.001)))
    sharp = (F.col("psf") > 0) & (F.col("scale") > 0) & (px < F.col("psf") / 1.5 / F.col("scale"))
    rim = photometry.near_edge(F.col("x"), F.col("y"), F.col("width"), F.col("height"), edge)
    return found.withColumn("fwhm_px", px).where(~F.coalesce(sharp, F.lit(False)) & ~F.coalesce(rim, F.lit(False)))


def passed_quality(sources: DataFrame, quality: DataFrame) -> DataFrame:
    """The sources of frames whose flag is OK. A frame with another flag speaks for no source: list it as affected when writing."""
    return sources.join(quality.where("quality_flag = 'OK'").select("frame_id"), "frame_id", "left_semi")


def frame_quality(shaped: DataFrame, stars: int = STARS, stars_narrow: int = STARS_NARROW) -> DataFrame:
    """Per frame: medians, star count and the quality flag; stars: how many a frame needs, in general and in narrow bands."""
    stats = shaped.groupBy("frame_id").agg(F.count("*").alias("n_raw"), F.median("fwhm").alias("fwhm_median"), F.median("elongation").alias("elongation_median"), F.median("snr").alias("snr_median"), F.count_if(is_star()).alias("star_count"), F.max("background").alias("sky_background"), F.max("filter").alias("filter"))
    return stats.withColumn("quality_flag", quality_flag(stars, stars_narrow))


def quality_flag(stars: Column | int = STARS, stars_narrow: Column | int = STARS_NARROW, fwhm: Column | float = FWHM_MAX, elongation: Column | float = ELONGATION_MAX, background: Column | float = BACKGROUND_MAX) -> Column:
    """LOW_STARS at once under three detections; several issues are BAD; few stars count only where nothing else does. The limits may be columns."""
    blur = F.coalesce(F.col("fwhm_median") > fwhm, F.lit(False))
    trail = F.col("elongation_median") > elongation
    bright = F.col("sky_background") > background
    floor = F.when(names.is_narrowband(F.col("filter")), stars_narrow).otherwise(stars)
    issues = blur.cast("int") + trail.cast("int") + bright.cast("int")
    return F.when(F.col("n_raw") < 3, "LOW_STARS").when(issues.isNull(), "BAD").when(issues >= 2, "BAD").when(blur, "BLUR").when(trail, "TRAIL").when(bright, "HIGH_BACKGROUND").when(F.col("star_count") < floor, "LOW_STARS").otherwise("OK")


def rejections(shaped: DataFrame) -> DataFrame:
    """Per frame: how many detections each criterion rejects, and ranges."""
    count = F.count_if
    return shaped.groupBy("frame_id").agg(count(F.col("elongation") >= STAR_ELONGATION).alias("by_elongation"), count(F.col("fwhm") < STAR_FWHM[0]).alias("by_small"), count(F.col("fwhm") > STAR_FWHM[1]).alias("by_large"), count(F.col("snr") < STAR_SNR).alias("by_snr"), count(F.col("flux") <= 0).alias("by_flux"), F.min("snr").alias("snr_min"), F.max("snr").alias("snr_max"), F.min("fwhm").alias("fwhm_min"), F.max("fwhm").alias("fwhm_max"), F.min("elongation").alias("elongation_min"), F.max("elongation").alias("elongation_max"))


def zero_points(sources: DataFrame) -> DataFrame:
    """Per frame: the median of catalogue minus instrumental magnitude over unsaturated Gaia matches, and its median absolute
    deviation; frames with fewer than three, and narrowband ones, have none. sources: flux, catalog_mag, filter ..."""
    usable = (F.col("catalog_name") == "Gaia DR3") & ~F.coalesce("saturated", F.lit(False)) & (F.col("flux") > 0) & F.col("catalog_mag").isNotNull() & ~F.isnan("catalog_mag")
    diff = F.col("catalog_mag") + 2.5e0 * F.log10(F.when(F.col("flux") > 0, F.col("flux")))
    rows = sources.where(usable & ~names.is_narrowband(F.col("filter"))).select("frame_id", diff.alias("d"))
    centre = rows.groupBy("frame_id").agg(F.median("d").alias("zero_point"), F.count("*").alias("n_ref")).where("n_ref >= 3")
    spread = rows.join(centre, "frame_id").groupBy("frame_id").agg(F.median(F.abs(F.col("d") - F.col("zero_point"))).alias("zero_point_err"))
    return centre.join(spread, "frame_id").select("frame_id", "zero_point", "zero_point_err", "n_ref")


def calibrated(sources: DataFrame, zero: DataFrame) -> DataFrame:
    """Photometric columns of every row; saturated rows are never measured, rows of frames without a zero point stay."""
    rows = sources.drop("mag").join(zero.select("frame_id", "zero_point", "zero_point_err"), "frame_id", "left")
    usable = ~F.coalesce("saturated", F.lit(False))
    return rows.withColumns(photometry.magnitudes(F.col("flux"), F.col("flux_err"), F.col("zero_point"), usable))
