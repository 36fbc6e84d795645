"""Image work on pixel tables (frame_id, y, x, adu): clipped statistics, stacks, masks, apertures, forced photometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.sources.lineage import written

SATURATION = 60_000.0


def clipped_statistics(pixels: DataFrame, sigma: float = 3.0, rounds: int = 5) -> DataFrame:
    """Per frame: n, median, mean, stddev after rounds of clipping around the median; a round that clips nothing changes nothing.

    Each round's limits are written (a row for each frame), so a round reads the pixels once and the plan doesn't grow with the rounds.
    """
    state = None
    for _ in range(rounds):
        kept = pixels if state is None else pixels.join(state, "frame_id").where((F.col("adu") >= F.col("low")) & (F.col("adu") <= F.col("high")))
        centre = kept.groupBy("frame_id").agg(F.median("adu").alias("m"), F.stddev_pop("adu").alias("s"))
        low, high = F.col("m") - sigma * F.col("s"), F.col("m") + sigma * F.col("s")
        if state is None:
            state = centre.select("frame_id", low.alias("low"), high.alias("high"))
        else:
            state = centre.join(state, "frame_id").select("frame_id", F.greatest("low", low).alias("low"), F.least("high", high).alias("high"))
        state = written(state)
    kept = pixels.join(state, "frame_id").where((F.col("adu") >= F.col("low")) & (F.col("adu") <= F.col("high")))
    return kept.groupBy("frame_id").agg(F.count("*").alias("n"), F.median("adu").alias("median"), F.mean("adu").alias("mean"), F.stddev_pop("adu").alias("stddev"))


def difference(pixels: DataFrame, references: DataFrame, min_frames: int = 3) -> DataFrame:
    """frame_id, y, x, diff: each frame less the per-pixel median of its reference frames (frame_id, reference_id), aligned already."""
    enough = references.groupBy("frame_id").count().where(F.col("count") >= min_frames).select("frame_id")
    wanted = references.join(enough, "frame_id", "left_semi")
    stack = wanted.join(pixels.withColumnsRenamed({"frame_id": "reference_id", "adu": "r"}), "reference_id").groupBy("frame_id", "y", "x").agg(F.median("r").alias("reference"))
    return pixels.join(stack, ["frame_id", "y", "x"]).select("frame_id", "y", "x", (F.col("adu") - F.col("reference")).alias("diff"))


def saturation_mask(pixels: DataFrame, radius_px: int, level: float = SATURATION) -> DataFrame:
    """frame_id, y, x of all pixels within a square of saturated ones; only these are spread, not the image."""
    steps = F.sequence(F.lit(-radius_px), F.lit(radius_px))
    hot = pixels.where(F.col("adu") >= level).select("frame_id", "y", "x")
    rows = hot.select("frame_id", "x", F.explode(F.transform(steps, lambda d: F.col("y") + d)).alias("y"))
    grown = rows.select("frame_id", "y", F.explode(F.transform(steps, lambda d: F.col("x") + d)).alias("x")).distinct()
    return grown.join(pixels.select("frame_id", "y", "x"), ["frame_id", "y", "x"], "left_semi")


def mask_radius(scale_arcsec: float, radius_arcsec: float = 10.0) -> int:
    return max(1, round(radius_arcsec / scale_arcsec))


def exceeding(diff: DataFrame, rms: DataFrame, mask: DataFrame, sigma: float = 5.0) -> DataFrame:
    """Difference pixels above sigma times their frame's rms and outside the mask."""
    return diff.join(mask, ["frame_id", "y", "x"], "left_anti").join(rms, "frame_id").where(F.col("diff") > sigma * F.col("rms")).select("frame_id", "y", "x", "diff")


def apertures(pixels: DataFrame, spots: DataFrame, size: DataFrame, block: int = 64, margin: int = 1) -> DataFrame:
    """spot_id, frame_id, net, area, background, sigma, err, hot of each spot (spot_id, frame_id, sx, sy, fwhm_px).

    Aperture of 2 widths, annulus of 4 to 6 (3 px where unknown), pixel centres decide. Spots probe the blocks of pixels
    that their annulus touches, so the range join is an equi-join. Spots whose box leaves the frame (size: frame_id, width,
    height) have null results.
    """
    w = F.when(F.col("fwhm_px") > 0, F.col("fwhm_px")).otherwise(3e0)
    s = spots.withColumns({"r_ap": 2 * w, "r_in": 4 * w, "r_out": 6 * w}).withColumn("half", F.ceil("r_out") + margin)
    s = s.join(size, "frame_id").withColumn("fits", (F.col("sx") - F.col("half") >= 0) & (F.col("sy") - F.col("half") >= 0) & (F.col("sx") + F.col("half") < F.col("width")) & (F.col("sy") + F.col("half") < F.col("height")))
    span = lambda c: F.sequence(F.floor((F.col(c) - F.col("r_out")) / block), F.floor((F.col(c) + F.col("r_out")) / block))
    probe = s.where("fits").withColumn("bx", F.explode(span("sx"))).withColumn("by", F.explode(span("sy")))
    cells = pixels.withColumns({"bx": F.floor(F.col("x") / block), "by": F.floor(F.col("y") / block)})
    d2 = (F.col("x") - F.col("sx")) * (F.col("x") - F.col("sx")) + (F.col("y") - F.col("sy")) * (F.col("y") - F.col("sy"))
    near = probe.join(cells, ["frame_id", "bx", "by"]).withColumn("d2", d2).where("d2 <= r_out * r_out")
    inner = F.col("d2") <= F.col("r_ap") * F.col("r_ap")
    ring = F.col("d2") >= F.col("r_in") * F.col("r_in")
    got = near.groupBy("spot_id").agg(F.sum(F.when(inner, F.col("adu"))).alias("total"), F.count_if(inner).alias("area"), F.median(F.when(ring, F.col("adu"))).alias("background"), F.stddev_pop(F.when(ring, F.col("adu"))).alias("sigma"), F.max("adu").alias("peak"))
    net = F.col("total") - F.col("background") * F.col("area")
    out = s.select("spot_id", "frame_id").join(got, "spot_id", "left")
    return out.select("spot_id", "frame_id", net.alias("net"), "area", "background", "sigma", F.sqrt(F.abs(net) + F.col("area") * F.col("sigma") * F.col("sigma")).alias("err"), (F.col("peak") >= SATURATION).alias("hot"))


def forced(measured: DataFrame, spots: DataFrame, zero_point: Column, min_snr: float = 3.0) -> DataFrame:
    """Measurements at known positions that are sure enough, as source rows."""
    m = measured.where("net > 0 AND err > 0 AND NOT hot").where(F.col("net") / F.col("err") >= min_snr)
    return m.join(spots.drop("frame_id"), "spot_id").select("spot_id", "frame_id", "ra", "dec", F.col("net").alias("flux"), F.col("err").alias("flux_err"), (F.col("net") / F.col("err")).alias("snr"), (zero_point - 2.5 * F.log10(F.col("net"))).alias("mag"), F.lit(1e0).alias("elongation"), F.lit(True).alias("forced"))


def not_recovered(catalog: DataFrame, matched: DataFrame, mag_limit: float = 20.0) -> DataFrame:
    """Gaia rows in a frame's field no fainter than the limit, and MPC rows, that the frame has no match for."""
    wanted = catalog.where(((F.col("catalog_name") == "Gaia DR3") & (F.col("catalog_mag") <= mag_limit)) | (F.col("catalog_name") == "MPC"))
    return wanted.join(matched.select("frame_id", "catalog_name", "catalog_id").distinct(), ["frame_id", "catalog_name", "catalog_id"], "left_anti")
