"""Thresholds as a table: a run may hold many settings rows, so what-if sweeps are joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that may be changed, with their kind and default.
SETTINGS = {
    "QC_FWHM_MAX_ARCSEC": ("float", "8.0"),
    "QC_ELONGATION_MAX": ("float", "2.0"),
    "QC_SNR_MIN": ("float", "5.0"),
    "QC_STARS_MIN": ("int", "10"),
    "QC_SKY_BACKGROUND_MAX": ("float", "50000"),
    "QC_STARS_MIN_NARROWBAND": ("int", "5"),
    "STAR_FWHM_MIN_ARCSEC": ("float", "2.5"),
    "STAR_FWHM_MAX_ARCSEC": ("float", "8.0"),
    "STAR_ELONGATION_MAX": ("float", "1.5"),
    "STAR_SNR_MIN": ("float", "50.0"),
    "SEP_DETECT_THRESH": ("float", "10.0"),
    "SEP_MIN_AREA": ("int", "15"),
    "STREAK_DETECT_SIGMA": ("float", "3.0"),
    "STREAK_ELONGATION_MIN": ("float", "5.0"),
    "STREAK_MIN_LENGTH_ARCSEC": ("float", "30.0"),
    "STREAK_MASK_DILATE_ARCSEC": ("float", "3.0"),
    "SATURATION_ADU": ("float", "60000"),
    "SATURATION_MASK_RADIUS_ARCSEC": ("float", "10.0"),
    "MATCH_CONE_ARCSEC": ("float", "5.0"),
    "MOVING_CONE_ARCSEC": ("float", "120.0"),
    "DELTA_MAG_ALERT": ("float", "0.5"),
    "MPC_MAG_LIMIT": ("float", "19.0"),
    "EDGE_MARGIN_FRAC": ("float", "0.05"),
    "SPACE_DEBRIS_ELONGATION_MIN": ("float", "3.0"),
    "SPACE_DEBRIS_EDGE_ELONGATION_MIN": ("float", "6.0"),
    "SUBTRACTION_MIN_FRAMES": ("int", "3"),
    "SUBTRACTION_DETECT_SIGMA": ("float", "5.0"),
    "SUBTRACTION_PREROTATE_MIN_DEG": ("float", "2.0"),
    "FORCED_PHOTOMETRY_ENABLED": ("bool", "true"),
    "FORCED_PHOTOMETRY_MAG_LIMIT": ("float", "20.0"),
    "FORCED_PHOTOMETRY_MIN_SNR": ("float", "3.0"),
    "SITE_LAT": ("float", "0.0"),
    "SITE_LON": ("float", "0.0"),
    "SITE_ELEV": ("int", "0"),
    "CHART_ENABLED": ("bool", "true"),
    "CHART_STAMP_SIZE_ARCSEC": ("float", "60.0"),
    "CHART_MAX_EPOCHS": ("int", "12"),
    "CHART_GIF_ENABLED": ("bool", "true"),
    "CHART_GIF_FRAME_DURATION_MS": ("int", "700"),
    "CHART_PREROTATE_MIN_DEG": ("float", "2.0"),
    "NORMALIZE_ENABLED": ("bool", "true"),
    "CACHE_TTL_HOURS": ("float", "1.0"),
    "WATCHER_DEBOUNCE_SEC": ("float", "5.0"),
    "WATCHER_MAX_BATCH_SIZE": ("int", "200"),
    "TASK_POLL_INTERVAL_SEC": ("float", "10.0"),
    "TASK_POLL_BACKOFF_MAX_SEC": ("float", "60.0"),
    "LOG_LEVEL": ("upper", "INFO"),
    "ASTAP_FOV_HINT": ("float", "0"),
    "ASTAP_RETRY_WIDE_SEARCH": ("bool", "true"),
    "ASTAP_WIDE_SEARCH_RADIUS_DEG": ("float", "30"),
    "ASTAP_TIMEOUT_SEC": ("float", "60"),
    "ASTAP_WIDE_SEARCH_TIMEOUT_SEC": ("float", "240"),
    "NARROWBAND_FILTERS": ("set", "Ha,OIII,SII,NII"),
}


def known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, kind, d) for k, (kind, d) in SETTINGS.items()], "param string, kind string, default string")


def typed(raw: Column, kind: Column) -> Column:
    """The value as canonical text, null where it can't be read as its kind."""
    text = F.trim(raw)
    members = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")))
    return (
        F.when(kind == "float", text.try_cast("double").cast("string"))
        .when(kind == "int", F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("long").cast("string")))
        .when(kind == "bool", F.lower(text).isin("true", "1", "yes").cast("string"))
        .when(kind == "upper", F.upper(text))
        .otherwise(F.array_join(members, ","))
    )


def applied(params: DataFrame) -> DataFrame:
    """params(run, param, value) -> a row for each run and known parameter: value (typed, or the default) and whether it was given.

    Unknown parameters and unreadable values are ignored. The table of known ones has a fixed size.
    """
    names = known(params.sparkSession)
    runs = params.select("run").distinct()
    given = params.join(F.broadcast(names.select("param", "kind")), "param").withColumn("v", typed(F.col("value"), F.col("kind"))).where("v IS NOT NULL").groupBy("run", "param").agg(F.max("v").alias("v"))
    every = runs.crossJoin(F.broadcast(names))
    out = every.join(given, ["run", "param"], "left")
    return out.select("run", "param", F.coalesce("v", typed(F.col("default"), F.col("kind"))).alias("value"), F.col("v").isNotNull().alias("given"))


def one_row(values: DataFrame, *params: str) -> DataFrame:
    """A column per parameter and a row per run."""
    return values.where(F.col("param").isin(*params)).groupBy("run").pivot("param", list(params)).agg(F.first("value"))
