"""Header ingest: 80-byte cards of image files to frame rows, without an image library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import names
from skyloom.sources.heads import CARD, HeadSource

# Keywords of each field, the first that is there and not blank counts.
ALIASES = {
    "object": ["OBJECT", "OBJNAME", "TARGET"],
    "exptime": ["EXPTIME", "EXPOSURE"],
    "filter": ["FILTER", "FILTNAM", "FILTERID"],
    "frame_type": ["IMAGETYP", "FRAME"],
    "airmass": ["AIRMASS"],
    "telescope": ["TELESCOP"],
    "camera": ["INSTRUME", "CAMERA"],
    "focal_length_mm": ["FOCALLEN"],
    "aperture_mm": ["APTDIA", "APERTURE"],
    "temp_celsius": ["CCD-TEMP", "CCDTEMP"],
    "temp_setpoint_celsius": ["SET-TEMP"],
    "binning_x": ["XBINNING", "BINNING"],
    "binning_y": ["YBINNING", "BINNING"],
    "gain": ["GAIN", "EGAIN"],
    "offset": ["OFFSET"],
    "width_px": ["NAXIS1"],
    "height_px": ["NAXIS2"],
    "pixel_size_um": ["XPIXSZ", "PIXSIZE", "PIXSCALE1", "PIXELSZ"],
    "observer_name": ["OBSERVER", "AUTHOR"],
    "site_name": ["SITENAME", "OBSERVAT"],
    "site_lat": ["SITELAT"],
    "site_lon": ["SITELONG"],
    "site_elev_m": ["SITEELEV"],
    "capture": ["SWCREATE", "SOFTWARE"],
    "ra_text": ["RA", "OBJCTRA"],
    "dec_text": ["DEC", "OBJCTDEC"],
    "date_obs": ["DATE-OBS"],
    "time_obs": ["TIME-OBS"],
    "mjd_obs": ["MJD-OBS"],
}
GROUPS = {
    "observation": {"object": "string", "exptime": "double", "filter": "string", "frame_type": "string", "airmass": "double"},
    "instrument": {"telescope": "string", "camera": "string", "focal_length_mm": "double", "aperture_mm": "double"},
    "sensor": {"temp_celsius": "double", "temp_setpoint_celsius": "double", "binning_x": "int", "binning_y": "int", "gain": "double", "offset": "double", "width_px": "int", "height_px": "int", "pixel_size_um": "double"},
    "observer": {"observer_name": "string", "site_name": "string", "site_lat": "double", "site_lon": "double", "site_elev_m": "double"},
    "software": {"capture": "string"},
}


def header_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, header of all .fits and .fit files below a folder; the header is null where a file has none. No image is read (see `heads`)."""
    spark.dataSource.register(HeadSource)
    return spark.read.format("image_heads").option("path", path).load().select("path", "header")


def header_stream(spark: SparkSession, path: str) -> DataFrame:
    """The same as a stream of the files that come."""
    spark.dataSource.register(HeadSource)
    return spark.readStream.format("image_heads").option("path", path).load().select("path", F.timestamp_micros("modified").alias("modified"), "header")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once a row: a lambda that names an expression works it out anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _all_cards(header: Column) -> Column:
    return F.regexp_extract_all(header, F.lit(rf"(?s)\A.{{0,{CARD - 1}}}\z|.{{{CARD}}}"), F.lit(0))  # one pass; substring would count from the start for each


def _before_end(all_cards: Column) -> Column:
    """The cards before END, or all where there is none."""
    end = F.array_position(F.transform(all_cards, lambda c: F.rtrim(F.substring(c, F.lit(1), F.lit(8)))), "END")
    return F.when(end > 0, F.slice(all_cards, F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))).otherwise(all_cards)


def cards(header: Column) -> Column:
    """Keyword to value: quotes and comments taken off, doubled quotes made single, the first of repeated keywords."""
    quoted = r"^= +'((?:[^']|'')*)'"
    def entry(c: Column) -> Column:
        body = F.substring(c, F.lit(9), F.lit(CARD - 8))
        text = F.replace(F.regexp_extract(body, quoted, 1), F.lit("''"), F.lit("'"))
        plain = F.trim(F.regexp_extract(body, r"^= ([^/]*)", 1))
        return F.struct(F.rtrim(F.substring(c, F.lit(1), F.lit(8))).alias("key"), F.when(body.rlike(quoted), F.rtrim(text)).otherwise(plain).alias("value"))
    # the first of a keyword: by sorting on keyword and place, each entry is held against its neighbour alone
    def first(numbered: Column) -> Column:
        kept = F.filter(numbered, lambda e, i: (i == 0) | (F.get(numbered, i - 1)["key"] != e["key"]))
        return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))))
    def read(used: Column) -> Column:
        entries = F.transform(F.filter(used, lambda c: F.substring(c, F.lit(9), F.lit(2)) == "= "), entry)
        return F.array_sort(F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("at"), e["value"].alias("value"))))
    return _bound(_bound(_all_cards(header), lambda every: read(_before_end(every))), first)


def frames(headers: DataFrame) -> DataFrame:
    """path and the nested groups; unreadable values are null. `headers` holds path and header."""
    rows = headers.withColumn("cards", cards(F.col("header")))
    def first(field: str) -> Column:
        return F.coalesce(*[F.when(F.trim(v) != "", F.trim(v)) for v in (F.try_element_at("cards", F.lit(k)) for k in ALIASES[field])])
    def cast(field: str, kind: str) -> Column:
        value = first(field)
        return value if kind == "string" else value.try_cast("double").cast("int") if kind == "int" else value.try_cast(kind)
    groups = [F.struct(*[cast(f, kind).alias(f) for f, kind in fields.items()]).alias(name) for name, fields in GROUPS.items()]
    obs_time = names.observed_at(first("date_obs"), first("time_obs"), first("mjd_obs"))
    return rows.select("path", obs_time.alias("obs_time"), F.coalesce(first("date_obs"), first("time_obs")).alias("obs_time_raw"), names.degrees_of(first("ra_text"), True).alias("ra"), names.degrees_of(first("dec_text"), False).alias("dec"), names.object_name(first("object")).alias("object_name"), names.filter_name(first("filter")).alias("filter_name"), names.frame_type(first("frame_type")).alias("frame_type"), *groups)


def science_frames(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frames that go on, and calibration frames, which leave the flow."""
    calibration = F.coalesce(F.col("frame_type").isin("Dark", "Flat", "Bias"), F.lit(False))
    return rows.where(~calibration), rows.where(calibration)
