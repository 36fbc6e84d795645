"""Catalogue extracts brought to one row shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import names

COLUMNS = ["catalog_name", "prio", "catalog_id", "ra", "dec", "catalog_mag", "object_type", "pmra", "pmdec", "ref_epoch"]
MPC_MAG_LIMIT = 19.0


def _finite(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def _shape(df: DataFrame, name: str, prio: int, **given: Column) -> DataFrame:
    kinds = {"catalog_id": "string", "object_type": "string"}
    made = {c: given.get(c, F.lit(None)).cast(kinds.get(c, "double")) for c in COLUMNS[2:]}
    return df.select(F.lit(name).alias("catalog_name"), F.lit(prio).alias("prio"), *[made[c].alias(c) for c in COLUMNS[2:]])


def gaia(df: DataFrame) -> DataFrame:
    """Rows with a finite magnitude. Ids stay text: they exceed what a double holds. The reference epoch is 2016 unless given."""
    return _shape(df.where(_finite("phot_g_mean_mag")), "Gaia DR3", 1, catalog_id=F.col("source_id"), ra=F.col("ra"), dec=F.col("dec"), catalog_mag=F.col("phot_g_mean_mag"), object_type=F.lit("STAR"), pmra=F.col("pmra"), pmdec=F.col("pmdec"), ref_epoch=F.coalesce("ref_epoch", F.lit(2016e0)))


def simbad(df: DataFrame) -> DataFrame:
    """Sexagesimal positions; no magnitude."""
    return _shape(df, "Simbad", 0, catalog_id=F.col("main_id"), ra=names.degrees_of(F.col("ra"), True), dec=names.degrees_of(F.col("dec"), False), object_type=F.col("otype"))


def twomass(df: DataFrame) -> DataFrame:
    """Rows with a finite J magnitude; a missing designation is made from the position."""
    made = F.concat(F.lit("2MASS J"), F.format_string("%.5f", "ra"), F.format_string("%+.5f", "dec"))
    return _shape(df.where(_finite("j_mag")), "2MASS", 2, catalog_id=F.coalesce(F.when(F.trim("designation") != "", F.trim("designation")), made), ra=F.col("ra"), dec=F.col("dec"), catalog_mag=F.col("j_mag"), object_type=F.lit("STAR"))


def panstarrs(df: DataFrame) -> DataFrame:
    return _shape(df.where(_finite("r_mag")), "Pan-STARRS", 3, catalog_id=F.concat(F.lit("PS1 "), F.col("obj_id").cast("string")), ra=F.col("ra"), dec=F.col("dec"), catalog_mag=F.col("r_mag"), object_type=F.lit("STAR"))


def mpc(df: DataFrame, limit: float = MPC_MAG_LIMIT) -> DataFrame:
    """Movers: those without a magnitude stay. A class that says comet is a COMET, else an ASTEROID."""
    kind = F.when(F.lower(F.coalesce("object_class", F.lit(""))).contains("comet"), "COMET").otherwise("ASTEROID")
    return _shape(df.where(F.col("v_mag").isNull() | (F.col("v_mag") <= limit)), "MPC", 4, catalog_id=F.col("designation"), ra=F.col("ra"), dec=F.col("dec"), catalog_mag=F.col("v_mag"), object_type=kind)
