"""Anomaly classification: the rules in order, the first that holds decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import names
from skyloom.operators import epochs, history
from skyloom.sources.lineage import written

DELTA_MAG, DEBRIS_ELONGATION, DEBRIS_EDGE_ELONGATION = 0.5, 3.0, 6.0
# Outcomes that are anomalies.
REPORTED = ["VARIABLE_STAR", "BINARY_STAR", "SUPERNOVA_CANDIDATE", "UNKNOWN", "ASTEROID", "COMET", "MOVING_UNKNOWN", "SPACE_DEBRIS"]
CHANGES = ["SUPERNOVA_CANDIDATE", "BINARY_STAR", "VARIABLE_STAR"]


def outcome(delta_mag: Column | float = DELTA_MAG, debris: Column | float = DEBRIS_ELONGATION, debris_edge: Column | float = DEBRIS_EDGE_ELONGATION) -> Column:
    """The decision over n_history, n_covering, vacated, delta_mag and the source's own columns; the limits may be columns too.

    Outcomes that aren't reported stay visible: FIRST_OBSERVATION, KNOWN_CATALOG_NEW, SUPPRESSED_*, NONE.
    """
    c = F.col
    kind = names.object_class(c("object_type"))
    free = c("catalog_name").isNull()
    edge, none = F.coalesce(c("near_edge"), F.lit(False)), c("n_history") == 0
    limit = F.when(edge, debris_edge).otherwise(debris)
    change = F.abs("delta_mag") > delta_mag
    return (
        F.when(c("catalog_name") == "MPC", F.when(c("object_type") == "ASTEROID", "ASTEROID").otherwise("COMET"))
        .when(free & c("saturated"), "SUPPRESSED_SATURATED")
        .when(free & none & (F.coalesce(c("elongation"), F.lit(0e0)) > limit), "SPACE_DEBRIS")
        .when(free & none & c("vacated"), F.when(edge, "SUPPRESSED_EDGE").otherwise("MOVING_UNKNOWN"))
        .when(c("n_covering") == 0, F.when(~c("from_subtraction"), "FIRST_OBSERVATION").when(edge, "SUPPRESSED_EDGE").when(~free, "SUPPRESSED_CATALOGUED").otherwise("UNKNOWN"))
        .when(none & kind["galaxy"], "SUPERNOVA_CANDIDATE")
        .when(none & free, F.when(edge, "SUPPRESSED_EDGE").otherwise("UNKNOWN"))
        .when(none, "KNOWN_CATALOG_NEW")
        .when(change & (c("delta_mag") < 0) & kind["galaxy"], "SUPERNOVA_CANDIDATE")
        .when(change & kind["binary"], "BINARY_STAR")
        .when(change & kind["variable"], "VARIABLE_STAR")
        .otherwise("NONE")
    )


def classified(current: DataFrame, past: DataFrame, frames: DataFrame, max_fov_deg: float, own: DataFrame | None = None) -> DataFrame:
    """obs_id, frame_id, n_history, n_covering, vacated, delta_mag, outcome of every current row.

    `current` may be one frame's sources or the whole history: the same joins classify all of it at once. History and coverage are counted
    without pairs. The wide cone is searched only for rows without narrow history, the ones that can have left a place; `own` (current, where it
    isn't given) holds all sources of the current rows' frames, which may have stayed there. What several joins use is written once
    to the shared folder; current and past should be tables themselves, since they are read several times.
    """
    narrow = written(epochs.narrow(current, past))
    covered = history.coverage(current, frames, max_fov_deg)
    fresh = current.join(narrow.select("obs_id"), "obs_id", "left_anti")
    moved = history.vacated(fresh, past, current if own is None else own).withColumn("vacated", F.lit(True))
    rows = current.join(narrow, "obs_id", "left").join(covered, "obs_id", "left").join(moved, "obs_id", "left")
    return described(rows)


def described(rows: DataFrame) -> DataFrame:
    """Rows with the outcome that their history, coverage and vacated place give; where these columns are missing, nothing came before."""
    kinds = {"n_history": "long", "n_covering": "long", "vacated": "boolean", "median_mag": "double"}
    rows = rows.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in rows.columns})
    rows = rows.withColumns({"n_history": F.coalesce("n_history", F.lit(0)).cast("long"), "n_covering": F.coalesce("n_covering", F.lit(0)).cast("long"), "vacated": F.coalesce("vacated", F.lit(False)), "delta_mag": F.col("mag") - F.col("median_mag")})
    return rows.withColumn("outcome", outcome())


def anomalies(rows: DataFrame) -> DataFrame:
    """The reported outcomes as anomaly records; delta_mag only where a change was the reason."""
    kept = rows.where(F.col("outcome").isin(REPORTED))
    changed = (F.col("n_history") > 0) & F.col("outcome").isin(CHANGES)
    delta = F.when(changed, F.col("delta_mag"))
    notes = F.when(changed, F.format_string("magnitude changed by %.2f", "delta_mag")).when(F.col("outcome") == "SPACE_DEBRIS", F.format_string("elongation %.2f", "elongation")).otherwise(F.concat(F.lit("no earlier source within 5 arcsec, "), F.col("n_covering").cast("string"), F.lit(" earlier frames")))
    return kept.select("frame_id", F.col("outcome").alias("anomaly_type"), "obs_id", F.coalesce("catalog_id", F.concat(F.lit("obs-"), F.col("obs_id").cast("string"))).alias("source_id"), "ra", "dec", F.col("mag").alias("magnitude"), delta.alias("delta_mag"), F.when(F.col("catalog_name") == "MPC", F.col("catalog_id")).alias("mpc_designation"), notes.alias("notes"), F.col("outcome").isin(names.ALERTS).alias("alert"))


def tallies(found: DataFrame) -> DataFrame:
    """Counts and alerts per frame and type, with totals (null type) and the grand total (null frame)."""
    return found.rollup("frame_id", "anomaly_type").agg(F.count("*").alias("n"), F.count_if("alert").alias("alerts"))
