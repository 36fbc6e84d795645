"""Queries of the survey operators over the derived sky tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import names, sky
from skyloom.operators import calibration, classify, dedup, ephemeris, epochs, history, matching, pixels, recovery, tracks, whatif
from skyloom.operators.cone import cone_pairs, renamed
from skyloom.plans.fixtures import PIXELS_SQL, clauses
from skyloom.plans.fixtures import pixels as pixel_table
from skyloom.plans.fixtures import sky as derived
from skyloom.plans.registry import query, separation_sql, table
from skyloom.sources import headers, heads, settings, store
from skyloom.sources.lineage import shared_folder, written
from skyloom.streaming import arrivals, detection

FOV = 1.0
SEP = separation_sql("s.ra", "s.dec", "k.ra", "k.dec")
NEAR_DEC = "abs(s.dec - k.dec) < 5e-2"


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return derived(spark, sf_dir, "sources"), derived(spark, sf_dir, "catalog")


# Matching ------------------------------------------------------------------------------------------------------------

@query(
    f"""WITH {clauses("frames", "catalog")} SELECT f.frame_id, k.catalog_name, k.catalog_id, round({separation_sql("f.ra_center", "f.dec_center", "k.ra", "k.dec")}, 6) AS sep_arcsec FROM frames f JOIN catalog k ON abs(f.dec_center - k.dec) < 1.1e0
 WHERE {separation_sql("f.ra_center", "f.dec_center", "k.ra", "k.dec")} <= CASE k.catalog_name WHEN 'Simbad' THEN 5e-1 WHEN 'MPC' THEN 1e0 ELSE 5e-1 * sqrt(2e0) END * f.fov_deg * 3.6e3 AND (k.catalog_name <> 'Pan-STARRS' OR f.dec_center >= -3e1)"""
)
def j01_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.footprint(derived(spark, sf_dir, "frames"), derived(spark, sf_dir, "catalog"), FOV, digits=6)


@query(
    f"""WITH {clauses("sources", "catalog")}, p AS (SELECT s.obs_id, k.catalog_id, {SEP} AS sep FROM sources s JOIN catalog k ON {NEAR_DEC} AND k.catalog_name = 'Gaia DR3')
 SELECT obs_id, catalog_id, round(sep, 6) AS sep_arcsec FROM (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY sep, catalog_id) AS r FROM p WHERE sep < 5) WHERE r = 1"""
)
def j02_nearest_gaia(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = _two(spark, sf_dir)
    return matching.nearest(s, k.where("catalog_name = 'Gaia DR3'")).withColumn("sep_arcsec", F.round("sep_arcsec", 6))


MATCHED = f"""pairs AS (SELECT s.obs_id, s.frame_id, k.*, {SEP} AS sep FROM sources s JOIN catalog k ON {NEAR_DEC}),
first AS (SELECT obs_id, catalog_name, catalog_id, catalog_mag, object_type, sep FROM (SELECT *, row_number() OVER (PARTITION BY obs_id ORDER BY prio, sep, catalog_id) AS r FROM pairs WHERE sep < 5 AND catalog_name <> 'MPC') WHERE r = 1),
chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY frame_id, catalog_id ORDER BY sep, obs_id) AS r FROM pairs WHERE sep < 120 AND catalog_name = 'MPC' AND obs_id NOT IN (SELECT obs_id FROM first)) WHERE r = 1),
movers AS (SELECT obs_id, catalog_name, catalog_id, cast(NULL AS double) AS catalog_mag, object_type, sep FROM (SELECT * EXCLUDE (r), row_number() OVER (PARTITION BY obs_id ORDER BY sep, catalog_id) AS r FROM chosen) WHERE r = 1),
matched AS (SELECT * FROM first UNION ALL SELECT * FROM movers)"""


@query(f"WITH {clauses('sources', 'catalog')}, {MATCHED} SELECT obs_id, catalog_name, catalog_id, catalog_mag, object_type, round(sep, 6) AS sep_arcsec FROM first")
def j03_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.cascade(*_two(spark, sf_dir)).withColumn("sep_arcsec", F.round("sep_arcsec", 6))


@query(f"WITH {clauses('sources', 'catalog')}, {MATCHED} SELECT obs_id, catalog_name, catalog_id, catalog_mag, object_type, round(sep, 6) AS sep_arcsec FROM movers")
def j04_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = _two(spark, sf_dir)
    return matching.movers(s, k, matching.cascade(s, k)).withColumn("sep_arcsec", F.round("sep_arcsec", 6))


#: A mover for each user, with a knot at noon of each day that has events, half a degree of way a day; some cross RA 0.
KNOTS = """SELECT concat('K', cast(user_id AS string)) AS designation, cast(cast(ts AS date) AS timestamp) + interval '12' hour AS knot_at,
 (min(ra0) + (day(cast(ts AS date)) - 15) * 3e-1 + 36e1) % 36e1 AS ra, min(dec0) + (day(cast(ts AS date)) - 15) * 1e-1 AS dec, CASE WHEN user_id % 4 = 0 THEN NULL ELSE 15e0 + user_id % 8 + day(cast(ts AS date)) / 1e1 END AS mag,
 CASE WHEN user_id % 2 = 0 THEN 'COMET' ELSE 'ASTEROID' END AS object_type FROM (SELECT *, obs_ts AS ts FROM sky_obs) GROUP BY user_id, cast(ts AS date)"""
_W = lambda n: f"CASE WHEN w < 1e-9 THEN (1e0 - h) * {n}0 + h * {n}1 ELSE (sin((1e0 - h) * w) * {n}0 + sin(h * w) * {n}1) / sin(w) END"
_U = lambda k: f"cos(radians(dec{k})) * cos(radians(ra{k})) AS x{k}, cos(radians(dec{k})) * sin(radians(ra{k})) AS y{k}, sin(radians(dec{k})) AS z{k}"
PREDICTED = f"""knots AS ({KNOTS}), way AS (SELECT *, {_U(0)}, {_U(1)} FROM (SELECT designation, epoch_us(knot_at) AS t0, ra AS ra0, dec AS dec0, mag AS mag0, object_type, CASE WHEN near THEN epoch_us(at1) ELSE epoch_us(knot_at) END AS t1, CASE WHEN near THEN ra1 ELSE ra END AS ra1, CASE WHEN near THEN dec1 ELSE dec END AS dec1, CASE WHEN near THEN mag1 ELSE mag END AS mag1
 FROM (SELECT *, coalesce(epoch_us(at1) - epoch_us(knot_at) <= 10 * 86400000000, false) AS near FROM (SELECT *, lead(knot_at) OVER v AS at1, lead(ra) OVER v AS ra1, lead(dec) OVER v AS dec1, lead(mag) OVER v AS mag1 FROM knots WINDOW v AS (PARTITION BY designation ORDER BY knot_at))))),
 turned AS (SELECT frame_id, ra_center, dec_center, fov_deg, way.*, CASE WHEN t1 > t0 THEN (epoch_us(obs_time) - t0) / (t1 - t0) ELSE 0e0 END AS h, 2e0 * asin(least(1e0, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2 + (z1 - z0) ** 2) / 2e0)) AS w
 FROM frames JOIN way ON epoch_us(obs_time) >= t0 AND (epoch_us(obs_time) < t1 OR t0 = t1 AND epoch_us(obs_time) = t0) AND abs(dec_center - dec0) < 5),
 spot AS (SELECT *, {_W("x")} AS x, {_W("y")} AS y, {_W("z")} AS z FROM turned),
 there AS (SELECT frame_id, designation AS catalog_id, (degrees(atan2(y, x)) + 36e1) % 36e1 AS ra, degrees(asin(greatest(-1e0, least(1e0, z / sqrt(x * x + y * y + z * z))))) AS dec, mag0 + (mag1 - mag0) * h AS mag, object_type, ra_center, dec_center, fov_deg FROM spot),
 predicted AS (SELECT *, {separation_sql("ra_center", "dec_center", "ra", "dec")} AS sep_arcsec FROM there WHERE {separation_sql("ra_center", "dec_center", "ra", "dec")} <= fov_deg * 3.6e3)"""


def _knots(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"WITH {clauses('sky_obs')} {KNOTS}".replace("FROM events", "FROM {events}")
    return spark.sql(text, events=table(spark, sf_dir, "events")).withColumnRenamed("knot_at", "at")


@query(f"WITH {clauses('frames')}, {PREDICTED} SELECT frame_id, catalog_id, round(ra, 6) AS ra, round(dec, 6) AS dec, round(mag, 6) AS mag, object_type, round(sep_arcsec, 4) AS sep_arcsec FROM predicted WHERE mag IS NULL OR mag <= 19")
def j01_predicted_movers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movers in the field of each frame at its own time."""
    found = ephemeris.predicted(derived(spark, sf_dir, "frames"), _knots(spark, sf_dir), FOV, mag_limit=19.0)
    return found.select("frame_id", "catalog_id", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"), F.round("mag", 6).alias("mag"), "object_type", F.round("sep_arcsec", 4).alias("sep_arcsec"))


@query(
    f"""WITH {clauses("frames", "catalog", "sources")}, {MATCHED}, {PREDICTED}, met AS (SELECT s.obs_id, s.frame_id, k.catalog_id, k.object_type, {separation_sql("s.ra", "s.dec", "k.ra", "k.dec")} AS sep FROM sources s JOIN predicted k ON k.frame_id = s.frame_id WHERE {separation_sql("s.ra", "s.dec", "k.ra", "k.dec")} < 1200 AND s.obs_id NOT IN (SELECT obs_id FROM first)),
 taken AS (SELECT * FROM met QUALIFY row_number() OVER (PARTITION BY frame_id, catalog_id ORDER BY sep, obs_id) = 1)
 SELECT obs_id, catalog_id, object_type, round(sep, 4) AS sep_arcsec FROM taken QUALIFY row_number() OVER (PARTITION BY obs_id ORDER BY sep, catalog_id) = 1"""
)
def j04_movers_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide cone of a third of a degree, since the derived movers pass by no detection on purpose."""
    s, k = _two(spark, sf_dir)
    there = ephemeris.predicted(derived(spark, sf_dir, "frames"), _knots(spark, sf_dir), FOV)
    got = ephemeris.movers_in_time(s, there, matching.cascade(s, k), 1200.0)
    return got.select("obs_id", "catalog_id", "object_type", F.round("sep_arcsec", 4).alias("sep_arcsec"))


DX = "(CASE WHEN k.ra - s.ra > 18e1 THEN k.ra - s.ra - 36e1 WHEN k.ra - s.ra < -18e1 THEN k.ra - s.ra + 36e1 ELSE k.ra - s.ra END) * cos(radians((s.dec + k.dec) / 2e0)) * 3.6e3"
OFFSET_PAIRS = f"pairs AS (SELECT s.obs_id, s.frame_id, k.catalog_id AS cat_catalog_id, {SEP} AS sep_arcsec, {DX} AS dx, (k.dec - s.dec) * 3.6e3 AS dy FROM sources s JOIN catalog k ON {NEAR_DEC} AND k.catalog_name = 'Gaia DR3' WHERE {SEP} < 90)"


@query(f"WITH {clauses('sources', 'catalog')}, {OFFSET_PAIRS} SELECT obs_id, frame_id, cat_catalog_id AS catalog_id, round(sep_arcsec, 6) AS sep_arcsec, round(dx, 6) AS dx, round(dy, 6) AS dy FROM pairs")
def j05_offset_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = matching.offset_pairs(*_two(spark, sf_dir))
    return p.select("obs_id", "frame_id", F.col("cat_catalog_id").alias("catalog_id"), *[F.round(c, 6).alias(c) for c in ("sep_arcsec", "dx", "dy")])


@query(
    f"""WITH {clauses("sources", "catalog")}, near AS (SELECT s.frame_id, s.obs_id, min({SEP}) AS sep FROM sources s JOIN catalog k ON {NEAR_DEC} AND {SEP} < 90 GROUP BY ALL)
 SELECT frame_id, round(min(sep), 6) AS sep_min, round(median(sep), 6) AS sep_median, round(max(sep), 6) AS sep_max, count(*) FILTER (sep <= 5) AS within_5, count(*) FILTER (sep <= 10) AS within_10, count(*) FILTER (sep <= 30) AS within_30, count(*) FILTER (sep <= 60) AS within_60 FROM near GROUP BY frame_id"""
)
def a04_separation_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = matching.separation_profile(*_two(spark, sf_dir))
    return p.withColumns({c: F.round(c, 6) for c in ("sep_min", "sep_median", "sep_max")})


def a05_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all frames of an object vote together here: the derived frames have too few sources each."""
    s, k = _two(spark, sf_dir)
    s = s.select("obs_id", F.col("object").alias("frame_id"), F.pmod(F.col("ra") + 10e0 / 3.6e3, F.lit(36e1)).alias("ra"), (F.col("dec") - 7e0 / 3.6e3).alias("dec"))
    return matching.offsets(matching.offset_votes(s, k)).withColumns({"dx": F.round("dx", 4), "dy": F.round("dy", 4)})


@query(
    f"""WITH {clauses("sources", "catalog")}, {MATCHED}, r AS (SELECT s.frame_id, m.catalog_name FROM sources s LEFT JOIN matched m ON m.obs_id = s.obs_id)
 SELECT frame_id, count(*) AS n_sources, count(catalog_name) AS n_matched, count(*) FILTER (catalog_name = 'Simbad') AS n_simbad, count(*) FILTER (catalog_name = 'Gaia DR3') AS n_gaia, count(*) FILTER (catalog_name = '2MASS') AS n_2mass, count(*) FILTER (catalog_name = 'Pan-STARRS') AS n_panstarrs, count(*) FILTER (catalog_name = 'MPC') AS n_mpc,
 count(catalog_name) / count(*) AS match_rate, count(catalog_name) / count(*) < 5e-2 AND count(*) >= 20 AS low_rate FROM r GROUP BY frame_id"""
)
def a07_match_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = _two(spark, sf_dir)
    return matching.tallies(s, matching.matched(s, k))


# History and classification ------------------------------------------------------------------------------------------

HISTORY = f"""hist AS (SELECT s.obs_id, s.frame_id, s.filter, k.obs_id AS h_obs_id, k.ra AS h_ra, k.dec AS h_dec, k.mag AS h_mag, k.filter AS h_filter, {SEP} AS sep FROM sources s JOIN sources k ON {NEAR_DEC} AND k.obs_time < s.obs_time WHERE {SEP} <= 120),
narrow AS (SELECT obs_id, count(*) AS n_history, median(CASE WHEN filter = h_filter THEN h_mag END) AS median_mag FROM hist WHERE sep <= 5 GROUP BY obs_id)"""
TILES = f"""tiles AS (SELECT DISTINCT round_even(ra / 1e-1, 0) * 1e-1 AS t_ra, round_even(dec / 1e-1, 0) * 1e-1 AS t_dec, obs_time FROM sources),
covering AS (SELECT t.t_ra, t.t_dec, t.obs_time, count(*) AS n_covering FROM tiles t JOIN frames f ON abs(t.t_dec - f.dec_center) < 6e-1 AND f.obs_time < t.obs_time AND {separation_sql("t.t_ra", "t.t_dec", "f.ra_center", "f.dec_center")} <= f.fov_deg / 2 * 3.6e3 GROUP BY ALL),
covered AS (SELECT s.obs_id, c.n_covering FROM sources s JOIN covering c ON c.t_ra = round_even(s.ra / 1e-1, 0) * 1e-1 AND c.t_dec = round_even(s.dec / 1e-1, 0) * 1e-1 AND c.obs_time = s.obs_time)"""
VACATED = f"""spots AS (SELECT DISTINCT frame_id, h_obs_id, h_ra, h_dec FROM hist WHERE obs_id NOT IN (SELECT obs_id FROM narrow)),
taken AS (SELECT DISTINCT p.frame_id, p.h_obs_id FROM spots p JOIN sources c ON c.frame_id = p.frame_id AND {separation_sql("p.h_ra", "p.h_dec", "c.ra", "c.dec")} <= 5),
moved AS (SELECT DISTINCT h.obs_id FROM hist h WHERE h.obs_id NOT IN (SELECT obs_id FROM narrow) AND NOT EXISTS (SELECT 1 FROM taken t WHERE t.frame_id = h.frame_id AND t.h_obs_id = h.h_obs_id))"""
OUTCOME = f"""{HISTORY},
{TILES},
{VACATED},
rows AS (SELECT s.*, coalesce(n.n_history, 0) AS n_history, coalesce(c.n_covering, 0) AS n_covering, m.obs_id IS NOT NULL AS vacated, s.mag - n.median_mag AS delta_mag, coalesce(contains(s.object_type, 'G'), false) AS galaxy, coalesce(contains(s.object_type, 'EB'), false) AS is_binary, coalesce(contains(s.object_type, 'V*') OR contains(s.object_type, 'Cep'), false) AS is_variable
 FROM sources s LEFT JOIN narrow n ON n.obs_id = s.obs_id LEFT JOIN covered c ON c.obs_id = s.obs_id LEFT JOIN moved m ON m.obs_id = s.obs_id),
outcomes AS (SELECT *, CASE WHEN catalog_name = 'MPC' THEN CASE WHEN object_type = 'ASTEROID' THEN 'ASTEROID' ELSE 'COMET' END
 WHEN catalog_name IS NULL AND saturated THEN 'SUPPRESSED_SATURATED'
 WHEN catalog_name IS NULL AND n_history = 0 AND elongation > CASE WHEN near_edge THEN 6 ELSE 3 END THEN 'SPACE_DEBRIS'
 WHEN catalog_name IS NULL AND n_history = 0 AND vacated THEN CASE WHEN near_edge THEN 'SUPPRESSED_EDGE' ELSE 'MOVING_UNKNOWN' END
 WHEN n_covering = 0 THEN CASE WHEN NOT from_subtraction THEN 'FIRST_OBSERVATION' WHEN near_edge THEN 'SUPPRESSED_EDGE' WHEN catalog_name IS NOT NULL THEN 'SUPPRESSED_CATALOGUED' ELSE 'UNKNOWN' END
 WHEN n_history = 0 AND galaxy THEN 'SUPERNOVA_CANDIDATE'
 WHEN n_history = 0 AND catalog_name IS NULL THEN CASE WHEN near_edge THEN 'SUPPRESSED_EDGE' ELSE 'UNKNOWN' END
 WHEN n_history = 0 THEN 'KNOWN_CATALOG_NEW'
 WHEN abs(delta_mag) > 5e-1 AND delta_mag < -5e-1 AND galaxy THEN 'SUPERNOVA_CANDIDATE'
 WHEN abs(delta_mag) > 5e-1 AND is_binary THEN 'BINARY_STAR' WHEN abs(delta_mag) > 5e-1 AND is_variable THEN 'VARIABLE_STAR' ELSE 'NONE' END AS outcome FROM rows)"""


@query(f"WITH {clauses('sources')}, {HISTORY} SELECT obs_id, h_obs_id, round(sep, 6) AS sep_arcsec FROM hist WHERE sep <= 5")
def j06_narrow_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    return history.history_pairs(s, s, matching.MATCH_CONE).select("obs_id", "h_obs_id", sky.rounded("sep_arcsec", 6).alias("sep_arcsec"))


@query(f"WITH {clauses('sources')}, {HISTORY} SELECT obs_id, n_history, median_mag FROM narrow")
def a06_historical_magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    return epochs.narrow(s, s)


@query(f"WITH {clauses('sources')}, {TILES} SELECT obs_id, n_covering FROM covered")
def j07_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.coverage(derived(spark, sf_dir, "sources"), derived(spark, sf_dir, "frames"), FOV)


@query(f"WITH {clauses('sources')}, {HISTORY}, {VACATED} SELECT obs_id FROM moved")
def j08_vacated(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = written(derived(spark, sf_dir, "sources"))
    return history.vacated(s.join(epochs.narrow(s, s).select("obs_id"), "obs_id", "left_anti"), s, s)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = written(derived(spark, sf_dir, "sources"))
    return classify.classified(s, s, written(derived(spark, sf_dir, "frames")), FOV)


@query(f"WITH {clauses('sources')}, {OUTCOME} SELECT obs_id, frame_id, n_history, n_covering, vacated, round(delta_mag, 6) AS delta_mag, outcome FROM outcomes")
def c01_f09_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("obs_id", "frame_id", "n_history", "n_covering", "vacated", F.round("delta_mag", 6).alias("delta_mag"), "outcome")


@query(f"WITH {clauses('sources')}, {OUTCOME} SELECT obs_id, frame_id, object_type, round(delta_mag, 6) AS delta_mag, outcome FROM outcomes WHERE n_history > 0 AND outcome IN ('SUPERNOVA_CANDIDATE', 'BINARY_STAR', 'VARIABLE_STAR')")
def c01_known_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir).where((F.col("n_history") > 0) & F.col("outcome").isin(classify.CHANGES))
    return rows.select("obs_id", "frame_id", "object_type", F.round("delta_mag", 6).alias("delta_mag"), "outcome")


#: Settings of what-if runs, by hand: (run, parameter, value).
WHAT_IF = [("narrow", "MATCH_CONE_ARCSEC", "2.5"), ("narrow", "MOVING_CONE_ARCSEC", "60"), ("wide", "MATCH_CONE_ARCSEC", "25"), ("wide", "SPACE_DEBRIS_ELONGATION_MIN", "2"), ("faint", "DELTA_MAG_ALERT", "0.1"), ("faint", "SPACE_DEBRIS_EDGE_ELONGATION_MIN", "4.5"), ("as it is", "LOG_LEVEL", "debug")]
_LIMITS = {"narrow": ("2.5e0", "60", "5e-1", "3", "6"), "wide": ("25", "120", "5e-1", "2", "6"), "faint": ("5", "120", "1e-1", "3", "45e-1"), "as it is": ("5", "120", "5e-1", "3", "6")}


def _what_if_sql(run: str) -> str:
    match, moving, delta, debris, edge = _LIMITS[run]
    text = OUTCOME.replace("<= 120)", f"<= {moving})").replace("WHERE sep <= 5 GROUP", f"WHERE sep <= {match} GROUP").replace(" <= 5),", f" <= {match}),").replace("THEN 6 ELSE 3 END", f"THEN {edge} ELSE {debris} END").replace("> 5e-1", f"> {delta}").replace("< -5e-1", f"< -{delta}")
    return f"SELECT '{run}' AS run, * FROM (WITH {text} SELECT obs_id, n_history, vacated, round(delta_mag, 6) AS delta_mag, outcome FROM outcomes)"


@query(f"WITH {clauses('sources')} {' UNION ALL '.join(map(_what_if_sql, _LIMITS))}")
def k10_what_if_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources classified under four sets of settings at once."""
    s = written(derived(spark, sf_dir, "sources"))
    given = settings.applied(spark.createDataFrame(WHAT_IF, "run string, param string, value string"))
    got = whatif.classified(s, s, written(derived(spark, sf_dir, "frames")), FOV, given)
    return got.select("run", "obs_id", "n_history", "vacated", F.round("delta_mag", 6).alias("delta_mag"), "outcome")


ANOMALIES = f"""{OUTCOME},
anomalies AS (SELECT frame_id, outcome AS anomaly_type, obs_id, coalesce(catalog_id, concat('obs-', cast(obs_id AS string))) AS source_id, ra, dec, mag AS magnitude, CASE WHEN n_history > 0 AND outcome IN ('SUPERNOVA_CANDIDATE', 'BINARY_STAR', 'VARIABLE_STAR') THEN delta_mag END AS delta_mag, CASE WHEN catalog_name = 'MPC' THEN catalog_id END AS mpc_designation,
 outcome IN ('SUPERNOVA_CANDIDATE', 'MOVING_UNKNOWN', 'SPACE_DEBRIS', 'UNKNOWN') AS alert, obs_time FROM outcomes WHERE outcome IN ('VARIABLE_STAR', 'BINARY_STAR', 'SUPERNOVA_CANDIDATE', 'UNKNOWN', 'ASTEROID', 'COMET', 'MOVING_UNKNOWN', 'SPACE_DEBRIS'))"""


@query(f"WITH {clauses('sources')}, {ANOMALIES} SELECT frame_id, anomaly_type, obs_id, source_id, ra, dec, magnitude, round(delta_mag, 6) AS delta_mag, mpc_designation, alert FROM anomalies")
def c02_f08_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.anomalies(_classified(spark, sf_dir)).drop("notes").withColumn("delta_mag", F.round("delta_mag", 6))


@query(f"WITH {clauses('sources')}, {ANOMALIES} SELECT frame_id, anomaly_type, count(*) AS n, count(*) FILTER (alert) AS alerts FROM anomalies GROUP BY ROLLUP (frame_id, anomaly_type)")
def a09_anomaly_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.tallies(classify.anomalies(_classified(spark, sf_dir)))


EPHEMERIDES = "SELECT DISTINCT catalog_id AS designation, obs_time, ra AS predicted_ra, dec AS predicted_dec, mag AS predicted_mag, 1e0 AS distance_au, (obs_id % 40) * 1e0 AS ra_rate, (obs_id % 30) * 1e0 AS dec_rate FROM sources WHERE catalog_name = 'MPC' AND NOT saturated"


@query(
    f"""WITH {clauses("sources")}, {ANOMALIES}, e AS ({EPHEMERIDES}) SELECT a.obs_id, a.source_id, e.predicted_ra, round(sqrt(e.ra_rate * e.ra_rate + e.dec_rate * e.dec_rate), 6) AS speed
 FROM anomalies a LEFT JOIN e ON a.anomaly_type IN ('ASTEROID', 'COMET') AND a.mpc_designation = e.designation AND a.obs_time = e.obs_time"""
)
def j12_ephemerides(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    found = classify.anomalies(_classified(spark, sf_dir)).join(s.select("obs_id", "obs_time"), "obs_id")
    table_ = spark.sql(EPHEMERIDES.replace("FROM sources", "FROM {s}"), s=s)
    rows = tracks.with_ephemerides(found, table_)
    return rows.select("obs_id", "source_id", F.col("ephemeris.predicted_ra").alias("predicted_ra"), F.round("ephemeris.angular_velocity_arcsec_per_hour", 6).alias("speed"))


# Dedup ---------------------------------------------------------------------------------------------------------------

@query(
    f"""WITH {clauses("sources")}, named AS (SELECT obs_id, frame_id, row_number() OVER (PARTITION BY frame_id, catalog_name, catalog_id ORDER BY from_subtraction, coalesce(flux, 0e0) DESC, obs_id) AS r, min(obs_id) OVER (PARTITION BY frame_id, catalog_name, catalog_id) AS place FROM sources WHERE catalog_name IS NOT NULL)
 SELECT obs_id, frame_id, place FROM named WHERE r = 1 UNION ALL SELECT obs_id, frame_id, obs_id FROM sources WHERE catalog_name IS NULL"""
)
def w01_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.by_identity(derived(spark, sf_dir, "sources").withColumn("seq", F.col("obs_id"))).select("obs_id", "frame_id", "place")


CROWD = """SELECT obs_id, object AS frame_id, obs_id AS seq, ra, dec, flux, catalog_name, from_subtraction OR obs_id % 2 = 0 AS from_subtraction FROM sources"""


@query(f"WITH {clauses('sources')}, c AS ({CROWD}), lost AS (SELECT DISTINCT s.obs_id FROM c s JOIN c k ON k.frame_id = s.frame_id AND s.catalog_name IS NULL AND k.catalog_name IS NULL AND s.from_subtraction AND NOT k.from_subtraction AND {SEP} < 5) SELECT obs_id FROM c WHERE obs_id NOT IN (SELECT obs_id FROM lost)")
def w02_subtraction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    crowd = spark.sql(CROWD.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    return dedup.subtraction_pairs(crowd).select("obs_id")


@query(f"WITH {clauses('sources')}, c AS ({CROWD}), lost AS (SELECT DISTINCT s.obs_id FROM c s JOIN c k ON k.frame_id = s.frame_id AND s.catalog_name IS NULL AND k.catalog_name IS NOT NULL AND {SEP} < 5) SELECT obs_id FROM c WHERE obs_id NOT IN (SELECT obs_id FROM lost)")
def w03_unmatched_near_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    crowd = spark.sql(CROWD.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    return dedup.unmatched_near_matched(crowd).select("obs_id")


_RANK = "CASE catalog_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in dedup.PRIORITY.items()) + " ELSE 5 END"


@query(
    f"""WITH RECURSIVE {clauses("sources")}, own AS (SELECT *, {_RANK} AS rank, coalesce(flux, 0e0) AS light FROM sources WHERE catalog_name IS NOT NULL),
 pr AS (SELECT s.frame_id, s.obs_id AS x, k.obs_id AS y, row_number() OVER (PARTITION BY s.frame_id ORDER BY s.obs_id, k.obs_id) AS n, CASE WHEN (s.rank, s.from_subtraction, -s.light, s.obs_id) < (k.rank, k.from_subtraction, -k.light, k.obs_id) THEN k.obs_id ELSE s.obs_id END AS loser
 FROM own s JOIN own k ON k.frame_id = s.frame_id AND s.obs_id < k.obs_id AND s.catalog_name <> k.catalog_name AND {SEP} < {dedup.CONE}),
 played AS (SELECT frame_id, cast(0 AS bigint) AS n, cast([] AS bigint[]) AS gone FROM pr GROUP BY 1 UNION ALL SELECT p.frame_id, p.n, CASE WHEN list_contains(gone, x) OR list_contains(gone, y) THEN gone ELSE list_append(gone, loser) END FROM played q JOIN pr p ON p.frame_id = q.frame_id AND p.n = q.n + 1)
 SELECT obs_id, frame_id, catalog_name FROM sources WHERE obs_id NOT IN (SELECT unnest(gone) FROM (SELECT gone FROM played QUALIFY row_number() OVER (PARTITION BY frame_id ORDER BY n DESC) = 1))"""
)
def w04_cross_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cross_catalog(derived(spark, sf_dir, "sources").withColumn("seq", F.col("obs_id"))).select("obs_id", "frame_id", "catalog_name")


# Quality and calibration ---------------------------------------------------------------------------------------------

SHAPED = "shaped AS (SELECT *, 2e0 * sqrt(2e0 * ln(2e0) * (a * a + b * b) / 2e0) * scale AS fwhm, CASE WHEN b <= 0 THEN 1e0 ELSE a / b END AS elongation, flux / err AS snr FROM detections)"


@query(
    f"""WITH {clauses("detections")}, {SHAPED}, q AS (SELECT frame_id, count(*) AS n_raw, median(fwhm) AS fwhm_median, median(elongation) AS elongation_median, median(snr) AS snr_median, count(*) FILTER (elongation < 1.5 AND fwhm >= 2.5 AND fwhm <= 8 AND flux > 0) AS star_count, max(background) AS sky_background, max(filter) AS filter FROM shaped GROUP BY frame_id),
 f AS (SELECT *, fwhm_median > 8 AS blur, elongation_median > 2 AS trail, sky_background > 50000 AS bright FROM q)
 SELECT frame_id, n_raw, round(fwhm_median, 6) AS fwhm_median, round(elongation_median, 6) AS elongation_median, round(snr_median, 6) AS snr_median, star_count, sky_background, CASE WHEN n_raw < 3 THEN 'LOW_STARS' WHEN blur::int + trail::int + bright::int >= 2 THEN 'BAD' WHEN blur THEN 'BLUR' WHEN trail THEN 'TRAIL' WHEN bright THEN 'HIGH_BACKGROUND' WHEN star_count < CASE WHEN filter = 'Ha' THEN 5 ELSE 10 END THEN 'LOW_STARS' ELSE 'OK' END AS quality_flag FROM f"""
)
def a01_a02_frame_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = calibration.frame_quality(calibration.shapes(derived(spark, sf_dir, "detections"))).drop("filter")
    return q.withColumns({c: F.round(c, 6) for c in ("fwhm_median", "elongation_median", "snr_median")})


@query(
    f"""WITH {clauses("detections")}, {SHAPED} SELECT frame_id, count(*) FILTER (elongation >= 1.5) AS by_elongation, count(*) FILTER (fwhm < 2.5) AS by_small, count(*) FILTER (fwhm > 8) AS by_large, count(*) FILTER (snr < 50) AS by_snr, count(*) FILTER (flux <= 0) AS by_flux,
 round(min(snr), 6) AS snr_min, round(max(snr), 6) AS snr_max, round(min(fwhm), 6) AS fwhm_min, round(max(fwhm), 6) AS fwhm_max, round(min(elongation), 6) AS elongation_min, round(max(elongation), 6) AS elongation_max FROM shaped GROUP BY frame_id"""
)
def a08_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = calibration.rejections(calibration.shapes(derived(spark, sf_dir, "detections")))
    return r.withColumns({f"{c}_{m}": F.round(f"{c}_{m}", 6) for c in ("snr", "fwhm", "elongation") for m in ("min", "max")})


BOXED = "boxed AS (SELECT d.*, x - a * 4 AS xmin, x + a * 4 + (obs_id % 90) AS xmax, y - b * 4 AS ymin, y + b * 4 AS ymax, 4096 AS width, 3072 AS height, CASE WHEN obs_id % 3 = 0 THEN NULL ELSE 2e0 + obs_id % 3 END AS psf FROM detections d)"


def _boxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"WITH {BOXED.replace('FROM detections', 'FROM {d}')} SELECT * FROM boxed", d=derived(spark, sf_dir, "detections"))


@query(
    f"""WITH {clauses("detections")}, {SHAPED}, w AS (SELECT *, CASE WHEN obs_id % 3 = 0 THEN NULL ELSE 2e0 + obs_id % 3 END AS psf FROM shaped)
 SELECT obs_id, elongation < 1.5 AND fwhm >= CASE WHEN psf > 0 THEN greatest(2.5e0, psf / 1.5e0) ELSE 2.5e0 END AND fwhm <= CASE WHEN psf > 0 THEN least(8e0, psf * 1.5e0) ELSE 8e0 END AND snr >= 50 AND flux > 0 AS strict_star, fwhm >= 2.5 AND elongation < 5 AND flux > 0 AS loose_star FROM w"""
)
def f02_f03_star_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = calibration.shapes(_boxed(spark, sf_dir))
    return rows.select("obs_id", calibration.strict_star(F.col("psf")).alias("strict_star"), calibration.is_star(loose=True).alias("loose_star"))


@query(
    f"""WITH {clauses("detections")}, {BOXED}, s AS (SELECT *, CASE WHEN obs_id % 4 = 0 THEN NULL ELSE scale END AS known FROM boxed)
 SELECT obs_id, a / CASE WHEN b > 0 THEN b ELSE 1e-6 END >= 5 AND sqrt((xmax - xmin) * (xmax - xmin) + (ymax - ymin) * (ymax - ymin)) >= CASE WHEN known > 0 THEN 3e1 / known ELSE 2e2 END AS streak FROM s"""
)
def f05_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxed(spark, sf_dir).withColumn("scale", F.expr("CASE WHEN obs_id % 4 = 0 THEN NULL ELSE scale END"))
    return rows.select("obs_id", calibration.is_streak().alias("streak"))


@query(
    f"""WITH {clauses("detections")}, {BOXED}, s AS (SELECT *, 2e0 * sqrt(2e0 * ln(2e0) * (a * a + greatest(b, 1e-3) * greatest(b, 1e-3)) / 2e0) AS px FROM boxed)
 SELECT obs_id, round(px, 6) AS fwhm_px FROM s WHERE NOT coalesce(px < psf / 1.5e0 / scale, false) AND x >= 5e-2 * width AND x <= width - 5e-2 * width AND y >= 5e-2 * height AND y <= height - 5e-2 * height"""
)
def f06_difference_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.difference_candidates(_boxed(spark, sf_dir)).select("obs_id", F.round("fwhm_px", 6).alias("fwhm_px"))


REFS = "SELECT obs_id, object AS frame_id, catalog_name, saturated, flux, flux / 5e1 + 1e0 AS flux_err, CASE WHEN catalog_name = 'Gaia DR3' THEN 12e0 + obs_id % 9 END AS catalog_mag, filter FROM sources"


@query(
    f"""WITH {clauses("sources")}, r AS ({REFS}), u AS (SELECT frame_id, catalog_mag + 2.5e0 * log10(flux) AS d FROM r WHERE catalog_name = 'Gaia DR3' AND NOT saturated AND flux > 0 AND filter NOT IN ('Ha', 'OIII', 'SII', 'NII')),
 z AS (SELECT frame_id, median(d) AS zp, count(*) AS n_ref FROM u GROUP BY frame_id HAVING count(*) >= 3), m AS (SELECT u.frame_id, median(abs(u.d - z.zp)) AS mad FROM u JOIN z USING (frame_id) GROUP BY ALL)
 SELECT frame_id, round(zp, 6) AS zero_point, round(mad, 6) AS zero_point_err, n_ref FROM z JOIN m USING (frame_id)"""
)
def a03_zero_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = spark.sql(REFS.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    return calibration.zero_points(refs).withColumns({c: F.round(c, 6) for c in ("zero_point", "zero_point_err")})


@query(
    f"""WITH {clauses("sources")}, r AS ({REFS}), u AS (SELECT frame_id, catalog_mag + 2.5e0 * log10(flux) AS d FROM r WHERE catalog_name = 'Gaia DR3' AND NOT saturated AND flux > 0 AND filter NOT IN ('Ha', 'OIII', 'SII', 'NII')),
 z AS (SELECT frame_id, median(d) AS zp FROM u GROUP BY frame_id HAVING count(*) >= 3)
 SELECT obs_id, CASE WHEN NOT saturated AND flux > 0 THEN round(-2.5e0 * log10(flux), 6) END AS mag_instrumental, CASE WHEN NOT saturated AND flux > 0 THEN round(1.0857e0 * flux_err / flux, 6) END AS mag_err, CASE WHEN NOT saturated AND flux_err > 0 THEN round(flux / flux_err, 6) END AS snr, CASE WHEN NOT saturated AND flux > 0 THEN round(-2.5e0 * log10(flux) + zp, 6) END AS mag, NOT saturated AND flux > 0 AND zp IS NOT NULL AS calibrated FROM r LEFT JOIN z USING (frame_id)"""
)
def p15_photometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = spark.sql(REFS.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    rows = calibration.calibrated(refs, calibration.zero_points(refs))
    return rows.select("obs_id", *[F.round(c, 6).alias(c) for c in ("mag_instrumental", "mag_err", "snr", "mag")], "calibrated")


@query(
    f"""WITH {clauses("sources", "detections")}, {SHAPED}, q AS (SELECT frame_id, count(*) AS n_raw, median(fwhm) AS fwhm_median, median(elongation) AS elongation_median, count(*) FILTER (elongation < 1.5 AND fwhm >= 2.5 AND fwhm <= 8 AND flux > 0) AS star_count, max(background) AS sky_background FROM shaped GROUP BY frame_id)
 SELECT obs_id FROM sources WHERE frame_id IN (SELECT frame_id FROM q WHERE n_raw >= 3 AND NOT fwhm_median > 8 AND NOT elongation_median > 2 AND NOT sky_background > 50000 AND star_count >= 1)"""
)
def f07_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One star is enough here: the derived frames hold few detections each."""
    q = calibration.frame_quality(calibration.shapes(derived(spark, sf_dir, "detections")), stars=1, stars_narrow=1)
    return calibration.passed_quality(derived(spark, sf_dir, "sources"), q).select("obs_id")


# Tracks --------------------------------------------------------------------------------------------------------------

TRACK = "track AS (SELECT catalog_id AS source_id, obs_id, frame_id, object, obs_time, ra, dec, mag, filter, row_number() OVER w AS epoch, count(*) OVER (PARTITION BY catalog_id) AS n_epochs FROM sources WHERE catalog_id IS NOT NULL WINDOW w AS (PARTITION BY catalog_id ORDER BY obs_time, obs_id))"


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, "sources").withColumn("source_id", F.col("catalog_id"))


@query(
    f"""WITH {clauses("sources")}, {TRACK}, l AS (SELECT *, lag(ra) OVER p AS b_ra, lag(dec) OVER p AS b_dec, lag(obs_time) OVER p AS b_time FROM track WHERE epoch > n_epochs - 12 WINDOW p AS (PARTITION BY source_id ORDER BY epoch)),
 g AS (SELECT *, {separation_sql("b_ra", "b_dec", "ra", "dec")} AS sep, abs(epoch_us(obs_time) - epoch_us(b_time)) / 3.6e9 AS h FROM l)
 SELECT source_id, obs_id, epoch, n_epochs, round(sep, 6) AS shift_arcsec, round(h, 6) AS gap_hours, CASE WHEN h > 0 THEN round(sep / h, 6) END AS velocity FROM g"""
)
def w05_w06_w07_j11_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tracks.kinematics(tracks.last_epochs(tracks.epochs(_observations(spark, sf_dir))))
    return rows.select("source_id", "obs_id", "epoch", "n_epochs", *[F.round(c, 6).alias(c) for c in ("shift_arcsec", "gap_hours", "velocity")])


@query(f"WITH {clauses('frames')}, r AS (SELECT a.frame_id, b.frame_id AS previous_id, b.obs_time AS previous_time, row_number() OVER (PARTITION BY a.frame_id ORDER BY b.obs_time DESC, b.frame_id DESC) AS r FROM frames a JOIN frames b ON b.object = a.object AND b.obs_time < a.obs_time) SELECT frame_id, previous_id, previous_time FROM r WHERE r = 1")
def j10_previous_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = derived(spark, sf_dir, "frames")
    return tracks.previous_frame(f, f)


SEQ = "SELECT source_id, anomaly_type, obs_id AS seq, mpc_designation FROM anomalies"


@query(
    f"""WITH {clauses("sources")}, {ANOMALIES}, f AS (SELECT source_id, anomaly_type, min(obs_id) AS seq FROM anomalies GROUP BY ALL), d AS (SELECT source_id, arg_min(mpc_designation, obs_id) FILTER (mpc_designation IS NOT NULL) AS own FROM anomalies GROUP BY ALL)
 SELECT f.source_id, array_to_string(list(anomaly_type ORDER BY seq), ',') AS types, arg_min(anomaly_type, seq) AS representative, any_value(coalesce(own, (SELECT min(catalog_id) FROM sources s WHERE s.catalog_id = f.source_id))) AS designation FROM f JOIN d ON d.source_id = f.source_id GROUP BY f.source_id"""
)
def a10_j13_types_and_designations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.anomalies(_classified(spark, sf_dir)).withColumn("seq", F.col("obs_id"))
    kinds = tracks.types_of_sources(found).withColumn("types", F.array_join("types", ","))
    return kinds.join(tracks.designations(found, _observations(spark, sf_dir)), "source_id")


@query(
    f"""WITH {clauses("frames")}, f AS (SELECT *, CASE WHEN day(obs_time) % 4 = 0 THEN NULL ELSE cast((day(obs_time) * 37) % 360 AS double) END AS pa FROM frames),
 m AS (SELECT a.frame_id, a.pa, b.frame_id AS ref, b.obs_time AS t, b.pa AS rpa, coalesce(a.filter = b.filter, false) AS same, count(*) FILTER (coalesce(a.filter = b.filter, false)) OVER (PARTITION BY a.frame_id) AS n_same FROM f a JOIN f b ON b.object = a.object),
 p AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY t DESC, ref) AS nth, count(*) OVER (PARTITION BY frame_id) AS n FROM m WHERE n_same < 3 OR same),
 k AS (SELECT *, CASE WHEN n > 10 AND pa IS NOT NULL THEN coalesce(least(abs(rpa - pa), 360 - abs(rpa - pa)), 180e0) ELSE 0e0 END AS off FROM p WHERE NOT (n > 10 AND pa IS NOT NULL) OR nth <= 30),
 t AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY off, nth) AS place FROM k), u AS (SELECT *, count(*) OVER (PARTITION BY frame_id) AS lft FROM t WHERE place <= 10 AND ref <> frame_id)
 SELECT frame_id, ref AS reference_id, place FROM u WHERE lft >= 3"""
)
def t01_reference_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = derived(spark, sf_dir, "frames").withColumn("position_angle", F.expr("CASE WHEN day(obs_time) % 4 = 0 THEN NULL ELSE cast((day(obs_time) * 37) % 360 AS double) END"))
    return tracks.reference_frames(f, f)


def track_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§3.3 as one job: anomalies to labelled, moving epochs."""
    found = classify.anomalies(_classified(spark, sf_dir)).withColumn("seq", F.col("obs_id"))
    own = _observations(spark, sf_dir)
    return tracks.track_report(found, own, own)


# Store ---------------------------------------------------------------------------------------------------------------

STORED = "SELECT frame_id, catalog_id AS source_id, min(obs_id) AS obs_id FROM sources WHERE catalog_id IS NOT NULL AND NOT from_subtraction GROUP BY frame_id, catalog_id"
BATCH = "SELECT frame_id, catalog_id AS source_id, min(obs_id) AS obs_id FROM sources WHERE catalog_id IS NOT NULL AND NOT near_edge AND filter = 'L' GROUP BY frame_id, catalog_id"
AFFECTED = "SELECT DISTINCT frame_id FROM sources WHERE filter IN ('L', 'Ha')"


def _write(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    s = derived(spark, sf_dir, "sources")
    make = lambda text: spark.sql(text.replace("FROM sources", "FROM {s}"), s=s)
    return store.reconcile(make(STORED), make(BATCH), make(AFFECTED))


RECONCILED = f"{clauses('sources')}, stored AS ({STORED}), batch AS ({BATCH}), affected AS ({AFFECTED}), obs AS (SELECT * FROM stored WHERE frame_id NOT IN (SELECT frame_id FROM affected) UNION ALL SELECT * FROM batch), gone AS (SELECT * FROM stored o WHERE frame_id IN (SELECT frame_id FROM affected) AND NOT EXISTS (SELECT 1 FROM batch b WHERE b.frame_id = o.frame_id AND b.source_id = o.source_id)), purged AS (SELECT DISTINCT source_id FROM gone WHERE source_id NOT IN (SELECT source_id FROM obs))"


@query(f"WITH {RECONCILED} SELECT frame_id, source_id, obs_id FROM obs")
def k05_reconciled_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _write(spark, sf_dir)["observations"].select("frame_id", "source_id", "obs_id")


@query(f"WITH {RECONCILED} SELECT (SELECT count(*) FROM batch WHERE source_id NOT IN (SELECT source_id FROM stored)) AS \"new\", (SELECT count(*) FROM batch WHERE source_id IN (SELECT source_id FROM stored)) AS matched, (SELECT count(*) FROM gone) AS retracted, (SELECT count(*) FROM purged) AS purged")
def k05_u02_write_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _write(spark, sf_dir)["counts"]


@query(
    f"""WITH {clauses("frames")}, stored AS (SELECT frame_id AS filename, object, obs_time, CASE WHEN filter = 'L' THEN 1e0 END AS pointing_error_arcsec, filter FROM frames WHERE filter <> 'R'), fresh AS (SELECT frame_id AS filename, object, obs_time, 2e0 AS pointing_error_arcsec, CASE WHEN filter = 'Ha' THEN NULL ELSE concat(filter, '+') END AS filter FROM frames WHERE filter <> 'B')
 SELECT coalesce(s.filename, n.filename) AS filename, sha256(coalesce(s.filename, n.filename)) AS frame_id, coalesce(n.object, s.object) AS object, coalesce(s.pointing_error_arcsec, n.pointing_error_arcsec) AS pointing_error_arcsec, coalesce(n.filter, s.filter) AS filter FROM stored s FULL JOIN fresh n ON n.filename = s.filename"""
)
def k03_upserted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = derived(spark, sf_dir, "frames").selectExpr("frame_id AS filename", "sha2(frame_id, 256) AS frame_id", "object", "obs_time", "filter")
    stored = f.where("filter <> 'R'").withColumn("pointing_error_arcsec", F.when(F.col("filter") == "L", 1e0))
    fresh = f.where("filter <> 'B'").withColumns({"pointing_error_arcsec": F.lit(2e0), "filter": F.when(F.col("filter") != "Ha", F.concat("filter", F.lit("+")))}).drop("frame_id")
    return store.upsert_frames(stored, fresh).select("filename", "frame_id", "object", "pointing_error_arcsec", "filter")


@query(f"WITH {clauses('sources')} SELECT s.obs_id, s.frame_id, coalesce(CASE WHEN obs_id % 7 = 0 THEN NULL ELSE elongation END, 0e0) AS elongation, coalesce(CASE WHEN obs_id % 5 = 0 THEN NULL ELSE saturated END, false) AS saturated, from_subtraction, f.filter FROM sources s JOIN frames f ON f.frame_id = s.frame_id")
def k04_wire_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    inner = s.selectExpr("obs_id", "frame_id", "CASE WHEN obs_id % 7 = 0 THEN NULL ELSE elongation END AS elongation", "CASE WHEN obs_id % 5 = 0 THEN NULL ELSE saturated END AS saturated", "from_subtraction AS _from_subtraction", "mag AS _scratch")
    return store.from_wire(store.to_wire(inner), derived(spark, sf_dir, "frames"))


@query(f"WITH {clauses('sources')}, {ANOMALIES}, gone AS (SELECT DISTINCT frame_id FROM sources WHERE filter IN ('L', 'Ha')) SELECT frame_id, obs_id, anomaly_type FROM anomalies WHERE frame_id NOT IN (SELECT frame_id FROM gone) UNION ALL SELECT frame_id, obs_id, 'UNKNOWN' FROM anomalies WHERE frame_id IN (SELECT frame_id FROM gone) AND alert")
def k06_replaced_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify.anomalies(_classified(spark, sf_dir))
    stored = found.select("frame_id", "obs_id", "anomaly_type")
    affected = spark.sql(AFFECTED.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    return store.replace_anomalies(stored, found.where("alert").select("frame_id", "obs_id", F.lit("UNKNOWN").alias("anomaly_type")), affected)


@query(f"WITH {clauses('sources')}, stored AS ({STORED}), gone AS ({AFFECTED}), kept AS (SELECT * FROM stored WHERE frame_id NOT IN (SELECT frame_id FROM gone)) SELECT DISTINCT source_id FROM stored WHERE source_id NOT IN (SELECT source_id FROM kept)")
def k07_orphans_of_deleted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    make = lambda text: spark.sql(text.replace("FROM sources", "FROM {s}"), s=s)
    stored = make(STORED)
    return store.delete_frames(derived(spark, sf_dir, "frames"), stored, stored, make(AFFECTED))["orphans"]


@query(f"WITH {clauses('frames')} SELECT frame_id, object, obs_time FROM frames WHERE obs_time >= timestamp '2024-01-05 00:00:00' AND obs_time < timestamp '2024-01-20 00:00:00' ORDER BY obs_time DESC, frame_id LIMIT 50 OFFSET 20")
def k08_t02_frame_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.list_frames(derived(spark, sf_dir, "frames").select("frame_id", "object", "obs_time"), None, "2024-01-05 00:00:00", "2024-01-20 00:00:00", 50, 20, newest_first=True)


@query(f"WITH {clauses('sources')} SELECT f.frame_id, f.object, s.obs_id, s.mag FROM frames f JOIN sources s ON s.frame_id = f.frame_id")
def k09_frames_with_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, s = derived(spark, sf_dir, "frames"), derived(spark, sf_dir, "sources")
    return store.frame_sources(f.select("frame_id", "object"), s.select("frame_id", "obs_id", "mag"))


@query(f"WITH {clauses('sources')}, r AS (SELECT frame_id, obs_id, row_number() OVER (PARTITION BY frame_id ORDER BY obs_id) AS seq, object, count(*) OVER (PARTITION BY frame_id) AS n FROM sources) SELECT frame_id, obs_id, CASE WHEN n % 2 = 1 THEN concat(object, '#', cast(seq AS varchar)) END AS source_id FROM r")
def j14_attached_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers of frames with an even number of rows lack the last one."""
    text = "SELECT frame_id, obs_id, object, row_number() OVER (PARTITION BY frame_id ORDER BY obs_id) AS seq, count(*) OVER (PARTITION BY frame_id) AS n FROM {s}"
    rows = spark.sql(text, s=derived(spark, sf_dir, "sources"))
    answered = rows.where("n % 2 = 1 OR seq < n").selectExpr("frame_id", "seq", "concat(object, '#', cast(seq AS string)) AS source_id")
    return store.with_source_ids(rows.select("frame_id", "obs_id", "seq"), answered).select("frame_id", "obs_id", "source_id")


@query(f"WITH {clauses('sources')} SELECT catalog_id AS source_id, count(*) AS n_observations FROM sources WHERE catalog_id IS NOT NULL GROUP BY catalog_id")
def a11_observation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.observation_counts(_observations(spark, sf_dir))


# Arrivals ------------------------------------------------------------------------------------------------------------

@query(
    """WITH a AS (SELECT user_id, event_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) >= 6e8 THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM a) SELECT user_id, event_id, cast(session AS bigint) AS session, cast(floor((row_number() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) - 1) / 2) AS bigint) AS chunk FROM s"""
)
def s02_arrival_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("arrived"), F.col("event_id").alias("path"))
    return arrivals.numbered_batches(e, "user_id", "600 seconds", 2).select("user_id", "event_id", "session", "chunk")


def _streamed(out: DataFrame, spark: SparkSession) -> DataFrame:
    """What a stream appends to a table until its backlog is done, in the shared folder."""
    base = shared_folder(spark)
    out.writeStream.format("parquet").option("path", f"{base}/rows").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/rows")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(kind).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query(
    """WITH a AS (SELECT cast(user_id AS varchar) AS user_id, concat('/in/', cast(event_id % 40 AS varchar), '.fits') AS path, ts, event_id FROM events),
 o AS (SELECT user_id, path, ts FROM a QUALIFY row_number() OVER (PARTITION BY user_id, path ORDER BY ts) = 1),
 g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 DAY THEN 0 ELSE 1 END AS fresh FROM o WINDOW w AS (PARTITION BY user_id ORDER BY ts, path)),
 s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, path ROWS UNBOUNDED PRECEDING) AS session FROM g),
 c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, session ORDER BY ts, path) - 1) // 3 AS chunk FROM s),
 b AS (SELECT user_id, session, chunk, count(*) = 3 AS whole, max(ts) AS last FROM c GROUP BY ALL),
 f AS (SELECT *, CASE WHEN whole THEN last ELSE last + INTERVAL 2 DAY END AS flushed, row_number() OVER (PARTITION BY user_id ORDER BY session, chunk) AS batch FROM b)
 SELECT user_id, batch, row_number() OVER (PARTITION BY user_id, batch ORDER BY ts, path) - 1 AS seq, path, epoch_us(ts) AS arrived_us, epoch_us(flushed) AS flushed_us, CASE WHEN whole THEN 'full' ELSE 'quiet' END AS reason
 FROM c JOIN f USING (user_id, session, chunk) WHERE flushed <= (SELECT max(ts) FROM events)"""
)
def s02_streamed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of arrivals by user: batches of three files, or after two quiet days; forty paths a user, so most arrivals are of files in flight."""
    came = _event_stream(spark, sf_dir).selectExpr("user_id", "concat('/in/', cast(event_id % 40 AS string), '.fits') AS path", "cast(ts AS timestamp) AS arrived", "false AS done")
    out = _streamed(arrivals.stream_batches(came, "user_id", "2 days", 3, "0 seconds"), spark)
    return out.select("user_id", "batch", "seq", "path", F.unix_micros("arrived").alias("arrived_us"), F.unix_micros("flushed").alias("flushed_us"), "reason")


@query("SELECT DISTINCT concat('/in/', cast(event_id // 2 AS varchar), '.fits') AS path FROM events")
def s03_unrepeated_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of file arrivals, two of them for each path."""
    came = _event_stream(spark, sf_dir).selectExpr("concat('/in/', cast(event_id div 2 AS string), '.fits') AS path", "cast(ts AS timestamp) AS arrived")
    return _streamed(arrivals.without_repeats(came, "4000 days").select("path"), spark)


@query(f"WITH {clauses('sources')}, {ANOMALIES} SELECT frame_id, obs_id, anomaly_type, round(delta_mag, 6) AS delta_mag FROM anomalies")
def s05_late_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of odd days arrive first, some with other magnitudes; then those of even days come late, and some of the odd ones again: what is kept is what a classification of everything gives."""
    centres = derived(spark, sf_dir, "frames").select("frame_id", "ra_center", "dec_center", "fov_deg")
    rows = written(derived(spark, sf_dir, "sources").join(centres, "frame_id"))
    survey = detection.Survey(spark, shared_folder(spark), rows.schema, FOV)
    odd, again = F.day("obs_time") % 2 == 1, F.pmod(F.xxhash64("frame_id"), F.lit(3)) == 0
    survey.take(rows.where(odd).withColumn("mag", F.when(again, F.col("mag") + 3).otherwise(F.col("mag"))))
    survey.take(rows.where(~odd | again))
    return survey.anomalies.read().select("frame_id", "obs_id", "anomaly_type", F.round("delta_mag", 6).alias("delta_mag"))


@query(
    """WITH s AS (SELECT concat('OBJ', cast(user_id AS varchar)) AS source_id, event_id AS obs_id, ts, event_type AS filter, value AS mag FROM events)
 SELECT a.source_id, a.obs_id, round(median(b.mag), 6) AS median_mag FROM s a LEFT JOIN s b ON b.source_id = a.source_id AND b.filter = a.filter AND b.ts < a.ts GROUP BY ALL"""
)
def s06_light_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations of each object as a stream, the kinds of events standing for filters."""
    rows = _event_stream(spark, sf_dir).selectExpr("concat('OBJ', cast(user_id AS string)) AS source_id", "event_id AS obs_id", "ts AS obs_time", "event_type AS filter", "value AS mag")
    return _streamed(detection.light_curves(rows), spark).withColumn("median_mag", F.round("median_mag", 6))


@query(
    """SELECT concat('/in/', cast(event_id AS varchar), '.fits') AS path, concat('M', cast(user_id AS varchar)) AS object_name, value AS exptime, CASE WHEN event_id % 3 = 0 THEN concat('cam ', event_type) END AS camera,
 event_id % 100 / 4e0 AS gain, CASE WHEN event_id % 5 = 0 THEN 'it''s me' END AS observer_name, cast(event_id % 4 + 1 AS integer) AS binning_x FROM events"""
)
def k01_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of cards written from the events, with several keywords for a field, and some with 300 comment cards."""
    card = lambda key, value: f"rpad(concat(rpad({key}, 8, ' '), '= ', {value}), 80, ' ')"
    cards = [
        card("'SIMPLE'", "'T / standard'"),
        "CASE WHEN event_id % 50 = 0 THEN repeat(rpad('COMMENT  none', 80, ' '), 300) ELSE '' END",
        card("CASE event_id % 3 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'OBJNAME' ELSE 'TARGET' END", """concat("'M", cast(user_id AS string), " ' / what")"""),
        card("CASE WHEN event_id % 2 = 0 THEN 'EXPTIME' ELSE 'EXPOSURE' END", "cast(value AS string)"),
        "CASE WHEN event_id % 3 = 0 THEN " + card("'CAMERA'", """concat("'cam ", event_type, "'")""") + " ELSE '' END",
        card("CASE WHEN event_id % 2 = 0 THEN 'GAIN' ELSE 'EGAIN' END", "concat(cast(event_id % 100 / 4e0 AS string), ' / e')"),
        "CASE WHEN event_id % 5 = 0 THEN " + card("'AUTHOR'", """\"'it''s me'\"""") + " ELSE '' END",
        card("'BINNING'", "cast(event_id % 4 + 1 AS string)"),
        "rpad('END', 80, ' ')",
        card("'OBJECT'", "'1'"),
    ]
    texts = table(spark, sf_dir, "events").selectExpr("concat('/in/', cast(event_id AS string), '.fits') AS path", f"concat({', '.join(cards)}) AS header")
    return headers.frames(texts).select("path", "object_name", "observation.exptime", "instrument.camera", "sensor.gain", "observer.observer_name", "sensor.binning_x")


def _image_files(rows: DataFrame, folder: str) -> int:
    """Writes an image file for each row (name, object, seconds, comments) from the tasks: a header, then zeros."""

    def write(batches):
        system, base = pafs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                cards = ["SIMPLE  =                    T", *["COMMENT none"] * r["comments"], f"OBJECT  = '{r['object']}'", f"EXPTIME = {r['seconds']}", "END"]
                head = "".join(c.ljust(80) for c in cards).encode()
                with system.open_output_stream(f"{base}/{r['name']}.fits") as out:
                    out.write(head + b" " * (-len(head) % heads.BLOCK) + bytes(50_000))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return rows.mapInArrow(write, "n long").agg(F.sum("n")).first()[0]


@query(
    """SELECT concat('u', cast(user_id AS varchar), '.fits') AS name, concat('M', cast(user_id AS varchar)) AS object_name, cast(min(event_id) AS double) AS exptime, cast(ceil((count(*) + 4) / 36e0) * 2880 AS bigint) AS head_bytes
 FROM events GROUP BY user_id"""
)
def k01_image_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image file for each user, with a comment card for each of their events, read again by its header alone."""
    folder = shared_folder(spark)
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").cast("int").alias("comments"), F.min("event_id").alias("seconds"))
    _image_files(rows.selectExpr("concat('u', cast(user_id AS string)) AS name", "concat('M ', cast(user_id AS string)) AS object", "seconds", "comments"), folder)
    spark.dataSource.register(heads.HeadSource)
    found = spark.read.format("image_heads").option("path", folder).load()
    named = headers.frames(found.select("path", "header")).select("path", "object_name", "observation.exptime")
    return named.join(found.select("path", "head_bytes"), "path").select(F.element_at(F.split("path", "/"), -1).alias("name"), "object_name", "exptime", "head_bytes")


# Pixels --------------------------------------------------------------------------------------------------------------

@query(
    f"""WITH {PIXELS_SQL}, a1 AS (SELECT frame_id, median(adu) AS m, stddev_pop(adu) AS s FROM pixels GROUP BY 1), b1 AS (SELECT frame_id, m - 2 * s AS lo, m + 2 * s AS hi FROM a1),
 a2 AS (SELECT frame_id, median(adu) AS m, stddev_pop(adu) AS s FROM pixels JOIN b1 USING (frame_id) WHERE adu BETWEEN lo AND hi GROUP BY 1), b2 AS (SELECT frame_id, greatest(lo, m - 2 * s) AS lo, least(hi, m + 2 * s) AS hi FROM a2 JOIN b1 USING (frame_id))
 SELECT frame_id, count(*) AS n, round(median(adu), 6) AS median, round(avg(adu), 6) AS mean, round(stddev_pop(adu), 6) AS stddev FROM pixels JOIN b2 USING (frame_id) WHERE adu BETWEEN lo AND hi GROUP BY 1"""
)
def x01_clipped_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = pixels.clipped_statistics(pixel_table(spark, sf_dir), 2.0, 2)
    return c.withColumns({n: F.round(n, 6) for n in ("median", "mean", "stddev")})


@query(
    f"""WITH {PIXELS_SQL}, stack AS (SELECT p.frame_id, r.y, r.x, median(r.adu) AS m FROM (SELECT DISTINCT frame_id FROM pixels) p JOIN pixels r ON r.frame_id IN (p.frame_id - 1, p.frame_id - 2, p.frame_id - 3) WHERE p.frame_id >= 3 GROUP BY ALL)
 SELECT frame_id, y, x, round(adu - m, 6) AS diff FROM pixels JOIN stack USING (frame_id, y, x)"""
)
def x02_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixel_table(spark, sf_dir)
    ids = p.select("frame_id").distinct()
    refs = ids.select("frame_id", F.explode(F.array(*[F.col("frame_id") - k for k in (1, 2, 3)])).alias("reference_id")).where("frame_id >= 3")
    return pixels.difference(p, refs).withColumn("diff", F.round("diff", 6))


@query(
    f"""WITH {PIXELS_SQL}, hot AS (SELECT frame_id, y, x FROM pixels WHERE adu >= 250), mask AS (SELECT DISTINCT p.frame_id, p.y, p.x FROM pixels p JOIN hot h ON h.frame_id = p.frame_id AND abs(h.y - p.y) <= 1 AND abs(h.x - p.x) <= 1)
 SELECT p.frame_id, p.y, p.x, p.adu > 1e2 AND NOT EXISTS (SELECT 1 FROM mask m WHERE m.frame_id = p.frame_id AND m.y = p.y AND m.x = p.x) AS exceeds, EXISTS (SELECT 1 FROM mask m WHERE m.frame_id = p.frame_id AND m.y = p.y AND m.x = p.x) AS masked FROM pixels p"""
)
def x03_x06_mask_and_exceedance(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixel_table(spark, sf_dir)
    mask = pixels.saturation_mask(p, 1, 250.0)
    rms = p.select("frame_id").distinct().withColumn("rms", F.lit(2e1))
    over = pixels.exceeding(p.withColumnRenamed("adu", "diff"), rms, mask).select("frame_id", "y", "x", F.lit(True).alias("e"))
    rows = p.select("frame_id", "y", "x").join(over, ["frame_id", "y", "x"], "left").join(mask.withColumn("m", F.lit(True)), ["frame_id", "y", "x"], "left")
    return rows.select("frame_id", "y", "x", F.coalesce("e", F.lit(False)).alias("exceeds"), F.coalesce("m", F.lit(False)).alias("masked"))


@query(
    f"""WITH {PIXELS_SQL}, near AS (SELECT frame_id, adu, (x - 3.5e0) * (x - 3.5e0) + (y - 3.5e0) * (y - 3.5e0) AS d2 FROM pixels), g AS (SELECT frame_id, sum(adu) FILTER (d2 <= 1) AS total, count(*) FILTER (d2 <= 1) AS area, median(adu) FILTER (d2 >= 4 AND d2 <= 9) AS bg, stddev_pop(adu) FILTER (d2 >= 4 AND d2 <= 9) AS sigma FROM near GROUP BY 1)
 SELECT frame_id AS spot_id, round(total - bg * area, 6) AS net, area, round(bg, 6) AS background, round(sigma, 6) AS sigma, round(sqrt(abs(total - bg * area) + area * sigma * sigma), 6) AS err FROM g"""
)
def x04_j15_apertures(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixel_table(spark, sf_dir)
    ids = p.select("frame_id").distinct()
    spots = ids.select(F.col("frame_id").alias("spot_id"), "frame_id", F.lit(3.5e0).alias("sx"), F.lit(3.5e0).alias("sy"), F.lit(0.5e0).alias("fwhm_px"))
    size = ids.select("frame_id", F.lit(8).alias("width"), F.lit(8).alias("height"))
    got = pixels.apertures(p, spots, size, block=4, margin=0)
    return got.select("spot_id", *[F.round(c, 6).alias(c) for c in ("net", "background", "sigma", "err")], "area")


@query(
    f"""WITH {clauses("frames", "catalog", "sources")}, {MATCHED}, m AS (SELECT s.frame_id, m.catalog_name, m.catalog_id FROM matched m JOIN sources s ON s.obs_id = m.obs_id), foot AS (SELECT f.frame_id, k.* FROM frames f JOIN catalog k ON abs(f.dec_center - k.dec) < 1.1e0 WHERE {separation_sql("f.ra_center", "f.dec_center", "k.ra", "k.dec")} <= CASE k.catalog_name WHEN 'MPC' THEN 1e0 ELSE 5e-1 * sqrt(2e0) END * 3.6e3 AND k.catalog_name IN ('Gaia DR3', 'MPC'))
 SELECT frame_id, catalog_name, catalog_id FROM foot WHERE (catalog_name = 'MPC' OR catalog_mag <= 20) AND NOT EXISTS (SELECT 1 FROM m WHERE m.frame_id = foot.frame_id AND m.catalog_name = foot.catalog_name AND m.catalog_id = foot.catalog_id)"""
)
def j09_not_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = _two(spark, sf_dir)
    wanted = k.where("catalog_name = 'MPC' OR catalog_name = 'Gaia DR3' AND catalog_mag <= 20")
    have = matching.matched(s, k).join(s.select("obs_id", "frame_id"), "obs_id")
    return matching.unmatched_footprint(derived(spark, sf_dir, "frames"), wanted, have, FOV)


@query(f"WITH {clauses('sources')} SELECT obs_id, frame_id, 'detection' AS origin, catalog_name FROM sources WHERE NOT from_subtraction UNION ALL SELECT obs_id, frame_id, 'difference', NULL FROM sources WHERE from_subtraction")
def u01_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources")
    found = s.where("NOT from_subtraction").select("obs_id", "frame_id", F.lit("detection").alias("origin"), "catalog_name")
    return found.unionByName(s.where("from_subtraction").select("obs_id", "frame_id", F.lit("difference").alias("origin")), allowMissingColumns=True)


#: A frame for each vector's image, with a projection of two arcseconds a pixel, and four catalogue rows in it; a quarter has a match.
IMAGES = """SELECT vec_id AS frame_id, cast(vec_id * 7 % 360 AS double) AS crval1, cast(vec_id * 11 % 121 AS double) - 6e1 AS crval2, 2e0 / 36e2 AS px, 2016e0 + vec_id % 10 AS epoch, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE 25e0 + vec_id % 3 END AS zero_point FROM embeddings"""
STARS = """SELECT frame_id, CASE WHEN k = 3 THEN 'MPC' ELSE 'Gaia DR3' END AS catalog_name, concat('S', cast(frame_id AS string), '-', cast(k AS string)) AS catalog_id, crval2 + (k * 3e-1 - 4e-1) * px AS dec, crval1 + (3e-1 - k * 2e-1) * px / cos(radians(crval2)) AS ra,
 CASE WHEN k = 1 THEN NULL ELSE 4e1 * k END AS pmra, -3e1 AS pmdec, CASE WHEN k = 2 THEN 2015e0 END AS ref_epoch, 14e0 + k * 3 + frame_id % 3 AS catalog_mag, (frame_id + k) % 4 = 0 AS has_match FROM images CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k)"""


@query(
    f"""WITH {PIXELS_SQL}, images AS ({IMAGES}), stars AS ({STARS}), open AS (SELECT s.*, i.crval1, i.crval2, i.px, i.epoch, i.zero_point, i.epoch - coalesce(ref_epoch, 2016e0) AS dt FROM stars s JOIN images i USING (frame_id) WHERE NOT has_match AND (catalog_name = 'MPC' OR catalog_mag <= 20)),
 moved AS (SELECT * EXCLUDE (ra, dec), CASE WHEN catalog_name = 'MPC' OR pmra IS NULL OR dt = 0 THEN ra ELSE ra + pmra / 1e3 / 3.6e3 * dt / cos(radians(dec)) END AS ra, CASE WHEN catalog_name = 'MPC' OR pmra IS NULL OR dt = 0 THEN dec ELSE dec + pmdec / 1e3 / 3.6e3 * dt END AS dec FROM open),
 den AS (SELECT *, sin(radians(crval2)) * sin(radians(dec)) + cos(radians(crval2)) * cos(radians(dec)) * cos(radians(ra - crval1)) AS den FROM moved),
 spot AS (SELECT *, 3.5e0 - degrees(cos(radians(dec)) * sin(radians(ra - crval1)) / den) / px AS sx, 3.5e0 + degrees((cos(radians(crval2)) * sin(radians(dec)) - sin(radians(crval2)) * cos(radians(dec)) * cos(radians(ra - crval1))) / den) / px AS sy FROM den),
 near AS (SELECT s.*, p.adu, (p.x - sx) ** 2 + (p.y - sy) ** 2 AS d2 FROM spot s JOIN pixels p USING (frame_id) WHERE sx >= 3 AND sy >= 3 AND sx < 5 AND sy < 5),
 g AS (SELECT frame_id, catalog_id, any_value(ra) AS ra, any_value(dec) AS dec, any_value(zero_point) AS zero_point, sum(adu) FILTER (d2 <= 1) AS total, count(*) FILTER (d2 <= 1) AS area, median(adu) FILTER (d2 >= 4 AND d2 <= 9) AS bg, stddev_pop(adu) FILTER (d2 >= 4 AND d2 <= 9) AS sigma FROM near GROUP BY ALL),
 m AS (SELECT *, total - bg * area AS net, sqrt(abs(total - bg * area) + area * sigma * sigma) AS err FROM (SELECT frame_id, catalog_id, min(ra) AS ra, min(dec) AS dec, min(zero_point) AS zero_point, min(total) AS total, min(area) AS area, min(bg) AS bg, min(sigma) AS sigma FROM g GROUP BY 1, 2))
 SELECT frame_id, catalog_id, 'forced' AS origin, round(ra, 6) AS ra, round(dec, 6) AS dec, round(net, 4) AS flux, round(err, 4) AS flux_err, round(zero_point - 2.5e0 * log10(net), 4) AS mag FROM m WHERE net > 0 AND err > 0 AND net / err >= 1.5 UNION ALL SELECT frame_id, catalog_id, 'detection', round(ra, 6), round(dec, 6), NULL, NULL, NULL FROM stars WHERE has_match"""
)
def x05_u01_forced_and_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows that a frame has no match for are measured at their place and join what was found."""
    images = spark.sql(IMAGES.replace("FROM embeddings", "FROM {e}"), e=table(spark, sf_dir, "embeddings"))
    stars = spark.sql(STARS.replace("FROM images", "FROM {i}"), i=images).withColumn("object_type", F.lit("STAR"))
    wcs = F.struct(F.lit(4.5e0).alias("crpix1"), F.lit(4.5e0).alias("crpix2"), "crval1", "crval2", (-F.col("px")).alias("cd11"), F.lit(0e0).alias("cd12"), F.lit(0e0).alias("cd21"), F.col("px").alias("cd22"))
    frames = images.select("frame_id", "epoch", wcs.alias("wcs"), F.lit(0.5e0).alias("fwhm_px"), "zero_point", F.lit(0.1e0).alias("zero_point_err"))
    size = images.select("frame_id", F.lit(8).alias("width"), F.lit(8).alias("height"))
    found = stars.where("has_match")
    places = recovery.spots(stars.drop("has_match"), found, frames)
    forced = recovery.recovered(places, pixel_table(spark, sf_dir), size, 1.5, block=4, margin=0)
    rows = recovery.all_rows(found.select("frame_id", "catalog_id", "ra", "dec"), found.select("frame_id", "ra", "dec").limit(0), forced)
    return rows.select("frame_id", "catalog_id", "origin", F.round("ra", 6).alias("ra"), F.round("dec", 6).alias("dec"), F.round("flux", 4).alias("flux"), F.round("flux_err", 4).alias("flux_err"), F.round("mag", 4).alias("mag"))


query()(a05_offsets)
query()(track_reports)
