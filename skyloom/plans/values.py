"""Queries of the column expressions: names, times, geometry, photometry, labels, settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import names, photometry, sky
from skyloom.plans.fixtures import clauses
from skyloom.plans.fixtures import sky as derived
from skyloom.plans.registry import query, separation_sql, table
from skyloom.sources import settings

RAW_NAMES = """SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN concat('m ', cast(p_partkey AS string)) WHEN 1 THEN concat('NGC_', cast(p_partkey AS string)) WHEN 2 THEN concat('sh2-', cast(p_partkey AS string))
 WHEN 3 THEN concat('abell ', cast(p_partkey AS string)) WHEN 4 THEN concat('Mrk-', cast(p_partkey AS string), ' ', cast(p_partkey % 7 AS string)) WHEN 5 THEN p_name WHEN 6 THEN concat('  ', p_name, '!! (test)') WHEN 7 THEN ''
 WHEN 8 THEN NULL WHEN 9 THEN '??' WHEN 10 THEN concat('C', cast(p_partkey AS string)) ELSE concat('__', p_brand, '__x  y') END AS raw FROM part"""

NAME_CASES = r"""CASE WHEN raw IS NULL OR trim(raw) = '' THEN '_UNKNOWN'
 WHEN regexp_matches(trim(raw), '^[mM][_\s\-]*\d+$') THEN concat('M', regexp_extract(trim(raw), '(\d+)$', 1))
 WHEN regexp_matches(trim(raw), '^[cC][_\s\-]*\d+$') THEN concat('C', regexp_extract(trim(raw), '(\d+)$', 1))
 WHEN regexp_matches(trim(raw), '(?i)^sh2?[_\s\-]*\d+$') THEN concat('SH2-', regexp_extract(trim(raw), '(?i)^sh2?[_\s\-]*(\d+)$', 1))
 WHEN regexp_matches(trim(raw), '(?i)^abell[_\s\-]*\d+$') THEN concat('Abell', regexp_extract(trim(raw), '(\d+)$', 1))
 WHEN regexp_matches(trim(raw), '(?i)^(ngc|ic|ugc|pgc|mcg|mrk|arp|vcc|eso|ugca)[_\s\-]*\d+([_\s\-]\d+)*$') THEN upper(regexp_replace(trim(raw), '[_\s\-]', '', 'g'))
 WHEN trim(regexp_replace(regexp_replace(replace(trim(raw), ' ', '_'), '[^A-Za-z0-9_\-+]', '', 'g'), '_+', '_', 'g'), '_') = '' THEN '_UNKNOWN'
 ELSE trim(regexp_replace(regexp_replace(replace(trim(raw), ' ', '_'), '[^A-Za-z0-9_\-+]', '', 'g'), '_+', '_', 'g'), '_') END"""


@query(f"WITH n AS ({RAW_NAMES}) SELECT p_partkey, {NAME_CASES} AS name, nullif(trim(raw), '') AS raw FROM n")
def p01_object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_NAMES.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    return rows.select("p_partkey", names.object_name(F.col("raw")).alias("name"), F.when(F.trim("raw") != "", F.trim("raw")).alias("raw"))


RAW_WORDS = """SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'Luminance' WHEN 1 THEN 'H-Alpha' WHEN 2 THEN ' red Filter' WHEN 3 THEN '[OIII]' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN 's2' WHEN 7 THEN p_brand WHEN 8 THEN 'nii filter' ELSE 'clear' END AS f,
 CASE p_partkey % 7 WHEN 0 THEN 'Light Frame' WHEN 1 THEN 'DARK' WHEN 2 THEN 'skyflat' WHEN 3 THEN 'offset' WHEN 4 THEN ' ' WHEN 5 THEN p_type ELSE NULL END AS t FROM part"""


@query(
    f"""WITH w AS ({RAW_WORDS}), x AS (SELECT p_partkey, nullif(trim(f), '') AS f, nullif(trim(t), '') AS t FROM w), y AS (SELECT *, lower(regexp_replace(f, '(?i)\\s*filter$', '')) AS k FROM x),
 z AS (SELECT p_partkey, CASE k WHEN 'luminance' THEN 'L' WHEN 'clear' THEN 'L' WHEN 'h-alpha' THEN 'Ha' WHEN 'red' THEN 'R' WHEN '[oiii]' THEN 'OIII' WHEN 's2' THEN 'SII' WHEN 'nii' THEN 'NII' ELSE f END AS filter_name,
 CASE lower(t) WHEN 'light frame' THEN 'Light' WHEN 'dark' THEN 'Dark' WHEN 'skyflat' THEN 'Flat' WHEN 'offset' THEN 'Bias' ELSE t END AS frame_type FROM y)
 SELECT *, coalesce(filter_name IN ('Ha', 'OIII', 'SII', 'NII'), false) AS narrowband, coalesce(frame_type IN ('Dark', 'Flat', 'Bias'), false) AS calibration FROM z"""
)
def p02_p03_f01_f04_vocabularies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_WORDS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    kind = names.frame_type(F.col("t"))
    return rows.select("p_partkey", names.filter_name(F.col("f")).alias("filter_name"), kind.alias("frame_type"), names.is_narrowband(F.col("f")).alias("narrowband"), F.coalesce(kind.isin("Dark", "Flat", "Bias"), F.lit(False)).alias("calibration"))


RAW_ANGLES = """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN concat(cast(o_orderkey % 24 AS string), ' ', cast(o_custkey % 60 AS string), ' ', cast(o_orderkey % 60 AS string), '.5') WHEN 1 THEN concat(cast(o_orderkey % 24 AS string), ':', cast(o_custkey % 60 AS string), ':00')
 WHEN 2 THEN cast(o_orderkey % 360 AS string) ELSE NULL END AS ra, CASE o_orderkey % 5 WHEN 0 THEN concat('-00 ', cast(o_custkey % 60 AS string), ' 30') WHEN 1 THEN concat('+', cast(o_orderkey % 90 AS string), ':', cast(o_custkey % 60 AS string), ':15') WHEN 2 THEN '-12.5' WHEN 3 THEN 'bad text' ELSE '7' END AS dec FROM orders"""


@query(
    f"""WITH r AS ({RAW_ANGLES}), s AS (SELECT o_orderkey, ra, dec, regexp_split_to_array(ra, '[\\s:]+') AS a, regexp_split_to_array(regexp_replace(dec, '^[+-]', ''), '[\\s:]+') AS d FROM r)
 SELECT o_orderkey, CASE WHEN regexp_matches(ra, '[\\s:]') THEN (try_cast(a[1] AS double) + try_cast(a[2] AS double) / 6e1 + try_cast(a[3] AS double) / 3.6e3) * 15e0 ELSE try_cast(ra AS double) END AS ra_deg,
 CASE WHEN dec = 'bad text' THEN NULL WHEN regexp_matches(dec, '[\\s:]') THEN (try_cast(d[1] AS double) + try_cast(d[2] AS double) / 6e1 + try_cast(d[3] AS double) / 3.6e3) * CASE WHEN starts_with(dec, '-') THEN -1e0 ELSE 1e0 END ELSE try_cast(dec AS double) END AS dec_deg FROM s"""
)
def p04_sexagesimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_ANGLES.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    return rows.select("o_orderkey", names.degrees_of(F.col("ra"), True).alias("ra_deg"), names.degrees_of(F.col("dec"), False).alias("dec_deg"))


RAW_TIMES = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN concat('2024-03-15T22:01:', cast(10 + event_id % 50 AS string)) WHEN 1 THEN '' ELSE NULL END AS d, CASE event_id % 6 WHEN 1 THEN concat('2024-03-15 21:01:', cast(10 + event_id % 50 AS string)) ELSE NULL END AS t, cast(60000 + event_id % 1000 AS string) AS m FROM events"""


@query(f"""WITH r AS ({RAW_TIMES}) SELECT event_id, CASE WHEN event_id % 3 = 0 THEN cast(d AS timestamp) WHEN event_id % 6 = 1 THEN cast(t AS timestamp) ELSE cast(date '2023-02-25' + cast(cast(m AS bigint) - 60000 AS integer) AS timestamp) END AS obs_time FROM r""")
def p05_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_TIMES.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    return rows.select("event_id", names.observed_at(F.col("d"), F.col("t"), F.col("m")).alias("obs_time"))


RAW_FILES = """SELECT p_partkey, p_size, concat(CASE p_partkey % 3 WHEN 0 THEN 'm_51' WHEN 1 THEN 'Andromeda_Galaxy' ELSE concat('NGC', cast(p_partkey AS string)) END, CASE p_partkey % 4 WHEN 0 THEN '_Light_L_300.fits' WHEN 1 THEN '_300_2024.FIT' WHEN 2 THEN '_bias_x.fits' ELSE '.fits' END) AS file,
 CASE p_partkey % 3 WHEN 0 THEN 'Light' WHEN 1 THEN 'Dark' ELSE NULL END AS kind, CASE p_partkey % 2 WHEN 0 THEN 'Ha' ELSE NULL END AS filt, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 2.5e0 ELSE cast(p_size AS double) END AS exptime,
 CASE p_partkey % 6 WHEN 0 THEN NULL ELSE concat('2024-03-15T22:01:', cast(10 + p_partkey % 50 AS string), '.125') END AS obs_time, CASE p_partkey % 4 WHEN 0 THEN p_size ELSE NULL END AS seq FROM part"""


@query(
    f"""WITH f AS ({RAW_FILES}), o AS (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'Andromeda_Galaxy' ELSE concat('NGC', cast(p_partkey AS string)) END AS obj FROM f)
 SELECT p_partkey, obj AS object_name, CASE WHEN obs_time IS NOT NULL THEN concat(concat_ws('_', obj, kind, CASE WHEN kind = 'Light' THEN filt END, CASE WHEN exptime = floor(exptime) THEN cast(cast(exptime AS bigint) AS string) ELSE printf('%.1f', exptime) END, regexp_replace(replace(obs_time, ':', '-'), '\\.\\d+', ''), lpad(cast(seq AS string), 3, '0')), '.fits') END AS file_name,
 trim(regexp_replace(regexp_replace(replace(concat(file, ' (1)'), ' ', '_'), '[^A-Za-z0-9_\\-+.]', '', 'g'), '_+', '_', 'g'), '_') AS safe FROM o"""
)
def p06_p07_p08_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_FILES.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    obj = names.object_from_filename(F.col("file"))
    return rows.select("p_partkey", obj.alias("object_name"), names.file_name(obj, F.col("kind"), F.col("filt"), F.col("exptime"), F.col("obs_time"), F.col("seq")).alias("file_name"), names.safe_name(F.concat("file", F.lit(" (1)"))).alias("safe"))


RAW_OPTICS = """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size / 1e1 WHEN 1 THEN 5e2 ELSE NULL END AS pixscale, CASE p_partkey % 4 WHEN 0 THEN NULL ELSE 3.76e0 + p_size / 1e1 END AS um, CASE p_partkey % 5 WHEN 0 THEN NULL ELSE 4e2 + p_partkey % 700 END AS focal, cast(1000 + p_size AS int) AS w, cast(800 + p_partkey % 900 AS int) AS h, cast(1 + p_partkey % 2 AS int) AS bx, cast(1 + p_partkey % 3 AS int) AS by2, CASE p_partkey % 7 WHEN 0 THEN 1.5e0 END AS solved FROM part"""


@query(
    f"""WITH o AS ({RAW_OPTICS}) SELECT p_partkey, coalesce(CASE WHEN pixscale BETWEEN 1e-2 AND 2e2 THEN pixscale END, CASE WHEN focal > 0 AND um > 0 THEN 206265e0 * (um / 1e3) / focal END) AS scale_arcsec,
 coalesce(solved, CASE WHEN focal > 0 THEN greatest(w, h) * 206265e0 * (coalesce(um, 3.76e0) * greatest(bx, by2) / 1e3) / focal / 3.6e3 END) AS fov_deg FROM o"""
)
def p09_p10_scale_and_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(RAW_OPTICS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
    c = F.col
    return rows.select("p_partkey", names.plate_scale(c("pixscale"), c("um"), c("focal")).alias("scale_arcsec"), names.field_of_view(c("w"), c("h"), c("um"), c("bx"), c("by2"), c("focal"), c("solved")).alias("fov_deg"))


MOUNT = "SELECT obs_id, CASE WHEN obs_id % 9 = 0 THEN NULL ELSE (ra + 359.99e0) % 36e1 END AS ra_m, dec + 1e-2 AS dec_m, ra AS ra_s, dec AS dec_s FROM sources"


@query(
    f"""WITH {clauses("sources")}, m AS ({MOUNT}) SELECT obs_id, CASE WHEN ra_m IS NOT NULL THEN round({separation_sql("ra_m", "dec_m", "ra_s", "dec_s")}, 6) END AS total,
 round(((((ra_s - ra_m + 18e1) % 36e1) + 36e1) % 36e1 - 18e1) * cos(radians(dec_m)) * 3.6e3, 6) AS along_ra, CASE WHEN ra_m IS NOT NULL THEN round((dec_s - dec_m) * 3.6e3, 6) END AS along_dec FROM m"""
)
def p11_p16_pointing_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(MOUNT.replace("FROM sources", "FROM {s}"), s=derived(spark, sf_dir, "sources"))
    e = sky.pointing_error("ra_m", "dec_m", "ra_s", "dec_s")
    return rows.select("obs_id", F.round(e["pointing_error_arcsec"], 6).alias("total"), F.round(e["pointing_error_ra_arcsec"], 6).alias("along_ra"), F.round(e["pointing_error_dec_arcsec"], 6).alias("along_dec"))


@query(
    f"""WITH {clauses("detections")} SELECT obs_id, round(2e0 * sqrt(2e0 * ln(2e0) * (a * a + b * b) / 2e0), 9) AS fwhm_px, CASE WHEN b <= 0 THEN a / 1e-6 ELSE a / b END AS elong_extract, CASE WHEN b <= 0 THEN 1e0 ELSE a / b END AS elong_quality, a / greatest(b, 1e-3) AS elong_diff,
 peak + background >= 60000 AS saturated, peak / rms AS snr_detect, CASE WHEN npix > 0 THEN round(flux / (rms * sqrt(npix)), 9) ELSE 0e0 END AS snr_diff,
 x < 5e-2 * 4096 OR x > 4096 - 5e-2 * 4096 OR y < 5e-2 * 3072 OR y > 3072 - 5e-2 * 3072 AS near_edge, x < 10 OR x > 4086 OR y < 10 OR y > 3062 AS edge_flag FROM detections"""
)
def p12_p13_p14_shapes_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, c = derived(spark, sf_dir, "detections"), F.col
    w, h = F.lit(4096), F.lit(3072)
    e = {f"elong_{n}": photometry.elongation(c("a"), c("b"), v) for n, v in (("extract", "extraction"), ("quality", "quality"), ("diff", "difference"))}
    return d.select("obs_id", F.round(photometry.fwhm_px(c("a"), c("b")), 9).alias("fwhm_px"), *[v.alias(k) for k, v in e.items()], photometry.saturated(c("peak"), c("background")).alias("saturated"), photometry.ratio(c("peak"), c("rms")).alias("snr_detect"), F.round(photometry.difference_snr(c("flux"), c("rms"), c("npix")), 9).alias("snr_diff"), photometry.near_edge(c("x"), c("y"), w, h).alias("near_edge"), photometry.edge_flag(c("x"), c("y"), w, h).alias("edge_flag"))


@query(
    f"""WITH {clauses("sources")}, x AS (SELECT ra, dec, obs_id, object_type, catalog_id, CASE WHEN obs_id % 5 = 0 THEN NULL ELSE (obs_id % 200) * 1e1 - 1e3 END AS pmra, (obs_id % 90) * 5e0 AS pmdec, CASE WHEN obs_id % 3 = 0 THEN NULL ELSE 2015.5e0 END AS ref FROM sources)
 SELECT obs_id, round_even(ra / 1e-1, 0) * 1e-1 AS tile_ra, round_even(dec / 1e-1, 0) * 1e-1 AS tile_dec, round(CASE WHEN pmra IS NULL THEN ra ELSE ra + pmra / 1e3 / 3.6e3 * (2024e0 - coalesce(ref, 2016e0)) / cos(radians(dec)) END, 9) AS ra_now, round(CASE WHEN pmra IS NULL THEN dec ELSE dec + pmdec / 1e3 / 3.6e3 * (2024e0 - coalesce(ref, 2016e0)) END, 9) AS dec_now,
 coalesce(contains(object_type, 'V*') OR contains(object_type, 'RR') OR contains(object_type, 'Cep') OR contains(object_type, 'BY') OR contains(object_type, 'RS') OR contains(object_type, 'Ell') OR contains(object_type, 'bL'), false) AS variable,
 coalesce(contains(object_type, '**') OR contains(object_type, 'EB') OR contains(object_type, 'SB'), false) AS is_binary, coalesce(contains(object_type, 'G'), false) AS galaxy FROM x"""
)
def p17_p18_p19_tiles_types_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = derived(spark, sf_dir, "sources").selectExpr("*", "CASE WHEN obs_id % 5 = 0 THEN NULL ELSE (obs_id % 200) * 1e1 - 1e3 END AS pmra", "(obs_id % 90) * 5e0 AS pmdec", "CASE WHEN obs_id % 3 = 0 THEN NULL ELSE 2015.5e0 END AS ref")
    ra, dec = sky.propagated("ra", "dec", "pmra", "pmdec", F.lit(2024e0), F.col("ref"))
    kind = names.object_class(F.col("object_type"))
    return s.select("obs_id", sky.tile("ra").alias("tile_ra"), sky.tile("dec").alias("tile_dec"), F.round(ra, 9).alias("ra_now"), F.round(dec, 9).alias("dec_now"), kind["variable"].alias("variable"), kind["binary"].alias("is_binary"), kind["galaxy"].alias("galaxy"))


@query(
    f"""WITH {clauses("detections")}, w AS (SELECT d.obs_id, d.x - 2048e0 AS dx, d.y - 1536e0 AS dy, o.ra0, o.dec0 FROM detections d JOIN sky_obs o ON o.obs_id = d.obs_id), p AS (SELECT obs_id, ra0, dec0, radians(-2.8e-4 * dx + 1e-5 * dy) AS xi, radians(1e-5 * dx + 2.8e-4 * dy) AS eta FROM w),
 q AS (SELECT obs_id, ra0, dec0, (((ra0 + degrees(atan2(xi, cos(radians(dec0)) - eta * sin(radians(dec0))))) % 36e1) + 36e1) % 36e1 AS ra, degrees(atan2(sin(radians(dec0)) + eta * cos(radians(dec0)), sqrt((cos(radians(dec0)) - eta * sin(radians(dec0))) * (cos(radians(dec0)) - eta * sin(radians(dec0))) + xi * xi))) AS dec FROM p)
 SELECT obs_id, round(ra, 8) AS ra, round(dec, 8) AS dec, round(degrees(atan2((CASE WHEN ra - ra0 > 18e1 THEN ra - ra0 - 36e1 WHEN ra - ra0 < -18e1 THEN ra - ra0 + 36e1 ELSE ra - ra0 END) * cos(radians(dec0)), dec - dec0)), 5) AS pa FROM q"""
)
def p20_p21_tangent_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = derived(spark, sf_dir, "detections").select("obs_id", "x", "y").join(derived(spark, sf_dir, "sky_obs").select("obs_id", "ra0", "dec0"), "obs_id")
    w = F.struct(F.lit(2048e0).alias("crpix1"), F.lit(1536e0).alias("crpix2"), F.col("ra0").alias("crval1"), F.col("dec0").alias("crval2"), F.lit(-2.8e-4).alias("cd11"), F.lit(1e-5).alias("cd12"), F.lit(1e-5).alias("cd21"), F.lit(2.8e-4).alias("cd22"))
    ra, dec = sky.pixel_to_sky("x", "y")
    placed = d.withColumn("wcs", w).select("obs_id", "ra0", "dec0", ra.alias("ra"), dec.alias("dec"))
    return placed.select("obs_id", F.round("ra", 8).alias("ra"), F.round("dec", 8).alias("dec"), F.round(sky.position_angle("ra0", "dec0", "ra", "dec"), 5).alias("pa"))


@query(
    """WITH e AS (SELECT event_id, (event_id % 977) * 7.301e0 AS s, (event_id % 101) * 0.773e0 AS h, CASE event_id % 5 WHEN 0 THEN 'ASTEROID' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'SPACE_DEBRIS' WHEN 3 THEN NULL ELSE 'VARIABLE_STAR' END AS k, CASE event_id % 3 WHEN 0 THEN '2024 AB1' END AS d, event_id % 4 AS n FROM events),
 f AS (SELECT *, CASE WHEN s < 60 THEN printf('%.2f″', s) WHEN s < 3600 THEN printf('%.2f′', s / 6e1) ELSE printf('%.3f°', s / 3.6e3) END AS shift, coalesce(d, CASE WHEN k IN ('ASTEROID', 'SPACE_DEBRIS') THEN concat('s', cast(event_id AS string)) END) AS ident FROM e),
 g AS (SELECT *, CASE WHEN k IS NOT NULL AND ident IS NOT NULL THEN concat(k, ' (', ident, ')') ELSE coalesce(k, ident) END AS label FROM f)
 SELECT event_id, CASE WHEN h > 0 THEN concat('Δ', shift, ' in ', CASE WHEN h < 1 THEN printf('%.0fmin', h * 6e1) WHEN h < 24 THEN printf('%.1fhr', h) ELSE printf('%.1fd', h / 24e0) END, printf(' (%.1f″/hr)', s / h)) ELSE concat('Δ', shift) END AS motion, label,
 CASE WHEN ident IS NOT NULL AND k IS NOT NULL THEN concat('(', ident, ')') END AS designation, CASE WHEN n <= 1 THEN 'before_after' WHEN k IN ('ASTEROID', 'SPACE_DEBRIS') THEN 'track' ELSE 'stamp_strip' END AS presentation FROM g"""
)
def p22_p23_p24_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").selectExpr("event_id", "(event_id % 977) * 7.301e0 AS s", "(event_id % 101) * 0.773e0 AS h", "CASE event_id % 5 WHEN 0 THEN 'ASTEROID' WHEN 1 THEN 'UNKNOWN' WHEN 2 THEN 'SPACE_DEBRIS' WHEN 3 THEN NULL ELSE 'VARIABLE_STAR' END AS k", "CASE event_id % 3 WHEN 0 THEN '2024 AB1' END AS d", "event_id % 4 AS n")
    label = names.moving_label(F.col("k"), F.col("d"), F.concat(F.lit("s"), F.col("event_id").cast("string")))
    return e.select("event_id", sky.motion_label("s", "h").alias("motion"), label.alias("label"), names.label_parts(label)[1].alias("designation"), names.presentation(F.col("n"), F.col("k")).alias("presentation"))


GIVEN = """SELECT o_orderkey AS run, CASE o_orderkey % 6 WHEN 0 THEN 'DELTA_MAG_ALERT' WHEN 1 THEN 'QC_STARS_MIN' WHEN 2 THEN 'FORCED_PHOTOMETRY_ENABLED' WHEN 3 THEN 'LOG_LEVEL' WHEN 4 THEN 'API_KEY' ELSE 'MATCH_CONE_ARCSEC' END AS param,
 CASE o_orderkey % 6 WHEN 0 THEN '0.75' WHEN 1 THEN CASE WHEN o_custkey % 2 = 0 THEN '12' ELSE 'many' END WHEN 2 THEN 'Yes' WHEN 3 THEN ' debug ' WHEN 4 THEN 'x' ELSE cast(o_custkey % 10 AS string) END AS value FROM orders"""


@query(
    f"""WITH g AS ({GIVEN}) SELECT run, CASE WHEN param = 'DELTA_MAG_ALERT' THEN 0.75e0 ELSE 0.5e0 END AS delta_mag, CASE WHEN param = 'QC_STARS_MIN' AND value = '12' THEN cast(12 AS bigint) ELSE cast(10 AS bigint) END AS stars_min,
 CASE WHEN param = 'LOG_LEVEL' THEN 'DEBUG' ELSE 'INFO' END AS log_level, CASE WHEN param = 'MATCH_CONE_ARCSEC' THEN cast(value AS double) ELSE 5e0 END AS match_cone FROM g"""
)
def k10_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.sql(GIVEN.replace("FROM orders", "FROM {orders}"), orders=table(spark, sf_dir, "orders"))
    wide = settings.one_row(settings.applied(given), "DELTA_MAG_ALERT", "QC_STARS_MIN", "LOG_LEVEL", "MATCH_CONE_ARCSEC")
    return wide.select("run", F.col("DELTA_MAG_ALERT").cast("double").alias("delta_mag"), F.col("QC_STARS_MIN").cast("long").alias("stars_min"), F.col("LOG_LEVEL").alias("log_level"), F.col("MATCH_CONE_ARCSEC").cast("double").alias("match_cone"))
