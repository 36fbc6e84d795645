"""Sky tables derived from the delivered ones: the same text runs in Spark SQL and in DuckDB.

The WITH clauses build on each other; `with_sky(query, upto)` puts those that a query needs before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SKY_OBS = """
SELECT event_id AS obs_id, user_id, concat(cast(user_id AS string), '_', cast(cast(ts AS date) AS string)) AS frame_id,
       concat('OBJ', cast(user_id AS string)) AS object, ts AS obs_ts, event_type, value,
       cast((user_id * 7) % 360 AS double) AS ra0, cast((user_id * 11) % 121 AS double) - 6e1 AS dec0, event_id % 7 AS star
FROM events"""

FRAMES = """
SELECT frame_id, object, min(obs_ts) AS obs_time, min(ra0) AS ra_center, min(dec0) AS dec_center, 1e0 AS fov_deg,
       CASE min(user_id) % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'R' ELSE CASE WHEN day(min(obs_ts)) % 2 = 0 THEN 'Ha' ELSE 'B' END END AS filter
FROM sky_obs GROUP BY frame_id, object"""

SOURCES = """
SELECT o.obs_id, o.frame_id, f.object, f.obs_time, f.filter,
       (o.ra0 + (o.star - 3) * 5e-2 + CASE WHEN o.event_type = 'error' THEN (o.obs_id % 17) * 2e1 / 36e2 ELSE (o.obs_id % 3) * 5e-1 / 36e2 END + 36e1) % 36e1 AS ra,
       o.dec0 + (o.star - 3) * 5e-2 + CASE WHEN o.event_type = 'error' THEN (o.obs_id % 19) * 2e1 / 36e2 ELSE (o.obs_id % 2) * 5e-1 / 36e2 END AS dec,
       CASE WHEN o.obs_id % 11 = 0 THEN NULL ELSE 12e0 + o.value / 1e2 END AS mag, o.value * 1e1 AS flux, 1e0 + (o.obs_id % 61) / 8e0 AS elongation,
       o.obs_id % 41 = 0 AS saturated, o.obs_id % 10 = 0 AS near_edge, o.obs_id % 13 = 0 AS from_subtraction,
       CASE o.event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'Gaia DR3' WHEN 'purchase' THEN 'Simbad' WHEN 'view' THEN '2MASS'
            ELSE CASE WHEN o.obs_id % 5 = 0 THEN 'MPC' ELSE 'Pan-STARRS' END END AS catalog_name,
       CASE WHEN o.event_type = 'error' THEN NULL ELSE concat(o.object, '-', cast(o.star AS string)) END AS catalog_id,
       CASE WHEN o.event_type = 'error' THEN NULL
            WHEN o.event_type = 'purchase' THEN CASE o.obs_id % 5 WHEN 0 THEN 'G' WHEN 1 THEN 'EB*' WHEN 2 THEN 'V*' WHEN 3 THEN 'AGN' ELSE 'Cep*' END
            WHEN o.event_type = 'signup' AND o.obs_id % 5 = 0 THEN CASE WHEN o.obs_id % 10 = 0 THEN 'COMET' ELSE 'ASTEROID' END
            ELSE 'STAR' END AS object_type
FROM sky_obs o JOIN frames f ON o.frame_id = f.frame_id"""

CATALOG = """
SELECT v.catalog_name, v.prio, concat(v.catalog_name, ' ', cast(k.user_id AS string), '-', cast(k.star AS string)) AS catalog_id,
       (k.ra0 + (k.star - 3) * 5e-2 + v.off_arcsec / 36e2 + 36e1) % 36e1 AS ra, k.dec0 + (k.star - 3) * 5e-2 + v.off_arcsec / 36e2 AS dec,
       CASE WHEN v.catalog_name IN ('Simbad', 'MPC') THEN NULL ELSE 12e0 + (k.user_id + k.star) % 9 END AS catalog_mag,
       CASE v.catalog_name WHEN 'MPC' THEN CASE WHEN k.star % 2 = 0 THEN 'COMET' ELSE 'ASTEROID' END
            WHEN 'Simbad' THEN CASE (k.user_id + k.star) % 5 WHEN 0 THEN 'G' WHEN 1 THEN 'EB*' WHEN 2 THEN 'V*' WHEN 3 THEN 'AGN' ELSE 'Cep*' END
            ELSE 'STAR' END AS object_type
FROM (SELECT DISTINCT user_id, ra0, dec0, star FROM sky_obs) k
JOIN (VALUES ('Simbad', 0, 1e0), ('Gaia DR3', 1, 5e-1), ('2MASS', 2, 2e0), ('Pan-STARRS', 3, -1e0), ('MPC', 4, 6e1)) AS v(catalog_name, prio, off_arcsec)
  ON (k.user_id * 5 + k.star * 3 + v.prio * 7) % 13 < 4"""

#: Raw detections: shapes and signals per source, and the frame's background.
DETECTIONS = """
SELECT obs_id, frame_id, 1e0 + (obs_id % 23) / 8e0 AS a, (obs_id % 11) / 4e0 AS b, value * 1e1 AS flux, 1e0 + (obs_id % 9) AS err,
       value * 6e1 AS peak, cast((obs_id * 37) % 4096 AS double) AS x, cast((obs_id * 53) % 3072 AS double) AS y,
       cast(user_id % 50 AS double) * 1e3 + 1e2 AS background, 1e1 + (obs_id % 7) AS rms, 5e-1 + (user_id % 4) / 2e0 AS scale,
       CASE user_id % 5 WHEN 0 THEN 'Ha' ELSE 'L' END AS filter, obs_id % 40 AS npix
FROM sky_obs"""

PARTS = {"sky_obs": SKY_OBS, "frames": FRAMES, "sources": SOURCES, "catalog": CATALOG, "detections": DETECTIONS}
NEEDS = {"sky_obs": [], "frames": ["sky_obs"], "sources": ["sky_obs", "frames"], "catalog": ["sky_obs"], "detections": ["sky_obs"]}


def clauses(*names: str) -> str:
    """The WITH clauses of these tables and of what they build on, without the word WITH."""
    wanted: list[str] = []

    def want(name: str) -> None:
        for n in NEEDS[name]:
            want(n)
        if name not in wanted:
            wanted.append(name)

    for n in names:
        want(n)
    return ",\n".join(f"{n} AS ({PARTS[n]})" for n in wanted)


def sky(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables. The events are read by path, so nothing is left in the session's catalogue."""
    text = clauses(name).replace("FROM events", "FROM {events}")
    return spark.sql(f"WITH {text} SELECT * FROM {name}", events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frame_id, y, x, adu: each vector of 64 numbers as an image of 8 x 8."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.selectExpr("vec_id AS frame_id", "posexplode(embedding) AS (pos, v)").selectExpr("frame_id", "pos div 8 AS y", "cast(pos % 8 AS long) AS x", "cast(v AS double) * 1e3 AS adu")


PIXELS_SQL = """pixels AS (SELECT vec_id AS frame_id, cast((pos - 1) // 8 AS bigint) AS y, cast((pos - 1) % 8 AS bigint) AS x, cast(embedding[pos] AS double) * 1e3 AS adu
FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS pos FROM embeddings))"""
