"""Boundary cases that the derived tables don't hold."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyloom.functions import names, sky
from skyloom.sources.lineage import written
from skyloom.operators import calibration, classify, dedup, ephemeris, epochs, history, matching, pixels, tracks
from skyloom.operators.cone import cone_pairs, renamed
from skyloom.sources import catalogs, headers, settings, store


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def points(spark, rows, prefix=""):
    return spark.createDataFrame(rows, f"{prefix}id long, {prefix}ra double, {prefix}dec double")


def test_cone_is_exact_at_radius_pole_and_wrap(spark):
    rng = random.Random(3)
    left = [(i, rng.uniform(0, 360), rng.uniform(-90, 90)) for i in range(80)] + [(90, 359.999, 10.0), (91, 123.0, 89.9999), (92, 10.0, 0.0), (93, None, 1.0)]
    right = [(i, ra + rng.uniform(-0.03, 0.03) if ra is not None else 0.0, max(-90.0, min(90.0, dec + rng.uniform(-0.03, 0.03)))) for i, ra, dec in left] + [(190, 0.001, 10.0), (191, 303.0, 89.9999), (192, 10.0, 120 / 3600)]
    l, r = points(spark, left), points(spark, right, "cat_")
    for inclusive in (False, True):
        got = cone_pairs(l, r, 120.0, inclusive).select("id", "cat_id").collect()
        sep = sky.separation_arcsec("ra", "dec", "cat_ra", "cat_dec")
        want = l.join(r, sep <= 120.0 if inclusive else sep < 120.0).select("id", "cat_id").collect()
        assert sorted(got) == sorted(want) and len(got) == len(set(got))
    assert {(90, 190), (91, 191)} <= {tuple(x) for x in got}


def test_names(spark):
    cases = {"M 51": "M51", "m_51": "M51", "UGC_6930": "UGC6930", "Mrk_501": "MRK501", "Abell_1": "Abell1", "Andromeda Galaxy": "Andromeda_Galaxy", "sh2 155": "SH2-155", "": "_UNKNOWN", "??": "_UNKNOWN"}
    for raw, want in cases.items():
        assert one(spark, names.object_name(F.lit(raw))) == want
    assert one(spark, names.object_name(F.lit(None).cast("string"))) == "_UNKNOWN"
    assert one(spark, names.object_from_filename(F.lit("UGC6930_Light_Luminance_300.fits"))) == "UGC6930"
    assert one(spark, names.object_from_filename(F.lit("300_Light.fits"))) == "_UNKNOWN"
    assert one(spark, names.degrees_of(F.lit("-00 30 00"), False)) == -0.5
    assert one(spark, names.degrees_of(F.lit("05:35:16"), True)) == pytest.approx(83.8166667)
    assert one(spark, names.filter_name(F.lit("Blue filter"))) == "B"


def test_wcs_round_trip(spark):
    w = F.struct(*[F.lit(v).alias(k) for k, v in {"crpix1": 100.0, "crpix2": 90.0, "crval1": 359.99, "crval2": 60.0, "cd11": -3e-4, "cd12": 1e-5, "cd21": 1e-5, "cd22": 3e-4}.items()])
    rows = spark.createDataFrame([(0.0, 0.0), (250.0, 10.0), (100.0, 90.0)], "x double, y double").withColumn("wcs", w)
    ra, dec = sky.pixel_to_sky("x", "y")
    back = rows.withColumns({"ra": ra, "dec": dec})
    x, y = sky.sky_to_pixel("ra", "dec")
    for r in back.select("x", "y", x.alias("bx"), y.alias("by")).collect():
        assert (r.bx, r.by) == pytest.approx((r.x, r.y), abs=1e-6)
    assert one(spark, sky.rotation(F.lit(179.0), F.lit(-179.0))) == pytest.approx(-2.0)
    assert one(spark, sky.wrap180(F.lit(-180.0))) == 180.0


def source(**k):
    return {"obs_id": 1, "frame_id": "f", "seq": 1, "ra": 10.0, "dec": 0.0, "flux": 1.0, "catalog_name": None, "catalog_id": None, "from_subtraction": False} | k


KIND = "obs_id long, frame_id string, seq long, ra double, dec double, flux double, catalog_name string, catalog_id string, from_subtraction boolean"


@pytest.mark.parametrize(("order", "left"), [((1, 2, 3), {1, 3}), ((3, 2, 1), {1}), ((2, 1, 3), {1, 3})])
def test_chain_follows_list_order(spark, order, left):
    """A(Simbad) - B(Gaia) - C(2MASS): A beats B; C falls only if it meets B before B has fallen."""
    at = {1: 10.0, 2: 10.0 + 4 / 3600, 3: 10.0 + 8 / 3600}
    name = {1: "Simbad", 2: "Gaia DR3", 3: "2MASS"}
    rows = spark.createDataFrame([source(obs_id=i, seq=s, ra=at[i], catalog_name=name[i], catalog_id=str(i)) for s, i in enumerate(order)], KIND)
    assert {r.obs_id for r in dedup.cross_catalog(rows).collect()} == left


def test_subtraction_pair_and_identity(spark):
    rows = spark.createDataFrame([source(), source(obs_id=2, seq=2, ra=10 + 2 / 3600, from_subtraction=True), source(obs_id=3, seq=3, ra=11.0, catalog_name="Simbad", catalog_id="a", flux=1.0), source(obs_id=4, seq=4, ra=11.0, catalog_name="Simbad", catalog_id="a", flux=5.0), source(obs_id=5, seq=0, ra=12.0, catalog_name="Simbad", catalog_id="a", flux=9.0, from_subtraction=True)], KIND)
    assert {r.obs_id for r in dedup.subtraction_pairs(rows).collect()} == {1, 3, 4, 5}
    kept = {r.obs_id: r.place for r in dedup.by_identity(rows).collect()}
    assert kept == {1: 1, 2: 2, 4: 0}


def test_zero_point_needs_three(spark):
    rows = [("a", "Gaia DR3", False, 100.0, 15.0 + d, "L") for d in (0.0, 0.2)] + [("b", "Gaia DR3", False, 100.0, 15.0 + d, "L") for d in (0.0, 0.2, 0.4, 1.0)] + [("b", "Gaia DR3", True, 100.0, 99.0, "L"), ("b", "Simbad", False, 100.0, 99.0, "L")] + [("c", "Gaia DR3", False, 100.0, 15.0, "Ha")] * 4
    got = calibration.zero_points(spark.createDataFrame(rows, "frame_id string, catalog_name string, saturated boolean, flux double, catalog_mag double, filter string")).collect()
    assert [r.frame_id for r in got] == ["b"] and got[0].zero_point == pytest.approx(20.3) and got[0].zero_point_err == pytest.approx(0.2) and got[0].n_ref == 4


def test_offset_is_recovered(spark):
    rng = random.Random(7)
    stars = [(f"g{i}", rng.uniform(149.5, 150.5), rng.uniform(1.5, 2.5)) for i in range(2500)]
    shift = (31.0, -22.0)
    true = [(i, "f", (s[1] - shift[0] / 3600), s[2] - shift[1] / 3600) for i, s in enumerate(stars[:18])]
    noise = [(100 + i, "f", rng.uniform(149.5, 150.5), rng.uniform(1.5, 2.5)) for i in range(22)]
    sources = spark.createDataFrame([(i, f, ra + rng.gauss(0, 1) / 3600, dec + rng.gauss(0, 1) / 3600) for i, f, ra, dec in true + noise], "obs_id long, frame_id string, ra double, dec double")
    catalog = spark.createDataFrame([("Gaia DR3", *s) for s in stars], "catalog_name string, catalog_id string, ra double, dec double")
    got = matching.offsets(matching.offset_pairs(sources, catalog)).collect()
    assert len(got) == 1 and got[0].dx == pytest.approx(31, abs=1.5) and got[0].dy == pytest.approx(-22, abs=1.5)
    few = matching.offset_pairs(sources.limit(2), catalog)
    assert matching.offsets(few).count() == 0


def test_replayed_write_changes_nothing(spark):
    kind = "frame_id string, source_id string, mag double"
    stored = spark.createDataFrame([("a", "s1", 1.0), ("a", "s2", 1.0), ("b", "s2", 2.0), ("c", "s3", 3.0)], kind)
    batch, affected = spark.createDataFrame([("a", "s1", 9.0), ("a", "s4", 9.0)], kind), spark.createDataFrame([("a",), ("c",)], "frame_id string")
    first = store.reconcile(stored, batch, affected)
    again = store.reconcile(first["observations"], batch, affected)
    assert sorted(first["observations"].collect()) == sorted(again["observations"].collect())
    assert first["counts"].first().asDict() == {"new": 1, "matched": 1, "retracted": 2, "purged": 1}
    assert {r.source_id for r in first["purged"].collect()} == {"s3"}
    assert again["counts"].first().asDict() == {"new": 0, "matched": 2, "retracted": 0, "purged": 0}


def test_settings(spark):
    given = spark.createDataFrame([(1, "QC_STARS_MIN", "x"), (1, "NARROWBAND_FILTERS", "SII, Ha,,"), (1, "API_KEY", "k"), (1, "DELTA_MAG_ALERT", "1.5")], "run long, param string, value string")
    got = {r.param: (r.value, r.given) for r in settings.applied(given).collect()}
    assert got["QC_STARS_MIN"] == ("10", False) and got["NARROWBAND_FILTERS"] == ("Ha,SII", True) and got["DELTA_MAG_ALERT"] == ("1.5", True) and "API_KEY" not in got


def test_headers(spark, tmp_path):
    card = lambda k, v: f"{k:<8}= {v}".ljust(80)
    text = "".join([card("SIMPLE", "T"), card("OBJNAME", "'M 51    '          / a name"), card("EXPTIME", "  abc"), card("XBINNING", "''"), card("BINNING", "2"), card("FILTNAM", "'H-Alpha '"), card("IMAGETYP", "'Light Frame'"), card("RA", "'13 29 52.7'"), card("DEC", "'-00 30 00'"), card("MJD-OBS", "60000.5"), card("OBSERVER", "'O''Brien'"), "END".ljust(80), card("OBJECT", "'late'")]).ljust(2880)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.FITS").write_bytes(text.encode())
    (tmp_path / "b.txt").write_text("no")
    (tmp_path / "long.fit").write_bytes((card("SIMPLE", "T") + "COMMENT".ljust(80) * 700 + card("OBJECT", "'late one'") + "END".ljust(80)).encode() + b"\xff" * 9999)
    late = {r.path[-8:]: r.object_name for r in headers.frames(headers.header_texts(spark, str(tmp_path))).collect()}
    assert late["long.fit"] == "late_one"
    (tmp_path / "long.fit").unlink()
    r = headers.frames(headers.header_texts(spark, str(tmp_path))).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.object_name, r.filter_name, r.frame_type, r.sensor.binning_x, r.observation.exptime, r.observer.observer_name) == ("M51", "Ha", "Light", 2, None, "O'Brien")
    assert r.dec == -0.5 and r.ra == pytest.approx(202.4695833) and str(r.obs_time) == "2023-02-25 12:00:00"


def test_heads_alone_are_read(spark, tmp_path):
    """Bytes read are the header's blocks, however large the image; files without a header have none; a stream takes what is new."""
    import io
    import os

    from skyloom.functions import names
    from skyloom.sources import heads

    card = lambda k, v: f"{k:<8}= {v}".ljust(80)
    head = lambda name, n: (card("SIMPLE", "T") + "COMMENT".ljust(80) * n + card("OBJECT", f"'{name}'") + "END".ljust(80))
    padded = lambda t: t.ljust(-(-len(t) // 2880) * 2880).encode()
    for n, blocks in ((0, 1), (33, 1), (34, 2), (500, 14)):
        text, size = heads.read_head(io.BytesIO(padded(head("x", n)) + bytes(10**6)))
        assert size == 2880 * blocks and text.rstrip().endswith("END") and text.count("COMMENT") == n
    assert heads.read_head(io.BytesIO(b"")) == (None, 0)
    assert heads.read_head(io.BytesIO(bytes(10**6))) == (None, 2880)
    assert heads.read_head(io.BytesIO(b"x" * 5000)) == (None, 5000)
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    for k, (name, content) in enumerate([("deep/a.fits", padded(head("M 31", 40)) + bytes(10**6)), ("b.FIT", padded(head("M 33", 0))), ("c.fits", bytes(9999)), ("d.fits", b""), ("e.txt", padded(head("no", 0)))]):
        (folder / name).write_bytes(content)
        os.utime(folder / name, ns=(10**18 + k, 10**18 + k))
    rows = {r.path[-6:]: r for r in headers.frames(headers.header_texts(spark, str(folder))).collect()}
    assert len(rows) == 4 and sorted(r.object_name for r in rows.values()) == sorted(["M31", "M33", names.UNKNOWN, names.UNKNOWN])
    got = spark.read.format("image_heads").option("path", str(folder)).option("filesPerPartition", 1).load()
    assert got.rdd.getNumPartitions() == 4 and {(r.length > 10**6, r.head_bytes) for r in got.where("header IS NOT NULL").collect()} == {(True, 5760), (False, 2880)}
    seen = []
    for turn in range(3):
        q = headers.header_stream(spark, str(folder)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
        q.processAllAvailable()
        q.stop()
        seen.append(spark.read.parquet(str(tmp_path / "out")).count())
        (folder / f"new{turn}.fits").write_bytes(padded(head("M 1", 1)))
    assert seen == [4, 5, 6]
    assert headers.header_texts(spark, str(tmp_path / "nothing")).count() == 0


def test_catalogs(spark):
    g = spark.createDataFrame([(2**60 + 1, 1.0, 2.0, 15.0, None, None, None), (5, 1.0, 2.0, float("nan"), None, None, None)], "source_id long, ra double, dec double, phot_g_mean_mag double, pmra double, pmdec double, ref_epoch double")
    assert [r.catalog_id for r in catalogs.gaia(g).collect()] == [str(2**60 + 1)]
    m = spark.createDataFrame([("x", 1.0, 2.0, None, "Comet nucleus"), ("y", 1.0, 2.0, 19.0, None), ("z", 1.0, 2.0, 19.1, None)], "designation string, ra double, dec double, v_mag double, object_class string")
    assert {(r.catalog_id, r.object_type) for r in catalogs.mpc(m).collect()} == {("x", "COMET"), ("y", "ASTEROID")}


def test_history_is_strictly_before_and_filters_are_known(spark):
    kind = "obs_id long, frame_id string, obs_time timestamp_ntz, ra double, dec double, mag double, filter string"
    t = ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]
    from datetime import datetime

    at = [datetime.fromisoformat(x) for x in t]
    rows = spark.createDataFrame([(1, "a", at[0], 10.0, 0.0, 12.0, "L"), (2, "a2", at[0], 10.0, 0.0, 13.0, None), (3, "b", at[1], 10.0, 4.999 / 3600, 15.0, "L"), (4, "b", at[1], 10.0, 0.0, 15.0, None)], kind)
    got = {r.obs_id: (r.n_history, r.median_mag) for r in history.narrow_history(history.history_pairs(rows, rows)).collect()}
    assert got == {3: (2, 12.0), 4: (2, None)}


def test_forced_photometry(spark):
    p = spark.range(400).selectExpr("'f' AS frame_id", "id div 20 AS y", "id % 20 AS x").withColumn("adu", F.when((F.col("x") == 10) & (F.col("y") == 10), 900.0).otherwise(100.0 + F.col("x") % 3))
    spots = spark.createDataFrame([(1, "f", 10.0, 10.0, 1.0, 5.0, 6.0), (2, "f", 1.0, 1.0, 1.0, 5.0, 6.0)], "spot_id long, frame_id string, sx double, sy double, fwhm_px double, ra double, dec double")
    size = spark.createDataFrame([("f", 20, 20)], "frame_id string, width int, height int")
    m = pixels.apertures(p, spots, size, block=8)
    got = {r.spot_id: r for r in m.collect()}
    assert got[1].area == 13 and got[2].net is None
    f = pixels.forced(m, spots, F.lit(25.0)).collect()
    assert [r.spot_id for r in f] == [1] and f[0].snr > 3 and f[0].elongation == 1.0


def test_sql_functions(spark):
    from skyloom.functions import registered

    assert len(registered.register(spark)) == 5
    for raw in ("m_51", "NGC 12 3", "mrk-501", "SH2 155", "abell 1", " a  b!", "??", None, "Arp_220"):
        mine = names.object_name(F.lit(raw).cast("string"))
        assert one(spark, mine) == one(spark, F.call_function("normalize_object_name", F.lit(raw).cast("string")))
    r = spark.sql("SELECT haversine_arcsec(10, 0, 10, 1) AS h, sky_tile(0.25) AS t, wrap180(-180) AS w, normalize_filter(' H-Alpha ') AS f, normalize_filter('x') AS x").first()
    assert r.h == pytest.approx(3600) and r.t == pytest.approx(0.2) and r.w == 180 and (r.f, r.x) == ("Ha", "x")


def test_previous_frame_over_months(spark):
    rows = [("a", "X", "2024-01-05"), ("b", "X", "2024-01-05"), ("c", "X", "2024-03-01"), ("d", "X", "2024-03-01"), ("e", "X", "2024-03-02"), ("f", "Y", "2024-03-02"), ("g", None, "2024-03-02"), ("h", "X", None)]
    frames = spark.createDataFrame(rows, "frame_id string, object string, obs_time string").withColumn("obs_time", F.col("obs_time").cast("timestamp_ntz"))
    got = {r.frame_id: r.previous_id for r in tracks.previous_frame(frames, frames).collect()}
    assert got == {"c": "b", "d": "b", "e": "d"}
    assert tracks.previous_frame(frames.limit(0), frames).count() == 0


def test_reference_frames_are_ranked(spark):
    archive = [(f"r{k:02d}", "X", "L" if k < 2 else None, f"2024-01-{k + 1:02d}", float(k * 10) if k % 5 else None) for k in range(20)] + [("y0", "Y", "L", "2024-01-01", 1.0), ("y1", "Y", "L", "2024-01-02", 2.0)]
    schema = "frame_id string, object string, filter string, obs_time string, position_angle double"
    archive = spark.createDataFrame(archive, schema)
    new = spark.createDataFrame([("n0", "X", "L", "2024-02-01", None), ("n1", "X", None, "2024-02-01", 355.0), ("y0", "Y", "L", "2024-02-01", 1.0), ("n2", None, "L", "2024-02-01", 1.0), ("r19", "X", "R", "2024-01-20", None)], schema)
    got = {}
    for r in sorted(tracks.reference_frames(new, archive).collect(), key=lambda r: (r.frame_id, r.place)):
        got.setdefault(r.frame_id, []).append((r.place, r.reference_id))
    newest = [f"r{k:02d}" for k in range(19, 9, -1)]
    assert got["n0"] == list(enumerate(newest, 1))
    assert got["r19"] == list(enumerate(newest, 1))[1:]
    off = lambda k: abs((k * 10 - 355 + 180) % 360 - 180) if k % 5 else 180
    assert [x for _, x in got["n1"]] == [f"r{k:02d}" for k in sorted(range(20), key=lambda k: (off(k), -k))[:10]]
    assert set(got) == {"n0", "n1", "r19"}


def test_forced_rows_join_the_others(spark):
    """A star that moved is measured where it is now; matched, faint, saturated, blank and outlying ones and frames without a projection give none."""
    from skyloom.operators import recovery

    px = 2 / 3600
    bright = {("f", 20, 20): 3000.0, ("f", 40, 20): 3000.0, ("f", 20, 40): 90_000.0, ("g", 20, 20): 3000.0}
    pixel = [(f, y, x, 100.0 + (x + y) % 3 + bright.get((f, x, y), 0.0)) for f in "fg" for y in range(60) for x in range(60)]
    pixel = spark.createDataFrame(pixel, "frame_id string, y long, x long, adu double")
    at = lambda x, y: (10 - (x - 29.5) * px, 0.0 + (y - 29.5) * px)
    rows = [("f", "Gaia DR3", "now", *at(20, 20), 0.0, 0.0, 15.0), ("f", "Gaia DR3", "moved", *at(35, 20), -1000.0, 0.0, 15.0), ("f", "Gaia DR3", "hot", *at(20, 40), None, None, 15.0), ("f", "MPC", "blank", *at(40, 40), -1000.0, 0.0, None), ("f", "Gaia DR3", "edge", *at(2, 20), None, None, 15.0), ("f", "Gaia DR3", "faint", *at(20, 20), None, None, 21.0), ("f", "Gaia DR3", "matched", *at(20, 20), None, None, 15.0), ("f", "Gaia DR3", "far", 190.0, 0.0, None, None, 15.0), ("g", "Gaia DR3", "unsolved", *at(20, 20), None, None, 15.0), ("f", "MPC", "comet", *at(20, 20), 9e5, 9e5, None)]
    field = spark.createDataFrame([(*r[:7], 2016.0, r[7], "STAR") for r in rows], "frame_id string, catalog_name string, catalog_id string, ra double, dec double, pmra double, pmdec double, ref_epoch double, catalog_mag double, object_type string")
    matched = spark.createDataFrame([("f", "Gaia DR3", "matched")], "frame_id string, catalog_name string, catalog_id string")
    wcs = {"crpix1": 30.5, "crpix2": 30.5, "crval1": 10.0, "crval2": 0.0, "cd11": -px, "cd12": 0.0, "cd21": 0.0, "cd22": px}
    frames = spark.createDataFrame([("f", 2026.0, wcs, 2.0, 25.0, 0.1), ("g", 2026.0, None, 2.0, 25.0, 0.1)], "frame_id string, epoch double, wcs struct<crpix1:double,crpix2:double,crval1:double,crval2:double,cd11:double,cd12:double,cd21:double,cd22:double>, fwhm_px double, zero_point double, zero_point_err double")
    size = spark.createDataFrame([("f", 60, 60), ("g", 60, 60)], "frame_id string, width int, height int")
    places = recovery.spots(field, matched, frames)
    got = {r.catalog_id: r for r in recovery.recovered(places, pixel, size, block=16).collect()}
    assert sorted(got) == ["comet", "moved", "now"]
    assert got["moved"].flux == pytest.approx(3000, abs=60) and got["moved"].mag == pytest.approx(25 - 2.5 * 3.477, abs=0.05) and got["moved"].elongation == 1.0
    assert recovery.spots(field, matched, frames, forced=False).count() == 0
    no_zero = recovery.recovered(places.withColumn("zero_point", F.lit(None).cast("double")), pixel, size, block=16)
    assert {r.mag for r in no_zero.collect()} == {None}
    both = recovery.all_rows(field.select("frame_id", "catalog_id", "ra"), field.select("frame_id", "catalog_id", "ra").limit(1), recovery.recovered(places, pixel, size, block=16))
    assert {(r.origin, r["count"]) for r in both.groupBy("origin").count().collect()} == {("detection", 10), ("difference", 1), ("forced", 3)}
    assert both.where("origin = 'difference'").first().catalog_id is None


def test_a_mover_is_where_it_is_at_the_frame_time(spark):
    """Across RA 0 between two frames, over a pole, at a knot's own time, and not in a gap that is too long."""
    from datetime import datetime, timedelta

    day = lambda d: datetime(2024, 1, 1) + timedelta(days=d)
    knots = [("m", day(0), 359.0, 10.0, 15.0, "ASTEROID"), ("m", day(4), 3.0, 10.0, 17.0, "ASTEROID"), ("m", day(20), 3.0, 20.0, None, "ASTEROID"), ("p", day(0), 0.0, 89.0, None, "COMET"), ("p", day(2), 180.0, 89.0, None, "COMET"), (None, day(0), 1.0, 1.0, 1.0, "x"), ("q", None, 1.0, 1.0, 1.0, "x"), ("m", day(0), 359.5, 10.0, 1.0, "again")]
    frames = [("a", day(0), 359.0, 10.0), ("b", day(1), 0.0, 10.0), ("c", day(2), 1.0, 10.0), ("d", day(3), 359.9, 10.0), ("e", day(4), 3.0, 10.0), ("f", day(10), 3.0, 13.0), ("g", day(20), 3.0, 20.0), ("h", day(1), 77.0, 90.0), ("i", day(1.5), 180.0, 89.5), ("j", day(-1), 359.0, 10.0), ("k", None, 359.0, 10.0), ("l", day(0.5), 359.5, 10.0)]
    k = spark.createDataFrame(knots, "designation string, at timestamp_ntz, ra double, dec double, mag double, object_type string")
    f = spark.createDataFrame(frames, "frame_id string, obs_time timestamp_ntz, ra_center double, dec_center double").withColumn("fov_deg", F.lit(0.5))
    for hours in (1.0, 24.0, 1000.0):
        got = {r.frame_id: r for r in ephemeris.predicted(f, k, 0.5, hours).collect()}
        assert sorted(got) == ["a", "b", "c", "e", "g", "h", "i", "l"]
        assert got["a"].mag == 15.0 and got["a"].object_type == "ASTEROID" and got["g"].mag is None
        assert abs((got["b"].ra + 180) % 360 - 180) < 1e-3 and abs(got["b"].mag - 15.5) < 1e-9 and abs(got["c"].ra - 1.0) < 1e-3
        assert abs(got["h"].dec - 90) < 1e-6 and abs(got["i"].dec - 89.5) < 1e-6 and abs(got["i"].ra - 180) < 1e-6
    assert [r.frame_id for r in ephemeris.predicted(f, k, 0.5, mag_limit=15.2).orderBy("frame_id").collect()] == ["a", "g", "h", "i"]
    sources = spark.createDataFrame([(1, "b", 0.001, 10.0), (2, "b", 0.002, 10.0), (3, "c", 0.001, 10.0), (4, "c", 1.0, 10.0), (5, "e", 3.0, 10.0)], "obs_id long, frame_id string, ra double, dec double")
    matched = sources.where("obs_id = 5").select("obs_id")
    assert {r.obs_id for r in ephemeris.movers_in_time(sources, ephemeris.predicted(f, k, 0.5), matched).collect()} == {1, 4}


def test_filter_names_in_sql_are_the_same(spark):
    from skyloom.functions import names, registered

    registered.register(spark)
    spellings = sorted({s for words in names.FILTERS.values() for s in words})
    raw = [f(s) + end for s in spellings for f in (str, str.upper) for end in ("", " Filter", "filter", "  FILTER ")] + ["Red Filter", "filter", " ", "", None, "x filter"]
    rows = spark.createDataFrame([(r,) for r in raw], "raw string").select("raw", names.filter_name(F.col("raw")).alias("a"), F.expr("normalize_filter(raw)").alias("b")).collect()
    assert len(spellings) >= 40 and all(r.a == r.b for r in rows) and {r.raw: r.a for r in rows}["Red Filter"] == "R"


def test_clipping_rounds_do_not_multiply_the_plan(spark):
    rows = spark.createDataFrame([(f, i, 0, float((i * 37 + f) % 101) + (5000.0 if i == 7 else 0.0)) for f in range(3) for i in range(60)], "frame_id long, y long, x long, adu double")
    table = written(rows)
    out = pixels.clipped_statistics(table, 3.0, 5)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 2
    assert all(r.n == 59 for r in out.collect())


def test_runs_of_settings_equal_single_runs(spark, sf_dir):
    from skyloom.operators import classify, whatif
    from skyloom.plans import survey
    from skyloom.plans.fixtures import sky as derived
    from skyloom.sources import settings

    assert len(settings.SETTINGS) == 53 and len({*settings.SETTINGS}) == 53
    s = written(derived(spark, sf_dir, "sources").where("object IN ('OBJ1', 'OBJ2', 'OBJ3')"))
    f = written(derived(spark, sf_dir, "frames"))
    given = settings.applied(spark.createDataFrame(survey.WHAT_IF, "run string, param string, value string"))
    columns = ["obs_id", "n_history", "n_covering", "vacated", "outcome"]
    every = whatif.classified(s, s, f, 1.0, given).collect()
    for run in ("narrow", "wide", "faint", "as it is"):
        alone = {tuple(r[c] for c in columns) for r in whatif.classified(s, s, f, 1.0, given.where(F.col("run") == run)).collect()}
        assert alone == {tuple(r[c] for c in columns) for r in every if r.run == run}
    assert alone == {tuple(r[c] for c in columns) for r in classify.classified(s, s, f, 1.0).collect()}
    assert len({(r.obs_id, r.outcome) for r in every}) > s.count()
    assert whatif.classified(s, s, f, 1.0, given.limit(0)).count() == 0
    shaped = calibration.shapes(derived(spark, sf_dir, "detections"))
    strict = settings.applied(spark.createDataFrame([("a", "QC_STARS_MIN", "1"), ("b", "QC_FWHM_MAX_ARCSEC", "2.0"), ("b", "STAR_ELONGATION_MAX", "9"), ("c", "X", "1")], "run string, param string, value string"))
    got = {(r.run, r.frame_id): (r.star_count, r.quality_flag) for r in whatif.frame_quality(shaped, strict).collect()}
    plain = {r.frame_id: (r.star_count, r.quality_flag) for r in calibration.frame_quality(shaped).collect()}
    assert {f: got["c", f] for f in plain} == plain
    assert {f: got["a", f] for f in plain} == {r.frame_id: (r.star_count, r.quality_flag) for r in calibration.frame_quality(shaped, 1).collect()}
    assert any(got["b", f] != plain[f] for f in plain) and len(got) == 3 * len(plain)


def epochs_rows(seed, n=400):
    """Stars with many epochs, close pairs at about the radius, across RA 0 and near a pole."""
    import random
    from datetime import datetime, timedelta

    rng = random.Random(seed)
    stars = [(0.0003, 10.0), (359.9995, 10.0), (120.0, 89.9995), (300.0, 89.9993), (50.0, -20.0), (50.0 + 5 / 3600, -20.0), (50.0, -20.0 + 4.6 / 3600)]
    rows = []
    for i in range(n):
        ra, dec = rng.choice(stars)
        ra, dec = ra + rng.gauss(0, 0.6) / 3600, dec + rng.gauss(0, 0.6) / 3600
        rows.append((i, f"f{i % 40}", datetime(2024, 1, 1) + timedelta(hours=i % 40 // 2), ra % 360, dec, rng.choice([None, "L", "L", "R"]), rng.choice([None, round(rng.gauss(14, 1), 2), round(rng.gauss(14, 1), 1)])))
    rows += [(n, "x", None, 50.0, -20.0, "L", 1.0), (n + 1, "x", datetime(2025, 1, 1), None, 1.0, "L", 1.0), (n + 2, "x", datetime(2025, 1, 1), 50.0, -20.0, "L", None)]
    return rows


@pytest.mark.parametrize("direct", [1 << 14, 0, 200])
def test_history_without_pairs_equals_pairs(spark, direct):
    kind = "obs_id long, frame_id string, obs_time timestamp_ntz, ra double, dec double, filter string, mag double"
    s = spark.createDataFrame(epochs_rows(3), kind)
    want = {r.obs_id: (r.n_history, r.median_mag) for r in history.narrow_history(history.history_pairs(s, s, 5.0)).collect()}
    rows = s.where("obs_id % 3 = 0")
    for asked, expected in ((s, want), (rows, {k: v for k, v in want.items() if k % 3 == 0})):
        got = {r.obs_id: (r.n_history, r.median_mag) for r in epochs.narrow(asked, s, direct=direct).collect()}
        assert {k: n for k, (n, _) in got.items()} == {k: n for k, (n, _) in expected.items()}
        assert all((m is None) == (expected[k][1] is None) and (m is None or abs(m - expected[k][1]) < 1e-9) for k, (_, m) in got.items())
    assert epochs.narrow(s.limit(0), s).count() == epochs.narrow(s, s.limit(0)).count() == 0


def test_pairs_of_a_place_do_not_grow_with_its_epochs():
    """A star seen n times: no pair is compared, whatever n; two stars a radius apart meet at the rim alone."""
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (500, 4000):
        ra, dec = 10 + rng.normal(0, 0.3, n) / 3600, 5 + rng.normal(0, 0.3, n) / 3600
        twice = lambda x: np.concatenate([x, x])
        mag = rng.normal(14, 1, n)
        cells = epochs.Cells(np.zeros(2 * n, np.int64), np.repeat([0, 1], n), twice(np.arange(n)), twice(ra), twice(dec), twice(mag), np.zeros(2 * n, np.int64), 5.0)
        assert cells.compared == 0 and (cells.n == np.arange(n)).all()
        assert all(cells.median[k] == np.median(mag[:k]) for k in (1, 2, 77, n - 1)) and np.isnan(cells.median[0])


def test_cells_in_portions(monkeypatch):
    """The same rows in one portion and in many, with groups that go on over batches."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n = 600
    cell = np.sort(rng.integers(0, 9, n))
    table = pa.table({"cx": cell, "cy": cell, "cz": -cell, "kind": rng.integers(0, 2, n), "obs_id": np.arange(n), "at": rng.integers(0, 50, n), "ra": 10 + cell + rng.normal(0, 2, n) / 3600, "dec": rng.normal(0, 2, n) / 3600, "mag": pa.array(rng.normal(14, 1, n), mask=rng.random(n) < 0.2), "filter": pa.array(rng.choice(["L", "R"], n), mask=rng.random(n) < 0.2)})
    whole = list(epochs._counted(5.0, 1 << 14)(iter(table.to_batches())))
    assert len(whole) == 1 and whole[0].num_rows > 100
    monkeypatch.setattr(epochs, "PAIRS_AT_ONCE", 40)
    monkeypatch.setattr(epochs, "ROWS_AT_ONCE", 30)
    for direct in (0, 300):
        parts = pa.Table.from_batches(epochs._counted(5.0, direct)(iter(table.to_batches(max_chunksize=17))))
        one, other = (sorted(zip(*t.to_pydict().values(), strict=True)) for t in (pa.Table.from_batches(whole), parts))
        assert [x[:2] for x in one] == [x[:2] for x in other]
        assert all(a == b or abs(a - b) < 1e-9 for (_, _, a), (_, _, b) in zip(one, other, strict=True))
