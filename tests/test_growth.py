"""Steps whose work may grow no faster than their input."""

from __future__ import annotations

import re
from datetime import datetime

import pyarrow as pa

from skyloom.functions import sky
from skyloom.operators import classify, dedup, ephemeris, history, matching, whatif
from skyloom.sources import headers, settings, skyhistory
from skyloom.streaming import arrivals, detection


def test_header_cards_are_read_once(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(None,), ("",), ("A       = 1".ljust(79),), ("A       = 1 / x".ljust(80) + "A       = 2".ljust(80) + "B       = 'it''s'".ljust(80) + "END".ljust(80) + "C       = 3".ljust(80),)], "header string")
    read = rows.select(headers.cards(F.col("header")).alias("cards"))
    # the reading of a card stands once in the expression, not again in the lambda that compares neighbours
    assert read._jdf.queryExecution().analyzed().toString().count("([^/]*)") == 1
    assert [r.cards for r in read.collect()] == [None, {}, {"A": "1"}, {"A": "1", "B": "it's"}]


ROWS = "obs_id long, frame_id string, obs_time timestamp, ra double, dec double, mag double, filter string, catalog_name string, object_type string, saturated boolean, near_edge boolean, elongation double, from_subtraction boolean"


def _seen(spark, frames=6, each=4):
    """Frames of one field, an hour apart: rows at the same place, and one that moves by 30 arcseconds a frame."""
    at = lambda f: datetime(2024, 1, 1, f)
    rows = [(f * 10 + k, f"f{f}", at(f), 10.0, 20.0, 15.0 + f, "L", None, None, False, False, 1.0, False) for f in range(frames) for k in range(each)]
    rows += [(f * 10 + 9, f"f{f}", at(f), 10.01 + f * 30 / 3600, 20.0, 17.0, "L", None, None, False, False, 1.0, False) for f in range(frames)]
    fields = [(f"f{f}", at(f), 10.0, 20.0, 1.0) for f in range(frames)]
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(fields, "frame_id string, obs_time timestamp, ra_center double, dec_center double, fov_deg double")


def _no_pairs(*_, **__):
    raise AssertionError("pairs of history")


def test_classification_makes_no_pairs_of_history(spark, monkeypatch):
    monkeypatch.setattr(history, "history_pairs", _no_pairs)
    rows, frames = _seen(spark)
    got = {r.obs_id: (r.n_history, r.n_covering, r.vacated) for r in classify.classified(rows, rows, frames, 1.0).collect()}
    assert got == {f * 10 + k: (f * 4 if k < 9 else 0, f, k == 9 and f > 0) for f in range(6) for k in (0, 1, 2, 3, 9)}


def test_coverage_joins_fields_not_frames(spark, monkeypatch):
    rows, frames = _seen(spark)
    met, plain = [], history.cone_pairs
    monkeypatch.setattr(history, "cone_pairs", lambda left, right, *a, **k: met.append(right.count()) or plain(left, right, *a, **k))
    assert {r.obs_id: r.n_covering for r in history.coverage(rows, frames, 1.0).collect()}[50] == 5
    assert met == [1]


def test_what_if_runs_make_no_pairs_of_history(spark, monkeypatch):
    monkeypatch.setattr(history, "history_pairs", _no_pairs)
    rows, frames = _seen(spark)
    runs = settings.applied(spark.createDataFrame([("a", "MATCH_CONE_ARCSEC", "28"), ("b", "MATCH_CONE_ARCSEC", "29"), ("c", "MOVING_CONE_ARCSEC", "20")], "run string, param string, value string"))
    got = {(r.run, r.obs_id): (r.n_history, r.vacated) for r in whatif.classified(rows, rows, frames, 1.0, runs).collect()}
    assert [got[run, 59] for run in "abc"] == [(0, True), (1, False), (0, False)] and got["b", 50] == got["c", 50] == (20, False)


def test_copies_meet_once_in_matching(spark, monkeypatch):
    met, plain = [], matching.cone_pairs
    monkeypatch.setattr(matching, "cone_pairs", lambda left, right, *a, **k: met.append((left.count(), right.count())) or plain(left, right, *a, **k))
    s = spark.createDataFrame([(i, f"f{i % 5}", 10.0, 20.0) for i in range(40)], "obs_id long, frame_id string, ra double, dec double")
    k = spark.createDataFrame([(name, p, f"{name}-{i}", 10.0, 20.0 + 1 / 3600, 12.0, "STAR") for p, name in enumerate(("Gaia DR3", "MPC")) for i in range(30)], "catalog_name string, prio int, catalog_id string, ra double, dec double, catalog_mag double, object_type string")
    assert {r.catalog_id for r in matching.cascade(s, k).collect()} == {"Gaia DR3-0"}
    assert {r.catalog_id for r in matching.nearest(s, k).collect()} == {"Gaia DR3-0"}
    assert sorted((r.obs_id, r.catalog_id) for r in matching.movers(s, k, s.limit(0)).collect()) == [(i, "MPC-0") for i in range(5)]
    assert matching.offset_votes(s, k).agg({"weight": "sum"}).first()[0] == matching.offset_pairs(s, k).count() == 1200
    frames = spark.createDataFrame([(f"f{i}", 10.0, 20.0, 1.0) for i in range(5)], "frame_id string, ra_center double, dec_center double, fov_deg double")
    have = spark.createDataFrame([("f1", "Gaia DR3", "Gaia DR3-7"), ("f2", "MPC", "MPC-3")], "frame_id string, catalog_name string, catalog_id string")
    left = {(r.frame_id, r.catalog_id) for r in matching.unmatched_footprint(frames, k, have, 1.0).collect()}
    assert left == {(f"f{i}", r.catalog_id) for i in range(5) for r in k.collect()} - {("f1", "Gaia DR3-7"), ("f2", "MPC-3")}
    assert met == [(1, 1), (1, 1), (40, 1), (40, 1), (40, 30), (1, 60)]


def test_footprints_round_once_a_field_and_spread_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "BLOCK", 4)
    field = (10.0, 20.0, 1.0)
    shown = [(f"f{i}", *field) for i in range(9)] + [("f3", *field), (None, *field), ("z", -0.0, -0.0, 1.0), ("w", 0.0, 0.0, 1.0), ("s", 0.0, -40.0, 0.5), ("e", 200.0, 60.0, 1.0), ("n", None, 20.0, 1.0), ("m", 10.0, 20.0, None)]
    frames = spark.createDataFrame(shown, "frame_id string, ra_center double, dec_center double, fov_deg double")
    stars = [(name, p, f"{name}-{i}", ra, dec + i * 0.1000001, 12.0, "STAR") for p, name in enumerate(matching.FOOTPRINT) for ra, dec in ((10.0, 20.0), (0.0, 0.0), (0.0, -40.0)) for i in range(11)]
    k = spark.createDataFrame(stars, "catalog_name string, prio int, catalog_id string, ra double, dec double, catalog_mag double, object_type string")
    found = matching.footprint(frames, k, 1.0, digits=6)
    met = frames.crossJoin(k).withColumn("sep", sky.separation_arcsec("ra_center", "dec_center", "ra", "dec")).dropna(subset=["sep", "fov_deg"]).collect()
    want = [(r.frame_id, r.catalog_name, r.catalog_id, round(r.sep, 6)) for r in met if r.sep <= matching.FOOTPRINT[r.catalog_name] * r.fov_deg * 3600 and (r.catalog_name != "Pan-STARRS" or r.dec_center >= -30)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert {r[0] for r in want} == {*(f"f{i}" for i in range(9)), None, "z", "w", "s"} and len(want) > 300
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" in plan and "round(" not in plan[: plan.index("Join Inner")]  # for each pair before
    assert found.rdd.getNumPartitions() >= matching.TASKS_A_CORE * 4  # one task for all pairs before


def test_seen_observations_take_a_state_call_a_bucket():
    state: dict[int, list[int]] = {}
    calls, buckets, count = [], 1, 0
    for part in range(10):
        seen = detection.Seen(lambda n: calls.append(n) or state.get(n), buckets, count)
        assert all(seen.add(i * 1500) for i in range(part * 300, part * 300 + 300)) and not seen.add(part * 1500)
        state.update({n: sorted(seen.held[n]) for n in seen.changed})
        buckets, count = seen.buckets, seen.count
    assert sorted(i for n in state for i in state[n]) == [i * 1500 for i in range(3000)] and buckets == 16 and len(calls) < 150
    seen.remove(0)
    assert seen.add(0)


def test_chains_are_replayed_as_sorted_pairs_stream_by(spark):
    kind = "obs_id long, frame_id string, seq long, ra double, dec double, catalog_name string, from_subtraction boolean, flux double"
    names = ["Simbad", "Gaia DR3", "2MASS"]
    rows = [(f * 10 + k, f"f{f}", f * 10 + k, 10.0 + k * 4 / 3600, 0.0, names[k % 3], False, 1.0) for f in range(3) for k in range(4)]
    kept = dedup.cross_catalog(spark.createDataFrame(rows, kind))
    assert "FlatMapGroups" not in kept._jdf.queryExecution().optimizedPlan().toString()  # no call of Python for each frame
    assert {r.obs_id for r in kept.collect()} == {f * 10 + k for f in range(3) for k in (0, 3)}
    batch = pa.RecordBatch.from_pydict({"frame_id": ["a", "a", "a", "b"], "obs_id": [1, 2, 3, 2], "o_obs_id": [2, 3, 4, 5], "wins": [True, True, False, False]})
    parts = dedup._replayed(iter([batch.slice(0, 1), batch.slice(1, 1), batch.slice(2)]))  # a frame goes on in the next batch
    assert [x for b in parts for x in b.column(0).to_pylist()] == [2, 3, 2]


def test_movers_are_placed_only_within_their_pieces_ball(spark):
    frames = spark.createDataFrame([("f", datetime(2024, 1, 1, 6), 10.0, 0.0, 1.0)], "frame_id string, obs_time timestamp, ra_center double, dec_center double, fov_deg double")
    knots = [(d, datetime(2024, 1, day), ra + day / 10, 0.5, None, "COMET") for d, ra in (("near", 10.0), ("far", 11.5)) for day in (1, 2)]
    found = ephemeris.predicted(frames, spark.createDataFrame(knots, "designation string, at timestamp, ra double, dec double, mag double, object_type string"), 1.0)
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and "_reach#" in joins[0]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # longer methods aren't compiled by the JVM
        code = spark._jvm.PythonSQLUtils.explainString(found.select("*")._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", code))) < 8000
    assert [r.catalog_id for r in found.collect()] == ["near"]


def test_a_survey_writes_few_folders_and_joins_only_what_may_be_replaced(spark, tmp_path):
    kind = "frame_id string, ra double, dec double, obs_time timestamp_ntz, v int"
    make = lambda rows: spark.createDataFrame([(f, ra, dec, datetime(2024, 1, 1), v) for f, ra, dec, v in rows], kind)
    table = skyhistory.SkyHistory(spark, str(tmp_path / "t"), make([]).schema)
    spots = [(f"f{ra}_{dec}", float(ra), float(dec), 1) for ra in range(0, 360, 7) for dec in range(-89, 90, 7)]
    table.publish(make(spots))
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan(table.read())  # nothing is newer than the only part
    assert len({f.split("/cell=")[1].split("/")[0] for f in table.read().inputFiles()}) <= 64  # a folder for each of 400 cells before
    both = make([*spots, ("x", None, 0.0, 0)]).select(skyhistory.cell().alias("own"), skyhistory.cell(across=skyhistory.ACROSS).alias("block")).distinct().collect()
    assert len({r.own for r in both}) > 300 and all(skyhistory.block(r.own) == r.block for r in both)
    near = skyhistory.cells_near(make(spots[500:501]), 1.0)
    assert spots[500][0] in {r.frame_id for r in table.read(near).collect()}
    table.publish(make([("f0_-89", 100.0, 10.0, 2), (None, 0.0, 0.0, 3)]), make(spots[:2]))
    assert plan(table.read()).count("Join") == 1
    assert sorted((r.frame_id, r.v) for r in table.read().collect()) == sorted([("f0_-89", 2), *[(f, 1) for f, *_ in spots[2:]]])


def test_a_batch_does_not_hold_its_own_frames_against_its_changes(spark, tmp_path, monkeypatch):
    rows, _ = _seen(spark)
    rows = rows.selectExpr("*", "cast(null AS string) AS catalog_id", "1e1 AS ra_center", "2e1 AS dec_center", "1e0 AS fov_deg").withColumn("obs_time", rows.obs_time.cast("timestamp_ntz"))
    survey = detection.Survey(spark, str(tmp_path / "survey"), rows.schema, 1.0)
    asked, plain = [], detection.recompute.affected_frames
    monkeypatch.setattr(detection.recompute, "affected_frames", lambda r, *a: asked.append({x.frame_id for x in r.collect()}) or plain(r, *a))
    survey.take(rows.where("frame_id <> 'f2'"))
    touched = survey.take(rows.where("frame_id IN ('f2', 'f3')"))
    assert asked == [set(), {"f0", "f1", "f4", "f5"}]
    assert {r.frame_id for r in touched.collect()} == {"f2", "f3", "f4", "f5"}


def test_pairs_of_history_take_one_distance_each(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    places = [(10.0, d) for d in (0.0, 4.999999, 5.0, 5.000001, 60.0)] + [(359.9999, 3.0), (0.0002, 2.0), (50.0, 323999.0)]
    rows = [(i * 2 + h, f"f{h}", at(h), ra, dec / 3600, 1.0, "L") for i, (ra, dec) in enumerate(places) for h in (0, 1)]
    s = spark.createDataFrame(rows, "obs_id long, frame_id string, obs_time timestamp, ra double, dec double, mag double, filter string")
    h = s.select(*[s[c].alias(f"h_{c}") for c in s.columns])
    pairs = history.history_pairs(s, s, 5.0)
    sep = sky.separation_arcsec("ra", "dec", "h_ra", "h_dec")
    want = {(r.obs_id, r.h_obs_id): r.sep for r in s.join(h, h.h_obs_time < s.obs_time).select("obs_id", "h_obs_id", sep.alias("sep")).where("sep <= 5").collect()}
    assert {(r.obs_id, r.h_obs_id): r.sep_arcsec for r in pairs.collect()} == want and len(want) > len(places)
    plan = pairs.select("obs_id", "h_obs_id", sky.rounded("sep_arcsec", 6).alias("sep"))._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "_l0#" in join and "round(" not in plan  # the chord decides before the distance; no decimal numbers
    assert {(r.obs_id, r.h_obs_id): r.x for r in pairs.select("obs_id", "h_obs_id", sky.rounded("sep_arcsec", 6).alias("x")).collect()} == {k: round(v, 6) for k, v in want.items()}


class _State:
    """A stand-in for all kinds of state, which counts calls."""

    calls = 0

    def __init__(self, *_):
        self.held = None

    def __getattr__(self, name):
        def call(*args):
            _State.calls += 1
            if name == "get":
                return self.held if self.held is not None or self.kind == "value" else []
            if name in ("update", "put"):
                self.held = args[0]
            elif name == "appendList":
                self.held = [*(self.held or []), *args[0]]
            elif name == "clear":
                self.held = None
            elif name == "updateValue":
                self.held = {**(self.held or {}), args[0]: args[1]}
            elif name in ("containsKey", "getValue"):
                return args[0] in (self.held or {}) if name == "containsKey" else self.held[args[0]]
            return []

        return call


def test_batches_of_files_take_few_state_calls():
    state = lambda kind: type("S", (_State,), {"kind": kind})()
    handle = type("H", (), {"getValueState": lambda *_: state("value"), "getListState": lambda *_: state("list"), "getMapState": lambda *_: state("map"), "listTimers": lambda *_: [], "registerTimer": lambda *_: None})()
    work, rows = arrivals._Batcher(10_000_000, 3), [(k * 1_000_000, False, f"p{k % 200}") for k in range(400)]
    work.init(handle)
    _State.calls = 0
    assert work._advance(("a",), 0, rows[1:]).empty
    got = work._advance(("a",), 300_000, [])
    assert len(got) == 200 and _State.calls < 20  # three calls a file before
    assert work._advance(("a",), 400_000, [(400_000_000, True, "p1"), (400_000_000, False, "p1"), (400_000_000, False, "p2")]).empty
    assert [r.path for r in work._advance(("a",), 500_000, []).itertuples()] == ["p1"]
