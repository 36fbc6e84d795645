"""Streams give what the batch operators give."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyloom.operators import classify
from skyloom.plans.fixtures import sky as derived
from skyloom.sources import store
from skyloom.sources.manifest import Conflict, Manifest
from skyloom.sources.skyhistory import SkyHistory, cells_near
from skyloom.streaming import arrivals, detection


def test_sessions_and_repeats(spark, sf_dir, tmp_path):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("arrived"), F.col("event_id").cast("string").alias("path"))
    e.union(e.where("user_id % 2 = 0")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    once = arrivals.without_repeats(stream, "400 days")
    q = once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == e.count()
    batch = arrivals.quiet_sessions(e, "user_id", "600 seconds")
    assert batch.agg(F.sum("n_files")).first()[0] == e.count()


def test_image_files_stream(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in ("a.fits", "b.FIT", "c.txt"):
        (tmp_path / "d" / n).write_bytes(b"x")
    q = arrivals.image_files(spark, str(tmp_path / "d")).select("path").writeStream.format("memory").queryName("files").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.path[-6:] for r in spark.table("files").collect()} == {"a.fits", "/b.FIT"}


KEPT = ["frame_id", "obs_id", "anomaly_type", "delta_mag", "notes"]


def some_rows(spark, sf_dir, path, objects=5):
    frames = derived(spark, sf_dir, "frames")
    names = ", ".join(f"'OBJ{k}'" for k in range(1, objects + 1))
    rows = derived(spark, sf_dir, "sources").join(frames.select("frame_id", "ra_center", "dec_center", "fov_deg"), "frame_id").where(f"object IN ({names})")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def whole(rows):
    return classify.anomalies(classify.classified(rows, rows, detection.frames_of(rows), 1.0))


def records(found):
    return sorted(map(str, found.select(KEPT).collect()))


def test_incremental_detection_equals_batch(spark, sf_dir, tmp_path):
    back = some_rows(spark, sf_dir, str(tmp_path / "in"))
    work = detection.detect_batch(spark, str(tmp_path / "survey"), back.schema, 1.0)
    stream = spark.readStream.schema(back.schema).parquet(str(tmp_path / "in"))
    arrivals.each_batch(stream, work, str(tmp_path / "c")).awaitTermination()
    work(back, 0)  # a replay
    survey = detection.Survey(spark, str(tmp_path / "survey"), back.schema, 1.0)
    assert records(survey.anomalies.read()) == records(whole(back))
    assert survey.sources.read().count() == back.count()


def test_late_reanalysed_and_demoted_frames(spark, sf_dir, tmp_path):
    """Frames in a random order; then some come again with other rows, and some are demoted. Others are classified anew only where they rest on these."""
    back = some_rows(spark, sf_dir, str(tmp_path / "in"), 2).where("day(obs_time) < 12")
    rows = back.where("obs_id % 9 <> 4").withColumn("mag", F.when(F.col("obs_id") % 5 == 0, F.col("mag") + 2).otherwise(F.col("mag")))
    survey = detection.Survey(spark, str(tmp_path / "survey"), back.schema, 1.0)
    turn = F.pmod(F.xxhash64("frame_id"), F.lit(3))
    for k in (1, 0, 2):
        touched = survey.take(rows.where(turn == k))
    assert touched.count() > rows.where(turn == 2).select("frame_id").distinct().count()
    assert records(survey.anomalies.read()) == records(whole(rows))
    again, gone = (F.pmod(F.xxhash64("frame_id"), F.lit(11)) == k for k in (3, 5))
    fresh = back.where(again)
    demoted = back.where(gone).select("frame_id").distinct()
    batch = fresh.unionByName(demoted, allowMissingColumns=True)
    assert fresh.count() and demoted.count()
    touched = survey.take(batch)
    now = rows.where(~again & ~gone).unionByName(fresh)
    assert records(survey.anomalies.read()) == records(whole(now))
    all_frames = {r[0] for r in now.select("frame_id").distinct().collect()}
    assert {r[0] for r in touched.collect()} & all_frames < all_frames  # not everything was classified anew
    before = records(survey.anomalies.read())
    for table in (survey.sources, survey.frames, survey.anomalies):
        table.compact()
        table.vacuum(1)
        assert len(table._parts()) == 1
    assert records(survey.anomalies.read()) == before and survey.sources.read().count() == now.count()


def test_sky_history_replaces_frames_and_reads_cells(spark, tmp_path):
    kind = "frame_id string, ra double, dec double, obs_time timestamp_ntz, v int"
    day = datetime(2024, 1, 1)
    make = lambda rows: spark.createDataFrame([(f, ra, dec, day, v) for f, ra, dec, v in rows], kind)
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "frame_id string")
    table = SkyHistory(spark, str(tmp_path / "t"), make([]).schema)
    got = lambda cells=None: sorted((r.frame_id, r.v) for r in table.read(cells).collect())
    assert got() == []
    table.publish(make([("a", 0.01, 0.0, 1), ("a", 359.99, 0.0, 2), ("b", 180.0, 89.999, 3), ("b", None, 1.0, 4)]))
    for _ in range(2):
        table.publish(make([("a", 90.0, 45.0, 5)]))  # it moved
    assert got() == [("a", 5), ("b", 3), ("b", 4)]
    near = cells_near(make([("x", 200.0, 89.9995, 0)]), 10.0)
    assert len(near) <= 8 and got(near) == [("b", 3)] and got({"1_1_1"}) == []
    table.publish(make([]), ids("b", "c"))
    assert got() == [("a", 5)]
    table.publish(make([("b", 0.0, 0.0, 6), ("z", 0.0, 0.0, 7)]), ids("b"))  # z isn't spoken for
    assert got() == [("a", 5), ("b", 6)]
    assert cells_near(make([("x", None, 0.0, 0)]), 10.0) == set()
    opened = {f.split("/cell=")[1].split("/")[0] for f in table.read(cells_near(make([("x", 90.0, 45.0, 0)]), 10.0)).inputFiles() if "/cell=" in f}
    assert 0 < len(opened) <= 8 and "none" not in opened
    table.compact(1)
    assert got() == [("a", 5), ("b", 6)]


def test_two_writers_and_a_crash(spark, tmp_path):
    path = str(tmp_path / "s")
    make = lambda n: spark.createDataFrame([(n,)], "n int")
    with pytest.raises(ValueError):
        store.load(spark, path)
    store.publish(lambda old: make(1), spark, path)
    calls = []

    def slow(old):
        calls.append(old.count())
        if len(calls) == 1:  # another writer commits meanwhile
            store.publish(lambda o: o.union(make(2)), spark, path)
        return old.union(make(3))

    store.publish(slow, spark, path)
    assert calls == [1, 2] and sorted(r.n for r in store.load(spark, path).collect()) == [1, 2, 3]

    def crash(old):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.publish(crash, spark, path)
    (tmp_path / "s" / "manifest" / "000000000009.json").write_text("")  # a crash between creating and writing
    assert store.load(spark, path).count() == 3
    assert store.publish(lambda old: old.union(make(4)), spark, path) == 10
    store.vacuum(spark, path, 1)
    assert store.load(spark, path).count() == 4 and len(list((tmp_path / "s" / "parts").iterdir())) == 1
    both = Manifest(spark, path)
    number, state = both.current()
    both.put(number, state)
    with pytest.raises(Conflict):
        both.put(number, state)


def test_ordered_state_equals_medians_of_all_before(monkeypatch):
    """Late rows, ties of values and times, blocks that split and expire; a row in order reads few blocks."""
    monkeypatch.setattr(detection, "BLOCK_MAGS", 8)
    rng = random.Random(4)
    store_, reads = {}, []

    def load(kind, block):
        reads.append((kind, block))
        return store_.get((kind, block))

    seen: list[tuple[int, float]] = []
    day = detection.DAY_US
    for k in range(700):
        held = detection.Magnitudes(load)
        at = (k // 2 if rng.random() < 0.8 else rng.randrange(k // 2 + 1)) * day
        reads.clear()
        want = sorted(m for t, m in seen if t < at)
        got = held.median_before(at)
        assert got == (0.5 * want[(len(want) - 1) // 2] + 0.5 * want[len(want) // 2] if want else None)
        if at == k // 2 * day:
            assert len(reads) <= 4  # two blocks of values, two of times
        mag = rng.choice([round(rng.gauss(12, 1), 1), 12.0])
        held.add(k, at, mag)
        seen.append((at, mag))
        if k % 100 == 99:
            edge = (k // 2 - 60) * day
            block = detection.BLOCK_DAYS * day
            gone = held.expire(edge)
            assert sorted(gone) == [i for i, (t, _) in enumerate(seen) if (t // block + 1) * block <= edge]
            seen = [(t, m) if (t // block + 1) * block > edge else (10**18, m) for t, m in seen]
        for kind, number in held.changed - held.dropped:
            store_[kind, number] = tuple(map(tuple, held.block(kind, number)))
        for x in held.dropped:
            store_.pop(x, None)
        store_["index", None] = held.index()
        assert held.firsts == sorted(held.firsts) and len({*held.blocks}) == len(held.blocks)
    assert len(store_["index", None][0]) > 5


def test_light_curves_with_late_and_repeated_rows(spark, tmp_path):
    kind = "source_id string, obs_id long, obs_time timestamp_ntz, filter string, mag double"
    day = lambda d: datetime(2024, 1, d)
    first = [("s", 1, day(1), "L", 10.0), ("s", 2, day(5), "L", 12.0), ("s", 3, day(5), "L", 20.0), ("s", 4, day(6), None, 9.0), (None, 5, day(7), "L", 1.0)]
    second = [("s", 6, day(3), "L", 30.0), ("s", 2, day(5), "L", 12.0), ("s", 7, day(6), "L", None), ("s", 8, None, "L", 5.0), ("t", 9, day(6), "L", 5.0)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in (first, second):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        q = detection.light_curves(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    got = sorted(((r.source_id, r.obs_id, r.median_mag) for r in spark.read.parquet(out).collect()), key=repr)
    # the late row 6 is compared with row 1 alone; row 7 with 1, 2, 3 and 6, row 2 counted once
    want = [("s", 1, None), ("s", 2, 10.0), ("s", 2, 20.0), ("s", 3, 10.0), ("s", 4, None), ("s", 6, 10.0), ("s", 7, 16.0), ("s", 8, None), ("t", 9, None)]
    assert got == sorted(want, key=repr)


def simulated(rows, gap, size, now):
    """Batches of (key, at, done, path) rows taken in order; seconds."""
    out = []
    for key in {r[0] for r in rows}:
        pending, flying, number = [], set(), 0

        def flush(at, reason):
            nonlocal number
            number += 1
            out.extend((key, number, k, p, reason, at) for k, (_, p) in enumerate(pending))
            flying.update(p for _, p in pending)
            pending.clear()

        for _, at, done, path in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], not r[2], r[3])):
            if pending and at - pending[-1][0] >= gap:
                flush(pending[-1][0] + gap, "quiet")
            if done:
                flying.discard(path)
            elif path not in flying and path not in [p for _, p in pending]:
                pending.append((at, path))
                if len(pending) == size:
                    flush(at, "full")
        if pending and pending[-1][0] + gap <= now:
            flush(pending[-1][0] + gap, "quiet")
    return sorted(out)


def test_streamed_batches_over_restarts(spark, tmp_path):
    """Late rows, repeats, files done and come again; the stream stops after each file and goes on from its checkpoint."""
    rng = random.Random(5)
    rows = [(rng.choice("ab"), t := rng.randrange(600), rng.random() < 0.4, f"p{rng.randrange(30)}") for _ in range(300)]
    rows = sorted({*rows}, key=lambda r: r[1] + rng.uniform(0, 20))  # up to 20 seconds behind
    rows.append(("z", 700, False, "last"))
    kind = "scope string, path string, arrived timestamp, done boolean"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    begin = datetime(2024, 1, 1)
    for a in range(0, len(rows), 60):
        part = [(k, p, begin + timedelta(seconds=t), d if d or a % 120 else None) for k, t, d, p in rows[a : a + 60]]
        spark.createDataFrame(part + [(None, "x", begin, False), ("a", None, begin, False)] * (a == 0), kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        made = arrivals.stream_batches(stream, "scope", "7 seconds", 3, "30 seconds")
        made.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = [(r.scope, r.batch, r.seq, r.path, r.reason, (r.flushed - begin).total_seconds()) for r in spark.read.parquet(out).collect()]
    want = simulated(rows, 7, 3, 670)
    assert sorted(got) == [w for w in want if w[0] != "z"] and {r[4] for r in got} == {"quiet", "full"}
