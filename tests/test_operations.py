"""Small cases of hand-over, stores, notices, features, winters and carry-over."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cindergrid.operators import behaviour, catalog, evolution, moisture, seasonal, synoptic
from cindergrid.sources import manifest, store
from cindergrid.streaming import notices, rasters


def test_a_state_cannot_go_backwards_or_beyond_the_run(spark):
    hours = spark.createDataFrame([(1, "r", h, 20.0, 40.0, 10.0, 0.0, True) for h in range(1, 6)], "cell long, run string, fhour long, temp_c double, rh double, wind_kmh double, precip_mm double, daylight boolean")
    states = spark.createDataFrame([(1, "r", 2, 5)], "cell long, run string, a long, b long").withColumn("state", moisture.start_state())
    assert sorted(r.fhour for r in evolution.advance(states, hours, "a", "b").collect()) == [3, 4, 5]
    for wrong in ("b", "a"), ("a", "c"):
        with pytest.raises(Exception, match="backwards|outside"):
            evolution.advance(states.withColumn("c", F.lit(49).cast("long")), hours, *wrong).collect()


def test_newest_anchor_wins_and_bootstrap_comes_last(spark):
    def rows(*r):
        return spark.createDataFrame([(1, "r", dt.date(2026, 7, d), 0, s) for d, s in r], "cell long, run string, anchor date, lead long, state string")

    got = evolution.start_states(rows((3, "own")), rows((4, "prior"), (3, "older")), rows((5, None)), rows((6, "boot"))).first()
    assert (got.anchor.day, got.state, got.source) == (4, "prior", "prior")
    assert evolution.start_states(rows((3, None)), rows((3, None)), rows((3, None)), rows((6, "boot"))).first().source == "bootstrap"


def test_partial_days_must_be_allowed_and_reach_the_hour(spark, tmp_path):
    day = spark.createDataFrame([("west", "2026-07-01", "a", dt.datetime(2026, 7, 1), False, True, None)], "model_key string, fire_date string, run_stamp string, run_init timestamp, complete boolean, cutoff_reached boolean, danger int")
    with pytest.raises(Exception, match="complete"):
        store.save_peaks(day, str(tmp_path / "p"))
    with pytest.raises(Exception, match="guidance"):
        store.save_peaks(day.withColumn("cutoff_reached", F.lit(False)), str(tmp_path / "p"), True)
    store.save_peaks(day, str(tmp_path / "p"), True)
    assert [r.danger for r in store.load_peaks(spark, str(tmp_path / "p"), F.lit("2026-07-02").cast("timestamp")).collect()] == [None]
    assert store.load_peaks(spark, str(tmp_path / "p"), F.lit("2026-06-30").cast("timestamp")).isEmpty()


def test_a_moved_cell_changes_the_fingerprint(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0)], "iy long, ix long, v double").withColumn("g", F.lit(1))
    one = store.grid_fingerprint(df, ["g"], ["iy", "ix"], ["v"]).first().fingerprint
    assert one == store.grid_fingerprint(df.orderBy(F.desc("v")), ["g"], ["iy", "ix"], ["v"]).first().fingerprint
    assert one != store.grid_fingerprint(df.withColumn("iy", 1 - F.col("iy")), ["g"], ["iy", "ix"], ["v"]).first().fingerprint


def test_notices_keep_their_state_between_batches(spark, tmp_path):
    start = dt.datetime(2026, 7, 1)
    steps = [(0, "warning"), (1, "warning"), (2, None), (3, None), (25, None), (26, "warning"), (27, "ok"), (28, "warning"), (29, "critical")]
    src = str(tmp_path / "src")
    for i, part in enumerate((steps[:4], steps[4:])):
        spark.createDataFrame([("m", start + dt.timedelta(hours=h), x) for h, x in part], "monitor string, ts timestamp, level string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("monitor string, ts timestamp, level string").parquet(src)
        notices.notices(stream).writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("ts").collect()
    told = [(int((r.ts - start).total_seconds() // 3600), r.level, r.reason) for r in got]
    assert told == [(0, "warning", "level"), (25, "warning", "failures"), (26, "warning", "level"), (28, "warning", "level"), (29, "critical", "level")]


def test_a_polygon_around_the_extent_meets_it(spark):
    ring = lambda a: [[-a, -a], [a, -a], [a, a], [-a, a], [-a, -a]]
    text = '[{"properties":{"name":"%s"},"geometry":{"type":"Polygon","coordinates":[%s]}}]'
    raw = spark.createDataFrame([(text % (k, ring(a)),) for k, a in (("around", 9), ("inside", 1), ("across", 3))] + [(text % ("away", [[20, 20], [21, 20], [21, 21], [20, 20]]),), ("x",)], "json string")
    got = synoptic.features_in(synoptic.vertices(raw), -2.0, 4.0, -2.0, 4.0)
    assert sorted(r.name for r in got.collect()) == ["across", "around", "inside"]


def test_whole_images_from_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"x" * 9 + bytes.fromhex(catalog.IMAGE_END))
    (tmp_path / "b.png").write_bytes(bytes.fromhex(catalog.IMAGE_END) + b"x")
    (tmp_path / "c.png").write_bytes(b"")
    got = catalog.whole_images(spark.read.format("binaryFile").load(str(tmp_path))).select("path").collect()
    assert [r.path[-5:] for r in got] == ["a.png"]


def test_winter_keeps_the_fall_code_and_summer_starts_from_it(spark):
    rows = [(1, i, 15.0, 45.0, 10.0, 0.0, 7, onset, 100.0) for i, onset in enumerate([0, 0, -1, 0, 1])]
    df = spark.createDataFrame(rows, "cell long, n long, temp double, rh double, wind double, rain double, month int, onset int, winter_rain double")
    got = seasonal.daily_codes(df, ["cell"], "n").orderBy("n").collect()
    gain = (0.36 * 17.8 + 6.4) / 2
    assert [r.d for r in got[:4]] == pytest.approx([15 + gain * i for i in range(1, 5)])
    fall = 15 + 2 * gain
    spring = 400 * math.log(800 / (800 * math.exp(-fall / 400) + 0.75 * 3.94 * 100))
    assert got[2].df == pytest.approx(fall) and got[4].d == pytest.approx(max(spring, 15) + gain)
    assert got[4].p == pytest.approx(6 + 1.894 * 16.1 * 55 * 12.4e-4)


def test_missing_weather_ends_the_codes(spark):
    df = spark.createDataFrame([(1, i, t, 45.0, 10.0, 0.0, 7, 0, 0.0) for i, t in enumerate([15.0, None, 15.0])], "cell long, n long, temp double, rh double, wind double, rain double, month int, onset int, winter_rain double")
    assert [r.f is None for r in seasonal.daily_codes(df, ["cell"], "n").orderBy("n").collect()] == [False, True, True]


def test_required_codes_are_an_error_where_there_are_none(spark):
    wanted = spark.createDataFrame([(1, dt.date(2026, 7, 3))], "cell long, day date")
    stored = spark.createDataFrame([(1, dt.date(2026, 7, 1), 80.0, 7.0, 20.0, 30.0)], "cell long, day date, f double, p double, d double, df double")
    got = seasonal.carried_over(wanted, stored, ["cell"], "day", required=True).first()
    assert (got.carried, got.codes.f, got.codes.df) == (2, 80.0, 30.0)
    with pytest.raises(Exception, match="stored codes"):
        seasonal.carried_over(wanted, stored.limit(0), ["cell"], "day", required=True).collect()


def test_level_ground_spread_of_one_fuel(spark):
    one = (("C2", 90.0, 10.0, 60.0, 0.0, 0.0, 50.0, -120.0, 0.0, 0.0, 0.0, 50.0, 200.0), ("rock", 90.0, 10.0, 60.0, 0.0, 0.0, 50.0, -120.0, 0.0, 0.0, 0.0, 50.0, 200.0))
    df = spark.createDataFrame(one, "fuel string, f double, moisture double, bui double, wind double, wind_dir double, lat double, lon double, elevation double, slope double, aspect double, conifer double, day_of_year double")
    got = {r.fuel: r for r in behaviour.behaviour(df).collect()}
    m = 147.2 * 11 / 149.5
    isi = 0.208 * 91.9 * math.exp(-0.1386 * m) * (1 + m**5.31 / 4.93e7)
    ros = 110 * (1 - math.exp(-0.0282 * isi)) ** 1.5 * math.exp(50 * math.log(0.7) * (1 / 60 - 1 / 64))
    assert got["C2"].isi == pytest.approx(isi) and got["C2"].ros == pytest.approx(ros)
    assert (got["rock"].ros, got["rock"].hfi) == (0, 0)


def test_guarded_appends(spark, tmp_path):
    path, base = str(tmp_path / "archive"), spark.range(20).selectExpr("cast(3 as long) fhour", "id cell", "cast(id as double) value")
    assert manifest.newest(spark, path) is None
    assert manifest.append(base, path, ["fhour"], ["cell"], "a") == 1
    assert manifest.append(base, path, ["fhour"], ["cell"], "a") == 1  # run again: not added again
    for wrong, what in ((base.withColumn("more", F.lit(1)), "schema"), (base.filter("cell > 3"), "grid")):
        with pytest.raises(ValueError, match=what):
            manifest.append(wrong, path, ["fhour"], ["cell"], "b")
    assert manifest.read(spark, path).count() == 20 and not (tmp_path / "archive/data/b").exists()
    base.withColumn("fhour", F.lit(6).cast("long")).write.parquet(f"{path}/data/half")  # what a failed writer left is never seen
    assert manifest.read(spark, path).agg(F.max("fhour")).first()[0] == 3
    assert manifest.append(base.withColumn("fhour", F.lit(6).cast("long")), path, ["fhour"], ["cell"], "c") == 2
    assert sorted((r.fhour, r["count"]) for r in manifest.read(spark, path).groupBy("fhour").count().collect()) == [(3, 20), (6, 20)]
    assert manifest.read(spark, path, version=1).count() == 20


def test_of_two_first_writers_one_is_held_against_the_other(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "archive"), spark.range(5).selectExpr("cast(3 as long) fhour", "id cell", "cast(id as double) value")
    claim, rivals = manifest._claim, [("same", base.withColumn("fhour", F.lit(6).cast("long"))), ("other", base.filter("cell > 1"))]

    def between(*args):
        """Another writer comes in just before the first claim."""
        monkeypatch.setattr(manifest, "_claim", claim)
        manifest.append(rival, path, ["fhour"], ["cell"], token)
        return claim(*args)

    token, rival = rivals[0]
    monkeypatch.setattr(manifest, "_claim", between)
    assert manifest.append(base, path, ["fhour"], ["cell"], "mine") == 2
    assert manifest.read(spark, path).count() == 10
    path, (token, rival) = str(tmp_path / "second"), rivals[1]
    monkeypatch.setattr(manifest, "_claim", between)
    with pytest.raises(ValueError, match="grid"):
        manifest.append(base, path, ["fhour"], ["cell"], "mine")
    assert manifest.read(spark, path).count() == 3


def test_a_manifest_in_the_making_is_waited_for(spark, tmp_path, monkeypatch):
    path, base = str(tmp_path / "archive"), spark.range(5).selectExpr("cast(3 as long) fhour", "id cell")
    manifest.append(base, path, ["fhour"], ["cell"], "a")
    (tmp_path / "archive/manifest/00000002").write_text("")
    assert manifest.read(spark, path).count() == 5
    monkeypatch.setattr(manifest, "ABANDONED", 0.0)  # its writer has died
    assert manifest.append(base, path, ["fhour"], ["cell"], "b") == 2
    assert manifest.read(spark, path).count() == 10


def test_rasters_come_once_and_faulty_ones_are_listed(spark, tmp_path):
    src, out, checkpoint = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    grid = lambda rows: "ncols 3\nnrows 2\nNODATA_value -999\n" + "\n".join(rows)

    def put(name, text):
        (src / name).parent.mkdir(parents=True, exist_ok=True)
        (src / name).write_bytes(text if isinstance(text, bytes) else text.encode())

    def run():
        rasters.write_rasters(rasters.files(spark, str(src), per_trigger=2), out, checkpoint, (2, 3)).awaitTermination()
        rows = sorted((r.valid_ts.strftime("%H%M"), r.iy, r.ix, r.flash_rate) for r in spark.read.parquet(f"{out}/rows").collect())
        return rows, sorted((r.name, r.fault) for r in spark.read.parquet(f"{out}/faults").collect())

    put("d1/20260708T1210Z_x.asc", grid(["1 2 -999", "nan 0 0.5"]))
    put("d1/none_x.asc", grid(["1 2 3", "4 5 6"]))
    put("d1/20260708T1220Z_x.asc", grid(["1 2 3"]))
    put("d1/20260708T1230Z_x.asc", grid(["1 2 3", "4 x 6"]))
    put("d1/20260708T1240Z_x.asc", b"\xff\xfe\x00")
    first = [("1210", 0, 0, 1.0), ("1210", 0, 1, 2.0), ("1210", 0, 2, None), ("1210", 1, 0, None), ("1210", 1, 1, 0.0), ("1210", 1, 2, 0.5)]
    rows, faults = run()
    assert sorted(rows, key=str) == sorted(first, key=str)
    assert [n for n, _ in faults] == ["20260708T1220Z_x.asc", "20260708T1230Z_x.asc", "20260708T1240Z_x.asc", "none_x.asc"] and all(f for _, f in faults)
    put("d2/20260708T1210Z_x.asc", grid(["9 9 9", "9 9 9"]))  # the same name from another folder, after a restart
    put("d2/20260708T1250Z_x.asc", grid(["1 1 1", "1 1 1"]))
    rows, faults = run()
    assert sorted(rows, key=str) == sorted([*first, *(("1250", y, x, 1.0) for y in range(2) for x in range(3))], key=str) and len(faults) == 4
