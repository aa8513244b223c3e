"""Small feeds, step ranges, the store and streamed blocks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cindergrid.operators import catalog, steps
from cindergrid.sources import feeds, store
from cindergrid.streaming import blocks


def test_first_line_of_a_station_stays(spark, tmp_path):
    (tmp_path / "s.csv").write_text("STATION_CODE,STATION_NAME,LATITUDE,LONGITUDE\n001,A,49.0,-123.0\n001,B,50,-120\n2,C,x,-120\n,D,49,-120\n")
    assert [tuple(r) for r in feeds.stations(spark, str(tmp_path)).collect()] == [("001", "A", 49.0, -123.0)]


def test_last_noon_row_of_a_day_stays(spark, tmp_path):
    (tmp_path / "2026-07-13.csv").write_text(
        "DATE_TIME,STATION_CODE,STATION_NAME,DANGER_RATING,FIRE_WEATHER_INDEX\n"
        "2026071312,001,T,2,1\n2026071312.0,001,T,3,18.0\n2026071313,001,T,4,1\n2026071312,001,T,,1\n"
    )
    got = feeds.observations(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("001", "2026-07-13", "T", 3.0, 18.0, None)]


def test_snapshots(spark, tmp_path):
    items = [("forecast", "2026071312", 3), ("FORECAST", "2026071312", 4), ("ACTUAL", "2026071312", 5), ("MANUAL", "202607", 1), ("MANUAL", "2026071112", 1)]
    data = [{"recordType": k, "dailyTimestamp": t, "dangerClass": c} for k, t, c in items]
    body = {"collection": [{"stationCode": "001", "stationName": "T", "summaryData": data}]}
    (tmp_path / "a.json").write_text(json.dumps({"snapshot_time_utc": "2026-07-12T12:00:00Z", "response": body}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"snapshot_time_utc": "2026-07-13T20:00:00Z"} | body, indent=1))
    (tmp_path / "c.json").write_text("{")
    got = feeds.forecast_snapshots(spark, str(tmp_path), multi_line=True).orderBy("run_init_utc").collect()
    assert [(r.fire_date, r.lead_hours, r.forecast_danger_class) for r in got] == [("2026-07-13", 32.0, 4.0), ("2026-07-13", 0.0, 4.0)]


def test_time_of_a_file_name(spark):
    df = spark.createDataFrame([("x/20260708T1210Z_flash.tif",), ("none.tif",)], "f string").select(feeds.obs_time(F.col("f")).cast("string"))
    assert [r[0] for r in df.collect()] == ["2026-07-08 12:10:00", None]


def test_step_ranges(spark):
    rows = [(1, 0, 0.001, "0"), (1, 3, 0.004, "0-3"), (1, 6, 0.006, "0-6"), (1, 9, 0.005, "6-9"), (1, 12, 0.001, "0-12"), (2, 3, 0.002, "3"), (2, 9, 0.007, "9"), (2, 12, 0.009, "12")]
    df = spark.createDataFrame(rows, "cell long, fhour int, value double, step_range string")
    got = {(r.cell, r.fhour): r.precip for r in steps.three_hour_precip(df, ["cell"], 1000.0).collect()}
    want = {(1, 0): 1, (1, 3): 4, (1, 6): 2, (1, 9): 5, (1, 12): 1, (2, 3): 2, (2, 9): 7, (2, 12): 2}
    assert got == pytest.approx(want)


def test_first_source_and_missing_values(spark):
    base = spark.range(3).withColumnRenamed("id", "cell")
    a, b = spark.createDataFrame([(0, 1.0), (1, None)], "cell long, ipw double"), spark.createDataFrame([(0, 5.0), (1, 6.0)], "cell long, ipw double")
    assert [r.ipw for r in steps.first_source(base, [a, b], ["cell"], "ipw").orderBy("cell").collect()] == [1.0, 6.0, None]
    raw = spark.createDataFrame([(1e21, 200.0), (3.0, -100.0)], "value double, lon double")
    assert [tuple(r) for r in steps.cleaned(raw).collect()] == [(None, -160.0), (3.0, -100.0)]


def test_store_replaces_only_its_hours_and_checks_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("r", 3, 1, 1.0), ("r", 6, 1, 2.0)], "run string, fhour int, cell long, value double")
    store.write_hours(df, path, ["run", "fhour"])
    store.write_hours(df.filter("fhour = 6").withColumn("value", F.lit(9.0)), path, ["run", "fhour"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("fhour", "value").collect()) == [(3, 1.0), (6, 9.0)]
    store.check_schema(df, path)
    with pytest.raises(ValueError, match="version"):
        store.check_schema(df.withColumn("more", F.lit(1)), path)


def test_half_points(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, 0.3, 49.8, 120.0, None)], "v double")
    assert [r[0] for r in df.select(store.half_points(F.col("v"))).collect()] == [0.0, 0.5, 50.0, 100.0, None]


def test_streamed_blocks_route_partial_ones(spark, tmp_path):
    start = dt.datetime(2026, 7, 1)
    rows = [(1, start + dt.timedelta(minutes=10 * i), 0.1) for i in range(1, 19)] + [(2, start + dt.timedelta(minutes=10), 0.1), (1, start + dt.timedelta(hours=9), 0.1)]
    src = str(tmp_path / "src")
    spark.createDataFrame(rows, "cell long, ts timestamp, rate double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("cell long, ts timestamp, rate double").parquet(src)
    blocks.route_blocks(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("cell").collect()
    assert [(r.cell, r.block_end.hour, round(r.total, 6), r.state) for r in got] == [(1, 3, 18.0, "whole"), (2, 3, 1.0, "partial")]


def test_a_tree_of_samples_is_one_table(spark, tmp_path):
    for model, day in (("west", 1), ("continental", 2)):
        (tmp_path / model / "run").mkdir(parents=True)
        (tmp_path / model / "run" / f"2026-07-0{day}.csv").write_text(f"station_code,lead_hours\n00{day},{day}.5\n")
    got = feeds.forecast_samples(spark, str(tmp_path), "station_code string, lead_hours double").orderBy("station_code").collect()
    assert [tuple(r) for r in got] == [("001", 1.5), ("002", 2.5)]


def test_upsert_keeps_the_newest_row(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "key string, at int, v int")
    got = catalog.upsert(rows(("a", 1, 1), ("b", 5, 2)), rows(("a", 2, 3), ("b", 4, 4), ("c", 1, 5)), "key", "at")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2, 3), ("b", 5, 2), ("c", 1, 5)]
