"""Published numbers and small scenarios."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cindergrid.functions import clock, geo
from cindergrid.functions import physics as P
from cindergrid.operators import grid, moisture, peak


def hours(spark, values):
    rows = [(1, i, *map(float, v), True) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "cell long, h int, temp_c double, rh double, wind_kmh double, precip_mm double, daylight boolean")


def test_first_hour_of_published_series(spark):
    got = moisture.evolve(hours(spark, [(14.78, 94.90, 2.7324, 0.0)]), ["cell"], "h").first()
    want = (83.1265, 6.0167, 15.4092, 1.8814, 6.0893, 0.8842)
    assert (got.ffmc, got.dmc, got.dc, got.isi, got.bui, got.fwi) == pytest.approx(want, abs=6e-4)


def test_rain_event(spark):
    rain = [0.4, 0.4, 0, 0, 0, 0, 0, 1.5, 0.1]
    got = moisture.evolve(hours(spark, [(20, 40, 15, r) for r in rain]), ["cell"], "h").orderBy("h").collect()[-1]
    want = (74.762601, 7.723823, 19.3875, 1.609265, 7.739380, 0.849284)
    assert (got.ffmc, got.dmc, got.dc, got.isi, got.bui, got.fwi) == pytest.approx(want, abs=6e-7)


def test_five_dry_hours_reset_the_rain(spark):
    got = moisture.evolve(hours(spark, [(20, 40, 15, 2.0)] + [(20, 40, 15, 0)] * 5), ["cell"], "h").orderBy("h").collect()[-1]
    assert (got.rain_total_mm, got.canopy_drying_hours) == (0, 0)


def test_missing_input_ends_the_state(spark):
    df = hours(spark, [(20, 40, 15, 0)] * 3).withColumn("rh", F.when(F.col("h") != 1, F.col("rh")))
    got = moisture.evolve(df, ["cell"], "h").orderBy("h").collect()
    assert got[0].fwi is not None and got[1].fwi is None and got[2].fwi is None


@pytest.mark.parametrize("ffmc, want", [(90.0, (15, 110.0, 50.0)), (84.0, (17, 112.0, 52.0))])
def test_peak_day(spark, ffmc, want):
    start = dt.datetime(2026, 7, 14, 12)
    rows = [(1, start + dt.timedelta(hours=i), 60.0 if i == 10 else 5.0, ffmc, 100.0 + i, 40.0 + i) for i in range(25)]
    df = spark.createDataFrame(rows, "cell long, valid_ts timestamp, wind_kmh double, ffmc double, fwi double, bui double")
    got = peak.peak_days(df, ["cell"]).orderBy("fire_date").first()
    assert (got.peak_hour, got.fwi, got.bui) == want
    assert (got.hour_count, got.complete) == (24, True)


def test_danger_matrix(spark):
    rows = [(r, f, b) for r in (1, 2, 3) for f, b in ((0.0, 0.0), (40.0, 100.0), (60.0, 250.0))]
    df = spark.createDataFrame(rows, "region int, fwi double, bui double")
    got = [r[0] for r in df.select(P.danger_class(F.col("fwi"), F.col("bui"), F.col("region"))).collect()]
    assert got == [1, 5, 5, 1, 4, 5, 1, 4, 5]


def test_block_end(spark):
    df = spark.createDataFrame([("2026-07-01 00:00:00",), ("2026-07-01 00:10:00",), ("2026-07-01 02:50:00",)], "t string")
    got = [r[0].hour for r in df.select(clock.block_end(F.col("t").cast("timestamp"))).collect()]
    assert got == [0, 3, 3]


def test_first_12z_window(spark):
    df = spark.createDataFrame([("20260708T12Z",), ("20260708T18Z",)], "s string")
    hours_ = F.sequence(F.lit(0), F.lit(48), F.lit(3))
    got = [r[0] for r in df.select(clock.first_12z_hours(clock.parse_stamp(F.col("s")), hours_)).collect()]
    assert (got[0][0], got[0][-1], got[1][0], got[1][-1]) == (3, 24, 21, 42)


def test_rh_edges(spark):
    df = spark.createDataFrame([(x,) for x in (None, 19.9, 20.0, 20.1, 30.0, 30.1, 60.0, 60.1, 80.0, 80.1)], "x double")
    got = [r[0] for r in df.select(P.rh_category(F.col("x"))).collect()]
    assert got == [None, "very dry", "dry", "dry", "dry", None, "moist", "moist", "moist", "very moist"]


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-123.1, 49.3), (-95.0, 49.0), (-60.0, 70.0)], "lon double, lat double")
    x, y = geo.lambert(F.col("lon"), F.col("lat"))
    lon, lat = geo.lambert_inverse(F.col("x"), F.col("y"))
    for r in df.withColumns({"x": x, "y": y}).select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert (r.lon2, r.lat2) == pytest.approx((r.lon, r.lat), abs=1e-8)


def test_billing_periods(spark):
    df = spark.createDataFrame([("2026-07-19",), ("2026-07-20",)], "d string").select(F.col("d").cast("timestamp").alias("t"))
    got = df.select(clock.billing_start(F.col("t"), F.lit(20)).cast("string"), clock.billing_end(F.col("t"), F.lit(20)).cast("string")).collect()
    assert [tuple(r) for r in got] == [("2026-06-20", "2026-07-20"), ("2026-07-20", "2026-08-20")]


def test_empty_crop_is_an_error(spark):
    df = spark.createDataFrame([(0, 0, 1.0)], "iy long, ix long, v double")
    with pytest.raises(Exception, match="no cell"):
        grid.crop(df, F.col("v") > 5).collect()
