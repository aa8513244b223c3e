"""Queries: feeds that are written as files and read back, the archive of hours, streamed blocks, step ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fires, lightning, steps
from ..sources import feeds, store
from ..streaming import blocks
from .standins import duck, view
from .weather import BLOCKS, STEPS

QUERIES, ORACLES = {}, {}
r4 = lambda c, a=None: (F.floor((F.col(c) if isinstance(c, str) else c) * 1e4 + 0.5) / 1e4).alias(a or c)


def station_catalogue(spark, sf_dir):
    c = view(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("STATION_CODE"), F.col("c_name").alias("STATION_NAME"),
        F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise((48 + F.col("c_nationkey")).cast("string")).alias("LATITUDE"), (-114 - F.col("c_nationkey")).cast("string").alias("LONGITUDE"))
    path = store.new_path(spark, "stations")
    c.unionByName(c).write.option("header", True).csv(path)
    return feeds.stations(spark, path)


QUERIES["station_catalogue"] = station_catalogue
ORACLES["station_catalogue"] = "select distinct cast(c_custkey as varchar) as station_code, c_name as station_name, cast(48 + c_nationkey as double) as lat, cast(-114 - c_nationkey as double) as lon from customer where c_custkey % 7 <> 0"

_DAYS = "select o_custkey as c, cast(o_orderdate as date) as d, max(o_orderkey) as k from {orders} group by 1, 2"


def _days(spark, sf_dir):
    o = view(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("c"), F.to_date("o_orderdate").alias("d")).agg(F.max("o_orderkey").alias("k"))


def observation_files(spark, sf_dir):
    k = F.col("k")
    rows = _days(spark, sf_dir).select(
        F.concat(F.date_format("d", "yyyyMMdd"), F.when(k % 4 == 0, "13").otherwise("12"), F.lit(".0")).alias("DATE_TIME"), F.col("c").cast("string").alias("STATION_CODE"),
        F.concat(F.lit("S"), "c").alias("STATION_NAME"), F.when(k % 11 != 0, k % 5 + 1).alias("DANGER_RATING"), (k % 40).alias("FIRE_WEATHER_INDEX"), (k % 120).alias("BUILDUP_INDEX"))
    path = store.new_path(spark, "observations")
    rows.write.option("header", True).csv(path)
    return feeds.observations(spark, path)


QUERIES["observation_files"] = observation_files
ORACLES["observation_files"] = duck(f"""select cast(c as varchar) as station_code, strftime(d, '%Y-%m-%d') as fire_date, 'S' || c as station_name, cast(k % 5 + 1 as double) as observed_danger_class,
cast(k % 40 as double) as observed_fwi, cast(k % 120 as double) as observed_bui from ({_DAYS}) q where k % 4 <> 0 and k % 11 <> 0""")


def forecast_snapshots(spark, sf_dir):
    item = lambda kind, days, cls: F.struct(F.lit(kind).alias("recordType"), F.concat(F.date_format(F.date_add("d", days), "yyyyMMdd"), F.lit("12")).alias("dailyTimestamp"), cls.cast("string").alias("dangerClass"))
    k = F.col("k")
    data = F.array(item("Forecast", 1, k % 5 + 1), item("actual", 1, k), item("manual", -1, k), item("ESTIMATE", 1, k % 4 + 1))
    station = F.struct(F.col("c").cast("string").alias("stationCode"), F.concat(F.lit("S"), "c").alias("stationName"), data.alias("summaryData"))
    rows = _days(spark, sf_dir).select(F.date_format("d", "yyyy-MM-dd'T06:00:00Z'").alias("snapshot_time_utc"), F.struct(F.array(station).alias("collection")).alias("response"))
    path = store.new_path(spark, "snapshots")
    rows.write.json(path)
    return feeds.forecast_snapshots(spark, path).withColumn("run_init_utc", F.date_format("run_init_utc", "yyyyMMdd HH"))


QUERIES["forecast_snapshots"] = forecast_snapshots
ORACLES["forecast_snapshots"] = duck(f"""select cast(c as varchar) as station_code, 'S' || c as station_name, strftime(d, '%Y%m%d') || ' 06' as run_init_utc, strftime(d + interval 1 day, '%Y-%m-%d') as fire_date,
cast(38 as double) as lead_hours, cast(k % 4 + 1 as double) as forecast_danger_class from ({_DAYS}) q""")


def active_fires(spark, sf_dir):
    e = F.col("event_id")
    number = F.concat(F.lit("F"), e)
    properties = F.struct(
        F.when(F.col("event_type") == "click", " Out ").otherwise(F.col("event_type")).alias("FIRE_STATUS"), number.alias("FIRE_NUMBER"), F.when(e % 5 == 0, "y").otherwise("N").alias("FIRE_OF_NOTE_IND"),
        F.when(e % 3 == 0, number).otherwise(F.concat(F.lit("Fire "), "user_id")).alias("INCIDENT_NAME"), F.col("value").alias("CURRENT_SIZE"))
    place = F.array(((e * 37 % 3800 - 14400) / 100).cast("double"), ((4450 + e * 53 % 1700) / 100).cast("double"))
    raw = view(spark, sf_dir, "events").select(F.to_json(F.array(F.struct(F.struct(place.alias("coordinates")).alias("geometry"), properties.alias("properties")))).alias("json"))
    return fires.active_fires(raw)


QUERIES["active_fires"] = active_fires
ORACLES["active_fires"] = """select * from (select 'F' || event_id as fire_id, cast(event_id * 37 % 3800 - 14400 as double) / 100 as lon, cast(4450 + event_id * 53 % 1700 as double) / 100 as lat, event_type as status,
value as size_ha, case when event_id % 3 <> 0 then 'Fire ' || user_id end as name, event_id % 5 = 0 as of_note from events where event_type <> 'click') q where lon between -142 and -108 and lat between 45 and 61"""


def archive_hours(spark, sf_dir):
    rows = view(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("run"), (F.col("l_linenumber") * 3).alias("fhour"), F.col("l_orderkey").alias("cell"), store.half_points(F.col("l_extendedprice") / 500 - 5).alias("value"))
    path = store.new_path(spark, "archive")
    store.write_hours(rows, path, ["run", "fhour"])
    back = spark.read.parquet(path)
    stats = store.hour_stats(back, ["run", "fhour"], "value", 0.5, 99.5)
    return store.with_complete(stats, ["run"], "fhour", [3, 6, 9, 12, 15, 18, 21])


QUERIES["archive_hours"] = archive_hours
ORACLES["archive_hours"] = """with v as (select cast(year(l_shipdate) as integer) as run, cast(l_linenumber * 3 as integer) as fhour, round_even(least(greatest(l_extendedprice / 500 - 5, 0), 100) * 2, 0) / 2 as value from lineitem),
s as (select run, fhour, count(*) as cells, count(value) as valid, count(*) filter (value <> 0) as nonzero, max(value) as top, count(*) filter (value < 0.5 or value > 99.5) as clipped from v group by 1, 2)
select *, list_sort(list(fhour) over (partition by run)) = [3, 6, 9, 12, 15, 18, 21] as complete from s"""


def streamed_blocks(spark, sf_dir):
    """Blocks of a stream in several batches: whole ones as they were told, the others from the stream's state. Repeats of
    an hour come in one batch, since what comes after a block was told changes nothing."""
    source, out, checkpoint = (store.new_path(spark, x) for x in ("flashes", "blocks", "stream"))
    view(spark, sf_dir, "flash10").repartition(3, F.xxhash64("cell", lightning.slot(F.col("ts"), 60))).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    blocks.waiting_blocks(stream, out, checkpoint, step_minutes=60).awaitTermination()
    whole = spark.read.parquet(out).withColumns({"n": F.lit(3).cast("long"), "state": F.lit("whole")})
    open_ = blocks.open_blocks(spark, checkpoint, step_minutes=60).withColumn("state", F.lit("partial"))
    return whole.unionByName(open_).select(F.date_format("block_end", "yyyy-MM-dd HH:mm:ss").alias("block_end"), "cell", r4("total"), "n", "state")


QUERIES["streamed_blocks"] = streamed_blocks
ORACLES["streamed_blocks"] = duck("""with b as (select block_end, cell, count(*) as n, count(rate) as valid, sum(greatest(coalesce(rate, 0), 0) * 60) as total from """ + STEPS + """ group by 1, 2)
select strftime(block_end, '%Y-%m-%d %H:%M:%S') as block_end, cell, case when n < 3 or valid = 3 then floor(total * 1e4 + 0.5) / 1e4 end as total, n, case when n = 3 then 'whole' else 'partial' end as state from b""")


def flash_exceedance(spark, sf_dir):
    b = lightning.three_hour_blocks(view(spark, sf_dir, "flash10"), step_minutes=60)
    return lightning.exceedance(b).select(F.date_format("block_end", "yyyy-MM-dd HH:mm:ss").alias("block_end"), "level", "cells")


QUERIES["flash_exceedance"] = flash_exceedance
ORACLES["flash_exceedance"] = duck("with " + BLOCKS + """
select strftime(block_end, '%Y-%m-%d %H:%M:%S') as block_end, cast(level as double) as level, count(*) as cells from b, (values (0.05), (0.5), (2.0)) l(level) where density >= level group by 1, 2""")


def precip_steps(spark, sf_dir):
    p, h = view(spark, sf_dir, "profile"), F.col("level") * 3
    step = F.when(F.col("level") % 3 == 0, h.cast("string")).when(F.col("level") % 3 == 1, F.concat(F.lit("0-"), h)).otherwise(F.concat(F.when(F.col("cell") % 2 == 0, 0).otherwise(h - 3), F.lit("-"), h))
    rows = p.select("cell", h.alias("fhour"), F.when(F.col("cell") % 9 != 0, F.col("rh") - 35).alias("value"), step.alias("step_range"))
    return steps.three_hour_precip(rows, ["cell"]).select("cell", "fhour", r4("precip"))


QUERIES["precip_steps"] = precip_steps
ORACLES["precip_steps"] = duck("""with p as (select cell, level * 3 as h, case when cell % 9 <> 0 then rh - 35 end as v, case level % 3 when 0 then null when 1 then 0 else case when cell % 2 = 0 then 0 else level * 3 - 3 end end as a from ({profile}) x),
j as (select c.*, q.h is not null as prev, q.v as pv, q.a as pa from p c left join p q on q.cell = c.cell and q.h = c.h - 3)
select cell, h as fhour, floor((case when v is null then null when prev and (a is null or pa is not null and h - a > 3 and pa = a or pa is null and a = 0 and h > 3) then case when pv is not null then greatest(v - pv, 0) end else greatest(v, 0) end) * 1e4 + 0.5) / 1e4 as precip from j""")


def waiting_blocks(spark, sf_dir):
    """Hours as parts of three-hour blocks that come in any order, in several batches; every fifth is told twice. An hour
    without a rate has arrived, and its block's total is missing."""
    wx = view(spark, sf_dir, "wx").select("cell", F.col("valid_ts").cast("timestamp").alias("ts"), F.when(F.col("hour_no") % 10 != 0, F.col("precip_mm")).alias("rate"), "hour_no")
    again = wx.filter("hour_no % 5 = 0")
    source, out = store.new_path(spark, "flashes"), store.new_path(spark, "blocks")
    wx.withColumn("k", F.lit(0)).unionByName(again.withColumn("k", F.lit(1))).repartition(3, F.xxhash64("cell", "ts", "k")).select("cell", "ts", "rate").write.parquet(source)
    stream = spark.readStream.schema("cell long, ts timestamp, rate double").option("maxFilesPerTrigger", 1).parquet(source)
    blocks.waiting_blocks(stream, out, store.new_path(spark, "stream"), step_minutes=60).awaitTermination()
    return spark.read.parquet(out).select(F.date_format("block_end", "yyyy-MM-dd HH:mm:ss").alias("block_end"), "cell", r4("total"))


QUERIES["waiting_blocks"] = waiting_blocks
ORACLES["waiting_blocks"] = duck("""with f as (select cell, valid_ts, to_timestamp(ceil(epoch(valid_ts) / 10800) * 10800) at time zone 'UTC' as b, case when hour_no % 10 <> 0 then precip_mm end as rate from ({wx}))
select strftime(b, '%Y-%m-%d %H:%M:%S') as block_end, cell, case when count(rate) = 3 then floor(sum(greatest(rate, 0)) * 60 * 1e4 + 0.5) / 1e4 end as total from f group by b, cell having count(distinct valid_ts) = 3""")


def partition_checks(spark, sf_dir):
    """Checks of the archive of hours after it was written in two parts and read back."""
    rows = view(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * 3).alias("fhour"), F.col("l_orderkey").alias("cell"), F.col("l_suppkey").alias("s"), F.when(F.col("l_quantity") < 48, F.col("l_quantity").cast("long")).alias("value"))
    path = store.new_path(spark, "archive")
    for part in ("fhour <= 9", "fhour > 9"):
        store.write_hours(rows.filter(part), path, ["fhour"])
    return store.partition_checks(spark.read.parquet(path), ["fhour"], "value", ["cell", "s", "value"])


QUERIES["partition_checks"] = partition_checks
ORACLES["partition_checks"] = """with r as (select cast(l_linenumber * 3 as integer) as fhour, case when l_quantity < 48 then cast(l_quantity as bigint) end as v, concat_ws(',', l_orderkey, l_suppkey, coalesce(cast(v as varchar), '-')) as line from lineitem)
select fhour, count(*) as cells, count(v) as valid, count(*) filter (v <> 0) as nonzero, min(v) as low, max(v) as top, cast(sum(('0x' || substr(md5(line), 1, 8))::ubigint) as bigint) as checksum from r group by 1"""


def stored_states(spark, sf_dir):
    """States of two runs over the grid and one over a part of it, stored and loaded for the grid and an anchor."""
    g = view(spark, sf_dir, "grid").select("iy", "ix", F.col("terrain").alias("state"))
    run = lambda name, day, d: d.select(F.lit("west").alias("model"), F.lit(name).alias("run"), F.lit(6).alias("fhour"), F.lit(day).cast("date").alias("anchor"), "iy", "ix", "state")
    path = store.new_path(spark, "states")
    for name, day, d in (("20260701T00Z", "2026-06-30", g), ("20260701T06Z", "2026-07-01", g), ("20260701T12Z", "2026-07-01", g.filter("ix < 40"))):
        store.save_states(run(name, day, d), path)
    got = store.load_states(spark, path, g, anchor=F.lit("2026-07-01").cast("date"))
    return got.select("run", F.col("anchor").cast("string").alias("anchor"), "iy", "ix", r4("state"))


QUERIES["stored_states"] = stored_states
ORACLES["stored_states"] = duck("select '20260701T06Z' as run, '2026-07-01' as anchor, iy, ix, floor(terrain * 1e4 + 0.5) / 1e4 as state from ({grid})")


def baseline_archive(spark, sf_dir):
    """Half points of three hours of the grid, stored with the formula and one fingerprint for all, as they share a grid."""
    g = view(spark, sf_dir, "grid").select(F.lit("r").alias("run"), F.explode(F.array(*map(F.lit, (3, 6, 9)))).alias("fhour"), "iy", "ix", (40.0 + F.col("iy")).alias("lat"), (-140.0 + F.col("ix")).alias("lon"), (F.col("v") / 20).alias("potential"))
    path = store.new_path(spark, "baseline")
    store.save_baseline(g, path, "v3")
    back = spark.read.parquet(path)
    return back.groupBy("run", "fhour", "formula").agg(F.count_distinct("grid").alias("grids"), F.count("potential").alias("valid"), F.sum("potential").alias("total"))


QUERIES["baseline_archive"] = baseline_archive
ORACLES["baseline_archive"] = duck("select 'r' as run, k.h as fhour, 'v3' as formula, 1 as grids, count(v) as valid, sum(round_even(least(greatest(v / 20, 0), 100) * 2, 0) / 2) as total from ({grid}) g, (values (3), (6), (9)) k(h) group by 1, 2")
