"""Queries: fuel moisture, peak-burn days, danger classes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import physics as P
from ..operators import daily, evolution, moisture, peak, rounds, steps
from ..sources import store
from ..streaming import moisture as codes
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r4 = lambda c: F.floor(F.col(c) * 1e4 + 0.5) / 1e4


def fwi_hours(spark, sf_dir):
    return moisture.evolve(view(spark, sf_dir, "wx"), ["cell"], "valid_ts")


def fwi_hourly(spark, sf_dir):
    rows = fwi_hours(spark, sf_dir)
    hour = ((F.unix_timestamp("valid_ts") - 1782907200) / 3600 + 1).cast("long")
    return rows.select("cell", hour.alias("hour_no"), *[(F.floor(F.col(c) * 1e3 + 0.5) / 1e3).alias(c) for c in ("ffmc", "dmc", "dc", "isi", "bui", "fwi")])


FWI_SQL = """wx as ({wx}), f as (
    select cell, cast(0 as bigint) as hour_no, 14875.0::double / 101 * (101 - 85) / (59.5 + 85) as mf, 280 / exp(6 / 43.43::double) + 20 as md, 400 * exp(-15 / 400::double) as mc,
        0.0::double as rt, 0.0::double as dry, cast(null as double) as wind from (select distinct cell from wx)
    union all
    select cell, hour_no, mf2, md2, mc2, rt2, dry2, wind_kmh from (
        select w.cell, w.hour_no, w.wind_kmh, w.temp_c as t, w.rh as h, w.precip_mm as p,
            case when p > 0 or f.rt = 0 then 0 else f.dry + 1 end as d0, case when d0 >= 5 then 0 else f.rt end as b, case when d0 >= 5 then 0 else d0 end as dry2,
            b + p as tot, tot as rt2, case when tot <= 0.5 then 0 when b > 0.5 then p else tot - 0.5 end as rf,
            42.5 * rf * exp(-100 / (251 - f.mf)) * (1 - exp(-6.93 / case when rf > 0 then rf else 1 end)) + case when f.mf > 150 then 0.0015 * (f.mf - 150) * (f.mf - 150) * sqrt(rf) else 0 end as delta,
            case when rf > 0 then least(f.mf + delta, 250) else f.mf end as mo,
            0.18 * (21.1 - t) * (1 - exp(-0.115 * h)) as e1, 0.942 * pow(h, 0.679) + 11 * exp((h - 100) / 10) + e1 as ed, 0.618 * pow(h, 0.753) + 10 * exp((h - 100) / 10) + e1 as ew,
            case when mo > ed then h / 100 else (100 - h) / 100 end as a1, 0.424 * (1 - pow(a1, 1.7)) + 0.0694 * sqrt(w.wind_kmh) * (1 - pow(a1, 8)) as k0, 2 * 0.0579 * k0 * exp(0.0365 * t) as rate,
            case when mo < ed then ew else ed end as eq, case when mo = ed then mo else eq + (mo - eq) * pow(10, -rate) end as mf2,
            case when b <= 1.5 then 0.92 * tot - 1.27 else 0.92 * p end as rwd, 43.43 * ln(280 / greatest(f.md - 20, 1e-6)) as ld,
            case when ld <= 33 then 100 / (0.3 * ld + 0.5) when ld <= 65 then -1.3 * ln(ld) + 14 else 6.2 * ln(ld) - 17.2 end as bb,
            least(case when tot > 1.5 then f.md + 1000 * rwd / (bb * rwd + 48.77) else f.md end, 300) as wd,
            least(case when w.daylight then (wd - 20) * exp(-(2.22e-4 * greatest(t, 0) * (100 - h) / 43.43)) + 20 else wd end, 300) as md2,
            case when b <= 2.8 then 0.83 * tot - 1.27 else 0.83 * p end as rwc, least(case when tot > 2.8 then f.mc + 3.937 * rwc / 2 else f.mc end, 400) as wc,
            case when t > 0 then 1.5e-2 * t + 3.0 / 16 else 0 end as pe, least(case when w.daylight then wc * exp(-pe / 400) else wc end, 400) as mc2
        from f join wx w on w.cell = f.cell and w.hour_no = f.hour_no + 1)),
codes as (select cell, hour_no, wind, least(greatest(59.5 * (250 - mf) / (14875.0::double / 101 + mf), 0), 101) as ffmc, greatest(43.43 * ln(280 / greatest(md - 20, 1e-6)), 0) as dmc, greatest(400 * ln(400 / greatest(mc, 1e-6)), 0) as dc,
        14875.0::double / 101 * (101 - ffmc) / (59.5 + ffmc) as m, case when wind >= 40 then 12 * (1 - exp(-0.0818 * (wind - 28))) else exp(0.05039 * wind) end as fw,
        greatest(0, 0.208 * fw * 91.9 * exp(-0.1386 * m) * (1 + pow(m, 5.31) / 4.93e7)) as isi, case when dmc + 0.4 * dc > 0 then 0.8 * dc * dmc / (dmc + 0.4 * dc) else 0 end as base,
        greatest(0, case when base < dmc then dmc - (0.92 + pow(0.0114 * dmc, 1.7)) * (dmc - base) / dmc else base end) as bui,
        0.1 * isi * case when bui > 80 then 1000 / (25 + 108.64 * exp(-0.023 * bui)) else 0.626 * pow(bui, 0.809) + 2 end as fb, case when fb <= 1 then fb else exp(2.72 * pow(0.434 * ln(greatest(fb, 1)), 0.647)) end as fwi from f where hour_no > 0)"""

QUERIES["fwi_hourly"] = fwi_hourly
ORACLES["fwi_hourly"] = duck("with recursive " + FWI_SQL + " select cell, hour_no, " + ", ".join(f"floor({c} * 1e3 + 0.5) / 1e3 as {c}" for c in ("ffmc", "dmc", "dc", "isi", "bui", "fwi")) + " from codes")


def _codes(rows):
    hour = ((F.unix_timestamp("valid_ts") - 1782907200) / 3600 + 1).cast("long")
    return rows.select("cell", hour.alias("hour_no"), *[(F.floor(F.col(c) * 1e3 + 0.5) / 1e3).alias(c) for c in ("ffmc", "dmc", "dc", "isi", "bui", "fwi")])


def fwi_segments(spark, sf_dir):
    """The fold in rounds of 48 hours, each from the states that the one before left."""
    return _codes(rounds.evolve(view(spark, sf_dir, "wx"), ["cell"], "valid_ts", size=48))


def streamed_codes(spark, sf_dir):
    """The fold over a stream of three batches, the last after a restart."""
    wx = view(spark, sf_dir, "wx").withColumn("valid_ts", F.col("valid_ts").cast("timestamp"))
    source, out, checkpoint = (store.new_path(spark, x) for x in ("hours", "evolved", "stream"))
    for k, part in enumerate(("hour_no <= 20", "hour_no between 21 and 50", "hour_no > 50")):
        wx.filter(part).coalesce(1).write.parquet(f"{source}/part={k}")
        if k:
            stream = spark.readStream.schema(wx.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")
            codes.write_evolved(stream.drop("hour_no"), ["cell"], "valid_ts", out, checkpoint).awaitTermination()
    return _codes(spark.read.parquet(f"{out}/hours"))


QUERIES["fwi_segments"], QUERIES["streamed_codes"] = fwi_segments, streamed_codes
ORACLES["fwi_segments"] = ORACLES["streamed_codes"] = ORACLES["fwi_hourly"]


def peak_danger(spark, sf_dir):
    days = peak.peak_days(fwi_hours(spark, sf_dir), ["cell"])
    region = (F.pmod("cell", F.lit(3)) + 1).cast("int")
    return days.select(
        "cell", F.col("fire_date").cast("string").alias("fire_date"), r4("fwi").alias("fwi"), r4("bui").alias("bui"), F.col("peak_hour").cast("long").alias("peak_hour"), "hour_count", "complete", "cutoff_reached",
        P.danger_class(F.col("fwi"), F.col("bui"), region).cast("long").alias("danger"), P.adjective_class(F.col("fwi")).cast("long").alias("adjective"),
    )


def _matrix_sql() -> str:
    col = lambda spec, x: " + ".join(f"cast({x} >= {e} as int)" for e in spec)
    return "case " + " ".join(f"when region = {r} then {s['classes']}[{col(s['bui'], 'bui')} + 1][{col(s['fwi'], 'fwi')} + 1]" for r, s in P.DANGER.items()) + " end"


PEAK_SQL = """h as (select *, timestamp '2026-07-01 12:00:00' + (hour_no - 8) * interval '1' hour as loc, cast(loc - interval 5 hour as date) as fire_date, extract(hour from loc) as lh from codes),
w as (select *, row_number() over d as seq, count(*) over (partition by cell, fire_date) as n, lag(wind) over d as b1, lag(wind, 2) over d as b2, lead(wind) over d as a1, lead(wind, 2) over d as a2, lead(lh) over (partition by cell order by hour_no) as nh
    from h window d as (partition by cell, fire_date order by hour_no)),
s as (select *, case when seq = 1 or seq = n then wind when seq = 2 or seq = n - 1 then 0.25 * b1 + 0.5 * wind + 0.25 * a1 else (b2 + 4 * b1 + 6 * wind + 4 * a1 + a2) / 16 end as sw,
    greatest(0, 0.208 * case when sw >= 40 then 12 * (1 - exp(-0.0818 * (sw - 28))) else exp(0.05039 * sw) end * 91.9 * exp(-0.1386 * m) * (1 + pow(m, 5.31) / 4.93e7)) as score from w),
k as (select *, row_number() over (partition by cell, fire_date order by score desc, seq) as rk from s),
g as (select cell, fire_date, max(case when rk = 1 then fwi end) as f1, max(case when rk = 1 then bui end) as u1, max(case when rk = 1 then lh end) as h1, max(case when lh = 17 then fwi end) as f2, max(case when lh = 17 then bui end) as u2,
    max(ffmc) as mx, count(*) as hour_count, max(case when seq = 1 then lh end) as fh, max(case when seq = n then nh end) as eh, max(loc) as ll from k group by 1, 2),
p as (select *, mx < 85 and f2 is not null as low, case when low then f2 else f1 end as fwi, case when low then u2 else u1 end as bui, case when low then 17 else h1 end as peak_hour, cell % 3 + 1 as region from g)
"""
QUERIES["peak_danger"] = peak_danger
ORACLES["peak_danger"] = duck("with recursive " + FWI_SQL + ", " + PEAK_SQL + f"""select cell, cast(fire_date as varchar) as fire_date, floor(fwi * 1e4 + 0.5) / 1e4 as fwi, floor(bui * 1e4 + 0.5) / 1e4 as bui, cast(peak_hour as bigint) as peak_hour, hour_count,
    fh = 5 and coalesce(eh, -1) = 5 and hour_count between 23 and 25 as complete, cast(ll as date) > fire_date or extract(hour from ll) >= 17 as cutoff_reached, cast({_matrix_sql()} as bigint) as danger,
    cast(1 + cast(fwi >= 6 as int) + cast(fwi >= 16 as int) + cast(fwi >= 23 as int) + cast(fwi >= 30 as int) as bigint) as adjective from p""")


def _whole_run(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").select("cell", F.lit("20260701T11Z").alias("run"), F.col("hour_no").alias("fhour"), "temp_c", "rh", "wind_kmh", "precip_mm", "daylight")
    return moisture.evolve(wx, ["cell", "run"], "fhour").withColumn("init", F.lit("2026-07-01 11:00:00").cast("timestamp"))


QUERIES["run_frames"] = lambda spark, sf_dir: evolution.frames(_whole_run(spark, sf_dir), [3, 6, 24, 48]).select("cell", "fhour", *[(F.floor(F.col(c) * 1e3 + 0.5) / 1e3).alias(c) for c in ("ffmc", "dmc", "dc", "fwi")])
ORACLES["run_frames"] = duck("with recursive " + FWI_SQL + " select cell, hour_no as fhour, " + ", ".join(f"floor({c} * 1e3 + 0.5) / 1e3 as {c}" for c in ("ffmc", "dmc", "dc", "fwi")) + " from codes where hour_no in (3, 6, 24, 48)")
QUERIES["run_peaks"] = lambda spark, sf_dir: evolution.peaks(_whole_run(spark, sf_dir)).select("cell", "run", F.col("fire_date").cast("string").alias("fire_date"), r4("fwi").alias("fwi"), r4("bui").alias("bui"), F.col("peak_hour").cast("long").alias("peak_hour"))
ORACLES["run_peaks"] = duck("with recursive " + FWI_SQL + ", " + PEAK_SQL + "select cell, '20260701T11Z' as run, cast(fire_date as varchar) as fire_date, floor(fwi * 1e4 + 0.5) / 1e4 as fwi, floor(bui * 1e4 + 0.5) / 1e4 as bui, cast(peak_hour as bigint) as peak_hour from p")


def daylight_hours(spark, sf_dir):
    rows = view(spark, sf_dir, "wx").withColumns({"lat": 48.5 + F.pmod("cell", F.lit(12)), "lon": -124.0 + F.pmod("cell", F.lit(9))})
    return rows.groupBy("cell").agg(F.count_if(clock.daylight(F.col("valid_ts"), F.col("lat"), F.col("lon"))).alias("light"), F.count(F.lit(1)).alias("hours"))


QUERIES["daylight_hours"] = daylight_hours
ORACLES["daylight_hours"] = duck("""with w as (select cell, 48.5 + cell % 12 as lat, -124.0 + cell % 9 as lon, valid_ts - interval 7 hour as loc from ({wx})),
a as (select *, 2 * pi() * (extract(doy from loc) - 1) / 365.0 as g, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) as e,
    0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) as t, radians(lat) as f,
    degrees(acos(least(greatest(cos(radians(90.833)) / (cos(f) * cos(t)) - tan(f) * tan(t), -1), 1))) as hd, (720 - 4 * (lon + hd) - e) / 60 - 7 as ri, (720 - 4 * (lon - hd) - e) / 60 - 7 as st, extract(hour from loc) as h from w)
select cell, count(*) filter ((ri <= h and h <= st) or (h < 6 and ri <= h + 24 and h + 24 <= st)) as light, count(*) as hours from a group by cell""")


def hourly_rain(spark, sf_dir):
    """Hourly and three-hourly amounts from accumulations; hours 1 and 3 are the first, gaps stay missing."""
    w = Window.partitionBy("cell").orderBy("hour_no").rowsBetween(Window.unboundedPreceding, 0)
    acc = view(spark, sf_dir, "wx").select("cell", "hour_no", F.sum("precip_mm").over(w).alias("acc")).filter("hour_no % 13 <> 0")
    rows = steps.hourly_amount(acc, ["cell"], "hour_no", "acc").withColumnRenamed("amount", "one")
    rows = steps.amount_since(rows, ["cell"], 3, "hour_no", "acc").withColumnRenamed("amount", "three")
    rows = steps.rises(rows, ["cell"], "hour_no", "acc")
    return rows.select("cell", "hour_no", r4("one").alias("rain_1h"), r4("three").alias("rain_3h"), r4("amount").alias("rise"))


QUERIES["hourly_rain"] = hourly_rain
ORACLES["hourly_rain"] = duck("""with a as (select cell, hour_no, sum(precip_mm) over (partition by cell order by hour_no) as acc from ({wx})), b as (select * from a where hour_no % 13 <> 0)
select b.cell, b.hour_no, floor(case when b.hour_no = 1 then b.acc when p.acc is not null then greatest(b.acc - p.acc, 0) end * 1e4 + 0.5) / 1e4 as rain_1h, floor(greatest(b.acc - coalesce(q.acc, 0), 0) * 1e4 + 0.5) / 1e4 as rain_3h, floor((b.acc - coalesce(lag(b.acc) over (partition by b.cell order by b.hour_no), 0)) * 1e4 + 0.5) / 1e4 as rise
from b left join b p on p.cell = b.cell and p.hour_no = b.hour_no - 1 left join b q on q.cell = b.cell and q.hour_no = b.hour_no - 3""")


def daily_extremes(spark, sf_dir):
    """Local-day extremes with their hours (earliest on ties), the noon sample and the rain since the last noon."""
    w = Window.partitionBy("cell").orderBy("hour_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = view(spark, sf_dir, "wx").withColumn("acc", F.sum("precip_mm").over(w))
    got = daily.extremes(rows, ["cell"], "temp_c").join(daily.noon_samples(rows, ["cell"], ["rh"], "acc"), ["cell", "local_date"])
    return got.select("cell", F.col("local_date").cast("string").alias("local_date"), r4("top").alias("tmax"), F.col("top_hour").alias("tmax_hour"), r4("low").alias("tmin"), F.col("low_hour").alias("tmin_hour"), r4("rh").alias("noon_rh"), (F.floor(F.col("rain_24h") * 1e3 + 0.5) / 1e3).alias("rain_24h"))


QUERIES["daily_extremes"] = daily_extremes
ORACLES["daily_extremes"] = duck("""with w as (select *, valid_ts - interval 7 hour as loc, cast(loc as date) as d, sum(precip_mm) over (partition by cell order by hour_no) as acc from ({wx})),
x as (select cell, d, max(temp_c) as tmax, min(temp_c) as tmin, max(case when extract(hour from loc) = 12 then rh end) as noon_rh, max(case when extract(hour from loc) = 12 then acc end) as na from w group by 1, 2),
y as (select w.cell, w.d, min(case when temp_c = tmax then loc end) as a, min(case when temp_c = tmin then loc end) as b from w join x on x.cell = w.cell and x.d = w.d group by 1, 2)
select x.cell, cast(x.d as varchar) as local_date, floor(tmax * 1e4 + 0.5) / 1e4 as tmax, cast(extract(hour from a) as bigint) as tmax_hour, floor(tmin * 1e4 + 0.5) / 1e4 as tmin, cast(extract(hour from b) as bigint) as tmin_hour, floor(noon_rh * 1e4 + 0.5) / 1e4 as noon_rh,
    floor(case when na - lag(na) over l is not null then greatest(na - lag(na) over l, 0) end * 1e3 + 0.5) / 1e3 as rain_24h from x join y on x.cell = y.cell and x.d = y.d window l as (partition by x.cell order by x.d)""")


def season_switch(spark, sf_dir):
    """Seasons of days whose mean temperature is set 8 degrees lower, so that both thresholds are crossed."""
    days = view(spark, sf_dir, "wx").groupBy("cell", F.to_date(clock.local(F.col("valid_ts"))).alias("d")).agg(F.avg("temp_c").alias("t"), F.sum("precip_mm").alias("p"))
    got = daily.seasons(days, ["cell"], "d", F.col("t") - 8, F.col("p"))
    return got.select("cell", F.col("d").cast("string").alias("local_date"), "season", "onset", F.col("days_in").alias("days"), r4("winter_rain").alias("winter_rain"))


QUERIES["season_switch"] = season_switch
ORACLES["season_switch"] = duck("""with w as (select cell, cast(valid_ts - interval 7 hour as date) as d, avg(temp_c) - 8 as t, sum(precip_mm) as p from ({wx}) group by 1, 2),
a as (select *, max(t) over (partition by cell order by d rows between 2 preceding and current row) as top, case when top < 5 then 'winter' when top > 12 then 'summer' end as tr from w),
b as (select *, last_value(tr ignore nulls) over (partition by cell order by d) as season from a), c as (select *, lag(season) over (partition by cell order by d) is distinct from season as onset from b),
e as (select *, sum(cast(onset as int)) over (partition by cell order by d) as spell from c)
select cell, cast(d as varchar) as local_date, season, onset, row_number() over (partition by cell, spell order by d) as days, floor(sum(case when season = 'winter' then p else 0 end) over (partition by cell, spell order by d) * 1e4 + 0.5) / 1e4 as winter_rain from e""")
