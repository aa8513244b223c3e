"""Queries: forecast verification, as-of choice, fires."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import asof, fires, spatial, verify
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r6 = lambda c: (F.floor(c * 1e6 + 0.5) / 1e6)


def pairs(spark, sf_dir):
    f = view(spark, sf_dir, "forecast")
    grid, snap = f.filter("id % 4 <> 0"), f.filter("id % 4 = 0").withColumn("fclass", F.when(F.col("id") % 28 != 0, F.col("fclass"))).withColumn("source", F.lit("snapshot"))
    return verify.matched([grid, snap], view(spark, sf_dir, "observed"))


PAIRS = """p as (select f.*, oclass, fclass - oclass as error, case when lead <= 18 then 'Day 0' when lead <= 42 then 'Day 1' when lead <= 72 then 'Day 2' end as lead_group
    from ({forecast}) f join ({observed}) o on o.station = f.station and o.fire_date = f.fire_date where lead >= 0 and lead <= 72 and f.id % 28 <> 0)"""


def verification_metrics(spark, sf_dir):
    m = verify.metrics(pairs(spark, sf_dir))
    return m.select("model", "lead_group", "n", *[r6(F.col(c)).alias(c) for c in ("exact", "within_one", "mae", "bias")])


QUERIES["verification_metrics"] = verification_metrics
ORACLES["verification_metrics"] = duck("with " + PAIRS + """, m as (select model, coalesce(lead_group, 'all') as lead_group, count(*) as n, 100 * avg(cast(error = 0 as double)) as exact, 100 * avg(cast(abs(error) <= 1 as double)) as within_one, avg(abs(error)) as mae, avg(error) as bias
    from p group by grouping sets ((model), (model, lead_group))) select model, lead_group, n, """ + ", ".join(f"floor({c} * 1e6 + 0.5) / 1e6 as {c}" for c in ("exact", "within_one", "mae", "bias")) + " from m")

QUERIES["verification_confusion"] = lambda spark, sf_dir: verify.confusion(pairs(spark, sf_dir))
ORACLES["verification_confusion"] = duck("with " + PAIRS + """, s as (select a.range as oclass, b.range as fclass from range(1, 6) a, range(1, 6) b)
    select s.oclass, s.fclass, count(p.id) as n from s left join p on cast(p.oclass as bigint) = s.oclass and cast(p.fclass as bigint) = s.fclass group by 1, 2""")

QUERIES["latest_forecasts"] = lambda spark, sf_dir: verify.keep_one(pairs(spark, sf_dir), ["model", "station", "fire_date"], ["lead", "id"], last=False).select("model", "station", F.col("fire_date").cast("string").alias("fire_date"), "lead", "id", "error")
ORACLES["latest_forecasts"] = duck("with " + PAIRS + " select model, station, cast(fire_date as varchar) as fire_date, lead, id, error from p qualify row_number() over (partition by model, station, fire_date order by lead, id) = 1")

QUERIES["verification_coverage"] = lambda spark, sf_dir: verify.coverage(pairs(spark, sf_dir), ["model"]).select("model", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"), "n", "stations")
ORACLES["verification_coverage"] = duck("with " + PAIRS + " select model, cast(min(fire_date) as varchar) as first, cast(max(fire_date) as varchar) as last, count(*) as n, count(distinct station) as stations from p group by model")


def asof_products(spark, sf_dir):
    """For every order as an as-of time, the newest urgent or high-priority order of its customer group placed before."""
    o = view(spark, sf_dir, "orders").select(F.pmod("o_custkey", F.lit(50)).alias("key"), F.col("o_orderdate").alias("init"), F.col("o_orderkey").alias("id"), "o_orderpriority")
    wanted = o.select(F.col("id").alias("wid"), "key", F.col("init").alias("as_of"))
    got = asof.newest_before(wanted, o.filter("o_orderpriority in ('1-URGENT', '2-HIGH')"), ["key"], "as_of", "init", ["id"])
    return got.select("wid", "key", F.col("found_init").cast("string").alias("found_init"), F.col("found_id").alias("found_id"))


QUERIES["asof_products"] = asof_products
ORACLES["asof_products"] = duck("""with o as (select o_custkey % 50 as key, o_orderdate as init, o_orderkey as id, o_orderpriority as p from orders), g as (select key, init, max(id) as id from o where p in ('1-URGENT', '2-HIGH') group by 1, 2)
select o.id as wid, o.key, cast(g.init as varchar) as found_init, g.id as found_id from o asof left join g on g.key = o.key and g.init <= o.init""")


def asof_days_back(spark, sf_dir):
    """For every customer group and day with orders, the newest filled order of that day, else of up to 3 days before, not
    after the day's last order."""
    o = view(spark, sf_dir, "orders").select(F.pmod("o_custkey", F.lit(200)).alias("key"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("n"), "o_orderstatus")
    wanted = o.groupBy("key", "day").agg(F.max("n").alias("as_of"))
    got = asof.newest_with_days_back(wanted, o.filter("o_orderstatus = 'F'"), ["key"], "day", "as_of", "n", back=3)
    return got.select("key", F.col("day").cast("string").alias("day"), F.col("found_day").cast("string").alias("found_day"), F.col("found_init").alias("found_n"))


QUERIES["asof_days_back"] = asof_days_back
ORACLES["asof_days_back"] = duck("""with o as (select o_custkey % 200 as key, cast(o_orderdate as date) as day, o_orderkey as n, o_orderstatus as s from orders), w as (select key, day, max(n) as as_of from o group by 1, 2)
select w.key, cast(w.day as varchar) as day, cast(p.day as varchar) as found_day, p.n as found_n from w join o p on p.key = w.key and p.day between w.day - 3 and w.day and p.n <= w.as_of and p.s = 'F' qualify row_number() over (partition by w.key, w.day order by p.day desc, p.n desc) = 1""")


def previous_states(spark, sf_dir):
    wx = view(spark, sf_dir, "wx")
    states = wx.filter("(hour_no + cell) % 7 = 0").select("cell", F.col("hour_no").alias("h"), F.col("temp_c").alias("state"))
    return asof.previous_state(wx.select("cell", F.col("hour_no").alias("h")), states, ["cell"], "h").select("cell", "h", F.col("lag").cast("long").alias("lag"), "state")


QUERIES["previous_states"] = previous_states
ORACLES["previous_states"] = duck("""with w as ({wx}), s as (select cell, hour_no as h, temp_c as state from w where (hour_no + cell) % 7 = 0)
select w.cell, w.hour_no as h, cast(l.lag as bigint) as lag, s.state from w cross join (values (6), (12), (18), (24)) l(lag) join s on s.cell = w.cell and s.h = w.hour_no - l.lag qualify row_number() over (partition by w.cell, w.hour_no order by l.lag) = 1""")


def bridge_runs(spark, sf_dir):
    """For every hour with events of a group as an anchor, the newest hour with a purchase as a run that reaches 30 hours on."""
    e = view(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("key"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("t"), "event_type")
    wanted = e.select("key", F.col("t").alias("anchor"), (F.col("t") + F.expr("interval 30 hours")).alias("target")).distinct()
    runs = e.filter("event_type = 'purchase'").select("key", F.col("t").alias("init")).distinct()
    got = asof.bridge_run(wanted, runs, ["key"], "anchor", "target", "init")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return got.select("key", text("anchor"), text("bridge"))


QUERIES["bridge_runs"] = bridge_runs
ORACLES["bridge_runs"] = duck("""with e as (select user_id % 20 as key, date_trunc('hour', ts) as t, event_type from events), w as (select distinct key, t as anchor from e), r as (select distinct key, t from e where event_type = 'purchase'),
j as (select w.key, w.anchor, r.t from w asof join r on r.key = w.key and r.t <= w.anchor) select key, strftime(anchor, '%Y-%m-%d %H:%M:%S') as anchor, strftime(t, '%Y-%m-%d %H:%M:%S') as bridge from j where t + interval 48 hour >= anchor + interval 30 hour""")


def hotspot_clusters(spark, sf_dir):
    c = fires.clusters(view(spark, sf_dir, "hotspot"))
    return c.select("gx", "gy", *[r6(F.col(k)).alias(k) for k in ("lon", "lat", "frp")], "detections", "latest")


QUERIES["hotspot_clusters"] = hotspot_clusters
ORACLES["hotspot_clusters"] = duck("""with h as (select *, greatest(coalesce(nullif(frp, 0), 0.1), 0.1) as w from ({hotspot}) where lon between -142 and -108 and lat between 45 and 61)
select cast(floor((lon + 142.0) / 0.12::double) as bigint) as gx, cast(floor((lat - 45.0) / 0.09::double) as bigint) as gy, floor(sum(lon * w) / sum(w) * 1e6 + 0.5) / 1e6 as lon, floor(sum(lat * w) / sum(w) * 1e6 + 0.5) / 1e6 as lat, floor(sum(w) * 1e6 + 0.5) / 1e6 as frp, count(*) as detections, max(ts) as latest from h group by 1, 2""")


def best_fire_source(spark, sf_dir):
    """Rows of the one best snapshot: events by type, the hour's end of January as now."""
    e = view(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("snapshot_id"), F.when(F.col("user_id") % 2 == 0, "primary").otherwise("secondary").alias("source"), (F.col("user_id") % 5 == 0).alias("live"))
    e = e.withColumn("retrieved_at", F.timestamp_seconds(F.lit(1706745600) - F.col("snapshot_id") * 1800))
    return fires.best_snapshot(e, F.timestamp_seconds(F.lit(1706745600))).select("event_id", "snapshot_id", "source")


QUERIES["best_fire_source"] = best_fire_source
ORACLES["best_fire_source"] = duck("""with e as (select event_id, user_id as snapshot_id, case when user_id % 2 = 0 then 'primary' else 'secondary' end as source, user_id % 5 = 0 as live, user_id * 0.5 as age from events),
r as (select *, case when age <= 1 then case when source = 'primary' then 0 else 2 end when live then case when source = 'primary' then 1 else 3 end when age <= 12 then case when source = 'primary' then 4 else 5 end end as rk from e)
select event_id, snapshot_id, source from r where snapshot_id = (select snapshot_id from r where rk is not null order by rk, age, snapshot_id limit 1)""")


def station_cells(spark, sf_dir):
    """Nearest part of a made grid for each customer, in metres of the equal-area projection."""
    c = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station"), (-125.0 + (F.col("c_custkey") % 97) / 40.0).alias("lon"), (49.0 + (F.col("c_custkey") % 89) / 40.0).alias("lat"))
    g = view(spark, sf_dir, "grid").select("iy", "ix", (-125.0 + F.col("ix") * 0.06).alias("lon"), (49.0 + F.col("iy") * 0.055).alias("lat"))
    xy = lambda df: df.withColumns(dict(zip(("x", "y"), geo.albers(F.col("lon"), F.col("lat")))))
    got = spatial.nearest_cell(xy(c), xy(g), 15_000.0)
    return got.select("station", "iy", "ix", (F.floor(F.col("distance") / 10 + 0.5) / 100).alias("km"))


_ALBERS = """(select {k}, 1000000 + rho * sin(th) as x, rho0 - rho * cos(th) as y from (select {k}, sin(radians(lat)) as s, %s as e2, sqrt(e2) as e1, %s as n, %s as cc, %s as rho0, (1 - e2) * (s / (1 - e2 * s * s) - ln((1 - e1 * s) / (1 + e1 * s)) / (2 * e1)) as q, 6378137 * sqrt(cc - n * q) / n as rho, n * radians(lon + 126) as th from {t}))"""


def _albers_sql(k: str, t: str) -> str:
    import math

    l0, l1, l2 = (math.radians(x) for x in (45.0, 50.0, 58.5))
    n = (geo._m(l1) ** 2 - geo._m(l2) ** 2) / (geo._q(l2) - geo._q(l1))
    c = geo._m(l1) ** 2 + n * geo._q(l1)
    d = lambda x: f"{x!r}::double"
    return (_ALBERS % (d(geo.E2), d(n), d(c), d(geo.A * math.sqrt(c - n * geo._q(l0)) / n))).replace("{k}", k).replace("{t}", t)


QUERIES["station_cells"] = station_cells
ORACLES["station_cells"] = duck("""with c0 as (select c_custkey as station, -125.0::double + (c_custkey % 97) / 40.0::double as lon, 49.0::double + (c_custkey % 89) / 40.0::double as lat from customer), g0 as (select iy, ix, -125.0::double + ix * 0.06::double as lon, 49.0::double + iy * 0.055::double as lat from ({grid})),
c as """ + _albers_sql("station", "c0") + ", g as " + _albers_sql("iy, ix", "g0") + """, j as (select station, iy, ix, sqrt((c.x - g.x) * (c.x - g.x) + (c.y - g.y) * (c.y - g.y)) as d from c cross join g qualify row_number() over (partition by station order by d, iy, ix) = 1)
select station, iy, ix, floor(d / 10 + 0.5) / 100 as km from j""")


def danger_regions(spark, sf_dir):
    """Customers in polygons whose edges come from the nations: a diamond around each."""
    p = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 37 % 1000) / 20.0 + 0.013).alias("x"), ((F.col("c_custkey") * 53 % 700) / 20.0 + 0.007).alias("y"))
    n = view(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") % 5 * 10 + 5.0).alias("cx"), (F.floor(F.col("n_nationkey") / 5) * 7 + 3.5).alias("cy"))
    c = F.explode(F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip("abcd", q)]) for q in ((-4, 0, 0, -3), (0, -3, 4, 0), (4, 0, 0, 3), (0, 3, -4, 0))])).alias("q")
    e = n.select(F.col("k").cast("string").alias("polygon"), "cx", "cy", c).select("polygon", (F.col("cx") + F.col("q.a")).alias("x1"), (F.col("cy") + F.col("q.b")).alias("y1"), (F.col("cx") + F.col("q.c")).alias("x2"), (F.col("cy") + F.col("q.d")).alias("y2"))
    return spatial.danger_region(p, e, {str(k): 2 if k % 2 else 3 for k in range(25)}).select("id", F.col("region").cast("long").alias("region"))


QUERIES["danger_regions"] = danger_regions
ORACLES["danger_regions"] = duck("""with p as (select c_custkey as id, (c_custkey * 37 % 1000) / 20.0 + 0.013 as x, (c_custkey * 53 % 700) / 20.0 + 0.007 as y from customer)
select id, cast(coalesce(max(case when n_nationkey is null then null when n_nationkey % 2 = 1 then 2 else 3 end), 1) as bigint) as region from p left join nation on abs(x - (n_nationkey % 5 * 10 + 5.0)) / 4 + abs(y - (floor(n_nationkey / 5) * 7 + 3.5)) / 3 < 1 group by id""")
