"""Queries: lightning, profiles, neighbourhoods, gusts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import physics as P
from ..operators import grid as G
from ..operators import fields, gusts, lightning, profile
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r4 = lambda c, a=None: (F.floor((F.col(c) if isinstance(c, str) else c) * 1e4 + 0.5) / 1e4).alias(a or c)
R4 = lambda x, a=None: f"floor(({x}) * 1e4 + 0.5) / 1e4 as {a or x}"


def flash_blocks(spark, sf_dir):
    b = lightning.three_hour_blocks(view(spark, sf_dir, "flash10"), step_minutes=60)
    return b.select(F.date_format("block_end", "yyyy-MM-dd HH:mm:ss").alias("block_end"), "cell", r4("density"))


#: The view's ten-minute times are taken by the hour, three to a block, since few of its blocks have all eighteen.
STEPS = """(select block_end, cell, ceil((epoch(ts) - epoch(block_end) + 10800) / 3600) as step, max(rate) as rate from (select timestamp '2024-01-01 00:00:00' + cast(ceil((epoch(ts) - 1704067200) / 10800) as bigint) * interval 3 hour as block_end, * from ({flash10})) group by 1, 2, 3)"""
BLOCKS = "b as (select block_end, cell, case when count(rate) = 3 then sum(greatest(rate, 0) * 60) end as density from " + STEPS + " group by 1, 2)"
QUERIES["flash_blocks"] = flash_blocks
ORACLES["flash_blocks"] = duck("with " + BLOCKS + " select strftime(block_end, '%Y-%m-%d %H:%M:%S') as block_end, cell, " + R4("density") + " from b")


def flash_window_total(spark, sf_dir):
    b = lightning.three_hour_blocks(view(spark, sf_dir, "flash10"), step_minutes=60)
    got = lightning.window_total(b, F.lit("2024-01-05 12:00:00").cast("timestamp"), F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return got.select("cell", r4("total"))


QUERIES["flash_window_total"] = flash_window_total
ORACLES["flash_window_total"] = duck("with " + BLOCKS + " select cell, " + R4("sum(coalesce(greatest(density, 0), 0))", "total") + " from b where block_end > timestamp '2024-01-05 12:00:00' and block_end <= timestamp '2024-01-20 12:00:00' group by cell")


def observation_windows(spark, sf_dir):
    times = view(spark, sf_dir, "flash10")
    days = times.select(F.to_date("ts").alias("d")).distinct().select(F.col("d").cast("string").alias("window_id"), (F.col("d").cast("timestamp") + F.expr("interval 12 hours")).alias("start"), (F.col("d").cast("timestamp") + F.expr("interval 36 hours")).alias("end"))
    return lightning.missing_times(times, days)


QUERIES["observation_windows"] = observation_windows
ORACLES["observation_windows"] = duck("""with t as (select distinct ts from ({flash10})), d as (select distinct cast(ts as date) as d from t), w as (select d, cast(d as timestamp) + interval 12 hour + k.range * interval 10 minute as ts from d, range(1, 145) k)
select cast(d as varchar) as window_id, count(*) as expected, count(t.ts) as present, count(*) = count(t.ts) as complete from w left join t on t.ts = w.ts group by d""")


def archive_readiness(spark, sf_dir):
    b = lightning.three_hour_blocks(view(spark, sf_dir, "flash10"), step_minutes=60).groupBy("block_end").agg(F.count_if(F.col("density") > 0).alias("nonzero"))
    got = lightning.readiness(b)
    return got.select(r4("span_days"), r4("coverage"), "active_blocks", "ready")


QUERIES["archive_readiness"] = archive_readiness
ORACLES["archive_readiness"] = duck("with " + BLOCKS + """, k as (select block_end, count(*) filter (density > 0) as nonzero from b group by 1), a as (select (epoch(max(block_end)) - epoch(min(block_end))) / 86400.0 as span, count(*) as n, count(*) filter (nonzero > 0) as active_blocks from k)
select """ + R4("span", "span_days") + ", " + R4("n / (floor(span * 8) + 1)", "coverage") + ", active_blocks, span >= 21 and n / (floor(span * 8) + 1) >= 0.95 and active_blocks >= 12 as ready from a")


def daily_potential(spark, sf_dir):
    wx = view(spark, sf_dir, "wx")
    h = wx.select(F.concat(F.lit("run"), (F.col("cell") % 7).cast("string")).alias("run"), F.col("hour_no").alias("fhour"), F.when((F.col("cell") % 7 == 3) & (F.col("hour_no") == 6), "v2").otherwise("v3").alias("formula"), "cell", F.when(F.col("rh") < 100, F.col("rh")).alias("potential"))
    wanted = h.select("run").distinct().select("run", F.explode(F.sequence(F.lit(3).cast("long"), F.lit(24).cast("long"), F.lit(3).cast("long"))).alias("fhour"))
    return lightning.daily_potential(h, wanted).select("run", "cell", r4("potential"))


QUERIES["daily_potential"] = daily_potential
ORACLES["daily_potential"] = duck("""with h as (select concat('run', cell % 7) as run, hour_no as fhour, case when cell % 7 = 3 and hour_no = 6 then 'v2' else 'v3' end as formula, cell, case when rh < 100 then rh end as potential from ({wx}) where hour_no between 3 and 24 and hour_no % 3 = 0),
ok as (select run from h group by run having count(distinct fhour) = 8 and count(distinct formula) = 1) select run, cell, """ + R4("max(potential)", "potential") + " from h where run in (select run from ok) group by 1, 2")


def hazard_windows(spark, sf_dir):
    wx = view(spark, sf_dir, "wx")  # runs of 49 hours one after another
    s = wx.select(F.floor((F.col("hour_no") - 1) / 49).alias("run"), ((F.col("hour_no") - 1) % 49).alias("fhour"), "cell", F.col("rh").alias("potential"), (F.col("rh") * 0.6).alias("rh"), F.col("precip_mm").alias("precip"), F.col("wind_kmh").alias("gust"), F.col("temp_c").alias("u"), (F.col("temp_c") * 2).alias("v"))
    hours = s.select("run", "fhour").distinct().filter("fhour % 3 = 0")
    return lightning.hazard_windows(s, hours).select("run", "fhour", "cell", *[r4(c) for c in ("potential", "dry", "gust", "u", "v")])


QUERIES["hazard_windows"] = hazard_windows
ORACLES["hazard_windows"] = duck("""with s as (select cast(floor((hour_no - 1) / 49) as bigint) as run, (hour_no - 1) % 49 as h, cell, rh as potential, rh * 0.6 as rh, precip_mm as precip, wind_kmh as gust, temp_c as u from ({wx})), p as (select distinct run, h as fhour from s where h % 3 = 0),
j as (select fhour, s.* from p join s on s.run = p.run and s.h between case when fhour = 0 then 0 else greatest(fhour - 2, 0) end and fhour), a as (select run, fhour, cell, max(potential) as potential, max(potential * least(greatest((55 - rh) / 25, 0), 1)) as d, arg_max(precip, h) as pr, max(gust) as gust from j group by 1, 2, 3),
w as (select run, fhour, cell, u from j qualify row_number() over (partition by run, fhour, cell order by gust desc, h) = 1)
select a.run, a.fhour, a.cell, """ + R4("potential") + ", " + R4("case when potential >= 25 then d * (1 - least(greatest((pr - 0.25) / 2.25, 0), 1)) else 0 end", "dry") + ", " + R4("gust") + ", " + R4("u") + ", " + R4("u * 2", "v") + " from a join w on w.run = a.run and w.fhour = a.fhour and w.cell = a.cell")


def column_water(spark, sf_dir):
    p = view(spark, sf_dir, "profile")
    p = p.select("cell", (F.col("p_hpa") * 100).alias("p_pa"), P.specific_humidity(F.col("temp"), F.col("rh"), F.col("p_hpa")).alias("q"), F.when(F.col("cell") % 41 != 0, F.col("surface_p") * 100).alias("surface_pa"))
    return profile.column_water(p, ["cell"], "surface_pa").select("cell", r4("ipw"))


QUERIES["column_water"] = column_water
ORACLES["column_water"] = duck("""with p as (select cell, p_hpa * 100 as p, case when cell % 41 <> 0 then surface_p * 100 end as s, least(greatest(rh, 0), 100) * 0.01 * 6.112 * exp(17.67 * (temp - 273.15) / (temp - 273.15 + 243.5)) as e, 0.622 * e / greatest(p_hpa - e, 1) as r, case when rh is not null then greatest(r / (1 + r), 0) end as q from ({profile})),
k as (select *, lag(q) over w as q0, lag(p) over w as p0 from p window w as (partition by cell order by p)), a as (select cell, max(s) as s, sum(case when p <= s then 0.5 * (q + q0) * (p - p0) / 9.80665 end) as t, max(case when p <= s then p end) as lp from k group by cell)
select a.cell, """ + R4("case when a.s is not null then greatest(coalesce(t, 0) + coalesce(l.q * greatest(a.s - a.lp, 0) / 9.80665, 0), 0) end", "ipw") + " from a left join k l on l.cell = a.cell and l.p = a.lp")


def charging_layers(spark, sf_dir):
    p = view(spark, sf_dir, "profile").withColumn("temp_c", F.col("temp") - 290)
    return profile.charging(p, ["cell"], "surface_p").select("cell", *[r4(c) for c in ("charge_factor", "charge_rh", "mid_rh")])


QUERIES["charging_layers"] = charging_layers
ORACLES["charging_layers"] = duck("""with p as (select cell, p_hpa as p, temp - 290 as t, rh, surface_p as s, lag(p_hpa) over w as d, lead(p_hpa) over w as u from ({profile}) window w as (partition by cell order by p_hpa desc)),
e as (select *, coalesce((d + p) / 2, p + (p - u) / 2) as hi, coalesce((p + u) / 2, p - (d - p) / 2) as lo, case when hi is not null and lo is not null then least(greatest(least(s, hi) - lo, 0), hi - lo) end as dep, case when rh is not null and dep > 0 then dep else 0 end as g from p),
a as (select cell, sum(case when t between -20 and 0 then exp(-0.5 * pow((t + 15) / 5.5, 2)) * g else 0 end) as w, sum(case when t between -20 and 0 then coalesce(rh, 0) * exp(-0.5 * pow((t + 15) / 5.5, 2)) * g else 0 end) / nullif(w, 0) as c, sum(case when t between -30 and -5 then g else 0 end) as mw, sum(case when t between -30 and -5 then coalesce(rh, 0) * g else 0 end) / nullif(mw, 0) as m from e group by cell)
select cell, """ + R4("case when c is not null then sqrt(least(greatest((c - 45) / 35, 0), 1) * least(greatest((w - 35) / 115, 0), 1)) end", "charge_factor") + ", " + R4("case when c is not null then least(greatest(c, 0), 100) end", "charge_rh") + ", " + R4("case when m is not null then least(greatest(m, 0), 100) end", "mid_rh") + " from a")


def layer_humidity(spark, sf_dir):
    p = view(spark, sf_dir, "profile")
    dry = p.groupBy("cell").agg(F.count_if(F.col("rh") < 50).alias("n_dry"))
    return fields.layer_mean(p, ["cell"], "rh").join(dry, "cell").select("cell", r4("mean", "mean_rh"), "n_dry")


QUERIES["layer_humidity"] = layer_humidity
ORACLES["layer_humidity"] = duck("select cell, " + R4("avg(case when surface_p >= p_hpa then rh end)", "mean_rh") + ", count(*) filter (rh < 50) as n_dry from ({profile}) group by cell")


def ridge_wind(spark, sf_dir):
    """Profiles interpolated to a height of each cell."""
    p = view(spark, sf_dir, "profile").select("cell", "level", "height", F.col("rh").alias("value"), (200.0 + F.col("cell") % 700).alias("target"))
    return profile.at_height(p, ["cell"], "target").select("cell", r4("value"))


QUERIES["ridge_wind"] = ridge_wind
ORACLES["ridge_wind"] = duck("""with recursive p as (select cell, height, rh as v, 200.0 + cell % 700 as t, row_number() over (partition by cell order by level) as k from ({profile})),
f as (select cell, k, height as h, v, cast(null as double) as r, t from p where k = 1 union all
    select p.cell, p.k, case when p.height is not null and p.v is not null and p.height > f.h then p.height else f.h end, case when p.height is not null and p.v is not null and p.height > f.h then p.v else f.v end,
        case when f.r is null and p.height - f.h > 1 and f.v is not null and p.v is not null and p.t >= f.h and p.t <= p.height then f.v + (p.t - f.h) / (p.height - f.h) * (p.v - f.v) else f.r end, f.t from f join p on p.cell = f.cell and p.k = f.k + 1)
select cell, """ + R4("coalesce(r, case when t >= h then v end)", "value") + " from f qualify row_number() over (partition by cell order by k desc) = 1")


def inversions(spark, sf_dir):
    return profile.inversions(view(spark, sf_dir, "profile"), ["cell"], "surface_t").select("cell", (F.floor(F.col("lapse") * 1e6 + 0.5) / 1e6).alias("lapse"), "inverted")


QUERIES["inversions"] = inversions
ORACLES["inversions"] = duck("""with recursive p as (select cell, height as z, temp as t, surface_t as s, row_number() over (partition by cell order by level) as k from ({profile})),
f as (select cell, cast(0 as bigint) as k, 2.0::double as h, max(s) as t, 0.0::double as dep, 0.0::double as best, cast(null as double) as top, cast(null as double) as tt, max(s) as s from p group by cell union all
    select cell, k, case when g then z else h end, case when g then t else t0 end, dep2, case when b then dep2 else best end, case when b then z else top end, case when b then t else tt end, s from (
        select p.cell, p.k, p.z, p.t, f.h, f.t as t0, f.best, f.top, f.tt, f.s, p.z - f.h >= 20 and p.z <= 3000 as g, case when g and p.t > f.t then f.dep + p.z - f.h else 0 end as dep2, g and p.t > f.t and dep2 > f.best as b from f join p on p.cell = f.cell and p.k = f.k + 1))
select cell, floor(case when best >= 100 and top > 2 then (tt - s) / (top - 2) end * 1e6 + 0.5) / 1e6 as lapse, best >= 100 as inverted from f qualify row_number() over (partition by cell order by k desc) = 1""")


def sounding_check(spark, sf_dir):
    return profile.sounding_ok(view(spark, sf_dir, "profile"), ["cell"], "surface_p")


QUERIES["sounding_check"] = sounding_check
ORACLES["sounding_check"] = duck("""with k as (select cell, p_hpa as p, lag(p_hpa) over (partition by cell order by p_hpa desc) as b from ({profile}) where p_hpa <= surface_p and surface_p >= 705)
select cell, count(*) as n_levels from k where b is null or b - p >= 0.05 group by cell having count(*) >= 6 and max(p) >= 700 and min(p) <= 500""")


def _one(spark, sf_dir):
    return view(spark, sf_dir, "grid").withColumn("f", F.lit(1))


def smooth_sql(weights: list[float]) -> str:
    r = len(weights) - 1
    one = lambda col, part, along: " + ".join(f"{weights[abs(k)]!r} * coalesce({'lag' if k < 0 else 'lead'}({col}, {abs(k)}) over (partition by {part} order by {along}), {'first_value' if k < 0 else 'last_value'}({col}) over (partition by {part} order by {along} rows between unbounded preceding and unbounded following))" if k else f"{weights[0]!r} * {col}" for k in range(-r, r + 1))
    return f"""a as (select iy, ix, coalesce(v, 0) as x, cast(v is not null as int)::double as w from ({{grid}})), b as (select iy, ix, {one('x', 'ix', 'iy')} as x, {one('w', 'ix', 'iy')} as w from a),
    c as (select iy, ix, {one('x', 'iy', 'ix')} as x, {one('w', 'iy', 'ix')} as w from b)"""


def _kernel(sigma: float) -> list[float]:
    import math

    r = int(4 * sigma + 0.5)
    k = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(r + 1)]
    return [x / (k[0] + 2 * sum(k[1:])) for x in k]


QUERIES["grid_gaussian"] = lambda spark, sf_dir: G.gaussian(_one(spark, sf_dir), ["f"], "v", 0.7).select("iy", "ix", r4("v"))
ORACLES["grid_gaussian"] = duck("with " + smooth_sql(_kernel(0.7)) + " select iy, ix, " + R4("case when w > 1e-12 then x / w end", "v") + " from c")
QUERIES["grid_box_mean"] = lambda spark, sf_dir: G.box_mean(_one(spark, sf_dir), ["f"], "v", 5).select("iy", "ix", (F.floor(F.col("v") * 1e6 + 0.5) / 1e6).alias("v"))
ORACLES["grid_box_mean"] = duck("with " + smooth_sql([0.2] * 3) + " select iy, ix, floor(case when w > 1e-12 then x / w end * 1e6 + 0.5) / 1e6 as v" + " from c")
QUERIES["grid_moving_max"] = lambda spark, sf_dir: G.moving_max(_one(spark, sf_dir), ["f"], "v", 7).select("iy", "ix", "v")
ORACLES["grid_moving_max"] = duck("with a as (select iy, ix, max(v) over (partition by ix order by iy rows between 3 preceding and 3 following) as v from ({grid})) select iy, ix, max(v) over (partition by iy order by ix rows between 3 preceding and 3 following) as v from a")
QUERIES["display_smoothing"] = lambda spark, sf_dir: G.gaussian(_one(spark, sf_dir).withColumn("known", F.col("v").isNotNull()), ["f"], "v", 1.1).select("iy", "ix", r4(F.when(F.col("known"), F.col("v")), "v"))
ORACLES["display_smoothing"] = duck("with " + smooth_sql(_kernel(1.1)) + " select c.iy, c.ix, " + R4("case when g.v is not null then c.x / c.w end", "v") + " from c join ({grid}) g on g.iy = c.iy and g.ix = c.ix")

GRAD = lambda v, part, along, s: f"case when lag({v}) over (partition by {part} order by {along}) is null then (lead({v}) over (partition by {part} order by {along}) - {v}) / {s} when lead({v}) over (partition by {part} order by {along}) is null then ({v} - lag({v}) over (partition by {part} order by {along})) / {s} else (lead({v}) over (partition by {part} order by {along}) - lag({v}) over (partition by {part} order by {along})) / {2 * s} end"
PEAKS = f"""g1 as (select *, {GRAD('terrain', 'ix', 'iy', 2500.0)} as gy, {GRAD('terrain', 'iy', 'ix', 2500.0)} as gx from ({{grid}})), g2 as (select *, {GRAD('gy', 'ix', 'iy', 2500.0)} as dyy, {GRAD('gx', 'iy', 'ix', 2500.0)} as dxx, {GRAD('gx', 'ix', 'iy', 2500.0)} as dxy from g1), g as (select *, coalesce(dxx * dyy - dxy * dxy > 0 and dxx < 0 and dyy < 0, false) as is_peak from g2)"""
QUERIES["terrain_peaks"] = lambda spark, sf_dir: G.peaks(_one(spark, sf_dir), ["f"], "terrain", 2500.0).select("iy", "ix", r4("slope_x"), r4("slope_y"), "is_peak")
ORACLES["terrain_peaks"] = duck("with " + PEAKS + " select iy, ix, " + R4("gx", "slope_x") + ", " + R4("gy", "slope_y") + ", is_peak from g")


def downslope_gusts(spark, sf_dir):
    s = F.col("size")
    g = _one(spark, sf_dir).withColumns({"regular": 20.0 + s, "strongest": 30.0 + s * 1.5, "u": F.when(s % 2 == 0, 8.0).otherwise(-6.0), "v": F.when(s % 3 == 0, 5.0).otherwise(-7.0), "lapse": F.when(s % 7 != 0, -0.004 - s / 20000.0), "inverted": s % 3 != 0}).drop("v_")
    g = g.drop("v").withColumn("v", F.when(s % 3 == 0, 5.0).otherwise(-7.0))
    got = G.downslope_gust(g, ["f"], 2500.0)
    return got.select("iy", "ix", r4("gust"), "mask")


QUERIES["downslope_gusts"] = downslope_gusts
ORACLES["downslope_gusts"] = duck("with " + PEAKS + ", " + smooth_sql([1 / 9] * 5).replace("coalesce(v, 0)", "coalesce(case when size % 7 <> 0 then -0.004 - size / 20000.0 end, 0)").replace("v is not null", "size % 7 <> 0") + """,
m1 as (select *, max(cast(is_peak and size % 3 <> 0 as int)) over (partition by ix order by iy rows between 4 preceding and 4 following) as o from g), m as (select *, max(o) over (partition by iy order by ix rows between 4 preceding and 4 following) as o2 from m1),
z as (select m.iy, m.ix, 20.0 + size as reg, 30.0 + size * 1.5 as st, coalesce(case when size % 2 = 0 then 8.0 else -6.0 end * gx + case when size % 3 = 0 then 5.0 else -7.0 end * gy < -0.1 and sqrt(gx * gx + gy * gy) >= 0.01 and c.x / c.w >= -0.006 and o2 = 1, false) as mask from m join c on c.iy = m.iy and c.ix = m.ix)
select iy, ix, """ + R4("case when mask then greatest(reg, case when st / greatest(reg, 1) < 1.5 then st else 0.5 * (reg + st) end) else reg end", "gust") + ", mask from z")

QUERIES["grid_fill_nearest"] = lambda spark, sf_dir: G.fill_nearest(_one(spark, sf_dir), ["f"], "v").select("iy", "ix", "v")
ORACLES["grid_fill_nearest"] = duck("""with g as ({grid}), k as (select iy as y, ix as x, v as w from g where v is not null), n as (select iy, ix, w from g join k on g.v is null qualify row_number() over (partition by iy, ix order by (iy - y) * (iy - y) + (ix - x) * (ix - x), y, x) = 1)
select g.iy, g.ix, coalesce(g.v, n.w) as v from g left join n on n.iy = g.iy and n.ix = g.ix""")
QUERIES["grid_crop"] = lambda spark, sf_dir: G.crop(view(spark, sf_dir, "grid"), (F.col("size") == 7) & (F.col("ix") < 30), 2).select("iy", "ix", "v")
ORACLES["grid_crop"] = duck("with g as ({grid}), b as (select min(iy) - 2 as a, max(iy) + 2 as b, min(ix) - 2 as c, max(ix) + 2 as d from g where size = 7 and ix < 30) select iy, ix, v from g, b where iy between a and b.b and ix between c and d")
QUERIES["grid_thin"] = lambda spark, sf_dir: G.thin(view(spark, sf_dir, "grid"), 4).select("iy", "ix", "v")
ORACLES["grid_thin"] = duck("with g as ({grid}), b as (select max(iy) as y, max(ix) as x from g) select iy, ix, v from g, b where (iy % 4 = 0 or iy = y) and (ix % 4 = 0 or ix = x)")


def grid_bilinear(spark, sf_dir):
    pts = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 37 % 380) / 10.0).alias("fy"), ((F.col("c_custkey") * 53 % 480) / 10.0).alias("fx"))
    g = view(spark, sf_dir, "grid").select("iy", "ix", F.col("v").alias("value"))
    strict, loose = G.bilinear(pts, g), G.bilinear(pts, g, 0.2).withColumnRenamed("value", "present")
    return strict.join(loose, "id").select("id", r4("value"), r4("present"))


QUERIES["grid_bilinear"] = grid_bilinear
ORACLES["grid_bilinear"] = duck("""with p as (select c_custkey as id, (c_custkey * 37 % 380) / 10.0::double as fy, (c_custkey * 53 % 480) / 10.0::double as fx from customer), c as (select id, floor(fy) + a.range as iy, floor(fx) + b.range as ix, (case when a.range = 1 then fy - floor(fy) else 1 - (fy - floor(fy)) end) * (case when b.range = 1 then fx - floor(fx) else 1 - (fx - floor(fx)) end) as w from p, range(2) a, range(2) b),
j as (select id, sum(w * v) as s, sum(case when v is not null then w end) as k, bool_and(v is not null) as ok from c left join ({grid}) g on g.iy = c.iy and g.ix = c.ix where w > 0 group by id) select id, """ + R4("case when ok then s end", "value") + ", " + R4("case when k > 0.2 then s / k end", "present") + " from j")


def grid_regrid(spark, sf_dir):
    pts = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 131 * 1000.0 - 2000).alias("x"), (F.col("c_custkey") % 107 * 1100.0).alias("y"))
    g = view(spark, sf_dir, "grid").select(F.col("iy").alias("row"), F.col("ix").alias("col"), F.col("v").alias("value"))
    return G.regrid_nearest(pts, g, 300.0, 100.0, 2500.0, 2600.0).select("id", "value")


QUERIES["grid_regrid"] = grid_regrid
ORACLES["grid_regrid"] = duck("with p as (select c_custkey as id, cast(round_even((c_custkey % 107 * 1100.0 - 100) / 2600, 0) as bigint) as r, cast(round_even((c_custkey % 131 * 1000.0 - 2300) / 2500, 0) as bigint) as c from customer) select id, g.v as value from p left join ({grid}) g on g.iy = p.r and g.ix = p.c")


def _floor(x):
    """The floor as a double, since Spark's is a long and ends at 2^63."""
    return F.rint(x) - (F.rint(x) > x).cast("double")


def vorticity(spark, sf_dir):
    """Absolute vorticity (1e-5/s) of a wind made of the grid's fields. Rows at a pole have values whose floor is beyond 64 bits."""
    g = view(spark, sf_dir, "grid").withColumns({"f": F.lit(1), "lat": 40.0 + F.col("iy") * 0.25, "lon": -140.0 + F.col("ix") * 0.25, "u": F.col("size") * 1.0, "w": F.col("terrain") / 100.0})
    return fields.absolute_vorticity(g, ["f"], "u", "w").select("iy", "ix", (_floor(F.col("absv") * 1e5 * 1e4 + 0.5) / 1e4).alias("absv"))


QUERIES["vorticity"] = vorticity
ORACLES["vorticity"] = duck("""with g as (select iy, ix, 40.0::double + iy * 0.25 as lat, -140.0::double + ix * 0.25 as lon, size * 1.0 as u, terrain / 100 as w from ({grid})), d as (select *, (lead(w) over r - lag(w) over r) / (6371229.0 * cos(radians(lat)) * radians(lead(lon) over r - lag(lon) over r)) as dv, (lead(u) over c - lag(u) over c) / (6371229.0 * radians(lead(lat) over c - lag(lat) over c)) as du from g window r as (partition by iy order by ix), c as (partition by ix order by iy))
select iy, ix, """ + R4("(coalesce(dv, lead(dv) over r, lag(dv) over r) - coalesce(du, lead(du) over c, lag(du) over c) + 2 * 7.292e-5::double * sin(radians(lat))) * 1e5", "absv") + " from d window r as (partition by iy order by ix), c as (partition by ix order by iy)")


def convective_gusts(spark, sf_dir):
    s = view(spark, sf_dir, "wx")
    t, h, w, p = (F.col(c) for c in ("temp_c", "rh", "wind_kmh", "precip_mm"))
    c = {"regular": F.when(F.col("hour_no") % 11 != 0, w), "dcape": t * 40, "li": 3 - h / 12, "cape": h * 15, "pbl": t * 60, "w850": w / 2, "w700": w / 1.5, "prate": p, "omega700": -t / 4, "temp700": t + 260}
    g = P.convective_gust(c)
    return s.select("cell", "hour_no", *[r4(v, k) for k, v in g.items()], P.gust_category(g["gust"]).alias("category"), P.rh_category(h).alias("moisture"), P.precip_category(p).alias("rain"))


QUERIES["convective_gusts"] = convective_gusts
_rmp = lambda x, a, b: f"least(greatest(({x} - {a}) / ({b} - {a})::double, 0), 1)"
ORACLES["convective_gusts"] = duck(f"""with a as (select cell, hour_no, rh, precip_mm as p, case when hour_no % 11 <> 0 then wind_kmh end as reg, temp_c * 40 as dc, 3 - rh / 12 as li, {_rmp('temp_c * 60', 300, 1800)} as pb, greatest(reg / 3.6, (0.70 + 0.15 * pb) * wind_kmh / 2, (0.45 + 0.20 * pb) * wind_kmh / 1.5) as mo, 0.35 * sqrt(greatest(2 * dc, 0)) as dn,
    case when reg is not null then 3.6 * least(greatest(sqrt(mo * mo + dn * dn), reg / 3.6), 55) end as potential, temp_c / 4 / (70000 / (287.05 * (temp_c + 260)) * 9.80665) as up,
    least(greatest({_rmp('1 - li', 0, 5)} * (0.85 + 0.15 * {_rmp('rh * 15', 50, 800)}) * greatest({_rmp('up', 0.15, 0.75)}, {_rmp('precip_mm', 0.25, 2.5)}) * {_rmp('dc', 150, 750)}, 0), 1) as trigger, reg + trigger * greatest(potential - reg, 0) as g0, case when reg is not null then g0 end as gust from ({{wx}}))
select cell, hour_no, {R4('gust')}, {R4('potential')}, {R4('trigger')}, case when gust < 40 then '<40' when gust < 60 then '40-60' when gust < 80 then '60-80' when gust >= 80 then '>=80' end as category,
    case when rh < 20 then 'very dry' when rh <= 30 then 'dry' when rh > 80 then 'very moist' when rh >= 60 then 'moist' end as moisture, case when p >= 10 then 'heavy' when p >= 2.5 then 'moderate' end as rain from a""")


def lightning_potential(spark, sf_dir):
    s = view(spark, sf_dir, "wx")
    t, h, p = F.col("temp_c"), F.col("rh"), F.col("precip_mm")
    v = lightning.potential({"li": 4 - h / 10, "cape": h * 20}, P.ramp(t, 5.0, 30.0), h, p, p / 3, t / 600)
    return s.select("cell", "hour_no", r4(v, "potential"))


QUERIES["lightning_potential"] = lightning_potential
ORACLES["lightning_potential"] = duck(f"""with a as (select cell, hour_no, {_rmp('temp_c', 5, 30)} as cf, least(greatest((1 - (4 - rh / 10)) / 6.0::double, 0), 1) as lf, {_rmp('rh * 20', 75, 800)} as kf, lf * (0.8 + 0.2 * kf) as i0, least(greatest(i0, 0), 1) as ins, least(greatest(cf * (0.85 + 0.15 * {_rmp('rh', 35, 75)}), 0), 1) as mo,
    greatest({_rmp('precip_mm', 0.05, 1.5)}, {_rmp('precip_mm / 3', 0.02, 0.8)}) as sg, greatest(sg, {_rmp('temp_c / 600', 0.005, 0.05)} * cf) as tr from ({{wx}})) select cell, hour_no, {R4('case when (lf < 0.05 and kf < 0.08) or mo < 0.08 then 0 else 100 * ins * mo * sqrt(least(greatest(tr, 0), 1)) end', 'potential')} from a""")


def whole_gusts(spark, sf_dir):
    """Two hours of the grid with profiles of five levels and a convective gust on every fourth row and column: the whole chain."""
    s, k = F.col("size"), F.col("k")
    g = view(spark, sf_dir, "grid").drop("v").withColumn("fhour", F.explode(F.array(F.lit(0), F.lit(3))))
    u, v = F.when(s % 2 == 0, 8.0).otherwise(-6.0), F.when(s % 3 == 0, 5.0).otherwise(-7.0)
    cells = g.select("fhour", "iy", "ix", "terrain", F.when(s % 11 != 0, 20.0 + s).alias("regular"), (30.0 + s * 1.5).alias("strongest"), F.lit(288.0).alias("surface_t"), (u / 2).alias("u10"), (v / 2).alias("v10"))
    many = g.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))))
    levels = many.select("fhour", "iy", "ix", k.alias("level"), (F.col("terrain") + 120.0 * k + s).alias("height"), (288.0 + F.when((s % 3 != 0) & (k <= 3), 1.5 * k).otherwise(-1.0 * k)).alias("temp"), (u * (1 + 0.2 * k)).alias("u"), (v * (1 + 0.1 * k)).alias("v"))
    coarse = G.thin(g, 4).select("fhour", "iy", "ix", F.when(s % 5 != 0, 20.0 + s + s / 3 - 5).alias("convective"))
    got = gusts.whole(cells, levels, coarse, ["fhour"], 2500.0, 4)
    shares = fields.branch_shares(got.filter("fhour <> 0"), ["fhour"])  # no branches are made at hour 0; a row an hour
    return got.join(F.broadcast(shares), "fhour", "left").select("fhour", "iy", "ix", r4("downslope"), r4("increment"), r4("gust"), r4("downslope_share"), r4("triggered_share"))


QUERIES["whole_gusts"] = whole_gusts
ORACLES["whole_gusts"] = duck("with recursive " + PEAKS + """, s as (select iy, ix, size, terrain, case when size % 11 <> 0 then 20.0 + size end as reg, 30.0 + size * 1.5 as st, case when size % 2 = 0 then 8.0 else -6.0 end as u, case when size % 3 = 0 then 5.0 else -7.0 end as v, gx, gy, is_peak from g),
r1 as (select *, max(terrain) over (partition by ix order by iy rows between 4 preceding and 4 following) as m from s), r as (select *, greatest(10.0, max(m) over (partition by iy order by ix rows between 4 preceding and 4 following) - terrain) as t from r1),
p as (select r.*, k.range as k, case when k.range = 0 then 10.0 else 120.0 * k.range + size end as z, case when k.range = 0 then u / 2 else u * (1 + 0.2::double * k.range) end as uk, case when k.range = 0 then v / 2 else v * (1 + 0.1::double * k.range) end as vk, 288.0 + case when size % 3 <> 0 and k.range <= 3 then 1.5 * k.range else -1.0 * k.range end as tk from r, range(6) k),
q as (select *, lag(z) over w as z0, lag(uk) over w as u0, lag(vk) over w as v0, max(z) over (partition by iy, ix) as zt from p window w as (partition by iy, ix order by k)),
wind as (select iy, ix, max(u0 + (t - z0) / (z - z0) * (uk - u0)) filter (t >= z0 and t <= z) as ur, max(v0 + (t - z0) / (z - z0) * (vk - v0)) filter (t >= z0 and t <= z) as vr, max(uk) filter (k = 5) as ut, max(vk) filter (k = 5) as vt from q group by 1, 2),
f as (select iy, ix, cast(0 as bigint) as k, 2.0::double as h, 288.0::double as t, 0.0::double as dep, 0.0::double as best, cast(null as double) as top, cast(null as double) as tt from s union all
    select iy, ix, k, case when ok then z else h end, case when ok then tk else t0 end, dep2, case when b then dep2 else best end, case when b then z else top end, case when b then tk else tt end from (
        select p.iy, p.ix, p.k, p.z, p.tk, f.h, f.t as t0, f.best, f.top, f.tt, p.z - f.h >= 20 and p.z <= 3000 as ok, case when ok and p.tk > f.t then f.dep + p.z - f.h else 0 end as dep2, ok and p.tk > f.t and dep2 > f.best as b from f join p on p.iy = f.iy and p.ix = f.ix and p.k = f.k + 1)),
i as (select iy, ix, case when best >= 100 and top > 2 then (tt - 288) / (top - 2) end as lapse, best >= 100 as inverted from f where k = 5),
""" + smooth_sql([1 / 9] * 5).replace("({grid})", "i").replace("coalesce(v, 0)", "coalesce(lapse, 0)").replace("v is not null", "lapse is not null") + """,
m1 as (select s.iy, s.ix, max(cast(is_peak and inverted as int)) over (partition by s.ix order by s.iy rows between 4 preceding and 4 following) as o from s join i on i.iy = s.iy and i.ix = s.ix), m as (select iy, ix, max(o) over (partition by iy order by ix rows between 4 preceding and 4 following) as o2 from m1),
d as (select s.*, coalesce(coalesce(ur, ut) * gx + coalesce(vr, vt) * gy < -0.1 and sqrt(gx * gx + gy * gy) >= 0.01 and case when c.w > 1e-12 then c.x / c.w end >= -0.006 and o2 = 1, false) as mask, case when mask then greatest(reg, case when st / greatest(reg, 1) < 1.5 then st else 0.5 * (reg + st) end) else reg end as down
    from s join wind on wind.iy = s.iy and wind.ix = s.ix join c on c.iy = s.iy and c.ix = s.ix join m on m.iy = s.iy and m.ix = s.ix),
e as (select max(iy) as y1, max(ix) as x1 from s), th as (select iy, ix, greatest(case when size % 5 <> 0 then 20.0 + size + size / 3 - 5 end - reg, case when size % 5 <> 0 and reg is not null then 0 end) as inc from s, e where (iy % 4 = 0 or iy = y1) and (ix % 4 = 0 or ix = x1) and size % 5 <> 0 and reg is not null),
y as (select s.iy, s.ix, cast(floor(s.iy / 4.0) as bigint) * 4 as a0, least(a0 + 4, y1) as a1, case when a1 > a0 then (s.iy - a0) / (a1 - a0) else 0 end as wa, cast(floor(s.ix / 4.0) as bigint) * 4 as b0, least(b0 + 4, x1) as b1, case when b1 > b0 then (s.ix - b0) / (b1 - b0) else 0 end as wb from s, e),
cw as (select iy, ix, a0 as cy, b0 as cx, (1 - wa) * (1 - wb) as w from y union all select iy, ix, a0, b1, (1 - wa) * wb from y union all select iy, ix, a1, b0, wa * (1 - wb) from y union all select iy, ix, a1, b1, wa * wb from y),
up as (select cw.iy, cw.ix, sum(w * inc) / sum(w) as inc from cw join th on th.iy = cw.cy and th.ix = cw.cx where w > 0 group by 1, 2 having sum(w) > 0.2),
o as (select 3 as fhour, d.iy, d.ix, reg, down, inc, greatest(reg, down) as syn, case when reg is not null then reg + greatest(coalesce(inc, 0), 0) end as tri from d left join up on up.iy = d.iy and up.ix = d.ix),
n as (select 100.0 * count(*) filter (down > reg + 5) / greatest(1, count(reg)) as ds, 100.0 * count(*) filter (tri > syn + 5) / greatest(1, count(reg)) as ts from o)
select cast(0 as int) as fhour, iy, ix, cast(null as double) as downslope, cast(null as double) as increment, """ + R4("reg", "gust") + ", cast(null as double) as downslope_share, cast(null as double) as triggered_share from s union all select fhour, iy, ix, " + ", ".join((R4("down", "downslope"), R4("inc", "increment"), R4("greatest(syn, tri)", "gust"), R4("ds", "downslope_share"), R4("ts", "triggered_share"))) + " from o, n")
