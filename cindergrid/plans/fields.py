"""Queries: fields of one hour made from others, daily values."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import physics as P
from ..operators import daily, fields, lightning
from ..operators import grid as G
from .standins import duck, view
from .weather import R4, _kernel, r4, smooth_sql

QUERIES, ORACLES = {}, {}
Q_SQL = "least(greatest(rh, 0), 100) * 0.01 * 6.112 * exp(17.67 * (temp - 273.15) / (temp - 273.15 + 243.5)) as e, 0.622 * e / greatest(p_hpa - e, 1) as r, case when rh is not null then r / (1 + r) end as q"


def _gusts(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").withColumns({"fhour": F.col("hour_no") - 1, "regular": F.when(F.col("hour_no") % 11 != 0, F.col("wind_kmh")), "increment": F.col("temp_c") - 9})
    return fields.all_cause_gust(wx.withColumn("downslope", F.when(F.col("cell") % 3 == 0, F.col("wind_kmh") * 1.2)))


GUSTS = "g as (select cell, hour_no - 1 as fhour, case when hour_no % 11 <> 0 then wind_kmh end as regular, case when cell % 3 = 0 then wind_kmh * 1.2 end as downslope, temp_c - 9 as inc, greatest(regular, downslope) as synoptic, case when regular is not null then regular + greatest(inc, 0) end as triggered from ({wx}))"
QUERIES["all_cause_gusts"] = lambda spark, sf_dir: _gusts(spark, sf_dir).select("cell", "fhour", r4("synoptic"), r4("triggered"), r4("gust"))
ORACLES["all_cause_gusts"] = duck("with " + GUSTS + " select cell, fhour, " + ", ".join((R4("synoptic"), R4("triggered"), R4("case when fhour = 0 then regular else greatest(synoptic, triggered) end", "gust"))) + " from g")
QUERIES["gust_branch_shares"] = lambda spark, sf_dir: fields.branch_shares(_gusts(spark, sf_dir), ["fhour"]).select("fhour", r4("downslope_share"), r4("triggered_share"))
ORACLES["gust_branch_shares"] = duck("with " + GUSTS + " select fhour, " + R4("100.0 * count(*) filter (downslope > regular + 5) / greatest(1, count(regular))", "downslope_share") + ", " + R4("100.0 * count(*) filter (triggered > synoptic + 5) / greatest(1, count(regular))", "triggered_share") + " from g group by 1")


def column_transport(spark, sf_dir):
    p = view(spark, sf_dir, "profile").select("cell", "p_hpa", P.specific_humidity(F.col("temp"), F.col("rh"), F.col("p_hpa")).alias("q"), (F.col("temp") - 270).alias("u"), (F.col("level") * 3.0).alias("v"), (10.0 + F.col("cell") % 30).alias("total"))
    t = fields.column_transport(p, ["cell"], "total").withColumn("w", P.unit_vector(F.col("transport_u"), F.col("transport_v")))
    return t.select("cell", r4("water"), r4("transport_u"), r4("transport_v"), r4(F.col("w.u"), "unit_u"), r4(F.col("w.v"), "unit_v"), fields.transport_band(F.col("w.speed")).alias("band"))


QUERIES["column_transport"] = column_transport
ORACLES["column_transport"] = duck(f"""with p as (select cell, p_hpa, temp - 270 as u, level * 3.0::double as v, 10.0::double + cell % 30 as total, {Q_SQL} from ({{profile}})), l as (select *, (p_hpa - lead(p_hpa) over w) * 100 / 9.80665 as d, 0.5 * (q + lead(q) over w) * d as lq, 0.5 * (q * u + lead(q * u) over w) * d as lu, 0.5 * (q * v + lead(q * v) over w) * d as lv from p window w as (partition by cell order by p_hpa desc)),
a as (select cell, case when count(q) = count(*) then coalesce(sum(lq), 0) end as w, case when w > 0.1 then max(total) / w end as s, case when count(q) = count(*) then coalesce(sum(lu), 0) end * s as tu, case when count(q) = count(*) then coalesce(sum(lv), 0) end * s as tv, sqrt(tu * tu + tv * tv) as m from l group by cell)
select cell, {R4('w', 'water')}, {R4('tu', 'transport_u')}, {R4('tv', 'transport_v')}, {R4('case when m > 0 then tu / m end', 'unit_u')}, {R4('case when m > 0 then tv / m end', 'unit_v')}, case when m < 250 then '<250' when m < 500 then '250-499' when m < 750 then '500-749' when m < 1000 then '750-999' when m >= 1000 then '1000+' end as band from a""")


def thinned_hazards(spark, sf_dir):
    """Cells of a grid thinned to 12 km with their class of rain, and whether dry lightning is flagged on every third one."""
    g = view(spark, sf_dir, "grid").withColumns({"precip": F.col("size") / 3.0, "dry": F.col("v") / 100})
    stride = 4
    wet = G.thin(g.withColumn("stride", G.stride_for(fields.PRECIP_GRID_KM, 2.8)).filter(F.col("stride") == stride), stride, keep_last=False)
    rain = wet.select("iy", "ix", P.precip_category(F.col("precip")).alias("class")).filter("class is not null")
    return rain.unionByName(G.thin(g, 3, keep_last=False).filter(F.col("dry") >= fields.DRY_FLAG).select("iy", "ix", F.lit("dry lightning").alias("class")))


QUERIES["thinned_hazards"] = thinned_hazards
ORACLES["thinned_hazards"] = duck("""with g as ({grid}) select iy, ix, case when size / 3.0::double >= 10 then 'heavy' else 'moderate' end as class from g where iy % 4 = 0 and ix % 4 = 0 and size / 3.0::double >= 2.5
union all select iy, ix, 'dry lightning' as class from g where iy % 3 = 0 and ix % 3 = 0 and v / 100 >= 15""")


def gust_arrows(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").withColumns({"u": F.when(F.col("hour_no") % 7 == 0, 0.0).otherwise(F.col("temp_c") - 12), "v": F.when(F.col("hour_no") % 7 == 0, 0.04).otherwise(F.col("rh") - 40)})
    w = wx.withColumn("w", P.unit_vector(F.col("u"), F.col("v"), 0.05)).filter("w.u is not null")
    return w.select("cell", "hour_no", r4(F.col("w.u"), "unit_u"), r4(F.col("w.v"), "unit_v"), P.gust_category(F.col("wind_kmh")).alias("category"))


QUERIES["gust_arrows"] = gust_arrows
ORACLES["gust_arrows"] = duck(f"""with w as (select *, temp_c - 12 as u, rh - 40 as v, sqrt(u * u + v * v) as s from ({{wx}}) where hour_no % 7 <> 0) select cell, hour_no, {R4('u / s', 'unit_u')}, {R4('v / s', 'unit_v')},
case when wind_kmh < 40 then '<40' when wind_kmh < 60 then '40-60' when wind_kmh < 80 then '60-80' else '>=80' end as category from w where s > 0.05""")


def gated_fields(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").select("cell", "hour_no", ((F.col("rh") - 55) * 1.5).alias("li"), ((F.col("rh") - 20) * 400).alias("cape"), (F.col("temp_c") * 300).alias("pbl"), (F.col("wind_kmh") * 2).alias("gust_ms"), ((F.col("temp_c") - 15) * 700).alias("helicity"))
    return fields.gated(wx).select("cell", "hour_no", *[r4(c) for c in fields.GATES])


QUERIES["gated_fields"] = gated_fields
ORACLES["gated_fields"] = duck(f"""with w as (select cell, hour_no, (rh - 55) * 1.5 as a, (rh - 20) * 400 as b, temp_c * 300 as c, wind_kmh * 2 as d, (temp_c - 15) * 700 as e from ({{wx}}))
select cell, hour_no, {R4('case when abs(a) <= 50 then a end', 'li')}, {R4('case when b >= 0 and b < 20000 then b end', 'cape')}, {R4('case when c between 0 and 6000 then c end', 'pbl')}, {R4('case when d >= 0 and d < 100 then d end', 'gust_ms')}, {R4('case when abs(e) <= 5000 then e end', 'helicity')} from w""")


def analysis_limits(spark, sf_dir):
    p = view(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*[F.lit(k) for k in ("ffmc", "dmc", "dc", "fwi", "bui", "isi")]), (F.col("p_partkey") % 6 + 1).cast("int")).alias("component"), (F.col("p_retailprice") - 950).alias("value"))
    return fields.within_limits(p).select("p_partkey", "component", r4("value"))


QUERIES["analysis_limits"] = analysis_limits
ORACLES["analysis_limits"] = duck(f"""with p as (select p_partkey, ['ffmc', 'dmc', 'dc', 'fwi', 'bui', 'isi'][p_partkey % 6 + 1] as component, p_retailprice - 950 as v, [101, 1000, 2000, 500, 1000, -1][p_partkey % 6 + 1] as top from part) select p_partkey, component, {R4('case when v between 0 and top then v end', 'value')} from p""")


def terrain_winds(spark, sf_dir):
    p = view(spark, sf_dir, "profile").groupBy("cell").agg(F.max("surface_p").alias("s"), F.max(F.when(F.col("level") == 1, F.col("temp"))).alias("low"), F.max(F.when(F.col("level") == 3, F.col("temp"))).alias("high"), F.max(F.when(F.col("level") == 1, F.col("p_hpa"))).alias("p"))
    w = P.vertical_velocity(F.col("low") - 290, F.col("low"), F.col("p"))
    cm = P.vertical_velocity_cm(F.col("low") - 290, F.col("low") - 145, F.col("p"))
    rh = P.relative_humidity(F.col("low") - 273.15, F.col("high") - 275)
    return p.select("cell", r4(fields.terrain_wind(F.col("low"), F.col("high"), F.col("s")), "wind"), r4(w * 1e3, "upward"), r4(cm, "upward_cm"), r4(rh, "rh"))


QUERIES["terrain_winds"] = terrain_winds
ORACLES["terrain_winds"] = duck(f"""with p as (select cell, max(surface_p) as s, max(case when level = 1 then temp end) as low, max(case when level = 3 then temp end) as high, max(case when level = 1 then p_hpa end) as p from ({{profile}}) group by cell)
select cell, {R4('case when s <= 885 then high else low end', 'wind')}, {R4('case when low > 150 then -(low - 290) / (p * 100 / (287.05 * low) * 9.80665) end * 1e3', 'upward')}, {R4('-(low - 290) / greatest(p * 100 / (287.05 * greatest(low - 145, 150)) * 9.80665, 1e-6) * 100', 'upward_cm')},
{R4('case when low is not null and high is not null then least(greatest(100 * exp(17.67 * (high - 275) / (high - 275 + 243.5)) / exp(17.67 * (low - 273.15) / (low - 273.15 + 243.5)), 0), 100) end', 'rh')} from p""")


def subcloud_humidity(spark, sf_dir):
    p = view(spark, sf_dir, "profile").withColumn("ground", F.when(F.col("cell") % 5 != 0, 40.0 + F.col("cell") % 50))
    return fields.layer_mean(p, ["cell"], "rh", ground="ground").select("cell", r4("mean"))


QUERIES["subcloud_humidity"] = subcloud_humidity
ORACLES["subcloud_humidity"] = duck(f"""with p as (select cell, case when surface_p >= p_hpa then rh end as x from ({{profile}}) union all select distinct cell, case when cell % 5 <> 0 then 40.0::double + cell % 50 end from ({{profile}})) select cell, {R4('avg(x)', 'mean')} from p group by cell""")


def area_shares(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").withColumns({"lat": 48.0 + F.col("cell") % 12, "gust": F.when(F.col("cell") % 9 != 0, F.col("wind_kmh") * 2)})
    return fields.area_shares(wx, ["hour_no"], "gust", {"share60": 60.0, "share90": 90.0}).select("hour_no", r4("share60"), r4("share90"))


QUERIES["area_shares"] = area_shares
ORACLES["area_shares"] = duck(f"""with w as (select hour_no, wind_kmh * 2 as g, cos(radians(48.0::double + cell % 12)) as w from ({{wx}}) where cell % 9 <> 0), h as (select distinct hour_no from ({{wx}}))
select h.hour_no, {R4('coalesce(sum(case when g >= 60 then w else 0 end) / sum(w), 0)', 'share60')}, {R4('coalesce(sum(case when g >= 90 then w else 0 end) / sum(w), 0)', 'share90')} from h left join w on w.hour_no = h.hour_no group by 1""")


def smoothed_potential(spark, sf_dir):
    g = view(spark, sf_dir, "grid").select(F.lit(1).alias("f"), "iy", "ix", F.col("v").alias("potential"))
    return lightning.smoothed_potential(g, ["f"], 1.2).select("iy", "ix", r4("potential"))


QUERIES["smoothed_potential"] = smoothed_potential
ORACLES["smoothed_potential"] = duck("with " + smooth_sql(_kernel(1.0)) + " select iy, ix, " + R4("least(greatest(case when w > 1e-12 then x / w end, 0), 100)", "potential") + " from c")


def noon_samples(spark, sf_dir):
    """Samples at local noon, rain between noons, and what falls after noon."""
    w = Window.partitionBy("cell").orderBy("hour_no").rowsBetween(Window.unboundedPreceding, 0)
    wx = view(spark, sf_dir, "wx").withColumn("acc", F.sum("precip_mm").over(w))
    got = daily.noon_samples(wx, ["cell"], ["temp_c", "rh", "wind_kmh"], "acc")
    return got.select("cell", F.col("local_date").cast("string").alias("local_date"), r4("temp_c"), r4("rh"), r4("wind_kmh"), (F.floor(F.col("rain_24h") * 1e3 + 0.5) / 1e3).alias("rain_24h"), (F.floor(F.col("rain_tomorrow") * 1e3 + 0.5) / 1e3).alias("rain_tomorrow"))


QUERIES["noon_samples"] = noon_samples
ORACLES["noon_samples"] = duck("""with w as (select *, valid_ts - interval 7 hour as loc, cast(loc as date) as d, extract(hour from loc) = 12 as noon, sum(precip_mm) over (partition by cell order by hour_no) as acc from ({wx})),
x as (select cell, d, max(case when noon then temp_c end) as temp_c, max(case when noon then rh end) as rh, max(case when noon then wind_kmh end) as wind_kmh, max(case when noon then acc end) as na, max_by(acc, hour_no) as la from w group by 1, 2)
select cell, cast(d as varchar) as local_date, """ + ", ".join(R4(c) for c in ("temp_c", "rh", "wind_kmh")) + """, floor(case when na - lag(na) over l is not null then greatest(na - lag(na) over l, 0) end * 1e3 + 0.5) / 1e3 as rain_24h,
    floor(case when la - na > 1e-4 then la - na when la - na is not null then 0 end * 1e3 + 0.5) / 1e3 as rain_tomorrow from x window l as (partition by cell order by d)""")
