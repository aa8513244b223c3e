"""Queries: the older daily codes, their hourly fine-fuel code, carry-over and fire behaviour."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import behaviour, seasonal
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r3 = lambda c: (F.floor(F.col(c) * 1e3 + 0.5) / 1e3).alias(c)
R3 = lambda c: f"floor({c} * 1e3 + 0.5) / 1e3 as {c}"


def _weather(spark, sf_dir):
    """Each hour of the stand-in weather as one step."""
    h = F.col("hour_no")
    return view(spark, sf_dir, "wx").select(
        "cell", h.alias("n"), F.col("temp_c").alias("temp"), "rh", F.col("wind_kmh").alias("wind"), F.col("precip_mm").alias("rain"), (F.floor(h / 10) % 12 + 1).alias("month"),
        F.when(h % 25 == 15, -1).when(h % 25 == 20, 1).otherwise(0).alias("onset"), (F.col("rh") * 2).alias("winter_rain"))


def daily_codes(spark, sf_dir):
    rows = seasonal.daily_codes(_weather(spark, sf_dir), ["cell"], "n")
    return rows.select("cell", "n", *map(r3, ("f", "p", "d", "df", "r", "u", "s", "severity")))


_STEP = """wx as (select cell, hour_no as n, temp_c as t, rh as h, wind_kmh as w, precip_mm as r, cast(floor(hour_no / 10) as bigint) % 12 + 1 as mon, case hour_no % 25 when 15 then -1 when 20 then 1 else 0 end as onset, rh * 2 as wr,
    case when r > 0.5 then r - 0.5 when r < 1e-7 then 1e-5 else r end as rf, 0.18 * (21.1 - t) * (1 - exp(-0.115 * h)) as e1, 0.942 * pow(h, 0.679) + 11 * exp((h - 100) / 10) + e1 as ed, 0.618 * pow(h, 0.753) + 10 * exp((h - 100) / 10) + e1 as ew,
    0.424 * (1 - pow(h / 100, 1.7)) + 0.0694 * sqrt(w) * (1 - pow(h / 100, 8)) as ka, 0.424 * (1 - pow((100 - h) / 100, 1.7)) + 0.0694 * sqrt(w) * (1 - pow((100 - h) / 100, 8)) as kb from ({wx}) x)"""
_WET = "m0 + 42.5 * rf * exp(-100 / (251 - m0)) * (1 - exp(-6.93 / rf)) + case when m0 > 150 then 0.0015 * (m0 - 150) * (m0 - 150) * sqrt(rf) else 0 end"

QUERIES["daily_codes"] = daily_codes
ORACLES["daily_codes"] = duck("with recursive " + _STEP + f""", st as (select cell, cast(0 as bigint) as n, 85.0::double as f, 6.0::double as p, 15.0::double as d, 15.0::double as df, 0.0::double as w from (select distinct cell from wx)
union all select cell, n, f2, p2, d2, df2, w from (select x.cell, x.n, x.w, case when onset = 1 then 85 else st.f end as f0, case when onset = 1 then 6 else st.p end as p0,
    greatest(case when onset = 1 then 400 * ln(800 / (800 * exp(-st.df / 400) + 0.75 * 3.94 * wr)) else st.d end, 15) as d0, case when onset = -1 then d0 else st.df end as df2,
    147.2 * (101 - f0) / (59.5 + f0) as m0, {_WET} as m1, least(greatest(m1, 0.1), 250) as m2, case when m2 > ed then ed + (m2 - ed) * pow(10, -(ka * 0.581 * exp(0.0365 * t))) when m2 >= ew then m2 else ew - (ew - m2) * pow(10, -(kb * 0.581 * exp(0.0365 * t))) end as m,
    59.5 * (250 - m) / (147.2 + m) as fx, case when fx < 1 then 1 else fx end as f2,
    0.92 * r - 1.27 as re, case when p0 <= 33 then 100 / (0.5 + 0.3 * p0) when p0 <= 65 then 14 - 1.3 * ln(p0) else 6.2 * ln(p0) - 17.2 end as b,
    greatest(case when r <= 1.5 then p0 else 43.43 * (5.6348 - ln(280 / exp(0.023 * p0) + 1000 * re / (48.77 + b * re))) end, 0) as pr, greatest(pr + 1.894 * (greatest(t, -1.1) + 1.1) * (100 - h) * {seasonal.DUFF_DAY}[mon] * 1e-4, 6) as p2,
    case when r <= 2.8 then d0 else greatest(d0 - 400 * ln(1 + 3.937 * (0.83 * r - 1.27) / (800 * exp(-d0 / 400))), 0) end as dr, greatest(dr + greatest(0.36 * (greatest(t, -2.8) + 2.8) + {seasonal.DROUGHT_DAY}[mon], 0) * 0.5, 15) as d2
    from st join wx x on x.cell = st.cell and x.n = st.n + 1)),
i as (select *, 147.2 * (101 - f) / (59.5 + f) as m, 0.208 * exp(0.05039 * w) * 91.9 * exp(-0.1386 * m) * (1 + pow(m, 5.31) / 4.93e7) as r,
    case when p <= 0.4 * d then 0.8 * p * d / (p + 0.4 * d) else p - (1 - 0.8 * d / (p + 0.4 * d)) * (0.92 + pow(0.0114 * p, 1.7)) end as u0, case when u0 < 0 then 1 else u0 end as u,
    greatest(0.1 * r * case when u > 80 then 1000 / (25 + 108.64 * exp(-0.023 * u)) else 0.626 * pow(u, 0.809) + 2 end, 1e-6) as bb, case when bb <= 1 then bb else exp(2.72 * pow(0.434 * ln(greatest(bb, 1)), 0.647)) end as s, 0.0272 * pow(s, 1.77) as severity from st where n > 0)
select cell, n, """ + ", ".join(map(R3, ("f", "p", "d", "df", "r", "u", "s", "severity"))) + " from i")


def hourly_fine_fuel(spark, sf_dir):
    return seasonal.hourly_fine_fuel(_weather(spark, sf_dir), ["cell"], "n").select("cell", "n", r3("moisture"), r3("f"))


QUERIES["hourly_fine_fuel"] = hourly_fine_fuel
ORACLES["hourly_fine_fuel"] = duck("with recursive " + _STEP + f""", s as (select cell, cast(0 as bigint) as n, 85.0::double as f, 0.0::double as moisture from (select distinct cell from wx)
union all select cell, n, f2, m2 from (select x.cell, x.n, 147.2 * (101 - s.f) / (59.5 + s.f) as m0, {_WET} as m1, least(greatest(m1, 0.1), 250) as m2,
    case when m2 > ed then ed + (m2 - ed) * exp(-2.303 * (0.0579 * ka * exp(0.0365 * t))) when m2 >= ew then m2 else ew - (ew - m2) * exp(-2.303 * (0.0579 * kb * exp(0.0365 * t))) end as m,
    59.5 * (250 - m) / (147.27723 + m) as fx, case when fx < 0 then 1 else fx end as f2 from s join wx x on x.cell = s.cell and x.n = s.n + 1))
select cell, n, {R3('moisture')}, {R3('f')} from s where n > 0""")


def codes_carried_over(spark, sf_dir):
    o = view(spark, sf_dir, "orders").groupBy(F.pmod("o_custkey", F.lit(20)).alias("cell"), F.to_date("o_orderdate").alias("day")).agg(F.max("o_orderkey").alias("k"))
    k = F.col("k")
    stored = o.filter("k % 3 <> 0").select("cell", "day", (k % 90).alias("f"), (k % 70).alias("p"), (k % 400).alias("d"), (k % 300).alias("df"))
    return seasonal.carried_over(o, stored, ["cell"], "day").select("cell", F.col("day").cast("string").alias("day"), F.col("carried").cast("long").alias("carried"), "codes.*")


QUERIES["codes_carried_over"] = codes_carried_over
ORACLES["codes_carried_over"] = duck("""with o as (select o_custkey % 20 as cell, cast(o_orderdate as date) as day, max(o_orderkey) as k from orders group by 1, 2), s as (select * from o where k % 3 <> 0),
j as (select o.cell, o.day, case when a.k is not null then 1 when b.k is not null then 2 end as carried, coalesce(a.k, b.k) as k from o left join s a on a.cell = o.cell and a.day = o.day - 1 left join s b on b.cell = o.cell and b.day = o.day - 2)
select cell, cast(day as varchar) as day, cast(carried as bigint) as carried, cast(coalesce(k % 90, 85) as double) as f, cast(coalesce(k % 70, 6) as double) as p, cast(coalesce(k % 400, 15) as double) as d, cast(coalesce(k % 300, 15) as double) as df from j""")

_KINDS = [*behaviour.FUELS, "rock"]


def fire_behaviour(spark, sf_dir):
    c, h = F.col("cell"), F.col("hour_no")
    rows = view(spark, sf_dir, "wx").select(
        "cell", h.alias("n"), F.get(F.array(*map(F.lit, _KINDS)), ((c + h) % len(_KINDS)).cast("int")).alias("fuel"), (60 + F.col("temp_c")).alias("f"), (5 + F.col("rh") / 4).alias("moisture"), F.col("rh").alias("bui"), F.col("wind_kmh").alias("wind"),
        (h * 37 % 360).cast("double").alias("wind_dir"), (48.5 + c % 12).alias("lat"), (-124.0 + c % 9).alias("lon"), (c % 20 * 100).cast("double").alias("elevation"), (h * 7 % 70).cast("double").alias("slope"),
        (h * 11 % 360).cast("double").alias("aspect"), (25 + c % 3 * 25).cast("double").alias("conifer"), (60 + h % 200).cast("double").alias("day_of_year"))
    return behaviour.behaviour(rows).select("cell", "n", "fuel", *map(r3, ("fmc", "sfc", "isi", "raz", "ros", "cfb", "tfc", "hfi")))


def _behaviour_sql() -> str:
    num = lambda v: "null::double" if v is None else f"{v}::double"
    table = ", ".join(f"({i}, '{k}', {', '.join(map(num, behaviour.FUELS.get(k, (None,) * 7)))})" for i, k in enumerate(_KINDS))
    a2, b2, c2 = behaviour.FUELS["C2"][:3]
    a1, b1, c1 = behaviour.FUELS["D1"][:3]
    cf = behaviour.curing_factor()
    ff = lambda m: f"91.9 * exp(-0.1386 * {m}) * (1 + pow({m}, 5.31) / 4.93e7)"
    ros = lambda x: f"case when fuel = 'M1' then pc / 100 * ({a2} * pow(1 - exp(-{b2} * {x}), {c2}) + {a1} * pow(1 - exp(-{b1} * {x}), {c1})) when fuel = 'C6' then 30 * pow(1 - exp(-0.08 * {x}), 3) when fuel like 'O1%' then a * pow(1 - exp(-b * {x}), c) * {cf} else coalesce(a * pow(1 - exp(-b * {x}), c), 0) end"
    gone = lambda k: f"(1 - exp(-{k} * bui))"
    return f"""with k(i, fuel, a, b, c, q, b0, cbh, cfl) as (values {table}),
w as (select cell, hour_no as n, 60 + temp_c as f, 5 + rh / 4 as mo, rh as bui, wind_kmh as ws, radians(hour_no * 37 % 360) + pi() as wa, 48.5::double + cell % 12 as lat, -124.0::double + cell % 9 as lon, cell % 20 * 100 as elv, hour_no * 7 % 70 as gs, radians(hour_no * 11 % 360) as sa,
    25 + cell % 3 * 25 as pc, 60 + hour_no % 200 as doy, (cell + hour_no) % {len(_KINDS)} as i from ({{wx}}) x),
x as (select *, 142.1 * (lat / (43 + 33.7 * exp(-0.0351 * (150 - lon)))) + 0.0172 * elv as d0, abs(doy - d0) as nd from w join k on k.i = w.i),
x2 as (select *, case when nd < 30 then 85 + 0.0189 * nd * nd when nd < 50 then 32.9 + 3.17 * nd - 0.0288 * nd * nd else 120 end as fmc,
    5 * {gone(0.0115)} as sp, 1.5 * {gone(0.0183)} as asp, case when fuel = 'C1' then case when f > 84 then 0.75 + 0.75 * sqrt(1 - exp(-0.23 * (f - 84))) else 0.75 - 0.75 * sqrt(1 - exp(-0.23 * (84 - f))) end when fuel = 'C2' then sp
    when fuel in ('C3', 'C4') then 5 * pow({gone(0.0164)}, 2.24) when fuel in ('C5', 'C6') then 5 * pow({gone(0.0149)}, 2.48) when fuel = 'C7' then case when f > 70 then 2 * (1 - exp(-0.104 * (f - 70))) else 0 end + 1.5 * {gone(0.0201)} when fuel = 'D1' then asp
    when fuel = 'M1' then pc / 100 * sp + (100 - pc) / 100 * asp when fuel like 'O1%' then 0.3 else 0 end as s0, case when s0 <= 0 then 0.01 else s0 end as sfc from x),
x3 as (select *,
    147.2 * (101 - f) / (59.5 + f) as m, {ff('m')} as fm, 0.208 * fm as isz from x2),
x4 as (select *, ({ros('isz')}) * case when gs < 60 then exp(3.533 * pow(gs / 100, 1.2)) else 0 end as rsf from x3),
x5 as (select *,
    (100 - rsf) / (pc * {a2}) as base from x4),
x6 as (select *, case when fuel = 'M1' then case when base >= 0 and base < 1 then ln(1 - pow(base, {1 / c2})) / -{b2} end when fuel like 'O1%' then case when rsf < {cf} * a then ln(1 - pow(rsf / ({cf} * a), 1 / c)) / -b end when a is not null then ln(greatest(1 - pow(rsf / a, 1 / c), 0.01)) / -b else 0 end as isf from x5),
x7 as (select *,
    {ff('mo')} as fo, case when isf > 0.1 then ln(isf / (0.208 * fo)) / 0.05039 else 0 end as w0 from x6),
x8 as (select *, case when w0 > 40 then case when isf < 0.999 * 2.496 * fo then 28 - ln(1 - isf / (2.496 * fo)) / 0.0818 else 112.45 end else w0 end as wse from x7),
x9 as (select *,
    ws * sin(wa) + wse * sin(sa) as vx, ws * cos(wa) + wse * cos(sa) as vy from x8),
x10 as (select *, case when gs > 0 and f > 0 then sqrt(vx * vx + vy * vy) else ws end as v from x9),
x11 as (select *, case when abs(vy / nullif(v, 0)) <= 1 then degrees(acos(vy / nullif(v, 0))) end as az, case when vx < 0 then 360 - az else az end as raz from x10),
x12 as (select *,
    0.208 * case when v >= 40 then 12 * (1 - exp(-0.0818 * (v - 28))) else exp(0.05039 * v) end * fm as isi from x11),
x13 as (select *, case when q is null then 0 when bui > 0 and b0 > 0 then exp(50 * ln(q) * (1 / bui - 1 / b0)) else 1 end as be, ({ros('isi')}) * be as sf,
    0.001 * pow(cbh, 1.5) * pow(460 + 25.9 * fmc, 1.5) / (300 * sfc) as rso from x12),
x14 as (select *, case when sf > rso then 1 - exp(-0.23 * (sf - rso)) else 0 end as cf0, 60 * (1 - exp(-0.0497 * isi)) * (pow(1.5 - 0.00275 * fmc, 4) / (460 + 25.9 * fmc) * 1000 / 0.778) as rsc,
    greatest(case when fuel = 'C6' then sf + cf0 * (rsc - sf) else sf end, 0) as ros from x13),
x15 as (select *, case when ros > rso then 1 - exp(-0.23 * (ros - rso)) else 0 end as cfb from x14),
x16 as (select *, case when q is null then 0 else sfc + coalesce(cfl, 0) * cfb end as tfc, 300 * tfc * ros as hfi from x15)
select cell, n, fuel, """ + ", ".join(map(R3, ("fmc", "sfc", "isi", "raz", "ros", "cfb", "tfc", "hfi"))) + " from x16"


QUERIES["fire_behaviour"] = fire_behaviour
ORACLES["fire_behaviour"] = duck(_behaviour_sql())
