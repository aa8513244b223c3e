"""Hourly fire behaviour per cell: consumption, slope-equivalent wind, spread, crowning, intensity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import physics as P
from .seasonal import fine_function, spread

# Published coefficients of the fuel types (Forestry Canada 1992); null where a type has no crown or rule.
FIELDS = ("a", "b", "c", "q", "bui0", "cbh", "cfl")
FUELS = {
    "C1": (90.0, 0.0649, 4.5, 0.90, 72.0, 2.0, 0.75),
    "C2": (110.0, 0.0282, 1.5, 0.70, 64.0, 3.0, 0.80),
    "C3": (110.0, 0.0444, 3.0, 0.75, 62.0, 8.0, 1.15),
    "C4": (110.0, 0.0293, 1.5, 0.80, 66.0, 4.0, 1.20),
    "C5": (30.0, 0.0697, 4.0, 0.80, 56.0, 18.0, 1.20),
    "C6": (30.0, 0.0800, 3.0, 0.80, 62.0, 7.0, 1.80),
    "C7": (45.0, 0.0305, 2.0, 0.85, 106.0, 10.0, 0.50),
    "D1": (30.0, 0.0232, 1.6, 0.90, 32.0, None, None),
    "M1": (None, None, None, 0.80, 50.0, 6.0, 0.80),
    "O1a": (190.0, 0.0310, 1.4, 1.0, None, None, None),
    "O1b": (250.0, 0.0350, 1.7, 1.0, None, None, None),
}
GRASS_LOAD, CURING = 0.3, 80.0
n = P.lit


def curing_factor(curing: float = CURING) -> float:
    return 0.176 + 0.02 * (curing - 58.8) if curing >= 58.8 else 0.005 * (2.718281828459045 ** (0.061 * curing) - 1)


def foliar_moisture(lat: Column, lon: Column, elevation: Column, day_of_year: Column) -> Column:
    least_day = n(142.1) * (lat / (n(43) + n(33.7) * F.exp(n(-0.0351) * (n(150) - lon)))) + n(0.0172) * elevation
    away = F.abs(day_of_year - least_day)
    return F.when(away < 30, n(85) + n(0.0189) * away * away).when(away < 50, n(32.9) + n(3.17) * away - n(0.0288) * away * away).when(away >= 50, n(120))


def surface_consumption(fuel: Column, f: Column, bui: Column, conifer: Column, grass: float = GRASS_LOAD) -> Column:
    gone = lambda k: n(1) - F.exp(n(-k) * bui)
    spruce, aspen = n(5) * gone(0.0115), n(1.5) * gone(0.0183)
    side = n(0.75) * F.sqrt(n(1) - F.exp(n(-0.23) * F.abs(f - n(84))))
    found = (
        F.when(fuel == "C1", F.when(f > 84, n(0.75) + side).otherwise(n(0.75) - side)).when(fuel == "C2", spruce)
        .when(fuel.isin("C3", "C4"), n(5) * F.pow(gone(0.0164), n(2.24))).when(fuel.isin("C5", "C6"), n(5) * F.pow(gone(0.0149), n(2.48)))
        .when(fuel == "C7", F.when(f > 70, n(2) * (n(1) - F.exp(n(-0.104) * (f - n(70))))).otherwise(n(0)) + n(1.5) * gone(0.0201))
        .when(fuel == "D1", aspen).when(fuel == "M1", conifer / n(100) * spruce + (n(100) - conifer) / n(100) * aspen)
        .when(fuel.isin("O1a", "O1b"), n(grass)).otherwise(n(0))
    )
    return F.when(found <= 0, n(0.01)).otherwise(found)


def _rate(isi: Column, a: Column, b: Column, c: Column) -> Column:
    return a * F.pow(n(1) - F.exp(-b * isi), c)


def level_spread(fuel: Column, isi: Column, conifer: Column, fuels: dict, cf: float) -> Column:
    """Spread without the effect of build-up. Mixed stands take the conifer share of both rates."""
    mixed = conifer / n(100) * (_rate(isi, *map(n, fuels["C2"][:3])) + _rate(isi, *map(n, fuels["D1"][:3])))
    own = _rate(isi, F.col("a"), F.col("b"), F.col("c"))
    return F.when(fuel == "M1", mixed).when(fuel.isin("O1a", "O1b"), own * n(cf)).when(fuel == "C6", n(30) * F.pow(n(1) - F.exp(n(-0.08) * isi), n(3))).otherwise(F.coalesce(own, n(0)))


def behaviour(rows: DataFrame, fuels: dict[str, tuple] = FUELS, curing: float = CURING) -> DataFrame:
    """rows (fuel, f, moisture, bui, wind, wind_dir, lat, lon, elevation, slope, aspect, conifer, day_of_year) with fmc, sfc,
    isi, raz, ros, cfb, tfc and hfi. A code outside fuels does not burn. The table of fuels has one row a code."""
    spark, cf = rows.sparkSession, curing_factor(curing)
    table = spark.createDataFrame([(k, *v) for k, v in fuels.items()], "fuel string, " + ", ".join(f"{c} double" for c in FIELDS))
    fuel, pc = F.col("fuel"), F.col("conifer")
    got = rows.join(table, "fuel", "left")
    got = got.withColumns({"fmc": foliar_moisture(F.col("lat"), F.col("lon"), F.col("elevation"), F.col("day_of_year")), "sfc": surface_consumption(fuel, F.col("f"), F.col("bui"), pc)})
    slope = F.when(F.col("slope") < 60, F.exp(n(3.533) * F.pow(F.col("slope") / n(100), n(1.2)))).otherwise(n(0))
    got = got.withColumn("_rsf", level_spread(fuel, spread(F.col("f"), n(0), True), pc, fuels, cf) * slope)
    share = F.pow(F.col("_rsf") / F.col("a"), n(1) / F.col("c"))
    of_grass = F.pow(F.col("_rsf") / (n(cf) * F.col("a")), n(1) / F.col("c"))
    base = (n(100) - F.col("_rsf")) / (pc * n(fuels["C2"][0]))
    mixed = F.log(n(1) - F.pow(F.when(base >= 0, base), n(1 / fuels["C2"][2]))) / n(-fuels["C2"][1])
    plain = F.log(F.greatest(n(1) - share, n(0.01))) / -F.col("b")
    isf = F.when(fuel == "M1", mixed).when(fuel.isin("O1a", "O1b"), F.log(n(1) - of_grass) / -F.col("b")).when(F.col("a").isNotNull(), plain).otherwise(n(0))
    got = got.withColumns({"_isf": isf, "_ff": fine_function(F.col("moisture"))})
    wse = F.when(F.col("_isf") > 0.1, F.log(F.col("_isf") / (n(0.208) * F.col("_ff"))) / n(0.05039)).otherwise(n(0))
    got = got.withColumn("_w", wse)
    most = n(2.496) * F.col("_ff")
    high = F.when(F.col("_isf") < n(0.999) * most, n(28) - F.log(n(1) - F.col("_isf") / most) / n(0.0818)).otherwise(n(112.45))
    got = got.withColumn("_wse", F.when(F.col("_w") > 40, high).otherwise(F.col("_w")))
    blows = F.radians("wind_dir") + n(3.141592653589793)
    got = got.withColumns({
        "_x": F.col("wind") * F.sin(blows) + F.col("_wse") * F.sin(F.radians("aspect")), "_y": F.col("wind") * F.cos(blows) + F.col("_wse") * F.cos(F.radians("aspect"))})
    got = got.withColumn("_v", F.when((F.col("slope") > 0) & (F.col("f") > 0), F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y"))).otherwise(F.col("wind")))
    cosine = F.try_divide(F.col("_y"), F.col("_v"))
    angle = F.degrees(F.acos(F.when(F.abs(cosine) <= 1, cosine)))
    got = got.withColumns({"isi": spread(F.col("f"), F.col("_v"), True), "raz": F.when(F.col("_x") < 0, n(360) - angle).otherwise(angle)})
    burns = F.col("q").isNotNull()
    effect = F.when(~burns, n(0)).when((F.col("bui") > 0) & (F.col("bui0") > 0), F.exp(n(50) * F.log(F.col("q")) * (n(1) / F.col("bui") - n(1) / F.col("bui0")))).otherwise(n(1))
    got = got.withColumns({"_surface": level_spread(fuel, F.col("isi"), pc, fuels, cf) * effect, "_rso": n(0.001) * F.pow(F.col("cbh"), n(1.5)) * F.pow(n(460) + n(25.9) * F.col("fmc"), n(1.5)) / (n(300) * F.col("sfc"))})
    crowned = lambda ros: F.when(ros > F.col("_rso"), n(1) - F.exp(n(-0.23) * (ros - F.col("_rso")))).otherwise(n(0))
    fme = F.pow(n(1.5) - n(0.00275) * F.col("fmc"), n(4)) / (n(460) + n(25.9) * F.col("fmc")) * n(1000)
    crown = n(60) * (n(1) - F.exp(n(-0.0497) * F.col("isi"))) * (fme / n(0.778))
    plantation = F.col("_surface") + crowned(F.col("_surface")) * (crown - F.col("_surface"))
    got = got.withColumn("ros", P.at_least(F.when(fuel == "C6", plantation).otherwise(F.col("_surface")), 0.0))
    got = got.withColumn("cfb", crowned(F.col("ros")))
    got = got.withColumn("tfc", F.when(burns, F.col("sfc") + F.coalesce("cfl", n(0)) * F.col("cfb")).otherwise(n(0)))
    return got.withColumn("hfi", n(300) * F.col("tfc") * F.col("ros")).drop(*FIELDS, *[c for c in got.columns if c.startswith("_")])
