"""Formulas as columns. A missing input gives a missing result, although greatest and least skip nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
FFMC_SCALE = 14875.0 / 101.0
FFMC_INTERCEPT_MM, DMC_INTERCEPT_MM, DC_INTERCEPT_MM, RESET_HOURS = 0.5, 1.5, 2.8, 5.0
DRY_AIR, GRAVITY = 287.05, 9.80665
EARTH_RADIUS_M, EARTH_SPIN = 6_371_229.0, 7.292e-5
ADJECTIVE_EDGES = [6.0, 16.0, 23.0, 30.0]
DANGER = {
    1: {"fwi": [1, 8, 17, 31], "bui": [20, 43, 70, 119], "classes": [[1, 2, 2, 3, 3], [2, 2, 3, 3, 4], [2, 3, 3, 4, 4], [2, 3, 4, 4, 5], [3, 3, 4, 5, 5]]},
    2: {"fwi": [5, 17, 27, 38], "bui": [49, 86, 119, 159], "classes": [[1, 2, 2, 3, 3], [2, 2, 3, 3, 4], [2, 3, 3, 4, 4], [2, 3, 4, 4, 5], [3, 3, 4, 5, 5]]},
    3: {"fwi": [5, 17, 28, 47], "bui": [51, 91, 141, 201], "classes": [[1, 2, 2, 3, 3], [2, 2, 3, 3, 4], [2, 3, 3, 4, 5], [2, 3, 4, 4, 5], [3, 3, 4, 4, 5]]},
}


def lit(x: float) -> Column:
    return F.lit(float(x))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, lit(low)), lit(high)))


def at_least(x: Column, low: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, lit(low)))


def at_most(x: Column, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(x, lit(high)))


def ramp(x: Column, low: float, high: float) -> Column:
    if high == low:
        raise ValueError("a ramp needs two different bounds")
    return clip((x - lit(low)) / lit(high - low), 0.0, 1.0)


def bins(x: Column, edges: list[float]) -> Column:
    """How many edges are at or below x."""
    return F.when(x.isNotNull(), reduce(lambda a, b: a + b, [(x >= lit(e)).cast("int") for e in edges]))


def ffmc_moisture(ffmc: Column) -> Column:
    return lit(FFMC_SCALE) * (lit(101) - ffmc) / (lit(59.5) + ffmc)


def dmc_moisture(dmc: Column) -> Column:
    return lit(280) / F.exp(dmc / lit(43.43)) + lit(20)


def dc_moisture(dc: Column) -> Column:
    return lit(400) * F.exp(-dc / lit(400))


def ffmc_code(m: Column) -> Column:
    return clip(lit(59.5) * (lit(250) - m) / (lit(FFMC_SCALE) + m), 0.0, 101.0)


def dmc_code(m: Column) -> Column:
    return at_least(lit(43.43) * F.log(lit(280) / at_least(m - lit(20), 1e-6)), 0.0)


def dc_code(m: Column) -> Column:
    return at_least(lit(400) * F.log(lit(400) / at_least(m, 1e-6)), 0.0)


def spread_index(ffmc: Column, wind: Column) -> Column:
    wind, m = at_least(wind, 0.0), ffmc_moisture(ffmc)
    of_wind = F.when(wind >= 40, lit(12) * (lit(1) - F.exp(lit(-0.0818) * (wind - lit(28))))).otherwise(F.exp(lit(0.05039) * wind))
    return at_least(lit(0.208) * of_wind * lit(91.9) * F.exp(lit(-0.1386) * m) * (lit(1) + F.pow(m, lit(5.31)) / lit(4.93e7)), 0.0)


def buildup_index(dmc: Column, dc: Column) -> Column:
    dmc, dc = at_least(dmc, 0.0), at_least(dc, 0.0)
    base = F.coalesce(F.try_divide(lit(0.8) * dc * dmc, dmc + lit(0.4) * dc), lit(0))
    part = F.coalesce(F.try_divide(dmc - base, dmc), lit(0))
    found = F.when(base < dmc, dmc - (lit(0.92) + F.pow(lit(0.0114) * dmc, lit(1.7))) * part).otherwise(base)
    return F.when(dmc.isNotNull() & dc.isNotNull(), F.greatest(found, lit(0)))


def fire_weather_index(isi: Column, bui: Column) -> Column:
    isi, bui = at_least(isi, 0.0), at_least(bui, 0.0)
    fuel = F.when(bui > 80, lit(1000) / (lit(25) + lit(108.64) * F.exp(lit(-0.023) * bui))).otherwise(lit(0.626) * F.pow(bui, lit(0.809)) + lit(2))
    base = lit(0.1) * isi * fuel
    high = F.exp(lit(2.72) * F.pow(lit(0.434) * F.log(at_least(base, 1.0)), lit(0.647)))
    return F.when(base <= 1, base).otherwise(high)


def adjective_class(fwi: Column) -> Column:
    return bins(fwi, ADJECTIVE_EDGES) + 1


def danger_class(fwi: Column, bui: Column, region: Column) -> Column:
    """1 to 5 by the region's matrix; null without an index or a region of 1 to 3."""
    found = F.lit(None).cast("int")
    for r, spec in DANGER.items():
        matrix = F.array(*[F.array(*[F.lit(c) for c in row]) for row in spec["classes"]])
        found = F.when(region == r, F.get(F.get(matrix, bins(bui, spec["bui"])), bins(fwi, spec["fwi"]))).otherwise(found)
    return found


def saturation_pressure(temp_c: Column) -> Column:
    return lit(6.112) * F.exp(lit(17.67) * temp_c / (temp_c + lit(243.5)))


def relative_humidity(temp_c: Column, dewpoint_c: Column) -> Column:
    return clip(lit(100) * saturation_pressure(dewpoint_c) / saturation_pressure(temp_c), 0.0, 100.0)


def specific_humidity(temp_k: Column, rh: Column, pressure_hpa: Column) -> Column:
    e = clip(rh, 0.0, 100.0) * lit(0.01) * saturation_pressure(temp_k - lit(273.15))
    ratio = lit(0.622) * e / at_least(pressure_hpa - e, 1.0)
    return ratio / (lit(1) + ratio)


def vertical_velocity(omega: Column, temp_k: Column, pressure_hpa: Column) -> Column:
    density = pressure_hpa * lit(100) / (lit(DRY_AIR) * temp_k)
    return F.when(temp_k > 150, -omega / (density * lit(GRAVITY)))


def vertical_velocity_cm(omega: Column, temp_k: Column, pressure_hpa: Column) -> Column:
    """Upward velocity in cm/s; temperatures below 150 K count as 150 K."""
    density = pressure_hpa * lit(100) / (lit(DRY_AIR) * at_least(temp_k, 150.0))
    return -omega / at_least(density * lit(GRAVITY), 1e-6) * lit(100)


def unit_vector(u: Column, v: Column, least: float = 0.0) -> Column:
    """struct(u, v, speed): the direction is missing where speed is not above the least."""
    speed = F.hypot(u, v)
    return F.struct(F.when(speed > least, u / speed).alias("u"), F.when(speed > least, v / speed).alias("v"), speed.alias("speed"))


def convective_gust(c: dict[str, Column]) -> dict[str, Column]:
    """Potential convective gust: gust, potential and trigger of columns regular (km/h), dcape, li, cape, pbl, w850, w700,
    prate, omega700, temp700."""
    regular = c["regular"] / lit(3.6)
    mixed = ramp(c["pbl"], 300.0, 1800.0)
    momentum = F.greatest(regular, (lit(0.70) + lit(0.15) * mixed) * c["w850"], (lit(0.45) + lit(0.20) * mixed) * c["w700"])
    down = lit(0.35) * F.sqrt(at_least(lit(2) * c["dcape"], 0.0))
    total = F.sqrt(momentum * momentum + down * down)
    potential = F.when(total.isNotNull() & regular.isNotNull(), F.least(F.greatest(total, regular), lit(55))) * lit(3.6)
    environment = ramp(lit(1) - c["li"], 0.0, 5.0) * (lit(0.85) + lit(0.15) * ramp(c["cape"], 50.0, 800.0))
    active = F.greatest(ramp(vertical_velocity(c["omega700"], c["temp700"], lit(700)), 0.15, 0.75), ramp(c["prate"], 0.25, 2.5))
    trigger = clip(environment * active * ramp(c["dcape"], 150.0, 750.0), 0.0, 1.0)
    gust = c["regular"] + trigger * at_least(potential - c["regular"], 0.0)
    return {"gust": gust, "potential": potential, "trigger": trigger}


def multiplicative_gust(c: dict[str, Column], p: dict[str, Column]) -> Column:
    """The older form that only the sweep uses; p has its nine parameters."""
    down = F.sqrt(at_least(lit(2) * c["dcape"], 0.0))
    momentum = F.greatest(p["w850_coeff"] * c["w850"], p["w700_coeff"] * c["w700"])
    of_li = clip((p["li_start"] - c["li"]) / p["li_span"], 0.0, 1.0)
    of_pbl = clip((c["pbl"] - p["pbl_base_m"]) / p["pbl_span_m"], 0.0, 1.0)
    gust = lit(3.6) * of_li * of_pbl * (p["dcape_coeff"] * down + momentum)
    return F.when((c["dcape"] >= p["dcape_min"]) & (c["li"] <= p["li_gate"]), gust)


def rh_category(rh: Column) -> Column:
    return F.when(rh < 20, "very dry").when(rh <= 30, "dry").when(rh > 80, "very moist").when(rh >= 60, "moist")


def gust_category(kmh: Column) -> Column:
    return F.when(kmh < 40, "<40").when(kmh < 60, "40-60").when(kmh < 80, "60-80").when(kmh >= 80, ">=80")


def precip_category(mm: Column) -> Column:
    return F.when(mm >= 10, "heavy").when(mm >= 2.5, "moderate")


def lead_group(hours: Column) -> Column:
    return F.when((hours > -0.001) & (hours <= 18), "Day 0").when((hours > 18) & (hours <= 42), "Day 1").when((hours > 42) & (hours <= 72), "Day 2")
