"""Hourly fuel moisture per cell: an ordered fold over each cell's hours, without Python in the path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fold
from ..functions import physics as P

STATE = ("mcffmc", "mcdmc", "mcdc", "rain_total_mm", "canopy_drying_hours")


def bind(values: dict[str, Column], body) -> Column:
    """body over the named values, each of them evaluated once."""
    held = F.array(F.struct(*[v.alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(held, lambda r: body({k: r[k] for k in values})), 1)


def _fine_fuel(m: Column, temp: Column, rh: Column, wind: Column, rain: Column) -> Column:
    n = P.lit
    safe = F.when(rain > 0, rain).otherwise(n(1))
    delta = n(42.5) * rain * F.exp(n(-100) / (n(251) - m)) * (n(1) - F.exp(n(-6.93) / safe))
    delta = delta + F.when(m > 150, n(0.0015) * (m - n(150)) * (m - n(150)) * F.sqrt(rain)).otherwise(n(0))
    e1 = n(0.18) * (n(21.1) - temp) * (n(1) - F.exp(n(-0.115) * rh))
    wet = F.exp((rh - n(100)) / n(10))
    start = {
        "mo": F.when(rain > 0, F.least(m + delta, n(250))).otherwise(m),
        "ed": n(0.942) * F.pow(rh, n(0.679)) + n(11) * wet + e1,
        "ew": n(0.618) * F.pow(rh, n(0.753)) + n(10) * wet + e1,
    }

    def dry(v: dict[str, Column]) -> Column:
        a1 = F.when(v["mo"] > v["ed"], rh / n(100)).otherwise((n(100) - rh) / n(100))
        k0 = n(0.424) * (n(1) - F.pow(a1, n(1.7))) + n(0.0694) * F.sqrt(wind) * (n(1) - F.pow(a1, n(8)))
        rate = n(2 * 0.0579) * k0 * F.exp(n(0.0365) * temp)
        to = F.when(v["mo"] < v["ed"], v["ew"]).otherwise(v["ed"])
        return F.when(v["mo"] == v["ed"], v["mo"]).otherwise(to + (v["mo"] - to) * F.pow(n(10), -rate))

    return bind(start, dry)


def _duff(m: Column, temp: Column, rh: Column, precip: Column, light: Column, before: Column) -> Column:
    n = P.lit
    after = before + precip
    rw = F.when(before <= P.DMC_INTERCEPT_MM, n(0.92) * after - n(1.27)).otherwise(n(0.92) * precip)

    def of(v: dict[str, Column]) -> Column:
        code = v["code"]
        b = F.when(code <= 33, n(100) / (n(0.3) * code + n(0.5))).when(code <= 65, n(-1.3) * F.log(code) + n(14)).otherwise(n(6.2) * F.log(code) - n(17.2))
        wet = F.least(F.when(after > P.DMC_INTERCEPT_MM, m + n(1000) * rw / (b * rw + n(48.77))).otherwise(m), n(300))
        rate = n(2.22e-4) * F.greatest(temp, n(0)) * (n(100) - rh) / n(43.43)
        return F.least(F.when(light, (wet - n(20)) * F.exp(-rate) + n(20)).otherwise(wet), n(300))

    return bind({"code": n(43.43) * F.log(n(280) / F.greatest(m - n(20), n(1e-6)))}, of)


def _drought(m: Column, temp: Column, precip: Column, light: Column, before: Column) -> Column:
    n = P.lit
    after = before + precip
    rw = F.when(before <= P.DC_INTERCEPT_MM, n(0.83) * after - n(1.27)).otherwise(n(0.83) * precip)
    wet = F.least(F.when(after > P.DC_INTERCEPT_MM, m + n(3.937) * rw / n(2)).otherwise(m), n(400))
    pe = F.when(temp > 0, n(1.5e-2) * temp + n(3 / 16)).otherwise(n(0))
    return F.least(F.when(light, wet * F.exp(-pe / n(400))).otherwise(wet), n(400))


def _state(values: list[Column]) -> Column:
    return F.struct(*[v.cast("double").alias(k) for k, v in zip(STATE, values)])


def start_state(ffmc: float | Column = 85.0, dmc: float | Column = 6.0, dc: float | Column = 15.0) -> Column:
    col = lambda x: x if isinstance(x, Column) else P.lit(x)
    ffmc, dmc, dc = col(ffmc), col(dmc), col(dc)
    good = ffmc.isNotNull() & dmc.isNotNull() & dc.isNotNull()
    return _state([F.when(good, x) for x in (P.ffmc_moisture(ffmc), P.dmc_moisture(dmc), P.dc_moisture(dc), P.lit(0), P.lit(0))])


def next_state(s: Column, w: Column) -> Column:
    """The state after one hour w (temp_c, rh, wind_kmh, precip_mm, daylight); missing once an input is missing."""
    n = P.lit
    values = {
        "temp": w["temp_c"], "rh": P.clip(w["rh"], 0.0, 100.0), "wind": P.at_least(w["wind_kmh"], 0.0), "rain": P.at_least(w["precip_mm"], 0.0),
        "total": s["rain_total_mm"], "dry": F.when((w["precip_mm"] > 0) | (s["rain_total_mm"] == 0), n(0)).otherwise(s["canopy_drying_hours"] + n(1)),
    }

    def after(v: dict[str, Column]) -> Column:
        over = v["dry"] >= P.RESET_HOURS
        before, dry = F.when(over, n(0)).otherwise(v["total"]), F.when(over, n(0)).otherwise(v["dry"])
        total = before + v["rain"]
        through = F.when(total <= P.FFMC_INTERCEPT_MM, n(0)).when(before > P.FFMC_INTERCEPT_MM, v["rain"]).otherwise(total - n(P.FFMC_INTERCEPT_MM))
        good = s["mcffmc"].isNotNull() & v["temp"].isNotNull() & v["rh"].isNotNull() & v["wind"].isNotNull() & v["rain"].isNotNull()
        found = [_fine_fuel(s["mcffmc"], v["temp"], v["rh"], v["wind"], through), _duff(s["mcdmc"], v["temp"], v["rh"], v["rain"], w["daylight"], before), _drought(s["mcdc"], v["temp"], v["rain"], w["daylight"], before), total, dry]
        return _state([F.when(good, x) for x in found])

    return bind(values, after)


def evolve(hours: DataFrame, keys: list[str], order: str, start: Column | None = None) -> DataFrame:
    """Each hour of hours (keys, order, temp_c, rh, wind_kmh, precip_mm, daylight) with its state and the six codes.
    One shuffle by keys; a cell's hours (49 of a run, or a whole history) form one array, whose states are gathered in chunks."""
    inputs = ["temp_c", "rh", "wind_kmh", "precip_mm", "daylight"]
    rows = hours.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *inputs))).alias("h"))
    kind = f"struct<{','.join(k + ':double' for k in STATE)}>"
    after = fold.states(F.col("h"), start if start is not None else start_state(), next_state, kind)
    rows = rows.select(*keys, F.inline(F.arrays_zip(F.col("h"), after.alias("s"))))
    rows = rows.select(*keys, "h.*", "s.*")
    rows = rows.withColumns({"ffmc": P.ffmc_code(F.col("mcffmc")), "dmc": P.dmc_code(F.col("mcdmc")), "dc": P.dc_code(F.col("mcdc"))})
    good = F.col("mcffmc").isNotNull()
    rows = rows.withColumns({"isi": F.when(good, P.spread_index(F.col("ffmc"), F.col("wind_kmh"))), "bui": F.when(good, P.buildup_index(F.col("dmc"), F.col("dc")))})
    return rows.withColumn("fwi", F.when(good, P.fire_weather_index(F.col("isi"), F.col("bui"))))
