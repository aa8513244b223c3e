"""Daily moisture codes with winters, hourly fine-fuel code, and their carry-over between runs (the older system)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fold
from ..functions import physics as P
from .moisture import bind

# Start-up codes, and day-length factors by month from January.
START = {"f": 85.0, "p": 6.0, "d": 15.0}
DUFF_DAY = [6.5, 7.5, 9.0, 12.8, 13.9, 13.9, 12.4, 10.9, 9.4, 8.0, 7.0, 6.0]
DROUGHT_DAY = [-1.6, -1.6, -1.6, 0.9, 3.8, 5.8, 6.4, 5.0, 2.4, 0.4, -1.6, -1.6]
CODES = ("f", "p", "d", "df")
n = P.lit


def by_month(month: Column, values: list[float]) -> Column:
    return F.get(F.array(*map(n, values)), month.cast("int") - 1)


def moisture_147(code: Column) -> Column:
    return n(147.2) * (n(101) - code) / (n(59.5) + code)


def wetted(moisture: Column, rain: Column) -> Column:
    """Fine-fuel moisture after rain, 0.1 to 250."""
    r = F.when(rain > 0.5, rain - n(0.5)).when(rain < 1e-7, n(1e-5)).otherwise(rain)
    wet = moisture + n(42.5) * r * F.exp(n(-100) / (n(251) - moisture)) * (n(1) - F.exp(n(-6.93) / r))
    wet = F.when(moisture > 150, wet + n(0.0015) * (moisture - n(150)) * (moisture - n(150)) * F.sqrt(r)).otherwise(wet)
    return F.when(wet > 250, n(250)).when(wet < 0, n(0.1)).otherwise(wet)


def dried(moisture: Column, temp: Column, rh: Column, wind: Column, daily: bool) -> Column:
    """Moisture after one day or one hour of drying or wetting towards its equilibrium."""
    shared = n(0.18) * (n(21.1) - temp) * (n(1) - F.exp(n(-0.115) * rh))
    ed = n(0.942) * F.pow(rh, n(0.679)) + n(11) * F.exp((rh - n(100)) / n(10)) + shared
    ew = n(0.618) * F.pow(rh, n(0.753)) + n(10) * F.exp((rh - n(100)) / n(10)) + shared
    share = lambda h: n(0.424) * (n(1) - F.pow(h, n(1.7))) + n(0.0694) * F.sqrt(wind) * (n(1) - F.pow(h, n(8)))
    heat = (n(0.581) if daily else n(0.0579)) * F.exp(n(0.0365) * temp)
    left = lambda k: F.pow(n(10), -k) if daily else F.exp(n(-2.303) * k)

    def settle(v: dict[str, Column]) -> Column:
        down = v["ed"] + (v["m"] - v["ed"]) * left(share(rh / n(100)) * heat)
        up = v["ew"] - (v["ew"] - v["m"]) * left(share((n(100) - rh) / n(100)) * heat)
        return F.when(v["m"] > v["ed"], down).when(v["m"] >= v["ew"], v["m"]).otherwise(up)

    return bind({"m": moisture, "ed": ed, "ew": ew}, settle)


def _fine(code: Column, w: Column) -> Column:
    m = dried(wetted(moisture_147(code), w["rain"]), w["temp"], w["rh"], w["wind"], daily=True)
    return bind({"f": n(59.5) * (n(250) - m) / (n(147.2) + m)}, lambda v: F.when(v["f"] < 1, n(1)).otherwise(v["f"]))


def _duff(code: Column, w: Column) -> Column:
    def rained(v: dict[str, Column]) -> Column:
        wet = n(20) + n(280) / F.exp(n(0.023) * code) + n(1000) * v["r"] / (n(48.77) + v["b"] * v["r"])
        return F.when(w["rain"] <= 1.5, code).otherwise(n(43.43) * (n(5.6348) - F.log(wet - n(20))))

    b = F.when(code <= 33, n(100) / (n(0.5) + n(0.3) * code)).when(code <= 65, n(14) - n(1.3) * F.log(code)).otherwise(n(6.2) * F.log(code) - n(17.2))
    after = P.at_least(bind({"b": b, "r": n(0.92) * w["rain"] - n(1.27)}, rained), 0.0)
    gain = n(1.894) * (P.at_least(w["temp"], -1.1) + n(1.1)) * (n(100) - w["rh"]) * by_month(w["month"], DUFF_DAY) * n(1e-4)
    return P.at_least(after + gain, START["p"])


def _drought(code: Column, w: Column) -> Column:
    wet = code - n(400) * F.log(n(1) + n(3.937) * (n(0.83) * w["rain"] - n(1.27)) / (n(800) * F.exp(-code / n(400))))
    after = F.when(w["rain"] <= 2.8, code).otherwise(P.at_least(wet, 0.0))
    lost = P.at_least(n(0.36) * (P.at_least(w["temp"], -2.8) + n(2.8)) + by_month(w["month"], DROUGHT_DAY), 0.0)
    return P.at_least(after + lost * n(0.5), START["d"])


def spring_drought(fall: Column, winter_rain: Column, carry: float = 1.0, wetting: float = 0.75) -> Column:
    """The drought code at the onset of summer, of the one at the last onset of winter and the rain since."""
    held = n(carry) * n(800) * F.exp(-fall / n(400)) + n(wetting) * n(3.94) * winter_rain
    return n(400) * F.log(n(800) / held)


def _state(values: list[Column]) -> Column:
    return F.struct(*[v.cast("double").alias(k) for k, v in zip(CODES, values)])


def next_day(s: Column, w: Column) -> Column:
    """The codes after day w (temp, rh, wind, rain, month, onset 1 summer | -1 winter | else, winter_rain). A missing
    weather value makes that day's codes and all later ones missing."""
    summer, winter = F.coalesce(w["onset"] == 1, F.lit(False)), F.coalesce(w["onset"] == -1, F.lit(False))
    known = w["temp"].isNotNull() & w["rh"].isNotNull() & w["wind"].isNotNull() & w["rain"].isNotNull()
    before = {
        "f": F.when(summer, n(START["f"])).otherwise(s["f"]), "p": F.when(summer, n(START["p"])).otherwise(s["p"]),
        "d": P.at_least(F.when(summer, spring_drought(s["df"], F.coalesce(w["winter_rain"], n(0)))).otherwise(s["d"]), START["d"]),
    }

    def after(v: dict[str, Column]) -> Column:
        found = [_fine(v["f"], w), _duff(v["p"], w), _drought(v["d"], w)]
        return _state([*[F.when(known, x) for x in found], F.when(winter, v["d"]).otherwise(s["df"])])

    return bind(before, after)


def start(f: Column | None = None, p: Column | None = None, d: Column | None = None, df: Column | None = None) -> Column:
    d = n(START["d"]) if d is None else d
    return _state([n(START["f"]) if f is None else f, n(START["p"]) if p is None else p, d, d if df is None else df])


def daily_codes(days: DataFrame, keys: list[str], order: str, first: Column | None = None) -> DataFrame:
    """Each day (keys, order, temp, rh, wind, rain, month, onset, winter_rain) with f, p, d, df and the indices r, u, s and
    the severity. One shuffle by keys; a cell's days of a season form one array. The start may be a column of keys."""
    inputs = ["temp", "rh", "wind", "rain", "month", "onset", "winter_rain"]
    rows = days.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, *inputs))).alias("h"))
    kind = f"struct<{','.join(k + ':double' for k in CODES)}>"
    after = fold.states(F.col("h"), start() if first is None else first, next_day, kind)
    rows = rows.select(*keys, F.inline(F.arrays_zip("h", after.alias("s")))).select(*keys, "h.*", "s.*")
    return with_indices(rows)


def with_indices(rows: DataFrame, f: str = "f", p: str = "p", d: str = "d", wind: str = "wind") -> DataFrame:
    rows = rows.withColumns({"r": spread(F.col(f), F.col(wind)), "u": buildup(F.col(p), F.col(d))})
    rows = rows.withColumn("s", weather_index(F.col("r"), F.col("u")))
    return rows.withColumn("severity", n(0.0272) * F.pow(F.col("s"), n(1.77)))


def spread(f: Column, wind: Column, capped: bool = False) -> Column:
    m = moisture_147(f)
    of_wind = F.exp(n(0.05039) * wind)
    if capped:
        of_wind = F.when(wind >= 40, n(12) * (n(1) - F.exp(n(-0.0818) * (wind - n(28))))).otherwise(of_wind)
    return n(0.208) * of_wind * fine_function(m)


def fine_function(m: Column) -> Column:
    return n(91.9) * F.exp(n(-0.1386) * m) * (n(1) + F.pow(m, n(5.31)) / n(4.93e7))


def buildup(p: Column, d: Column) -> Column:
    low = n(0.8) * p * d / (p + n(0.4) * d)
    high = p - (n(1) - n(0.8) * d / (p + n(0.4) * d)) * (n(0.92) + F.pow(n(0.0114) * p, n(1.7)))
    found = F.when(p + d == 0, n(0)).when(p <= n(0.4) * d, low).otherwise(high)
    return F.when(found < 0, n(1)).otherwise(found)


def weather_index(r: Column, u: Column) -> Column:
    fuel = F.when(u > 80, n(1000) / (n(25) + n(108.64) * F.exp(n(-0.023) * u))).otherwise(n(0.626) * F.pow(u, n(0.809)) + n(2))
    base = P.at_least(n(0.1) * r * fuel, 1e-6)
    return F.when(base <= 1, base).otherwise(F.exp(n(2.72) * F.pow(n(0.434) * F.log(P.at_least(base, 1.0)), n(0.647))))


def hourly_fine_fuel(hours: DataFrame, keys: list[str], order: str, first: Column | None = None) -> DataFrame:
    """Each hour (keys, order, temp, rh, wind, rain) with moisture (after the hour's rain) and the fine-fuel code f."""
    rows = hours.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(order, "temp", "rh", "wind", "rain"))).alias("h"))
    pair = lambda m, f: F.struct(m.cast("double").alias("moisture"), f.cast("double").alias("f"))

    def step(s: Column, w: Column) -> Column:
        def after(v: dict[str, Column]) -> Column:
            m = dried(v["wet"], w["temp"], w["rh"], w["wind"], daily=False)
            code = bind({"f": n(59.5) * (n(250) - m) / (n(147.27723) + m)}, lambda x: F.when(x["f"] < 0, n(1)).otherwise(x["f"]))
            return pair(v["wet"], code)

        return bind({"wet": wetted(moisture_147(s["f"]), w["rain"])}, after)

    start_pair = pair(F.lit(None), n(START["f"]) if first is None else first)
    states = fold.states(F.col("h"), start_pair, step, "struct<moisture:double,f:double>")
    return rows.select(*keys, F.inline(F.arrays_zip("h", states.alias("s")))).select(*keys, "h.*", "s.*")


def carried_over(wanted: DataFrame, stored: DataFrame, keys: list[str], day: str, required: bool = False) -> DataFrame:
    """wanted (keys, day) with the codes stored for the day before, else two days before, else the start-up codes, and
    carried: 1, 2 or null. With required, a row without stored codes is an error."""
    w = wanted.select(*keys, day).distinct().withColumn("carried", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("_d", F.date_sub(F.col(day), F.col("carried")))
    codes = stored.select(*keys, F.col(day).alias("_d"), F.struct(*[F.col(c).cast("double").alias(c) for c in CODES]).alias("_c"))
    best = w.join(codes, [*keys, "_d"]).groupBy(*keys, day).agg(F.min_by(F.struct("carried", "_c"), "carried").alias("m"))
    got = wanted.join(best, [*keys, day], "left")
    if required:
        found = F.when(F.col("m").isNull(), F.raise_error(F.lit("no stored codes of the two days before")).cast("double"))
        got = got.withColumn("m", F.when(F.col("m").isNotNull() | found.isNull(), F.col("m")))
    return got.select(*[F.col(c) for c in wanted.columns], F.col("m.carried").alias("carried"), F.coalesce("m._c", start()).alias("codes"))
