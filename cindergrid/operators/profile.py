"""Ordered reductions of vertical profiles. A profile is a sorted array in one row: some twenty levels, never more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as P


def folded(levels: DataFrame, keys: list[str], order: Column, fields: list[str], extra: list[Column]) -> DataFrame:
    item = F.struct(order.alias("_o"), *fields)
    return levels.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("p"), *extra)


def at_height(levels: DataFrame, keys: list[str], target: str) -> DataFrame:
    """(keys, value): linear interpolation of (level, height, value) to target; layers of a metre or less and missing
    points are passed over, and above the top its value holds."""
    rows = folded(levels, keys, F.col("level"), ["height", "value"], [F.max(target).alias("t")])
    return with_height(rows, "p", "t", "value").select(*keys, "value")


def with_height(rows: DataFrame, points: str, target: str, out: str) -> DataFrame:
    """rows with out, their sorted array of points (height, value) interpolated as in ``at_height``."""
    first = F.struct(F.get(points, 0)["height"].alias("h"), F.get(points, 0)["value"].alias("v"), F.lit(None).cast("double").alias("r"))

    def step(a: Column, x: Column) -> Column:
        t, depth = F.col(target), x["height"] - a["h"]
        good = a["r"].isNull() & (depth > 1) & a["v"].isNotNull() & x["value"].isNotNull() & (t >= a["h"]) & (t <= x["height"])
        usable = x["height"].isNotNull() & x["value"].isNotNull() & (x["height"] > a["h"])
        r = F.when(good, a["v"] + F.try_divide(t - a["h"], depth) * (x["value"] - a["v"])).otherwise(a["r"])
        return F.struct(F.when(usable, x["height"]).otherwise(a["h"]).alias("h"), F.when(usable, x["value"]).otherwise(a["v"]).alias("v"), r.alias("r"))

    done = rows.withColumn("_a", F.aggregate(F.slice(points, 2, 1000), first, step))
    return done.withColumn(out, F.coalesce("_a.r", F.when(F.col(target) >= F.col("_a.h"), F.col("_a.v")))).drop("_a")


def inversions(levels: DataFrame, keys: list[str], surface: str, top_m: float = 3000.0, least_m: float = 100.0) -> DataFrame:
    """(keys, lapse, inverted): the deepest inversion of (level, height, temp) over the surface temperature."""
    rows = folded(levels, keys, F.col("level"), ["height", "temp"], [F.max(surface).alias("s")])
    return with_inversion(rows, "p", "s", top_m, least_m).select(*keys, "lapse", "inverted")


def with_inversion(rows: DataFrame, points: str, surface: str, top_m: float = 3000.0, least_m: float = 100.0) -> DataFrame:
    """rows with lapse and inverted, of their sorted array of points (height, temp); both missing where there is none."""
    n, none = P.lit, F.lit(None).cast("double")
    first = F.struct(n(2).alias("h"), F.col(surface).cast("double").alias("t"), n(0).alias("depth"), n(0).alias("best"), none.alias("top"), none.alias("top_t"))

    def step(a: Column, x: Column) -> Column:
        layer = x["height"] - a["h"]
        good = F.coalesce(x["temp"].isNotNull() & a["t"].isNotNull() & (layer >= 20) & (x["height"] <= top_m), F.lit(False))
        rises = good & F.coalesce(x["temp"] > a["t"], F.lit(False))
        depth = F.when(rises, a["depth"] + layer).otherwise(n(0))
        better = rises & (depth > a["best"])
        pick = lambda c, new, old: F.when(c, new).otherwise(old)
        return F.struct(
            pick(good, x["height"], a["h"]).alias("h"), pick(good, x["temp"], a["t"]).alias("t"), depth.alias("depth"), pick(better, depth, a["best"]).alias("best"),
            pick(better, x["height"], a["top"]).alias("top"), pick(better, x["temp"], a["top_t"]).alias("top_t"),
        )

    done = rows.withColumn("_a", F.aggregate(points, first, step))
    inverted = F.col("_a.best") >= least_m
    return done.withColumns({"lapse": F.when(inverted & (F.col("_a.top") > 2), (F.col("_a.top_t") - F.col(surface)) / (F.col("_a.top") - 2)), "inverted": inverted}).drop("_a")


def column_water(levels: DataFrame, keys: list[str], surface_pa: str) -> DataFrame:
    """(keys, ipw): trapezoids over (p_pa, q) from the top down, with a partial layer at the surface; layers below
    ground and missing ones count nothing; a missing surface pressure is a missing result."""
    w = Window.partitionBy(*keys).orderBy("p_pa")
    q = P.at_least(F.col("q"), 0.0)
    rows = levels.withColumns({"_q": q, "_pq": F.lag(q).over(w), "_pp": F.lag("p_pa").over(w)})
    above = F.col("p_pa") <= F.col(surface_pa)
    part = 0.5 * (F.col("_q") + F.col("_pq")) * (F.col("p_pa") - F.col("_pp")) / P.GRAVITY
    got = rows.groupBy(*keys).agg(
        F.max(surface_pa).alias("_s"), F.sum(F.when(above, part)).alias("_sum"), F.max_by(F.struct(F.col("p_pa").alias("p"), F.col("_q").alias("q")), F.when(above, F.col("p_pa"))).alias("_l"))
    base = F.coalesce(F.col("_l.q") * F.greatest(F.col("_s") - F.col("_l.p"), F.lit(0.0)) / P.GRAVITY, F.lit(0.0))
    return got.select(*keys, F.when(F.col("_s").isNotNull(), F.greatest(F.coalesce("_sum", F.lit(0.0)) + base, F.lit(0.0))).alias("ipw"))


def layer_depths(levels: DataFrame, keys: list[str], surface_hpa: str) -> DataFrame:
    """With upper, lower (midpoints between pressure levels, outer ones mirrored) and depth above ground of each level."""
    w = Window.partitionBy(*keys).orderBy(F.desc("p_hpa"))
    p, down, up = F.col("p_hpa"), F.lag("p_hpa").over(w), F.lead("p_hpa").over(w)
    rows = levels.withColumns({"_d": down, "_u": up})
    upper = F.coalesce((F.col("_d") + p) / 2, p + (p - F.col("_u")) / 2)
    lower = F.coalesce((p + F.col("_u")) / 2, p - (F.col("_d") - p) / 2)
    rows = rows.withColumns({"upper": upper, "lower": lower})
    depth = F.least(F.greatest(F.least(F.col(surface_hpa), F.col("upper")) - F.col("lower"), F.lit(0.0)), F.col("upper") - F.col("lower"))
    return rows.withColumn("depth", depth).drop("_d", "_u")


def charging(levels: DataFrame, keys: list[str], surface_hpa: str) -> DataFrame:
    """(keys, charge_factor, charge_rh, mid_rh) of levels (p_hpa, temp_c, rh)."""
    rows = layer_depths(levels, keys, surface_hpa)
    t, rh, depth = F.col("temp_c"), F.col("rh"), F.col("depth")
    good = t.isNotNull() & rh.isNotNull() & (depth > 0)
    z = (t + 15) / 5.5
    charge = F.when(good & t.between(-20, 0), F.exp(-0.5 * z * z) * depth).otherwise(0.0)
    middle = F.when(good & t.between(-30, -5), depth).otherwise(0.0)
    mean = lambda w: F.try_divide(F.sum(F.coalesce(rh, F.lit(0.0)) * w), F.sum(w))
    got = rows.groupBy(*keys).agg(mean(charge).alias("c"), F.sum(charge).alias("w"), mean(middle).alias("m"))
    factor = F.sqrt(P.clip(P.ramp(F.col("c"), 45.0, 80.0) * P.ramp(F.col("w"), 35.0, 150.0), 0.0, 1.0))
    return got.select(*keys, factor.alias("charge_factor"), P.clip(F.col("c"), 0.0, 100.0).alias("charge_rh"), P.clip(F.col("m"), 0.0, 100.0).alias("mid_rh"))


def sounding_ok(levels: DataFrame, keys: list[str], surface_hpa: str) -> DataFrame:
    """(keys, n_levels) of the soundings fit for downdraft energy: levels at or below the surface pressure, steps of
    0.05 hPa and more, six levels, the lowest at 700 hPa or more, the highest at 500 or less, the surface at 705 or more."""
    w = Window.partitionBy(*keys).orderBy(F.desc("p_hpa"))
    kept = levels.filter((F.col("p_hpa") <= F.col(surface_hpa)) & (F.col(surface_hpa) >= 705)).withColumn("_b", F.lag("p_hpa").over(w))
    kept = kept.filter(F.col("_b").isNull() | (F.col("_b") - F.col("p_hpa") >= 0.05))
    got = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_levels"), F.max("p_hpa").alias("_hi"), F.min("p_hpa").alias("_lo"))
    return got.filter("n_levels >= 6 and _hi >= 700 and _lo <= 500").select(*keys, "n_levels")
