"""Fields of one hour made from others: gust branches, vapour transport, layer means, vorticity, area shares, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as P

# What a field may be at most and least; beyond it is missing. Bounds are open where they are marked so.
GATES = {"li": (-50.0, 50.0, False), "cape": (0.0, 20000.0, True), "pbl": (0.0, 6000.0, False), "gust_ms": (0.0, 100.0, True), "helicity": (-5000.0, 5000.0, False)}
ANALYSIS_LIMITS = {"ffmc": (0.0, 101.0), "dmc": (0.0, 1000.0), "dc": (0.0, 2000.0), "fwi": (0.0, 500.0), "bui": (0.0, 1000.0)}
DRY_FLAG = 15.0
PRECIP_GRID_KM = 12.0


def gated(fields: DataFrame, gates: dict[str, tuple[float, float, bool]] | None = None) -> DataFrame:
    """Each field that has a gate, missing beyond it. An open gate leaves out its upper bound."""
    gates = GATES if gates is None else gates
    inside = lambda c, low, high, open_: (c >= low) & ((c < high) if open_ else (c <= high))
    return fields.withColumns({k: F.when(inside(F.col(k), *g), F.col(k)) for k, g in gates.items() if k in fields.columns})


def within_limits(analysis: DataFrame, component: str = "component", value: str = "value", limits: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """value of rows by component, missing outside the component's limits; components without limits are missing too."""
    ok = [(F.col(component) == k) & F.col(value).between(a, b) for k, (a, b) in (ANALYSIS_LIMITS if limits is None else limits).items()]
    found = F.lit(False)
    for c in ok:
        found = found | c
    return analysis.withColumn(value, F.when(found, F.col(value)))


def all_cause_gust(rows: DataFrame) -> DataFrame:
    """rows (fhour, regular, downslope, convective in km/h, increment: what the convective branch has above its own regular
    gust) with branches synoptic and triggered, and gust: the largest that is there; at hour 0 the regular one alone."""
    triggered = F.col("regular") + P.at_least(F.greatest(F.col("increment"), F.lit(0.0)), 0.0)
    rows = rows.withColumns({"synoptic": F.greatest("regular", "downslope"), "triggered": triggered})
    return rows.withColumn("gust", F.when(F.col("fhour") == 0, F.col("regular")).otherwise(F.greatest("synoptic", "triggered")))


def branch_shares(gusts: DataFrame, keys: list[str], material: float = 5.0) -> DataFrame:
    """(keys, downslope_share, triggered_share): per cent of the cells with a regular gust that a branch raises by more. All
    rows count with the branches that they have; which hours have any is for what makes them."""
    n = F.greatest(F.lit(1), F.count("regular"))
    share = lambda c: 100.0 * F.count_if(c) / n
    return gusts.groupBy(*keys).agg(
        share(F.col("downslope") > F.col("regular") + material).alias("downslope_share"), share(F.col("triggered") > F.col("synoptic") + material).alias("triggered_share"))


def column_transport(levels: DataFrame, keys: list[str], total: str, least_water: float = 0.1) -> DataFrame:
    """(keys, water, transport_u, transport_v) of levels (keys, p_hpa, q, u, v, total column water): trapezoids between the
    levels of a column, the transport scaled to the total; missing where a level lacks a value, or the layer has too little
    water to be scaled. One shuffle, by keys."""
    w = Window.partitionBy(*keys).orderBy(F.desc("p_hpa"))
    rows = levels.withColumns({"_qu": F.col("q") * F.col("u"), "_qv": F.col("q") * F.col("v")})
    depth = (F.col("p_hpa") - F.lead("p_hpa").over(w)) * 100.0 / P.GRAVITY
    layer = lambda c: 0.5 * (F.col(c) + F.lead(c).over(w)) * depth
    rows = rows.withColumns({f"_l{c}": layer(c) for c in ("q", "_qu", "_qv")})
    whole = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.coalesce(F.sum(f"_l{c}"), F.lit(0.0)))
    got = rows.groupBy(*keys).agg(whole("q").alias("_q"), whole("_qu").alias("_u"), whole("_qv").alias("_v"), F.max(total).alias("_t"))
    scale = F.when(F.col("_q") > least_water, F.col("_t") / F.col("_q"))
    return got.select(*keys, P.at_least(F.col("_q"), 0.0).alias("water"), (F.col("_u") * scale).alias("transport_u"), (F.col("_v") * scale).alias("transport_v"))


def transport_band(amount: Column) -> Column:
    return F.when(amount < 250, "<250").when(amount < 500, "250-499").when(amount < 750, "500-749").when(amount < 1000, "750-999").when(amount >= 1000, "1000+")


def layer_mean(levels: DataFrame, keys: list[str], value: str, level: str = "p_hpa", surface: str = "surface_p", ground: str | None = None) -> DataFrame:
    """(keys, mean) of the values on levels that lie above ground (level <= surface pressure), missing ones left out; with
    ground, a column that is equal within keys, its value counts as one level more."""
    above = F.when(F.col(surface) >= F.col(level), F.col(value))
    if ground is None:
        return levels.groupBy(*keys).agg(F.avg(above).alias("mean"))
    got = levels.groupBy(*keys).agg(F.sum(above).alias("_s"), F.count(above).alias("_n"), F.max(ground).alias("_g"))
    n = F.col("_n") + F.col("_g").isNotNull().cast("int")
    return got.select(*keys, F.when(n > 0, (F.coalesce("_s", F.lit(0.0)) + F.coalesce("_g", F.lit(0.0))) / n).alias("mean"))


def area_shares(cells: DataFrame, keys: list[str], value: str, levels: dict[str, float], lat: str = "lat") -> DataFrame:
    """(keys, a column a level): the share of the valid cells' area, by the cosine of latitude, at or above each level."""
    weight = F.when(F.col(value).isNotNull(), F.cos(F.radians(lat)))
    share = lambda x: F.coalesce(F.try_divide(F.sum(F.when(F.col(value) >= x, weight).otherwise(0.0)), F.sum(weight)), F.lit(0.0))
    return cells.groupBy(*keys).agg(*[share(x).alias(k) for k, x in levels.items()])


def absolute_vorticity(grid: DataFrame, keys: list[str], u: str = "u", v: str = "v") -> DataFrame:
    """grid (keys, iy, ix, lat, lon in degrees, u, v) with absv in 1/s on a regular grid; edges copy their neighbours."""
    row, col = Window.partitionBy(*keys, "iy").orderBy("ix"), Window.partitionBy(*keys, "ix").orderBy("iy")
    dx = P.EARTH_RADIUS_M * F.cos(F.radians("lat")) * F.radians(F.lead("lon").over(row) - F.lag("lon").over(row))
    dy = P.EARTH_RADIUS_M * F.radians(F.lead("lat").over(col) - F.lag("lat").over(col))
    g = grid.withColumns({"_dv": (F.lead(v).over(row) - F.lag(v).over(row)) / dx, "_du": (F.lead(u).over(col) - F.lag(u).over(col)) / dy})
    fill = lambda c, w: F.coalesce(F.col(c), F.lead(c).over(w), F.lag(c).over(w))
    return g.withColumn("absv", fill("_dv", row) - fill("_du", col) + 2 * P.EARTH_SPIN * F.sin(F.radians("lat"))).drop("_dv", "_du")


def terrain_wind(low: Column, high: Column, surface_hpa: Column, level: float = 850.0, margin: float = 35.0) -> Column:
    """The wind of the higher level where the ground reaches up to the lower one."""
    return F.when(surface_hpa <= level + margin, high).otherwise(low)
