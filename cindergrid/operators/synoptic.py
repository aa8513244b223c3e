"""The fields of a synoptic frame in the units that are shown, and features that meet an extent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLYGON = "array<struct<properties:struct<name:string>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"


def frame(fields: DataFrame) -> DataFrame:
    """One row a cell: vorticity in 1e-5/s, heights in km, pressure in kPa, temperature in C, wind in km/h, the land mask,
    lifted index and CAPE within their limits, and the mean humidity of 850 and 700 hPa where both are there."""
    c = F.col
    shown = {
        "vorticity_e5": c("absv") * 1.0e5, "height500_km": c("hgt500") / 1000.0, "pressure_kpa": c("prmsl_pa") / 1000.0, "temp_c": c("temp_k") - 273.15,
        "wind_kmh": F.sqrt(c("u") * c("u") + c("v") * c("v")) * 3.6, "land": c("terrain_m") > 0.5, "lifted_index": F.when(F.abs(c("li")) <= 50, c("li")),
        "cape": F.when((c("cape") >= 0) & (c("cape") < 20000), c("cape")), "rh_mean": 0.5 * (c("rh850") + c("rh700")),
    }
    keep = [x for x in fields.columns if x not in {"absv", "hgt500", "prmsl_pa", "temp_k", "u", "v", "terrain_m", "li", "cape", "rh850", "rh700"}]
    return fields.select(*keep, *[e.alias(k) for k, e in shown.items()])


def vertices(raw: DataFrame, column: str = "json") -> DataFrame:
    """(feature, name, ring, i, x, y, x2, y2): the edges of JSON arrays of polygons."""
    f = raw.select(F.monotonically_increasing_id().alias("_file"), F.posexplode(F.from_json(column, POLYGON)).alias("_n", "f"))
    rings = f.select(F.concat_ws("-", "_file", "_n").alias("feature"), F.col("f.properties.name").alias("name"), F.posexplode("f.geometry.coordinates").alias("ring", "r"))
    ends = F.arrays_zip(F.slice("r", F.lit(1), F.size("r") - 1).alias("a"), F.slice("r", F.lit(2), F.size("r") - 1).alias("b"))
    rows = rings.filter(F.size("r") > 1).select("feature", "name", "ring", F.posexplode(ends).alias("i", "e"))
    at = lambda p, i, k: F.get(F.col(f"e.{p}"), i).alias(k)
    return rows.select("feature", "name", "ring", "i", at("a", 0, "x"), at("a", 1, "y"), at("b", 0, "x2"), at("b", 1, "y2"))


def crosses(west: float, east: float, south: float, north: float) -> Column:
    """Whether the edge x, y, x2, y2 touches the extent: their boxes overlap, and its corners lie on both sides of the line."""
    x, y, x2, y2 = (F.col(k) for k in ("x", "y", "x2", "y2"))
    side = [(x2 - x) * (b - y) - (y2 - y) * (a - x) for a in (west, east) for b in (south, north)]
    low, high = F.least(*side), F.greatest(*side)
    return (F.least(x, x2) <= east) & (F.greatest(x, x2) >= west) & (F.least(y, y2) <= north) & (F.greatest(y, y2) >= south) & (low <= 0) & (high >= 0)


def features_in(edges: DataFrame, west: float, east: float, south: float, north: float) -> DataFrame:
    """(feature, name) of the polygons that meet the extent: an edge touches it, or they hold its corner (an odd number of
    edges lies east of it)."""
    x, y, x2, y2 = (F.col(k) for k in ("x", "y", "x2", "y2"))
    beside = ((y > south) != (y2 > south)) & (west < (x2 - x) * (south - y) / F.when(y2 != y, y2 - y) + x)
    got = edges.groupBy("feature", "name").agg(F.max(crosses(west, east, south, north)).alias("_t"), (F.count_if(F.coalesce(beside, F.lit(False))) % 2 == 1).alias("_h"))
    return got.filter(reduce(lambda a, b: a | b, [F.col("_t"), F.col("_h")])).select("feature", "name")
