"""The all-cause gust as one plan: from level tables and a thinned convective gust to the gust of every cell."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fields, grid, profile


def upsampled(cells: DataFrame, coarse: DataFrame, keys: list[str], value: str, stride: int, least_weight: float = 0.2) -> DataFrame:
    """cells (keys, iy, ix) with value of coarse (keys, iy, ix, value), which has every stride-th row and column and the last
    ones: bilinear between the four around, of those that are there, where their weight is above least_weight. The corners of
    a block of cells meet in one row, which its cells look up."""
    last = cells.groupBy(*keys).agg(F.max("iy").alias("_y1"), F.max("ix").alias("_x1"))
    known = coarse.select(*keys, F.col("iy").cast("long"), F.col("ix").cast("long"), F.col(value).alias("_v")).filter("_v is not null")
    known = known.join(F.broadcast(last), keys).filter("iy <= _y1 and ix <= _x1")  # a row a grid

    def ends(c: str, top: str):
        low = F.floor(F.col(c) / stride) * stride
        at = lambda x, end: F.struct(x.alias("at"), F.lit(end).alias("end"))
        return F.explode(F.when(F.col(c) == low, F.array(at(low, 0), at(low - stride, 1))).when(F.col(c) == F.col(top), F.array(at(low, 1))))

    ways = [(a, b) for a in (0, 1) for b in (0, 1)]
    mine = lambda a, b: F.when((F.col("_a.end") == a) & (F.col("_b.end") == b), F.col("_v"))
    blocks = known.withColumn("_a", ends("iy", "_y1")).withColumn("_b", ends("ix", "_x1")).groupBy(*keys, F.col("_a.at").alias("_cy"), F.col("_b.at").alias("_cx")).agg(
        F.max("_y1").alias("_y1"), F.max("_x1").alias("_x1"), *[f(mine(a, b)).alias(f"_{n}{a}{b}") for a, b in ways for n, f in (("s", F.sum), ("n", F.count))])
    rows = cells.withColumns({"_cy": F.floor(F.col("iy") / stride) * stride, "_cx": F.floor(F.col("ix") / stride) * stride}).join(blocks.hint("merge"), [*keys, "_cy", "_cx"], "left")

    def share(c: str, low: str, top: str):
        high = F.least(F.col(low) + stride, F.col(top))
        return F.when(high > F.col(low), (F.col(c) - F.col(low)) / (high - F.col(low))).otherwise(0.0)

    rows = rows.withColumns({"_y": share("iy", "_cy", "_y1"), "_x": share("ix", "_cx", "_x1")})
    rows = rows.withColumns({f"_w{a}{b}": (F.col("_y") if a else 1 - F.col("_y")) * (F.col("_x") if b else 1 - F.col("_x")) for a, b in ways})
    there = lambda k, c: F.when((F.col(f"_n{k}") > 0) & (F.col(f"_w{k}") > 0), F.col(f"_w{k}") * F.col(c)).otherwise(0.0)
    total = lambda n: reduce(add, [there(f"{a}{b}", f"_{n}{a}{b}") for a, b in ways])
    rows = rows.withColumns({"_s": total("s"), "_k": total("n")})
    return rows.select(*cells.columns, F.when(F.col("_k") > least_weight, F.col("_s") / F.col("_k")).alias(value))


def whole(cells: DataFrame, levels: DataFrame, coarse: DataFrame, keys: list[str], spacing: float, stride: int, radius_km: float = 10.0) -> DataFrame:
    """cells with downslope, increment, synoptic, triggered and gust.

    cells: (keys, fhour among them, iy, ix, terrain, regular, strongest, surface_t, u10, v10); levels: (keys, iy, ix, level,
    height above the sea, temp, u, v), the lowest first; coarse: (keys, iy, ix, convective), thinned by stride. The height
    of the ridge is the largest terrain within radius_km; the winds there come from the profile over the wind at 10 m, the
    stability from the deepest inversion; the convective branch is what it has over the regular gust, upsampled. Branches are
    made for hours other than 0, where the gust is the regular one.

    The cells go through the chain as one table whose rows gain columns, and a cell's levels are folded once: joining results
    back by cell would plan, and hold on the driver, the steps before it once more for each."""
    at, branched = [*keys, "iy", "ix"], cells.filter("fhour <> 0")
    extra = coarse.filter("fhour <> 0").join(branched.select(*at, "regular").hint("merge"), at).withColumn("increment", F.when(F.col("convective").isNotNull() & F.col("regular").isNotNull(), F.greatest(F.col("convective") - F.col("regular"), F.lit(0.0))))
    more = [c for c in cells.columns if c not in (*at, "terrain", "regular", "strongest", "surface_t", "u10", "v10")]  # whatever their names
    rows = branched.withColumn("_more", F.struct(*more)).drop(*more) if more else branched
    rows = upsampled(rows, extra.select(*at, "increment"), keys, "increment", stride)
    size = 2 * max(1, math.ceil(radius_km * 1000 / spacing)) + 1
    rows = grid.moving_max(rows.withColumn("_ridge", F.col("terrain")), keys, "_ridge", size)
    rows = rows.withColumn("_target", F.greatest(F.lit(10.0), F.col("_ridge") - F.col("terrain")))
    rows = rows.join(profile.folded(levels.filter("fhour <> 0"), at, F.col("level"), ["height", "temp", "u", "v"], []).hint("merge"), at, "left")
    above = lambda c, name: F.transform("p", lambda x: F.struct(x["_o"].alias("_o"), (x["height"] - F.col("terrain")).alias("height"), x[c].alias(name)))
    for name, low in (("u", "u10"), ("v", "v10")):
        ground = F.array(F.struct(F.lit(-1).cast("long").alias("_o"), F.lit(10.0).alias("height"), F.col(low).alias("value")))
        rows = rows.withColumn(f"_{name}", F.sort_array(F.when(F.col("p").isNull(), ground).otherwise(F.concat(ground, above(name, "value")))))
        rows = profile.with_height(rows, f"_{name}", "_target", name)
    rows = profile.with_inversion(rows.withColumn("_t", F.sort_array(above("temp", "temp"))), "_t", "surface_t")
    rows = grid.downslope_gust(rows.drop("p", "_u", "_v", "_t", "_ridge", "_target"), keys, spacing, radius_km).withColumn("downslope", F.col("gust"))
    none = F.lit(None).cast("double")
    first = cells.filter("fhour = 0").withColumns({"downslope": none, "increment": none})
    return fields.all_cause_gust(rows.select(*[F.col(f"_more.{c}") if c in more else c for c in cells.columns], "downslope", "increment").unionByName(first))
