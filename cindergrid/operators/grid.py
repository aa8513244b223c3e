"""Neighbourhood operators and regridding on long grid tables (keys, iy, ix, value).

Focal passes are separable: one over the rows of a column, one over the columns of a row, each a window shuffled by
(keys, line). At an edge the nearest cell is repeated, as often as the window sticks out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINES = (("ix", "iy"), ("iy", "ix"))  # of a separable pass: the key of a line, and what runs along it


def crop(grid: DataFrame, inside: Column, pad: int = 8) -> DataFrame:
    """The index box around the cells where inside holds, widened by pad; an empty box is an error."""
    box = grid.filter(inside).agg(F.min("iy").alias("y0"), F.max("iy").alias("y1"), F.min("ix").alias("x0"), F.max("ix").alias("x1"))
    checked = box.withColumn("y0", F.when(F.col("y0").isNull(), F.raise_error(F.lit("no cell lies in the extent")).cast("long")).otherwise(F.col("y0")))
    near = F.col("iy").between(F.col("y0") - pad, F.col("y1") + pad) & F.col("ix").between(F.col("x0") - pad, F.col("x1") + pad)
    return grid.join(F.broadcast(checked), near).drop("y0", "y1", "x0", "x1")  # the box is one row


def thin(grid: DataFrame, stride: int, keep_last: bool = True) -> DataFrame:
    """Every stride-th row and column; with keep_last the last ones too."""
    if not keep_last:
        return grid.filter((F.col("iy") % stride == 0) & (F.col("ix") % stride == 0))
    last = grid.agg(F.max("iy").alias("y1"), F.max("ix").alias("x1"))
    kept = ((F.col("iy") % stride == 0) | (F.col("iy") == F.col("y1"))) & ((F.col("ix") % stride == 0) | (F.col("ix") == F.col("x1")))
    return grid.join(F.broadcast(last), kept).drop("y1", "x1")  # one row


def stride_for(target_km: float, resolution_km: float, minimum: int = 1) -> Column:
    return F.greatest(F.lit(minimum), F.rint(F.lit(target_km / resolution_km)).cast("int"))


def sigma_for(target_km: float, resolution_km: float, minimum: float = 0.55) -> float:
    return max(minimum, target_km / resolution_km)


def _pass(df: DataFrame, keys: list[str], line: str, along: str, r: int, weights: list[float], columns: list[str]) -> DataFrame:
    """Weighted sums over along-r..along+r of each line; beyond an end its last value counts."""
    lane = Window.partitionBy(*keys, line).orderBy(along)
    whole = lane.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = {f"_{c}{e}": f(c).over(whole) for c in columns for e, f in (("0", F.first), ("1", F.last))}
    df = df.withColumns(ends)

    def total(c: str) -> Column:
        out = F.col(c) * weights[0]
        for k in range(1, r + 1):
            lo, hi = F.coalesce(F.lag(c, k).over(lane), F.col(f"_{c}0")), F.coalesce(F.lead(c, k).over(lane), F.col(f"_{c}1"))
            out = out + (lo + hi) * weights[k]
        return out

    return df.withColumns({c: total(c) for c in columns}).drop(*ends)


def _normalised(grid: DataFrame, keys: list[str], value: str, r: int, weights: list[float]) -> DataFrame:
    df = grid.withColumns(_weighed(value))
    for line, along in LINES:
        df = _pass(df, keys, line, along, r, weights, ["_v", "_w"])
    return df.withColumn(value, F.when(F.col("_w") > 1e-12, F.col("_v") / F.col("_w"))).drop("_v", "_w")


def _weighed(value: str) -> dict[str, Column]:
    good = F.col(value).isNotNull()
    return {"_v": F.when(good, F.col(value)).otherwise(0.0).cast("double"), "_w": good.cast("double")}


def gaussian(grid: DataFrame, keys: list[str], value: str, sigma: float) -> DataFrame:
    """Missing values weigh nothing and are filled where any weight reaches; the kernel ends at four sigma."""
    r = int(4 * sigma + 0.5)
    kernel = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(r + 1)]
    total = kernel[0] + 2 * sum(kernel[1:])
    return _normalised(grid, keys, value, r, [k / total for k in kernel])


def box_mean(grid: DataFrame, keys: list[str], value: str, size: int) -> DataFrame:
    if size % 2 == 0:
        raise ValueError("the size of a centred box is odd")
    return _normalised(grid, keys, value, size // 2, [1 / size] * (size // 2 + 1))


def moving_max(grid: DataFrame, keys: list[str], value: str, size: int) -> DataFrame:
    for line, along in LINES:
        grid = grid.withColumn(value, _line_max(keys, line, along, value, size))
    return grid


def _line_max(keys: list[str], line: str, along: str, value: str, size: int) -> Column:
    return F.max(value).over(Window.partitionBy(*keys, line).orderBy(along).rowsBetween(-(size // 2), size // 2))


def gradient(grid: DataFrame, keys: list[str], value: str, out: str, along: str, spacing: float = 1.0) -> DataFrame:
    """Central differences along iy or ix, one-sided at the ends."""
    w = Window.partitionBy(*keys, "ix" if along == "iy" else "iy").orderBy(along)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    begins, ends = F.lag(F.lit(1)).over(w).isNull(), F.lead(F.lit(1)).over(w).isNull()
    inside = (after - before) / (2.0 * spacing)
    return grid.withColumn(out, F.when(begins, (after - F.col(value)) / spacing).when(ends, (F.col(value) - before) / spacing).otherwise(inside))


def peaks(grid: DataFrame, keys: list[str], terrain: str, spacing: float) -> DataFrame:
    """With slope_x, slope_y and is_peak (Hessian test of a local maximum). Three shuffles: what goes along the same lines is together."""
    g = gradient(gradient(grid, keys, terrain, "slope_y", "iy", spacing), keys, "slope_y", "_dyy", "iy", spacing)
    g = gradient(gradient(g, keys, terrain, "slope_x", "ix", spacing), keys, "slope_x", "_dxx", "ix", spacing)
    g = gradient(g, keys, "slope_x", "_dxy", "iy", spacing)
    det = F.col("_dxx") * F.col("_dyy") - F.col("_dxy") * F.col("_dxy")
    return g.withColumn("is_peak", F.coalesce((det > 0) & (F.col("_dxx") < 0) & (F.col("_dyy") < 0), F.lit(False))).drop("_dyy", "_dxx", "_dxy")


def downslope_gust(grid: DataFrame, keys: list[str], spacing: float, radius_km: float = 10.0) -> DataFrame:
    """gust of columns regular, strongest, terrain, u, v, lapse, inverted (boolean): raised where wind crosses a steep
    slope downwards in stable air with an inversion near a peak."""
    size = 2 * max(1, math.ceil(radius_km * 1000 / spacing)) + 1
    g = peaks(grid, keys, "terrain", spacing)
    g = g.withColumns({"_over": (F.col("is_peak") & F.coalesce("inverted", F.lit(False))).cast("int"), **_weighed("lapse")})
    for line, along in LINES:  # a moving maximum and a box mean, a shuffle for both
        g = g.withColumn("_over", _line_max(keys, line, along, "_over", size))
        g = _pass(g, keys, line, along, size // 2, [1 / size] * (size // 2 + 1), ["_v", "_w"])
    g = g.withColumn("lapse", F.when(F.col("_w") > 1e-12, F.col("_v") / F.col("_w"))).drop("_v", "_w")
    across = F.col("u") * F.col("slope_x") + F.col("v") * F.col("slope_y")
    steep = F.sqrt(F.col("slope_x") * F.col("slope_x") + F.col("slope_y") * F.col("slope_y"))
    mask = F.coalesce((across < -0.1) & (steep >= 0.01) & (F.col("lapse") >= -0.006) & (F.col("_over") == 1), F.lit(False))
    ratio = F.col("strongest") / F.greatest(F.col("regular"), F.lit(1.0))
    candidate = F.when(ratio < 1.5, F.col("strongest")).otherwise(0.5 * (F.col("regular") + F.col("strongest")))
    return g.withColumns({"slope_index": across, "mask": mask, "gust": F.when(mask, F.greatest("regular", candidate)).otherwise(F.col("regular"))}).drop("_over")


def fill_nearest(grid: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Missing cells take the value of the nearest cell that has one (ties: smaller iy, then ix). A distance transform in two
    passes, linear in the raster: windows find the nearest known cell of each column for every line that lacks values, then
    each such line, by itself, finds its cells' columns (see ``lines``). The table may leave cells out. A grid (keys) without
    any known cell stays missing."""
    plain = grid.withColumn("_k", F.lit(0))  # a key where there is none
    keys, known = [*keys, "_k"], F.col(value).isNotNull()
    have = plain.filter(known).select(*keys, "iy", "ix", F.struct(F.col("iy").alias("y"), F.col(value).alias("v")).alias("_at"))
    todo = plain.filter(~known).select(*keys, "iy", "ix")
    every = todo.select(*keys, "iy").distinct().join(have.select(*keys, "ix").distinct(), keys)  # cells of the raster
    both = have.withColumn("_ask", F.lit(False)).unionByName(every.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    up, down = Window.partitionBy(*keys, "ix").orderBy("iy", "_ask"), Window.partitionBy(*keys, "ix").orderBy(F.desc("iy"), "_ask")
    near = both.withColumn("_a", F.last("_at", ignorenulls=True).over(up)).withColumn("_b", F.last("_at", ignorenulls=True).over(down)).filter("_ask")
    above = F.coalesce(F.col("iy") - F.col("_a.y") <= F.col("_b.y") - F.col("iy"), F.col("_b").isNull())
    columns = near.select(*keys, "iy", "ix", F.inline(F.array(F.when(above, F.col("_a")).otherwise(F.col("_b")))))
    kind = {f.name: f.dataType.simpleString() for f in have.select(*keys, "iy", "ix", F.col("_at.v").alias("v")).schema}
    rows = columns.unionByName(todo.join(have.select(*keys).distinct(), keys, "left_semi"), allowMissingColumns=True)
    found = rows.groupBy(*keys, "iy").applyInArrow(_line(keys), ", ".join(f"`{c}` {kind[c]}" for c in [*keys, "iy", "ix", "v"]))
    return plain.join(found.withColumnRenamed("v", "_v"), [*keys, "iy", "ix"], "left").withColumn(value, F.coalesce(F.col(value), F.col("_v"))).select(*grid.columns)


def _line(keys: list[str]):
    """Of a line's columns (ix, y, v: the nearest known cell of each) and missing cells (y null): the cells with their v."""

    def made(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("ix")
        y = table.column("y")
        ask = y.is_null().to_numpy()
        x, cells, columns = table.column("ix").to_numpy(), np.flatnonzero(ask), np.flatnonzero(~ask)
        y = y.take(pa.array(columns)).to_numpy()
        order = np.lexsort((x[columns], y))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = lines(x[cells], x[columns], (y - table.column("iy")[0].as_py()) ** 2 * len(order) + rank)
        return table.select([*keys, "iy", "ix"]).take(pa.array(cells)).append_column("v", table.column("v").take(pa.array(columns[at])))

    return made


def lines(x: np.ndarray, at: np.ndarray, height: np.ndarray) -> np.ndarray:
    """For each x the index i with the least (x - at[i])^2 * n + height[i], for n sorted at with heights that rank ties apart.
    The index grows with x, so every other x is bounded by its neighbours: log(n) rounds, each linear."""
    n, m = len(at), len(x)
    best = np.zeros(m, np.int64)
    step = 1 << max(0, m - 1).bit_length()
    while step:
        mine = np.arange(step - 1, m, 2 * step)  # those between mine are done, or come later
        low = np.where(mine >= step, best[np.maximum(mine - step, 0)], 0)
        high = np.where(mine + step < m, best[np.minimum(mine + step, m - 1)], n - 1)
        size = high - low + 1
        begin = np.cumsum(size) - size
        i = np.repeat(low - begin, size) + np.arange(size.sum())
        cost = (np.repeat(x[mine], size) - at[i]) ** 2 * n + height[i]
        least = np.repeat(np.minimum.reduceat(cost, begin), size) if len(mine) else cost
        hit = np.flatnonzero(cost == least)
        best[mine] = i[hit]
        step //= 2
    return best


def regrid_nearest(points: DataFrame, raster: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
    """points (x, y, ...) with the raster's (row, col, value) by rounding; outside, value is null."""
    at = points.withColumns({"row": F.rint((F.col("y") - y0) / dy).cast("long"), "col": F.rint((F.col("x") - x0) / dx).cast("long")})
    return at.join(raster, ["row", "col"], "left")


def bilinear(points: DataFrame, grid: DataFrame, least_weight: float | None = None) -> DataFrame:
    """points (id, fy, fx in index units) with value from the four cells around; any missing one makes it missing. With
    least_weight, present cells are weighed alone and the value is kept where their weight is above it."""
    y, x = F.floor("fy"), F.floor("fx")
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    c = points.withColumns({"_y": y, "_x": x, "_c": corner})
    wy, wx = F.col("fy") - F.col("_y"), F.col("fx") - F.col("_x")
    weight = F.when(F.col("_c.a") == 1, wy).otherwise(1 - wy) * F.when(F.col("_c.b") == 1, wx).otherwise(1 - wx)
    c = c.select("id", (F.col("_y") + F.col("_c.a")).alias("iy"), (F.col("_x") + F.col("_c.b")).alias("ix"), weight.alias("_w")).filter("_w > 0")
    j = c.join(grid.select("iy", "ix", "value"), ["iy", "ix"], "left").groupBy("id").agg(
        F.sum(F.col("_w") * F.col("value")).alias("_s"), F.sum(F.when(F.col("value").isNotNull(), F.col("_w"))).alias("_k"), F.bool_and(F.col("value").isNotNull()).alias("_all"))
    value = F.when(F.col("_all"), F.col("_s")) if least_weight is None else F.when(F.col("_k") > least_weight, F.col("_s") / F.col("_k"))
    return j.select("id", value.alias("value"))
