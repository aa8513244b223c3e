"""Nearest cells and points in polygons as equi-joins over buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_cell(stations: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    """stations (station, x, y) with the nearest of cells (iy, ix, x, y) at any distance (ties: smaller iy, then ix). A cell
    within reach lies in one of the nine buckets around the station; stations without one go on with twice the reach, until
    all that have a place are placed. Without any cell no station is."""
    todo, found = stations.select("station", "x", "y").filter("x is not null and y is not null"), None
    some = bool(cells.head(1))
    while some and (found is None or todo.head(1)):
        got = _within(todo, cells, reach).persist()
        found = got if found is None else found.unionByName(got)
        todo = todo.join(got.select("station"), "station", "left_anti").persist()
        reach *= 2
    return found if found is not None else _within(todo, cells, reach)


def _within(stations: DataFrame, cells: DataFrame, reach: float) -> DataFrame:
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    s = stations.select("station", F.col("x").alias("sx"), F.col("y").alias("sy"), near.alias("o"))
    s = s.withColumns({"bx": F.floor(F.col("sx") / reach) + F.col("o.i"), "by": F.floor(F.col("sy") / reach) + F.col("o.j")}).drop("o")
    c = cells.select("iy", "ix", F.col("x").alias("cx"), F.col("y").alias("cy"), F.floor(F.col("x") / reach).alias("bx"), F.floor(F.col("y") / reach).alias("by"))
    dx, dy = F.col("sx") - F.col("cx"), F.col("sy") - F.col("cy")
    pairs = s.join(c, ["bx", "by"]).withColumn("d", F.sqrt(dx * dx + dy * dy)).filter(F.col("d") <= reach)
    best = pairs.groupBy("station").agg(F.min(F.struct("d", "iy", "ix")).alias("m"))
    return best.select("station", "m.iy", "m.ix", F.col("m.d").alias("distance"))


def _borders(edges: DataFrame, side: float) -> DataFrame:
    """edges with the cells (j, i) of a square raster that they pass through."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    band = lambda c: F.floor(c / side).cast("long")
    x_at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + F.try_divide((y - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    bands = edges.withColumn("j", F.explode(F.sequence(band(low), band(high))))
    a, b = x_at(F.greatest(low, F.col("j") * side)), x_at(F.least(high, (F.col("j") + 1) * side))
    flat, slack = F.col("y1") == F.col("y2"), 1e-9 * side
    left = F.when(flat, F.least("x1", "x2")).otherwise(F.least(a, b)) - slack
    right = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(a, b)) + slack
    return bands.withColumn("i", F.explode(F.sequence(band(left), band(right))))


def cover(edges: DataFrame, side: float) -> tuple[DataFrame, DataFrame]:
    """The cells (polygon, j, i) that lie inside or on the border of each polygon, with odd: whether the lower left corner
    is inside, and border; and the edges with the border cells that they pass through. Corners come from crossings of the
    raster's lines, summed along each line."""
    parts = _borders(edges.select("polygon", "x1", "y1", "x2", "y2"), side)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = F.sequence(F.ceil(low / side).cast("long"), F.ceil(high / side).cast("long") - 1)  # those with low <= y < high
    crossed = edges.filter(F.ceil(low / side) < F.ceil(high / side)).withColumn("j", F.explode(lines))
    at = F.col("x1") + F.try_divide((F.col("j") * side - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1"))
    counts = crossed.select("polygon", "j", F.ceil(at / side).cast("long").alias("i")).groupBy("polygon", "j", "i").agg(F.count(F.lit(1)).alias("n"))
    line = Window.partitionBy("polygon", "j").orderBy("i")
    runs = counts.select("polygon", "j", "i", F.sum("n").over(line).alias("n"), F.lead("i").over(line).alias("end")).filter("n % 2 = 1 and end > i")
    odd = runs.select("polygon", "j", F.explode(F.sequence(F.col("i"), F.col("end") - 1)).alias("i"), F.lit(True).alias("odd"), F.lit(False).alias("border"))
    border = parts.select("polygon", "j", "i").distinct().select("*", F.lit(False).alias("odd"), F.lit(True).alias("border"))
    cells = odd.unionByName(border).groupBy("polygon", "j", "i").agg(F.bool_or("odd").alias("odd"), F.bool_or("border").alias("border"))
    return cells, parts


def in_polygons(points: DataFrame, edges: DataFrame, side: float = 1.0) -> DataFrame:
    """(id, polygon) of points (id, x, y) inside polygons given by edges (polygon, x1, y1, x2, y2).

    A cover of cells (of this side) decides all points but those in cells that a polygon's border passes through. There the
    edges that the path from the cell's corner up and then right to the point crosses are counted, and no others: work
    follows the edges of a cell, however many its band has."""
    cells, parts = cover(edges, side)
    place = lambda c: F.floor(F.col(c) / side).cast("long")
    near = points.select("id", "x", "y", place("y").alias("j"), place("x").alias("i")).join(cells, ["j", "i"])
    inside = near.filter("not border").select("id", "polygon")
    x0, y0 = F.col("i") * side, F.col("j") * side
    right = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (lambda at: (at <= F.col("x")) & (at > x0))(F.col("x1") + F.try_divide((F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")), F.col("y2") - F.col("y1")))
    slope = F.try_divide(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1"))
    at = F.col("y1") + (x0 - F.col("x1")) * slope
    under = lambda y: (at < y) | ((at == y) & (slope <= 0))
    up = ((F.col("x1") > x0) != (F.col("x2") > x0)) & (under(F.col("y")) != under(y0))
    crossed = F.when(right, 1).otherwise(0) + F.when(up, 1).otherwise(0)
    tested = near.filter("border").join(parts, ["polygon", "j", "i"]).groupBy("id", "polygon", "x", "y").agg((F.coalesce(F.sum(crossed), F.lit(0)) + F.max(F.col("odd").cast("int"))).alias("n"))
    return inside.unionByName(tested.filter("n % 2 = 1").select("id", "polygon")).distinct()


def overlapping(edges: DataFrame, region_of: dict[str, int], side: float = 1.0) -> DataFrame:
    """(a, b): polygons of different regions that overlap: their edges cross, or a corner of one, or the middle of an edge,
    lies inside the other away from its border. Common borders are no overlap."""
    region = F.coalesce(*[F.when(F.col("polygon") == k, F.lit(v)) for k, v in region_of.items()])
    e = edges.withColumn("region", region).filter("region is not null")
    parts = _borders(e, side)
    other = parts.select("j", "i", *[F.col(c).alias(f"o_{c}") for c in ("polygon", "region", "x1", "y1", "x2", "y2")])
    turn = lambda ax, ay, bx, by, cx, cy: (F.col(bx) - F.col(ax)) * (F.col(cy) - F.col(ay)) - (F.col(by) - F.col(ay)) * (F.col(cx) - F.col(ax))
    d1, d2 = turn("x1", "y1", "x2", "y2", "o_x1", "o_y1"), turn("x1", "y1", "x2", "y2", "o_x2", "o_y2")
    d3, d4 = turn("o_x1", "o_y1", "o_x2", "o_y2", "x1", "y1"), turn("o_x1", "o_y1", "o_x2", "o_y2", "x2", "y2")
    tiny = 1e-9
    apart = lambda a, b: ((a > tiny) & (b < -tiny)) | ((a < -tiny) & (b > tiny))
    crossing = parts.join(other, ["j", "i"]).filter((F.col("region") < F.col("o_region")) & apart(d1, d2) & apart(d3, d4)).select(F.col("polygon").alias("a"), F.col("o_polygon").alias("b"))
    at = F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))))
    corners = e.select(F.col("polygon").alias("own"), F.col("region").alias("own_region"), at.alias("p")).select(F.struct("own", "own_region", "p").alias("id"), "p.x", "p.y")
    held = in_polygons(corners, e, side).join(e.select("polygon", "region").distinct(), "polygon").filter("region <> id.own_region")
    place = lambda c: F.floor(F.col(c) / side).cast("long")
    held = held.withColumns({"j": place("id.p.y"), "i": place("id.p.x")})
    beside = parts.select("j", "i", "polygon", "x1", "y1", "x2", "y2")
    on = (F.abs((F.col("x2") - F.col("x1")) * (F.col("id.p.y") - F.col("y1")) - (F.col("y2") - F.col("y1")) * (F.col("id.p.x") - F.col("x1"))) <= tiny) & F.col("id.p.x").between(F.least("x1", "x2") - tiny, F.greatest("x1", "x2") + tiny) & F.col("id.p.y").between(F.least("y1", "y2") - tiny, F.greatest("y1", "y2") + tiny)
    clear = held.join(beside.withColumn("_on", F.lit(True)), ["polygon", "j", "i"], "left").groupBy("id", "polygon").agg(F.coalesce(F.bool_or(F.col("_on") & on), F.lit(False)).alias("touches")).filter("not touches")
    return crossing.unionByName(clear.select(F.least("id.own", "polygon").alias("a"), F.greatest("id.own", "polygon").alias("b"))).distinct()


def danger_region(points: DataFrame, edges: DataFrame, region_of: dict[str, int], default: int = 1, side: float = 1.0) -> DataFrame:
    """(id, region): the region of the polygon that a point is in, 3 before 2, else the default. A name of region_of without
    a polygon is an error, and so are polygons of different regions that overlap."""
    missing = sorted(set(region_of) - {r.polygon for r in edges.filter(F.col("polygon").isin(list(region_of))).select("polygon").distinct().collect()})  # as many as region_of has
    if missing:
        raise ValueError(f"no polygon is named {', '.join(missing)}")
    both = overlapping(edges, region_of, side).head(1)
    if both:
        raise ValueError(f"polygons of different regions overlap: {both[0].a} and {both[0].b}")
    region = F.coalesce(*[F.when(F.col("polygon") == k, F.lit(v)) for k, v in region_of.items()])
    found = in_polygons(points, edges, side).groupBy("id").agg(F.max(region).alias("region"))
    return points.select("id").join(found, "id", "left").select("id", F.coalesce("region", F.lit(default)).alias("region"))
