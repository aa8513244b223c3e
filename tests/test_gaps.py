"""Wide gaps of grids, polygons, hot keys and long folds against brute force."""

import random

import pytest

from cindergrid.operators import asof, moisture, rounds, seasonal, spatial
from cindergrid.operators import grid as G
from cindergrid.streaming import moisture as codes


def test_fill_reaches_over_wide_gaps(spark):
    known = {(0, 0): 1.0, (0, 1): 2.0, (3, 299): 3.0, (2, 150): 4.0}
    rows = [("a", y, x, known.get((y, x))) for y in range(4) for x in range(0, 700, 7)] + [("a", y, x, v) for (y, x), v in known.items() if x % 7]
    rows += [("b", 0, x, None) for x in range(3)]
    got = {(r.f, r.iy, r.ix): r.v for r in G.fill_nearest(spark.createDataFrame(rows, "f string, iy long, ix long, v double"), ["f"], "v").collect()}
    for f, y, x, _ in rows:
        near = min(known, key=lambda c: ((c[0] - y) ** 2 + (c[1] - x) ** 2, *c))
        assert got[f, y, x] == (known[near] if f == "a" else None)


def test_fill_from_solid_areas(spark):
    rng = random.Random(2)
    hole = lambda y, x: (y - 20) ** 2 + (x - 20) ** 2 < 200 or rng.random() < 0.05
    cells = {(y, x): None if hole(y, x) else float(y * 40 + x) for y in range(40) for x in range(40)}
    known = [c for c, v in cells.items() if v is not None]
    got = G.fill_nearest(spark.createDataFrame([("a", y, x, v) for (y, x), v in cells.items()], "f string, iy long, ix long, v double"), ["f"], "v").collect()
    assert {(r.iy, r.ix): r.v for r in got} == {c: cells[min(known, key=lambda k: ((k[0] - c[0]) ** 2 + (k[1] - c[1]) ** 2, *k))] for c in cells}


def test_polygons_with_many_edges_in_one_band(spark):
    """A comb whose teeth all cross one band, a hole, integer corners on the raster's lines, and points on the lines."""
    import math

    import duckdb

    ring = [(0.0, 0.0)] + [p for k in range(400) for p in ((k * 0.1, 0.95), (k * 0.1 + 0.05, 0.02 * (k % 3)))] + [(40.0, 0.95), (40.0, -3.0), (0.0, -3.0)]
    square, hole = [(2.0, -2.0), (6.0, -2.0), (6.0, 2.0), (2.0, 2.0)], [(3.0, -1.0), (5.0, -1.0), (5.0, 1.0), (3.0, 1.0)]
    star = [(10 + (3 if k % 2 else 1.3) * math.cos(k * math.pi / 7 + 0.1), 0.5 + (3 if k % 2 else 1.3) * math.sin(k * math.pi / 7 + 0.1)) for k in range(14)]
    edges = [(name, *a, *b) for name, r in (("comb", ring), ("square", square), ("square", hole), ("star", star)) for a, b in zip(r, r[1:] + r[:1])]
    rng = random.Random(4)
    points = [(i, rng.uniform(-2, 42), rng.uniform(-4, 4)) for i in range(4000)]
    points += [(4000 + i, float(x), y) for i, (x, y) in enumerate((x, y + 0.25) for x in range(-1, 12) for y in range(-3, 3))]
    kind = "polygon string, x1 double, y1 double, x2 double, y2 double"
    e, p = spark.createDataFrame(edges, kind), spark.createDataFrame(points, "id long, x double, y double")
    con = duckdb.connect()
    con.register("e", e.toPandas())
    con.register("p", p.toPandas())
    want = con.execute("select id, polygon from p, e where (y1 > y) <> (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) group by 1, 2 having count(*) % 2 = 1").fetchall()
    for side in (1.0, 0.3):
        got = spatial.in_polygons(p, e, side).collect()
        assert sorted((r.id, r.polygon) for r in got) == sorted(want) and len(want) > 1000
    cells, parts = spatial.cover(e, 0.3)
    assert parts.groupBy("polygon", "j", "i").count().agg({"count": "max"}).first()[0] < 20  # edges of a cell, not of a band


def test_regions_must_be_known_and_apart(spark):
    box = lambda name, x, y, w: [(name, *a, *b) for r in [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]] for a, b in zip(r, r[1:] + r[:1])]
    kind = "polygon string, x1 double, y1 double, x2 double, y2 double"
    p = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5), (3, 9.0, 9.0)], "id long, x double, y double")
    beside = spark.createDataFrame(box("a", 0.0, 0.0, 1.0) + box("b", 1.0, 0.0, 1.0), kind)  # a common border is no overlap
    got = spatial.danger_region(p, beside, {"a": 2, "b": 3}).collect()
    assert sorted((r.id, r.region) for r in got) == [(1, 2), (2, 3), (3, 1)]
    with pytest.raises(ValueError, match="c"):
        spatial.danger_region(p, beside, {"a": 2, "c": 3})
    for other in (box("b", 0.5, 0.25, 1.0), box("b", 0.25, 0.25, 0.5)):  # across, and within
        with pytest.raises(ValueError, match="overlap"):
            spatial.danger_region(p, spark.createDataFrame(box("a", 0.0, 0.0, 1.0) + other, kind), {"a": 2, "b": 3})
    assert len(spatial.danger_region(p, spark.createDataFrame(box("a", 0.0, 0.0, 1.0) + box("b", 0.25, 0.25, 0.5), kind), {"a": 2, "b": 2}).collect()) == 3


def test_a_hot_key_is_scanned_in_slices(spark):
    rng = random.Random(9)
    wanted = [("hot" if i % 10 else "b", rng.randrange(5000), i) for i in range(600)]
    products = [("hot" if i % 10 else "b", rng.randrange(5000), i) for i in range(300)]
    got = asof.newest_before(spark.createDataFrame(wanted, "k string, t int, id int"), spark.createDataFrame(products, "k string, i int, v int"), ["k"], "t", "i", ["v"], slices=16)
    for r in got.collect():
        fit = [(i, v) for k, i, v in products if k == r.k and i <= r.t]
        assert (r.found_i, r.found_v) == (max(fit) if fit else (None, None))


def test_rounds_give_what_one_array_gives(spark):
    rng = random.Random(5)
    hours = [(c, h, 10 + 15 * rng.random(), 30 + 50 * rng.random(), 20 * rng.random(), rng.choice([0.0, 0.0, 0.0, 2.5]), h % 24 > 8) for c, n in ((1, 130), (2, 40), (3, 1)) for h in range(n)]
    df = spark.createDataFrame(hours, "cell long, h long, temp_c double, rh double, wind_kmh double, precip_mm double, daylight boolean")
    key = lambda rows: sorted((r.cell, r.h, r.ffmc, r.dmc, r.dc, r.fwi) for r in rows)
    assert key(rounds.evolve(df, ["cell"], "h", size=25).collect()) == key(moisture.evolve(df, ["cell"], "h").collect())
    assert rounds.evolve(df.limit(0), ["cell"], "h").collect() == []
    days = spark.createDataFrame([(c, d, 5 + 20 * rng.random(), 40.0, 10.0, rng.choice([0.0, 3.0]), 5 + d // 30, int(d == 0), 100.0) for c in (1, 2) for d in range(90)], "cell long, day long, temp double, rh double, wind double, rain double, month int, onset int, winter_rain double")
    of_days = lambda rows: sorted((r.cell, r.day, r.f, r.p, r.df, r.s) for r in rows)
    assert of_days(rounds.daily_codes(days, ["cell"], "day", size=20).collect()) == of_days(seasonal.daily_codes(days, ["cell"], "day").collect())


def test_streamed_fold_keeps_late_hours_apart(spark, tmp_path):
    kind = "cell long, h long, temp_c double, rh double, wind_kmh double, precip_mm double, daylight boolean"
    row = lambda c, h: (c, h, 15.0 + h, 40.0, 10.0, 0.5 * (h % 3), True)
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for part in ([row(1, h) for h in range(5)] + [row(2, 0)], [row(1, 3), row(1, 5), row(3, 0)], [row(2, 1), row(1, 6)]):
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(kind).parquet(src)
        codes.write_evolved(stream, ["cell"], "h", out, str(tmp_path / "ckpt")).awaitTermination()  # a restart each
    whole = spark.createDataFrame([row(1, h) for h in range(7)] + [row(2, 0), row(2, 1), row(3, 0)], kind)
    key = lambda df: sorted((r.cell, r.h, r.ffmc, r.dmc, r.dc) for r in df.collect())
    assert key(spark.read.parquet(f"{out}/hours")) == key(moisture.evolve(whole, ["cell"], "h"))
    assert [(r.cell, r.h) for r in spark.read.parquet(f"{out}/late").collect()] == [(1, 3)]
