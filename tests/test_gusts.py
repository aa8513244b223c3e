"""Shares of gust branches against brute force."""

import math
from collections import defaultdict

from cindergrid.operators import fields
from cindergrid.plans import registry
from cindergrid.plans.standins import view
from tests.compare import duck

SF = "/root/testdata/sf0.001"


def test_branch_shares_count_every_row(spark):
    kind = "run string, fhour int, regular double, downslope double, increment double"
    rows = [("a", 0, 20.0, 26.0, 0.0), ("a", 0, 20.0, 24.0, 9.0), ("a", 0, 20.0, None, 6.0), ("a", 0, 20.0, None, None), ("a", 0, None, 90.0, 9.0), ("a", 3, 20.0, 30.0, 9.0), ("b", 0, 20.0, None, None), ("b", None, 20.0, 26.0, 0.0)]
    gusts = fields.all_cause_gust(spark.createDataFrame(rows, kind))
    got = {(r.run, r.fhour): (r.downslope_share, r.triggered_share) for r in fields.branch_shares(gusts, ["run", "fhour"]).collect()}
    # 29 is no more than 5 over a synoptic gust of 24; a cell without a regular gust is in no share, an hour without branches has none raised
    assert got == {("a", 0): (25.0, 25.0), ("a", 3): (100.0, 0.0), ("b", 0): (0.0, 0.0), ("b", None): (100.0, 0.0)}
    whole = {r.run: (r.downslope_share, r.triggered_share) for r in fields.branch_shares(gusts.drop("fhour"), ["run"]).collect()}
    assert whole == {"a": (40.0, 20.0), "b": (50.0, 0.0)}


def test_gust_branch_shares_have_every_hour(spark):
    cells = defaultdict(list)
    for r in view(spark, SF, "wx").collect():
        cells[r.hour_no - 1].append((r.wind_kmh if r.hour_no % 11 else None, r.wind_kmh * 1.2 if r.cell % 3 == 0 else None, max(r.temp_c - 9, 0.0)))
    want, part = {}, lambda n, of: math.floor(100.0 * n / max(1, of) * 1e4 + 0.5) / 1e4
    for h, rows in cells.items():
        known = [(a, b, c) for a, b, c in rows if a is not None]
        want[h] = (part(sum(b is not None and b > a + 5 for a, b, _ in known), len(known)), part(sum(a + c > max(a, b or 0.0) + 5 for a, b, c in known), len(known)))
    got = {r.fhour: (r.downslope_share, r.triggered_share) for r in registry.QUERIES["gust_branch_shares"](spark, SF).collect()}
    assert got == want and 0 in want and any(want[0])
    of_sql = duck(SF).execute(registry.ORACLES["gust_branch_shares"]).fetchall()
    assert {h: (a, b) for h, a, b in of_sql} == want
