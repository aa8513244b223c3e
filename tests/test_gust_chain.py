"""The gust chain: what its plan holds and sends to the driver, and the upsampling against brute force."""

import math
import random
from collections import defaultdict

import pytest

from cindergrid.operators import gusts
from cindergrid.plans import registry

SF = "/root/testdata/sf0.001"


def nodes(plan):
    """A Spark plan's nodes as they ran."""
    yield plan
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif name.endswith("QueryStage"):
        below = [plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    for x in below:
        yield from nodes(x)


def test_whole_gusts_is_one_chain_and_sends_no_cells(spark):
    df = registry.QUERIES["whole_gusts"](spark, SF)
    assert len(df.collect()) == 400
    ran = list(nodes(df._jdf.queryExecution().executedPlan()))
    sent = [x.metrics().apply("numOutputRows").value() for x in ran if x.nodeName() == "BroadcastExchange"]
    # the last row and column of a grid, and the shares of an hour; joins by cell are no broadcasts, however small the tables look
    assert sent and max(sent) == 1
    assert sum(x.nodeName().startswith("Scan") for x in ran) <= 12 and sum(x.nodeName() == "Exchange" for x in ran) <= 18


@pytest.mark.parametrize("seed", range(3))
def test_upsampled_equals_brute_force(spark, seed):
    r, stride = random.Random(seed), 4
    cells, coarse = [], []
    for key, y0, ny, nx in (("a", 0, 14, 11), ("b", -3, 9, 13), ("c", 0, 1, 1)):
        cells += [(key, y, x) for y in range(y0, ny) for x in range(nx) if r.random() < 0.95 or key == "c"]
        y1, x1 = (max(c[i] for c in cells if c[0] == key) for i in (1, 2))
        coarse += [(key, y, x, r.uniform(-9, 9) if r.random() < 0.8 else None) for y in range(y0, y1 + 6) for x in range(x1 + 6) if r.random() < 0.9 and (y % stride == 0 or y == y1) and (x % stride == 0 or x == x1) or r.random() < 0.02]
    known, ends = defaultdict(list), {k: tuple(max(c[i] for c in cells if c[0] == k) for i in (1, 2)) for k in "abc"}
    for k, y, x, v in coarse:
        if v is not None:
            known[k, y, x].append(v)

    def corners(i, top):
        low = math.floor(i / stride) * stride
        high = min(low + stride, top)
        w = (i - low) / (high - low) if high > low else 0.0
        return [(low, 1 - w), (high, w)]

    want = {}
    for k, y, x in cells:
        have = [(wy * wx, v) for cy, wy in corners(y, ends[k][0]) for cx, wx in corners(x, ends[k][1]) if wy * wx > 0 for v in known[k, cy, cx]]
        weight = sum(w for w, _ in have)
        want[k, y, x] = sum(w * v for w, v in have) / weight if weight > 0.2 else None
    got = gusts.upsampled(spark.createDataFrame(cells, "k string, iy long, ix long"), spark.createDataFrame(coarse, "k string, iy long, ix long, z double"), ["k"], "z", stride)
    assert got.columns == ["k", "iy", "ix", "z"]
    found = {(q.k, q.iy, q.ix): q.z for q in got.collect()}
    assert found.keys() == want.keys() and sum(v is not None for v in want.values()) > 100
    assert all(v is None and found[c] is None or found[c] == pytest.approx(v) for c, v in want.items())
