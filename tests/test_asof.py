"""As-of choice against brute force, with ties and nulls."""

import random

from cindergrid.operators import asof


def test_newest_before_with_ties_and_nulls(spark):
    rng = random.Random(1)
    wanted = [(rng.choice(["a", "b", None]), rng.choice([None, *range(20)]), i // 2) for i in range(80)]
    products = [(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 20, 3)]), rng.choice([None, 1, 2])) for _ in range(60)]
    got = asof.newest_before(spark.createDataFrame(wanted, "k string, t int, id int"), spark.createDataFrame(products, "k string, i int, v int"), ["k"], "t", "i", ["v"])
    assert not any(name in got._jdf.queryExecution().executedPlan().toString() for name in ("Join", "CartesianProduct"))
    low = lambda v: -1 if v is None else v
    want = []
    for k, t, i in wanted:
        fit = [(p[1], p[2]) for p in products if k is not None and p[0] == k and p[1] is not None and t is not None and p[1] <= t]
        want.append((k, t, i, *(max(fit, key=lambda p: (p[0], low(p[1]))) if fit else (None, None))))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
