"""Operators on embeddings against brute force, with nulls, faults, ties and repeated rows."""

import math

import numpy as np
import pytest

from cindergrid.llm import flatgraph, whitening
from cindergrid.llm.common import table
from cindergrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>, label int, v string, n long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "extra", 5) for i, v in rows], KIND)


def exact_deviation(xs):
    n, sums = len(xs), [sum(c) for c in zip(*xs)]
    return [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in xs]


def held(got, vectors, components):
    """The rows against numpy on the same integers; either sign of a component, the same for all rows."""
    xs = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in vectors}
    x = np.array(list(xs.values()), float)
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    want = dict(zip(xs, centred @ directions / np.sqrt(values)))
    deviation = dict(zip(xs, exact_deviation(list(xs.values()))))
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(by) == len(xs) * components
    for c in range(components):
        own, ref = np.array([by[i, c + 1].whitened for i in xs]), np.array([want[i][c] for i in xs])
        assert min(np.abs(own - ref).max(), np.abs(own + ref).max()) < 1e-6
    for (i, c), r in by.items():
        assert (r.n, int(r.deviation)) == (len(xs), deviation[i])
        assert abs(r.explained - values[c - 1] / centred.var(axis=0).sum()) < 1e-9 and r.identity_error < 1e-8


def test_whitening_of_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    held(QUERIES["op12_whitening"](spark, SF).collect(), rows, 32)


def test_whitening_drops_faulty_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=5) * [3, 2, 1, 0.5, 0.2]) for i in range(40)] + [(100, [1e4, -1e4, 0, 0, 1])]
    bad = [(50, None), (51, [1, 2, None, 4, 5]), (52, [1, 2, float("nan"), 4, 5]), (53, [1, 2, 3, float("inf"), 5]), (54, [1, 2]), (55, [])]
    held(whitening.whiten(frame(spark, good + bad)).collect(), good, 5)


def test_whitening_of_repeated_null_and_equal_rows(spark):
    twice = whitening.whiten(frame(spark, [(1, [1, 2]), (1, [1, 2]), (None, [3, 1]), (2, [0, 0])])).collect()
    assert sorted((r.vec_id or -1, r.component) for r in twice) == [(-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (2, 2)]
    flat = whitening.whiten(frame(spark, [(1, [1, 2]), (2, [1, 3]), (3, [1, 5])])).collect()  # a dimension without variance
    assert {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)
    for rows in ([], [(1, None)], [(1, [1, 2])], [(1, [1, 2]), (2, [1, 2])]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_whitening_beyond_64_bits(spark):
    """Sums of squares that do not fit into 64 bits are still exact."""
    rows = [(1, [2.0**44, 1]), (2, [-(2.0**44), 0]), (3, [0, 2])]
    xs = [[int(64 * c) + 1_000_000 for c in v] for _, v in rows]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(frame(spark, rows)).collect()}
    assert [got[i] for i in (1, 2, 3)] == exact_deviation(xs)


def brute_links(rows, similarity=0.95):
    """{position: (n_links, component)} by comparing all pairs."""
    size = max((len(v) for _, v in rows if v is not None), default=0)
    ok = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {k: (0, rows[k][0]) for k in range(len(rows))}
    if ok:
        u = np.array([rows[k][1] for k in ok], np.float32).astype(float)
        u /= np.linalg.norm(u, axis=1)[:, None]
        near = u @ u.T >= similarity
        label = np.arange(len(ok))
        while True:
            new = np.where(near, label[None, :], len(ok)).min(axis=1)
            if (new == label).all():
                break
            label = new
        for i, k in enumerate(ok):
            ids = [rows[ok[j]][0] for j in range(len(ok)) if label[j] == label[i] and rows[ok[j]][0] is not None]
            out[k] = (int(near[i].sum()) - 1, min(ids, default=None))
    return sorted(((i, *out[k], i == out[k][1]) for k, (i, _) in enumerate(rows)), key=str)


def linked(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


def noisy(rng, centre, n, size):
    return [centre + rng.normal(size=len(centre)) * size / math.sqrt(len(centre)) for _ in range(n)]


def test_embedding_duplicates_with_faults_and_copies(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    near = [v for c in base[:12] for v in noisy(rng, c / np.linalg.norm(c), 6, 0.25)]  # about the link's angle apart
    rows = [(i, v) for i, v in enumerate([*base, *near])]
    rows += [(200, base[0]), (201, base[0]), (201, base[0]), (None, base[0]), (None, base[20] * -1), (202, None), (203, [0.0] * 16), (204, [None] + [1.0] * 15), (205, [float("nan")] + [1.0] * 15), (206, [float("inf")] * 16), (207, [1.0] * 3), (208, [])]
    want = brute_links(rows)
    assert linked(flatgraph.near_duplicates(frame(spark, rows))) == want
    assert sum(r[1] for r in want) > 100
    for few in ([], [(1, None)], [(1, [1, 0]), (2, [1, 0.1])]):
        assert linked(flatgraph.near_duplicates(frame(spark, few))) == brute_links(few)


def test_embedding_duplicates_of_large_groups(spark):
    """Groups far over a shard's limit, one of them wider than a bead, which is compared in blocks."""
    rng = np.random.default_rng(6)
    centres = [c / np.linalg.norm(c) for c in rng.normal(size=(3, 24))]
    vectors = noisy(rng, centres[0], 300, 0.1) + noisy(rng, centres[1], 200, 0.2) + noisy(rng, centres[2], 150, 0.25) + [centres[0]] * 50 + list(rng.normal(size=(300, 24)))
    rows = list(enumerate(vectors))
    got = flatgraph.near_duplicates(frame(spark, rows), limit=128).cache()
    assert linked(got) == brute_links(rows) and got.first().recall == 1


def test_embedding_duplicates_of_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    assert linked(QUERIES["op11_embedding_duplicates"](spark, SF)) == brute_links(rows)


def test_range_search_finds_what_is_in_range():
    rng = np.random.default_rng(7)
    v = np.array([*rng.normal(size=(400, 12)), *noisy(rng, rng.normal(size=12), 200, 0.6)])
    v /= np.linalg.norm(v, axis=1)[:, None]
    lists = flatgraph._pruned(v)
    links = np.full((len(v), max(map(len, lists))), -1)
    for k, x in enumerate(lists):
        links[k, : len(x)] = x
    a, b = flatgraph.range_search(v, np.zeros(len(v)), links, math.acos(0.95), np.arange(len(v)))
    near = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    assert len(a) >= 0.99 * near.sum() > 1000 and near[a, b].all()
