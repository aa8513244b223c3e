"""Near-duplicates of embeddings by a robust-pruned flat graph, built on overlapping shards.

1. Equal vectors form one class, with their number. Groups of near copies become beads first: vectors are dealt down a tree
   of centroids (fit in tasks, on a bounded sample of each group that is too large: ``SAMPLE`` rows a centroid), and those
   within half the link's angle of a centroid, or of a centre found in a group that is small enough, belong to its bead. Two
   members of a bead are linked whatever they are (the angles add up), so a group of any size costs linear work and no pairs.
2. Beads, with their radius, and all other classes are the vertices. They are dealt down such a tree again, each to its
   ``overlap`` nearest centroids, until no shard has more than ``limit``. Shards that do not come apart in ``DEPTH`` levels are cut by hash,
   and every two of the pieces become a shard.
3. In each shard every vertex gets its nearest vertices, pruned robustly (one is left out if a nearer one kept is much
   closer to it), and the edges back. A vertex's lists from all its shards are united.
4. Each shard searches this graph for each of its vertices: from the medoid and from the vertex itself, best first, going on
   from everything in range until nothing in range is unexplored. A pair is looked at in the smallest of the shards
   that both are in, in double precision. The links of single vertices are counted where they are found; only links that
   join different parts leave the task.
5. Where a bead is one of a pair, radii decide, or else all members are compared, in blocks.
6. Components come from contraction rounds. ``audit`` compares a bounded set of rows with all rows.

Nulls and edges: vectors that are null, zero, hold null or non-finite entries, or are not as long as most, link with nothing
and are components of their own. A null id is never a component's name unless it is alone (kept, with a null component). Repeated rows
are vectors of their own and link with each other. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash
from .cpsjoin import components
from .whitening import usable

FAN, SAMPLE, DEPTH, CELL = 256, 32, 6, 8192
DEGREE, CANDIDATES, ALPHA, BEAM, STEP = 24, 96, 1.2, 24, 4
#: Radians that a bead stays within its bound, for rounding.
SLACK = 1e-7


def _mix(*parts) -> np.ndarray:
    """A 63-bit hash of whole numbers."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p, np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return (h >> np.uint64(1)).astype(np.int64)


def _bead(group, nth) -> np.ndarray:
    """A bead's name, negative: of a centroid of a group, or of a small group by one of its members (nth -1)."""
    return -_mix(group, nth) - 1


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _vectors(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (rows.shape[1] if len(rows) else 0), pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-300)


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


# --- the tree of centroids -----------------------------------------------------------------------------------------


def _fan(n, limit: int, overlap: int):
    """So many centroids that members, dealt to `overlap` of them, come to half the limit each."""
    return F.least(F.lit(FAN), F.ceil(2 * overlap * n / limit))


def _centroids(apart: float):
    """Of the sample (group, vertex, v, fan) of a group: spherical k-means, the fullest first, none within `apart` of a fuller one."""

    def made(table: pa.Table) -> pa.Table:
        v, vertex = _matrix(table.column("v")), table.column("vertex").to_numpy()
        v = v[np.argsort(_mix(vertex, 1), kind="stable")]
        k = min(len(v), table.column("fan")[0].as_py())
        c = v[:k]
        for _ in range(8):
            near = (v @ c.T).argmax(axis=1)
            total = np.zeros_like(c)
            np.add.at(total, near, v)
            c = np.where(np.abs(total).sum(axis=1, keepdims=True) > 0, _unit(total), c)
        weight = np.bincount((v @ c.T).argmax(axis=1), minlength=k)
        kept: list[int] = []
        for i in np.argsort(-weight, kind="stable"):
            if not kept or (c[kept] @ c[i]).max() < math.cos(apart):
                kept.append(int(i))
        m = len(kept)
        return pa.table({"group": pa.array(np.full(m, table.column("group")[0].as_py())), "nth": pa.array(np.arange(m, dtype=np.int32)), "bead": pa.array(_bead(table.column("group")[0].as_py(), np.arange(m))), "c": _vectors(c[kept])})

    return made


def _dealt(half: float | None, overlap: int):
    """Members of a cell to the nearest centroids, or, with half, those so near to one to its bead, others to the nearest."""

    def made(rows: pa.Table, centres: pa.Table) -> pa.Table:
        v, vertex, group = _matrix(rows.column("v")), rows.column("vertex").to_numpy(), rows.column("group").to_numpy()
        bead, angle = np.zeros(len(v), np.int64), np.zeros(len(v))
        if not centres.num_rows:
            take, child = np.arange(len(v)), group
        else:
            centres = centres.sort_by("nth")
            near = v @ _matrix(centres.column("c")).T
            if half is None:
                k = min(overlap, near.shape[1])
                nth = np.argpartition(-near, k - 1, axis=1)[:, :k]
                take, child = np.repeat(np.arange(len(v)), k), _mix(np.repeat(group, k), nth.ravel())
            else:
                inside = near >= math.cos(half - SLACK)
                first, take = inside.argmax(axis=1), np.arange(len(v))
                bead = np.where(inside.any(axis=1), _bead(group, first), 0)
                angle = np.where(bead < 0, _angle(near[take, first]), 0.0)
                child = np.where(bead < 0, bead, _mix(group, near.argmax(axis=1)))
        return rows.select(["vertex", "v"]).take(pa.array(take)).append_column("group", pa.array(child)).append_column("bead", pa.array(bead[take])).append_column("angle", pa.array(angle[take]))

    return made


def _level(rows: DataFrame, limit: int, half: float | None, overlap: int) -> tuple[DataFrame, DataFrame]:
    """rows (vertex, v, group, n) of large groups one level down, and the centroids."""
    fan = _fan(F.col("n"), limit, overlap)
    sample = rows.filter(F.pmod(F.xxhash64("vertex", F.lit(7)), F.lit(1 << 30)) < fan * SAMPLE / F.col("n") * (1 << 30))
    centres = stash(sample.select("group", "vertex", "v", fan.alias("fan")).groupBy("group").applyInArrow(_centroids(0.05 if half else 0.0), "group long, nth int, bead long, c array<double>"), "centroids")
    cells = F.ceil(F.col("n") / CELL).cast("int")
    members = rows.select("vertex", "v", "group", F.pmod(F.xxhash64("vertex", F.lit(3)), cells).cast("int").alias("cell"))
    wide = rows.groupBy("group").agg(F.max(cells).alias("cells"))
    dealt = centres.join(wide, "group").select(F.col("group").alias("of"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("at"), "nth", "c")
    found = members.groupBy("group", "cell").cogroup(dealt.groupBy("of", "at")).applyInArrow(_dealt(half, overlap), "vertex long, v array<double>, group long, bead long, angle double")
    return stash(found, "dealt"), centres


def _sized(rows: DataFrame) -> DataFrame:
    return rows.join(rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")), "group")


def _local_beads(angle: float):
    """Of a small group: beads around the means of vertices in range of each other, the best connected first."""

    def made(table: pa.Table) -> pa.Table:
        v, vertex = _matrix(table.column("v")), table.column("vertex").to_numpy()
        n, near, inner = len(v), math.cos(angle), math.cos(angle / 2 - SLACK)
        degree = np.concatenate([(v[a : a + 512] @ v.T >= near).sum(axis=1) for a in range(0, n, 512)]) - 1
        bead, own, free, centres = np.zeros(n, np.int64), np.zeros(n), np.ones(n, bool), []
        for i in np.lexsort((vertex, -degree)):
            if degree[i] < 2:
                break
            if not free[i]:
                continue
            linked = free & (v @ v[i] >= near)
            if linked.sum() < 3:
                continue
            centre = _unit(v[linked].sum(axis=0))
            cosine = v @ centre
            inside = free & (cosine >= inner)
            if inside.sum() >= 3:
                name = int(_bead(int(vertex[inside].min()), -1))
                bead[inside], own[inside] = name, _angle(cosine[inside])
                free &= ~inside
                centres.append((name, centre))
        rows = table.select(["vertex", "v"]).append_column("bead", pa.array(bead)).append_column("angle", pa.array(own))
        if not centres:
            return rows
        extra = {"vertex": pa.nulls(len(centres), pa.int64()), "v": _vectors(np.array([c for _, c in centres])), "bead": pa.array([b for b, _ in centres]), "angle": pa.array(np.zeros(len(centres)))}
        return pa.concat_tables([rows, pa.table(extra)])

    return made


def beads(classes: DataFrame, angle: float, limit: int) -> tuple[DataFrame, DataFrame]:
    """(vertex, v, bead, angle) of all classes (vertex, v), bead 0 for none; and the beads' centres (bead, v)."""
    n = classes.count()
    rows, members, centres = classes.select("vertex", "v", F.lit(0).cast("long").alias("group"), F.lit(n).cast("long").alias("n")), [], []
    small = []
    for _ in range(DEPTH):
        large = rows.filter(F.col("n") > limit)
        small.append(rows.filter(F.col("n") <= limit))
        if not large.head(1):
            break
        found, level = _level(large, limit, angle / 2, 1)
        members.append(found.filter("bead < 0").select("vertex", "v", "bead", "angle"))
        centres.append(level.select("bead", F.col("c").alias("v")))
        rows = stash(_sized(found.filter("bead = 0").select("vertex", "v", "group")), "groups")
    else:
        members.append(rows.filter(F.col("n") > limit).select("vertex", "v", F.lit(0).cast("long").alias("bead"), F.lit(0.0).alias("angle")))
    local = reduce(DataFrame.unionByName, small).select("group", "vertex", "v").groupBy("group")
    got = stash(local.applyInArrow(_local_beads(angle), "vertex long, v array<double>, bead long, angle double"), "beads")
    members.append(got.filter("vertex is not null"))
    centres.append(got.filter("vertex is null").select("bead", "v"))
    return reduce(DataFrame.unionByName, members), reduce(DataFrame.unionByName, centres)


# --- shards and their graph ------------------------------------------------------------------------------------------


def shards(vertices: DataFrame, limit: int, overlap: int) -> DataFrame:
    """(shard, vertex) of vertices (vertex, v): overlapping, of at most limit vertices, nearly always."""
    n = vertices.count()
    rows, done = vertices.select("vertex", "v", F.lit(0).cast("long").alias("group"), F.lit(n).cast("long").alias("n")), []
    for _ in range(DEPTH):
        done.append(rows.filter(F.col("n") <= limit).select(F.col("group").alias("shard"), "vertex"))
        rows = rows.filter(F.col("n") > limit)
        if not rows.head(1):
            return reduce(DataFrame.unionByName, done).distinct()
        rows = stash(_sized(_level(rows, limit, None, overlap)[0].select("vertex", "v", "group").dropDuplicates(["vertex", "group"])), "groups")
    done.append(rows.filter(F.col("n") <= limit).select(F.col("group").alias("shard"), "vertex"))
    pieces = F.ceil(2 * F.col("n") / limit).cast("int")
    own, other = F.pmod(F.xxhash64("vertex", F.lit(5)), F.col("p")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("p") - 1))
    cut = rows.filter(F.col("n") > limit).select("group", "vertex", pieces.alias("p")).withColumns({"a": own, "b": other}).filter("a <> b")
    done.append(cut.select(F.xxhash64("group", F.least("a", "b"), F.greatest("a", "b")).alias("shard"), "vertex"))
    return reduce(DataFrame.unionByName, done).distinct()


def _pruned(v: np.ndarray) -> list[np.ndarray]:
    """For each row its robustly pruned neighbours, and the edges back, nearest first."""
    n, k = len(v), min(CANDIDATES, len(v) - 1)
    edges = []
    for a in range(0, n, 256):
        block = v[a : a + 256]
        near = block @ v.T
        near[np.arange(len(block)), np.arange(a, a + len(block))] = -2
        cand = np.argpartition(-near, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, cand, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        cand, near = np.take_along_axis(cand, order, axis=1), np.take_along_axis(near, order, axis=1)
        far, held = np.sqrt(np.maximum(2 - 2 * near, 0)), v[cand]
        alive, row = np.ones(cand.shape, bool), np.arange(len(block))
        for _ in range(min(DEGREE, k)):
            pick, some = alive.argmax(axis=1), alive.any(axis=1)
            if not some.any():
                break
            chosen = cand[row, pick]
            edges.append(np.stack((row[some] + a, chosen[some])))
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("bkd,bd->bk", held, v[chosen]), 0))
            alive &= ALPHA * between > far
            alive[row, pick] = False
    if not edges:
        return [np.zeros(0, np.int64)] * n
    a, b = np.concatenate(edges, axis=1)
    a, b = np.unique(np.concatenate((np.stack((a, b)), np.stack((b, a))), axis=1), axis=1)
    order = np.lexsort((-np.einsum("nd,nd->n", v[a], v[b]), a))
    a, b = a[order], b[order]
    nth = np.arange(len(a)) - np.searchsorted(a, a)
    a, b = a[nth < 2 * DEGREE], b[nth < 2 * DEGREE]
    return np.split(b, np.searchsorted(a, np.arange(1, n)))


def _adjacent(table: pa.Table) -> pa.Table:
    vertex = table.column("vertex").to_numpy()
    lists = _pruned(_matrix(table.column("v"))) if len(vertex) > 1 else [np.zeros(0, np.int64)]
    return pa.table({"vertex": table.column("vertex"), "neighbours": pa.array([vertex[x] for x in lists], pa.list_(pa.int64()))})


def range_search(v: np.ndarray, radius: np.ndarray, links: np.ndarray, angle: float, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, found) with an angle of at most `angle` and both radii, by the graph (a row of links a vertex, -1: none)."""
    n, m = len(v), len(queries)
    medoid, row = int((v @ v.sum(axis=0)).argmax()), np.arange(m)
    cosine, open_ = np.full((m, n), -2.0), np.zeros((m, n), bool)
    for start in (np.full(m, medoid), queries):
        cosine[row, start], open_[row, start] = np.einsum("nd,nd->n", v[queries], v[start]), True
    reach = lambda q, x: np.cos(np.minimum(angle + radius[queries[q]] + radius[x], math.pi))
    active, k, beam = row, min(STEP, n), min(BEAM, n)
    while len(active):
        front = np.where(open_[active], cosine[active], -3.0)
        pick = np.argpartition(-front, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(front, pick, axis=1)
        worst = -np.partition(-cosine[active], beam - 1, axis=1)[:, beam - 1]
        go = (value > -3) & ((value >= worst[:, None]) | (value >= reach(active[:, None], pick)))
        q, x = np.repeat(active, k)[go.ravel()], pick[go]
        open_[q, x] = False
        active = active[go.any(axis=1)]
        to = links[x]
        q, to = np.repeat(q, to.shape[1])[to.ravel() >= 0], to[to >= 0]
        new = cosine[q, to] == -2.0
        q, to = q[new], to[new]
        cosine[q, to], open_[q, to] = np.einsum("nd,nd->n", v[queries[q]], v[to]), True
    q, x = np.nonzero(cosine > -2)
    hit = (queries[q] != x) & (cosine[q, x] >= reach(q, x))
    return queries[q[hit]], x[hit]


def _joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each vertex the smallest of its part, by links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            return label


FOUND = "a long, b long, more long"


def _searched(least: float, angle: float):
    """Of a shard (vertex, v, radius, weight, neighbours, shards): for each vertex the weight of single vertices or beads that it
    is linked with (b null), links that join parts (more null), and pairs with a bead that are to be compared (more 0)."""

    def made(table: pa.Table) -> pa.Table:
        vertex, v = table.column("vertex").to_numpy(), _matrix(table.column("v"))
        radius, weight, n = table.column("radius").to_numpy(), table.column("weight").to_numpy(), table.num_rows
        order = np.argsort(vertex)
        flat = table.column("neighbours").combine_chunks()
        ids, counts = flat.flatten().to_numpy(), flat.value_lengths().to_numpy()
        at = order[np.minimum(np.searchsorted(vertex[order], ids), n - 1)]
        row, there = np.repeat(np.arange(n), counts), vertex[at] == ids  # others are not in this shard
        row, at = row[there], at[there]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        links = np.full((n, int(nth.max()) + 1 if len(nth) else 1), -1)
        links[row, nth] = at
        found = [range_search(v, radius, links, angle, np.arange(a, min(a + 128, n))) for a in range(0, n, 128)]
        a, b = (np.concatenate(x) for x in zip(*found))
        a, b = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b))), axis=1)
        homes = [set(x) for x in table.column("shards").to_pylist()]
        here = table.column("shard")[0].as_py()
        own = np.array([min(homes[x] & homes[y]) == here for x, y in zip(a, b)], bool)
        a, b = a[own], b[own]
        cosine = np.einsum("nd,nd->n", v[a], v[b])
        both = radius[a] + radius[b]
        single = both == 0
        sure = np.where(single, cosine >= least, _angle(cosine) + both <= angle - SLACK)
        ask = ~single & ~sure
        count = np.bincount(a[sure], weight[b[sure]], n) + np.bincount(b[sure], weight[a[sure]], n)
        label = _joined(n, a[sure], b[sure])
        some, moved = np.flatnonzero(count), np.flatnonzero(label != np.arange(n))
        left = np.concatenate((vertex[some], vertex[moved], vertex[a[ask]]))
        right = pa.array(np.concatenate((np.zeros(len(some), np.int64), vertex[label[moved]], vertex[b[ask]])), mask=np.arange(len(left)) < len(some))
        more = pa.array(np.concatenate((count[some].astype(np.int64), np.zeros(len(left) - len(some), np.int64))), mask=(np.arange(len(left)) >= len(some)) & (np.arange(len(left)) < len(some) + len(moved)))
        return pa.table({"a": pa.array(left), "b": right, "more": more})

    return made


def _compared(least: float):
    """Of two blocks of members (a, b, first: whether of a, vertex, v, weight): links of each, and that of a and b."""

    def made(table: pa.Table) -> pa.Table:
        first = table.column("first").to_numpy(zero_copy_only=False)
        vertex, v, weight = table.column("vertex").to_numpy(), _matrix(table.column("v")), table.column("weight").to_numpy()
        near = v[first] @ v[~first].T >= least
        count = np.concatenate((near @ weight[~first], weight[first] @ near)).astype(np.int64)
        names, some = np.concatenate((vertex[first], vertex[~first])), count > 0
        a, b, more = names[some].tolist(), [None] * int(some.sum()), count[some].tolist()
        if some.any():
            a, b, more = a + [table.column("a")[0].as_py()], b + [table.column("b")[0].as_py()], more + [None]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "more": pa.array(more, pa.int64())})

    return made


def _asked(pairs: DataFrame, members: DataFrame, least: float, block: int) -> DataFrame:
    """The members (owner, vertex, v, weight) of pairs (a, b) of owners, compared in blocks."""
    size = members.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    pairs = pairs.join(size.withColumnsRenamed({"owner": "a", "blocks": "na"}), "a").join(size.withColumnsRenamed({"owner": "b", "blocks": "nb"}), "b")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vertex", F.lit(9)), F.col(n)).cast("int")
    sides = [
        pairs.join(members.withColumnRenamed("owner", side), side).select("a", "b", (own("na") if side == "a" else every("na")).alias("i"), (every("nb") if side == "a" else own("nb")).alias("j"), F.lit(side == "a").alias("first"), "vertex", "v", "weight")
        for side in ("a", "b")
    ]
    return stash(sides[0].unionByName(sides[1]).groupBy("a", "b", "i", "j").applyInArrow(_compared(least), FOUND), "compared")


# --- the whole -----------------------------------------------------------------------------------------------------


def keyed(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v: the unit vector, key) of all rows; key and v are null where a vector links with nothing."""
    good = usable("embedding") & F.exists("embedding", lambda c: c != 0)
    lengths = embeddings.filter(good).groupBy(F.size("embedding").alias("d")).count().agg(F.max(F.struct("count", "d"))["d"]).first()[0]
    doubles = F.when(good & (F.size("embedding") == (lengths or -1)), F.col("embedding").cast("array<double>"))
    rows = embeddings.select(F.col("vec_id").cast("long"), doubles.alias("c"))
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, x: s + x * x)))
    return rows.select("vec_id", F.transform("c", lambda x: x / F.col("norm")).alias("v"), F.md5(F.col("c").cast("string").cast("binary")).alias("key"))


def audit(classes: DataFrame, similarity: float, queries: int = 256) -> float | None:
    """Recall of the links that classes (vertex, v, weight, n_links) state, by comparing so many of them, the first by hash,
    with all; None where these have no links."""
    asked = classes.orderBy(F.xxhash64("vertex", F.lit(13)), "vertex").limit(queries).select("v", "n_links").collect()
    if not asked:
        return None
    v = np.array([r.v for r in asked])

    def made(batches):
        total = np.zeros(len(v), np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                total += (v @ _matrix(part.column("v")).T >= similarity) @ part.column("weight").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(v)), pa.int32()), pa.array(total)], ["i", "n"])

    there = classes.select("v", "weight").mapInArrow(made, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    true = {r.i: r.n - 1 for r in there}
    total = sum(true.values())
    return sum(min(r.n_links, true[i]) for i, r in enumerate(asked)) / total if total else None


def near_duplicates(embeddings: DataFrame, similarity: float = 0.95, limit: int = 2048, overlap: int = 3, audited: int = 256) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) of every row of embeddings (vec_id, embedding)."""
    angle, rows = math.acos(similarity), keyed(embeddings)
    some = rows.filter("key is not null").groupBy("key").agg(F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    classes = stash(some.withColumn("vertex", F.monotonically_increasing_id()), "classes")

    members, centres = beads(classes, angle, limit)
    members = stash(members.join(classes.select("vertex", "weight", "least", "key"), "vertex").withColumn("owner", F.when(F.col("bead") < 0, F.col("bead")).otherwise(F.col("vertex"))), "members")
    held = stash(members.filter("bead < 0").groupBy("bead").agg((F.max("angle") + SLACK).alias("radius"), F.sum("weight").alias("weight")), "held")
    single = members.filter("bead = 0").select("vertex", "v", F.lit(0.0).alias("radius"), "weight")
    vertices = stash(single.unionByName(held.join(centres, "bead").select(F.col("bead").alias("vertex"), "v", "radius", "weight")), "vertices")

    sharded = stash(shards(vertices, limit, overlap), "shards")
    lists = sharded.join(vertices.select("vertex", "v"), "vertex").groupBy("shard").applyInArrow(_adjacent, "vertex long, neighbours array<long>")
    graph = stash(lists.groupBy("vertex").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "graph")
    homes = sharded.groupBy("vertex").agg(F.collect_list("shard").alias("shards"))
    cells = sharded.join(vertices, "vertex").join(graph, "vertex").join(homes, "vertex")
    found = stash(cells.groupBy("shard").applyInArrow(_searched(similarity, angle), FOUND), "found")
    asked = found.filter("b is not null and more is not null").select("a", "b").distinct()
    compared = _asked(asked, members.select("owner", "vertex", "v", "weight"), similarity, limit // 2) if asked.head(1) else found.limit(0)

    of_owner = found.filter("b is null").groupBy(F.col("a").alias("owner")).agg(F.sum("more").alias("by_owner"))
    of_vertex = compared.filter("b is null").groupBy(F.col("a").alias("vertex")).agg(F.sum("more").alias("by_vertex"))
    inside = held.select(F.col("bead").alias("owner"), F.col("weight").alias("inside"))
    links = found.filter("b is not null and more is null").select("a", "b").unionByName(compared.filter("b is not null").select("a", "b"))
    labels = components(links).select(F.col("rep").alias("owner"), "label")
    none = F.lit(0).cast("long")
    n_links = F.coalesce("inside", "weight") - 1 + F.coalesce("by_owner", none) + F.coalesce("by_vertex", none)
    named = members.join(inside, "owner", "left").join(of_owner, "owner", "left").join(of_vertex, "vertex", "left").join(labels, "owner", "left")
    named = stash(named.select("key", "vertex", "v", "weight", "least", n_links.alias("n_links"), F.coalesce("label", "owner").alias("label")), "linked-classes")
    recall = audit(named, similarity, audited) if audited else None
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = named.select("key", "n_links", "label").join(smallest, "label").select("key", "n_links", "component_id", F.lit(True).alias("there"))
    every = rows.select("vec_id", "key").join(of_class, "key", "left")
    component = F.when(F.col("there"), F.col("component_id")).otherwise(F.col("vec_id"))
    return every.select("vec_id", F.coalesce("n_links", none).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"), F.lit(recall).cast("double").alias("recall"))
