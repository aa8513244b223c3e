"""Near-duplicates by a chosen-path set similarity join.

1. Each document's distinct word shingles become 64-bit hashes; equal sets (a 128-bit digest) form one class, whose
   smallest doc_id stands for it. A class has a signature of 128 minwise values.
2. In each of ``trees`` independent trees, a node picks coordinates of the signature by a hash of its path (the root one,
   others two), and each class goes to the children named by its own minimum there. Nodes with one class end; nodes of at
   most ``limit`` classes are compared exhaustively; larger ones branch again. At the first level those whose classes hang
   together but for at most ``limit`` (near copies; see ``links_within``) are done with in linear time instead.
   What still branches after ``depth`` levels is compared in blocks, so nothing is capped. A pair of similarity 0.8 meets in
   no node of a tree with a chance of 0.2 at level 1 and below 0.25 at any level, so 9 trees miss it with one below 4 in a
   million, however deep they go.
3. Comparing inside a node uses the signatures and keeps pairs whose estimate is 0.62 or more, of which it gives a
   spanning forest. These links join classes to candidate groups. (A pair of similarity 0.8 falls short of that
   estimate with a chance below one in 100,000; that of sharing no compared node comes on top.)
4. Within each candidate group links are confirmed on the full sets until every pair of classes either hangs together or
   was compared itself. Components of those links are the result.

Links and labels are always tables; components are found by contraction rounds over them. A text moves once where its
group has at most ``limit // 4`` classes, about twice in larger groups of near copies; sets are made from texts where
they are needed and never shuffled.

Nulls and edges: a null text, or one without words, has an empty set, links with nothing and is its own component;
repeated rows with one doc_id are one class and all kept; a null doc_id is kept unless a smaller id is its copy;
an empty table gives no rows. Extra columns stay in ``keep_first`` and are ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, slices, stash

K = 128
_RNG = np.random.Generator(np.random.PCG64(20240229))
_MULTIPLY = _RNG.integers(0, 1 << 31, K, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _RNG.integers(0, 1 << 32, K, dtype=np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xBF58476D1CE4E5B9)
MEMO = 150_000
FEW = 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _Q
    x = (x ^ (x >> np.uint64(29))) * _P
    return x ^ (x >> np.uint64(32))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles of `width` words."""

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []
        memo, digest = self.words, xxhash.xxh3_64_intdigest
        if len(memo) > MEMO:
            memo.clear()
        ids = []
        for w in words:
            h = memo.get(w)
            if h is None:
                h = memo[w] = digest(w)
            ids.append(h)
        if not ids:
            return np.zeros(0, np.uint64)
        w = np.array(ids, np.uint64)
        n, k = len(w), min(self.width, len(w))
        h = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            h = h * _P + w[j : n - k + 1 + j]
        return np.unique(_mix(h))


def signature(shingles: np.ndarray) -> np.ndarray:
    out = np.full(K, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(x), 1024):
        np.minimum(out, ((x[a : a + 1024, None] * _MULTIPLY) ^ _FLIP).min(axis=0), out=out)
    return out


def profiles(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature) of docs (doc_id, text); key and signature are null for empty sets."""

    def made(batches):
        shingles = Shingles(width)
        for batch in slices(batches):
            n, keys, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                n.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signatures.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "set_key", "signature"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(made, "doc_id long, n_shingles long, set_key binary, signature binary")


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _children(path: np.ndarray, rep: np.ndarray, sig: np.ndarray, picks: int) -> tuple[np.ndarray, np.ndarray]:
    """The children of each row by so many coordinates that its path picks."""
    out = []
    for turn in range(1, picks + 1):
        pick = _mix(path + np.uint64(turn * int(_Q) % (1 << 64)))
        k = (pick % np.uint64(K)).astype(np.int64)
        value = sig[np.arange(len(path)), k].astype(np.uint64)
        out.append(_mix(path * _P + (k.astype(np.uint64) << np.uint64(33)) + value))
    return np.concatenate(out), np.tile(rep, picks)


def _branch(rows: DataFrame, trees: range | None = None) -> DataFrame:
    """(path, rep) of the children, by two coordinates, of rows (path, rep, signature), or of the roots of these trees, by
    one, for rows (rep, signature)."""

    def made(batches):
        for batch in slices(batches, 2000):
            sig = _matrix(batch.column("signature"), np.uint32)
            rep = batch.column("rep").to_numpy(zero_copy_only=False)
            if trees is None:
                starts = [batch.column("path").to_numpy(zero_copy_only=False).view(np.uint64)]
            else:
                starts = [np.full(len(rep), t * 1_000_003 + 17, np.uint64) for t in trees]
            for start in starts:
                path, own = _children(start, rep, sig, 2 if trees is None else 1)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(own)], ["path", "rep"])

    return rows.mapInArrow(made, "path long, rep long")


def _block(key: str, n: Column, limit: int) -> Column:
    """Number of the block of about limit rows that a class has among the n of its group."""
    return F.pmod(F.xxhash64(F.col(key), F.col("rep")), F.ceil(n / F.lit(limit))).cast("int")


def _groups(batches, keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first `keys` columns, of batches that come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(k[:, a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _forest(label: np.ndarray, asked: np.ndarray, linked) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links that join the labels which the graph joins where linked(i) marks the neighbours of i, for the asked i; and
    the labels then, the smallest of those that were joined."""
    label, found = label.copy(), []
    for i in np.flatnonzero(asked):
        other = label != label[i]
        if not other.any():
            break
        near = np.flatnonzero(linked(i) & other)
        if len(near):
            for lab, j in zip(*np.unique(label[near], return_index=True)):
                found.append((int(i), int(near[j])))
                label[(label == lab) | (label == label[i])] = min(lab, label[i])
    return found, label


def _by_sketches(least: int):
    """Classes are linked when their sketches agree in `least` places."""

    def linker(data: pa.Array):
        s = _matrix(data, np.uint8)
        return lambda i: (s == s[i]).sum(axis=1) >= least

    return lambda: linker


def _by_sets(width: int, percent: int):
    """Classes are linked when the full sets of their texts have this similarity."""

    def prepared():
        shingles = Shingles(width)

        def linker(data: pa.Array):
            sets = [shingles(t) for t in data.to_pylist()]
            size = np.array([len(s) for s in sets])
            starts = np.concatenate(([0], size.cumsum()[:-1]))
            index = np.unique(np.concatenate(sets), return_inverse=True)[1]
            flags = np.zeros(int(index.max()) + 1, np.int64)

            def linked(i):
                own = index[starts[i] : starts[i] + size[i]]
                flags[own] = 1
                both = np.add.reduceat(flags[index], starts)
                flags[own] = 0
                return 100 * both >= percent * (size + size[i] - both)

            return linked

        return linker

    return prepared


FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("group", pa.int64()), ("label", pa.int64()), ("few", pa.bool_())])


def _compared(cells: DataFrame, prepared, limit: int, named: bool = True, few: int = FEW) -> DataFrame:
    """Links (a, b) found in cells (group, _a, _b, rep, label, asked, n, data). With named, also, for groups of more than
    limit classes (n), each class a with b null, its group, the part (label) that it hangs together with in the cell, and
    whether it is one of a few of that part."""

    def made(batches):
        linker, found = prepared(), []
        for group in _groups(batches, 3):
            label, asked, n = (group.column(c).to_numpy() for c in ("label", "asked", "n"))
            rep = group.column("rep").to_numpy()
            if (label != label[0]).any() and asked.any():
                pairs, label = _forest(label, asked, linker(group.column("data").combine_chunks()))
                found += [(int(rep[i]), int(rep[j]), None, None, None) for i, j in pairs]
            if named and n[0] > limit:
                key, order = group.column("group")[0].as_py(), np.lexsort((rep, label))
                begins = np.concatenate(([True], label[order][1:] != label[order][:-1]))
                nth = np.arange(len(order)) - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
                found += [(int(rep[i]), None, key, int(label[i]), bool(k < few)) for i, k in zip(order, nth)]
            if len(found) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), FOUND)], schema=FOUND)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), FOUND)], schema=FOUND)

    rows = cells.select("group", "_a", "_b", "rep", "label", "asked", "n", "data")
    return rows.repartition("group", "_a", "_b").sortWithinPartitions("group", "_a", "_b").mapInArrow(made, "a long, b long, group long, label long, few boolean")


def links_within(members: DataFrame, payload: DataFrame, prepared, limit: int, leave: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Links (a, b) that join just those classes of each group (group, rep, n: its size) which all its pairs join, by the
    payload (rep, data) of the classes.

    A group of at most limit classes is one cell, where each pair is looked at until all hang together. A larger one is
    cut into blocks first, so each payload moves once; then a few classes of each part that hangs together meet again, in
    rounds, while the parts halve. The rest, all classes outside the largest part, is compared with the whole group: one
    more move for each class and `limit` such classes. With leave, groups with a larger rest are not compared with it but
    given back as (group, rep), None without any; else they are, and only that is quadratic."""
    block = _block("group", F.col("n"), limit)
    first = payload.join(members, "rep").withColumns({"_a": block, "_b": block, "label": F.col("rep"), "asked": F.lit(True)})
    got = stash(_compared(first, prepared, limit), "compared")
    links, named = got.filter("b is not null").select("a", "b"), got.filter("b is null").select("group", F.col("a").alias("rep"), "label", "few")
    big = members.filter(F.col("n") > limit).select("group", "rep", "n")
    if not named.head(1):
        return links, None
    big = stash(payload.join(big, "rep"), "large-groups")
    before = None
    while True:
        open_ = stash(named.filter("few").groupBy("group").agg(F.count(F.lit(1)).alias("m"), F.count_distinct("label").alias("k")).filter("k > 1"), "open-groups")
        total = open_.agg(F.sum("k").alias("k"), F.max("m").alias("m")).first()
        if not total.k or before is not None and 2 * total.k > before:
            break
        before = total.k
        part = F.pmod(F.xxhash64("group", "label"), F.ceil(F.col("m") / F.lit(limit))).cast("int")  # a part's few stay together
        again = big.join(named.filter("few").join(open_, "group").select("group", "rep", "label", part.alias("_a"), part.alias("_b")), ["group", "rep"])
        got = stash(_compared(again.withColumn("asked", F.lit(True)), prepared, limit), "compared")
        links = links.unionByName(got.filter("b is not null").select("a", "b"))
        step = got.filter("b is null").select("group", F.col("a").alias("rep"), F.col("label").alias("to"), F.col("few").alias("still"))
        moved = named.filter("few").join(step, ["group", "rep"]).select("group", "label", "to").distinct()
        renamed = named.join(moved, ["group", "label"], "left").join(step.select("group", "rep", "still"), ["group", "rep"], "left")
        named = stash(renamed.select("group", "rep", F.coalesce("to", "label").alias("label"), F.coalesce("still", F.lit(False)).alias("few")), "named")
        if total.m <= limit:
            break
    tops = named.groupBy("group", "label").agg(F.count(F.lit(1)).alias("m")).groupBy("group").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("n"))
    named = named.join(tops.filter("n > top.m"), "group").withColumn("rest", F.col("n") - F.col("top.m"))
    named = stash(named.select("group", "rep", "label", "top", "rest", "n"), "rests")
    exact, left = named, None
    if leave:
        left = named.filter(F.col("rest") > limit).select("group", "rep")
        left = left if left.head(1) else None
        exact = named.filter(F.col("rest") <= limit)
    if exact.head(1):
        every = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(n / F.lit(limit)).cast("int") - 1))
        asked = exact.filter(F.col("label") != F.col("top.label")).select("group", _block("group", F.col("rest"), limit).alias("_a"), every(F.col("n")).alias("_b"), "rep", "label", F.lit(True).alias("asked"))
        others = exact.select("group", every(F.col("rest")).alias("_a"), _block("group", F.col("n"), limit).alias("_b"), "rep", "label", F.lit(False).alias("asked"))
        links = links.unionByName(stash(_compared(big.join(asked.unionByName(others), ["group", "rep"]), prepared, limit, named=False).select("a", "b"), "compared"))
    return links, left


def components(edges: DataFrame) -> DataFrame:
    """(rep, label) of every end of edges (a, b): label is the same within a component and differs between them.
    Each round moves every vertex to its neighbour with the smallest hash (or itself) and keeps the edges that remain
    between different ones, so the vertices fall by a share each round, whatever the graph's shape."""
    edges = stash(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        move = both.groupBy("a").agg(F.min(order("b")).alias("m")).select(F.col("a").alias("v"), F.least(order("a").alias("x"), F.col("m"))["id"].alias("to"))
        move = stash(move, "moves")
        if labels is None:
            labels = move.select(F.col("v").alias("rep"), F.col("to").alias("label"))
        else:
            labels = labels.join(move.withColumnRenamed("v", "label"), "label", "left").select("rep", F.coalesce("to", "label").alias("label"))
        ends = edges.join(move.select(F.col("v").alias("a"), F.col("to").alias("a2")), "a").join(move.select(F.col("v").alias("b"), F.col("to").alias("b2")), "b")
        edges = stash(ends.filter("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        if not edges.head(1):
            return labels


def chance_apart(level: int, similarity: float = 0.8) -> float:
    """That a pair of this similarity meets in no node of this level of a tree: the root picks one coordinate, others two.
    It grows with the level, but for 0.8 never beyond 1/4."""
    apart = 1 - similarity
    for _ in range(level - 1):
        apart = 1 - similarity + similarity * apart * apart
    return apart


def _search(reps: DataFrame, trees: range, limit: int, depth: int, least: int) -> tuple[list[DataFrame], int]:
    """Candidate links of these trees, and the deepest level. Nodes over the limit whose classes hang together, but for at
    most limit of them, are done with in linear time at the first level; the others branch."""
    nodes, leaves, links, sketches = _branch(reps, trees), [], [], _sketches(reps)
    for level in range(1, depth + 1):
        rows = stash(nodes, "nodes")
        sizes = stash(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "node-sizes")  # a table: both sides of the join are exchanged
        rows = stash(rows.join(sizes, "path").select(F.col("path").alias("group"), "rep", "n"), "shared-nodes")
        if level == depth or not sizes.filter(F.col("n") > limit).head(1):
            leaves.append(rows)
            break
        leaves.append(rows.filter(F.col("n") <= limit))
        left = rows.filter(F.col("n") > limit)
        if level == 1:  # near copies stay together whatever the path, so the first level finds them
            found, left = links_within(left, sketches, _by_sketches(least), limit, leave=True)
            links.append(found)
            if left is None:
                break
        nodes = _branch(left.select(F.col("group").alias("path"), "rep").join(reps, "rep").select("path", "rep", "signature"))
    own, many = _block("group", F.col("n"), limit), F.ceil(F.col("n") / F.lit(limit)).cast("int")
    cells = reduce(DataFrame.unionByName, leaves).withColumns({"_own": own, "_j": F.explode(F.sequence(F.lit(0), many - 1))})  # once, up to limit
    cells = cells.select("group", F.least("_own", "_j").alias("_a"), F.greatest("_own", "_j").alias("_b"), "rep", F.col("rep").alias("label"), F.lit(True).alias("asked"), "n")
    found = _compared(sketches.join(cells, "rep"), _by_sketches(least), limit, named=False)
    return [stash(found.select("a", "b"), "compared"), *links], level


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, trees: int = 9, limit: int = 1024, depth: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text)."""
    return _by_row(docs, width, percent, trees, limit, depth).drop("set_key")


def _by_row(docs: DataFrame, width: int = 5, percent: int = 80, trees: int = 9, limit: int = 1024, depth: int = 4) -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id, kept) of every row of docs."""
    profile = stash(profiles(docs, width), "profiles")
    some = profile.filter("n_shingles > 0 and doc_id is not null")
    classes = stash(some.groupBy("set_key").agg(F.min(F.struct("doc_id", "signature")).alias("m")).select("set_key", F.col("m.doc_id").alias("rep"), "m.signature"), "classes")
    reps, least = classes.select("rep", "signature"), int(0.62 * K)

    links, _ = _search(reps, range(trees), limit, depth, least)
    candidates = stash(components(reduce(DataFrame.unionByName, links)), "candidates")

    groups = stash(candidates.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "candidate-groups")
    members = stash(candidates.join(groups, "label").select(F.col("label").alias("group"), "rep", "n"), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").alias("data"))
    labels = components(links_within(members, texts, _by_sets(width, percent), max(2, limit // 4))[0])

    smallest = labels.groupBy("label").agg(F.min("rep").alias("component"))
    linked = labels.join(smallest, "label").select("rep", "component")
    of_class = classes.select("set_key", "rep").join(linked, "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    found = profile.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", "set_key", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _sketches(reps: DataFrame) -> DataFrame:
    """(rep, data): the low bytes of the signature, enough for comparing."""

    def made(batches):
        for batch in batches:
            if batch.num_rows:
                low = _matrix(batch.column(1), np.uint32).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in low], pa.binary())], ["rep", "data"])

    return reps.mapInArrow(made, "rep long, data binary")


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs, with all their columns, of one document of each group: that with the smallest doc_id. A row without
    an id goes if its own set of shingles is linked with a document that has one."""
    rows = stash(_by_row(docs, **settings), "by-row")
    names = iter(x for n in range(len(docs.columns) + 2) if (x := f"_kept{n}") not in docs.columns)
    id_, text = next(names), next(names)
    kept = rows.filter("kept and doc_id is not null").select(F.col("doc_id").alias(id_)).distinct()
    named = docs.filter(F.col("doc_id").isNotNull())
    first = named.join(kept, named["doc_id"].cast("long") == kept[id_], "left_semi")
    nameless = docs.filter(F.col("doc_id").isNull())
    gone = rows.filter("doc_id is null and not kept").select("set_key").distinct()
    texts = profiles(nameless.select(F.xxhash64("text").alias("doc_id"), "text"), settings.get("width", 5)).join(gone, "set_key").select(F.col("doc_id").alias(text)).distinct()
    return first.unionByName(nameless.join(texts, F.xxhash64(nameless["text"]) == texts[text], "left_anti"))
