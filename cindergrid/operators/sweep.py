"""Parameter sweep of the older gust formula: candidates, metrics, score, ranks."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import physics as P
from ..sources import store

# The baseline and the ranges of the nine parameters.
BASELINE = {"dcape_coeff": 0.52, "w850_coeff": 0.65, "w700_coeff": 0.50, "li_start": 1.0, "li_span": 5.0, "li_gate": 0.0, "pbl_base_m": 300.0, "pbl_span_m": 1200.0, "dcape_min": 250.0}
RANGES = {
    "dcape_coeff": [0.25, 0.35, 0.45, 0.52, 0.60, 0.70, 0.85],
    "w850_coeff": [0.25, 0.40, 0.55, 0.65, 0.80, 1.00],
    "w700_coeff": [0.15, 0.30, 0.45, 0.50, 0.65, 0.85],
    "li_start": [0.0, 0.5, 1.0, 1.5, 2.0],
    "li_span": [3.0, 4.0, 5.0, 6.5, 8.0],
    "li_gate": [-1.0, 0.0, 1.0, 2.0],
    "pbl_base_m": [0.0, 150.0, 300.0, 500.0, 750.0],
    "pbl_span_m": [700.0, 1000.0, 1200.0, 1600.0, 2200.0],
    "dcape_min": [100.0, 250.0, 400.0, 600.0],
}
NAMES = list(BASELINE)


def candidates(spark: SparkSession, random_samples: int = 6000, seed: int = 20260629) -> DataFrame:
    """(seq, label, nine parameters): the baseline, one parameter at a time, and hashed random picks; of equal sets the
    first stays. li_gate is at most li_start + 0.75 among random ones."""
    one = spark.range(1).select(F.lit(0).cast("long").alias("seq"), F.lit("baseline").alias("label"), *[P.lit(v).alias(k) for k, v in BASELINE.items()])
    seq, all_ = 1, one
    for name in NAMES:
        values = F.posexplode(F.array(*map(P.lit, RANGES[name]))).alias("pos", "val")
        more = spark.range(1).select(values).select((F.col("pos") + seq).cast("long").alias("seq"), F.concat(F.lit(f"one_at_a_time_{name}_"), F.col("val").cast("string")).alias("label"), *[F.col("val").alias(k) if k == name else P.lit(v).alias(k) for k, v in BASELINE.items()])
        seq, all_ = seq + len(RANGES[name]), all_.unionByName(more)
    drawn = lambda i, n: (F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string"), F.lit(str(i)))), 1, 8), 16, 10).cast("long") % n + 1).cast("int")
    pick = lambda i, k: F.element_at(F.array(*map(P.lit, RANGES[k])), drawn(i, len(RANGES[k]))).alias(k)
    rnd = spark.range(random_samples).select((F.col("id") + seq).alias("seq"), F.concat(F.lit("random_"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("label"), *[pick(i, k) for i, k in enumerate(NAMES)])
    rnd = rnd.withColumn("li_gate", F.least(F.col("li_gate"), F.col("li_start") + 0.75))
    w = Window.partitionBy(*NAMES).orderBy("seq")
    return all_.unionByName(rnd).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def varied(params: DataFrame) -> DataFrame:
    """With n_varied and, where it is one, the parameter that differs from the baseline."""
    off = {k: (F.abs(F.col(k) - v) > 1e-6) for k, v in BASELINE.items()}
    n = sum((c.cast("int") for c in off.values()), F.lit(0))
    return params.withColumns({"n_varied": n, "varied": F.when(n == 1, F.coalesce(*[F.when(c, k) for k, c in off.items()]))})


def penalty(value: Column, low: float, high: float, scale: float) -> Column:
    below, above = (low - value) / scale, (value - high) / scale
    return F.when(value.isNull(), 999.0).when(value.between(low, high), 0.0).when(value < low, below * below).otherwise(above * above)


# Weight, bounds without penalty and scale of each part of the score.
PENALTIES = {
    "max60": (3.5, 0.035, 0.16, 0.04), "mean60": (2.5, 0.006, 0.045, 0.02), "max90": (5.0, 0.001, 0.035, 0.012), "mean90": (3.0, 0.00005, 0.006, 0.004), "p995": (2.5, 62.0, 92.0, 16.0), "top": (2.0, 82.0, 125.0, 25.0),
    "coast60": (2.0, 0.0, 0.18, 0.12), "ratio": (1.5, 0.0, 0.75, 0.5), "dcape_strong": (1.5, 450.0, 1400.0, 250.0), "li_strong": (1.5, -8.0, -1.2, 1.0), "pbl_strong": (1.0, 700.0, 3200.0, 500.0),
}
#: Bins of the first pass: gusts of this width in km/h, the last one open; other fields by this many of their own quantiles.
WIDTH, GUSTS, OTHERS = 0.25, 1024, 64
#: Sets in one matrix of counts, and the quantiles that are told, by what they are of.
BLOCK = 64
QUANTILES = (("gust", 0.99, "p99"), ("gust", 0.995, "p995"), ("dcape", 0.5, "dcape_strong"), ("li", 0.5, "li_strong"), ("pbl", 0.5, "pbl_strong"))
KINDS = ("gust", "dcape", "li", "pbl")
INPUTS = ("dcape", "li", "pbl", "w850", "w700")


def gusts(c: dict[str, np.ndarray], sets: np.ndarray):
    """For each set (a row of NAMES) the places of the rows that pass its gates, and their gusts. Factors that sets share
    are worked out once."""
    at = {k: i for i, k in enumerate(NAMES)}
    down, memo = np.sqrt(np.maximum(2 * c["dcape"], 0)), {}

    def once(key, make):
        if key not in memo:
            memo[key] = make()
        return memo[key]

    for p in sets:
        v = {k: p[i] for k, i in at.items()}
        momentum = once(("m", v["w850_coeff"], v["w700_coeff"]), lambda v=v: np.maximum(v["w850_coeff"] * c["w850"], v["w700_coeff"] * c["w700"]))
        of_li = once(("l", v["li_start"], v["li_span"]), lambda v=v: 3.6 * np.clip((v["li_start"] - c["li"]) / v["li_span"], 0, 1))
        of_pbl = once(("p", v["pbl_base_m"], v["pbl_span_m"]), lambda v=v: np.clip((c["pbl"] - v["pbl_base_m"]) / v["pbl_span_m"], 0, 1))
        open_ = once(("g", v["dcape_min"], v["li_gate"]), lambda v=v: np.flatnonzero((c["dcape"] >= v["dcape_min"]) & (c["li"] <= v["li_gate"])))
        yield open_, (of_li[open_] * of_pbl[open_]) * (v["dcape_coeff"] * down[open_] + momentum[open_])


def _columns(batches, rows: int = 1 << 16):
    """Columns of so many rows at a time, or a little more."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield {k: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in batch.schema.names}
            held, n = [], 0
    if n:
        yield {k: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in held[0].schema.names}


def _bin(gust: np.ndarray) -> np.ndarray:
    return np.minimum((gust / WIDTH).astype(np.int64), GUSTS - 1)


def _added(parts: DataFrame, width: int) -> DataFrame:
    """The sums of each block's matrices, of their last column the greatest, one after another as a task reads them."""

    def made(batches):
        total, last = None, None
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = np.frombuffer(counts.as_buffer()).reshape(-1, width)
                if block != last:
                    if last is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([total.tobytes()], pa.binary())], ["block", "counts"])
                    total, last = np.zeros_like(one), block
                top = np.maximum(total[:, -1], one[:, -1])
                total = total + one
                total[:, -1] = top
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([total.tobytes()], pa.binary())], ["block", "counts"])

    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(made, "block long, counts binary")


def _totals(rows: DataFrame, sets: np.ndarray, cuts: dict[str, np.ndarray], n_hours: int) -> DataFrame:
    """(block, counts): of each block of sets one matrix over all rows: counts by bin of gusts and, of strong ones, of the
    other fields; weights by hour over 60, over 90, and over 60 at the coast; the greatest gust. Tasks add up in memory,
    and so do those that a block's matrices meet in, one after another."""
    width = GUSTS + 3 * OTHERS + 3 * n_hours + 1

    def told(total):
        blocks = range(0, len(sets), BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK for b in blocks], pa.int64()), pa.array([total[b : b + BLOCK].tobytes() for b in blocks], pa.binary())], ["block", "counts"])

    def made(batches):
        total, some = np.zeros((len(sets), width)), False
        for c in _columns(batches):
            some = True
            others = [GUSTS + i * OTHERS + np.searchsorted(cuts[k], c[k], side="right") for i, k in enumerate(KINDS[1:])]
            hour = GUSTS + 3 * OTHERS + c["h"].astype(np.int64)
            for row, (at, gust) in zip(total, gusts(c, sets)):
                if not len(at):
                    continue
                row[:GUSTS] += np.bincount(_bin(gust), minlength=GUSTS)
                row[-1] = max(row[-1], gust.max() + 1)  # 0: no gust at all
                strong = gust >= 60
                if strong.any():
                    hit, over = at[strong], gust[strong] >= 90
                    for o in others:
                        row += np.bincount(o[hit], minlength=width)
                    w = c["weight"][hit]
                    row += np.bincount(hour[hit], w, width) + np.bincount(hour[hit] + n_hours, w * over, width) + np.bincount(hour[hit] + 2 * n_hours, w * c["coastal"][hit], width)
        if some:
            yield from told(total)

    return _added(rows.mapInArrow(made, "block long, counts binary"), width)


class _Bins:
    """The bins that hold quantiles, as slots: by place of the set and kind, with bounds to part each into PARTS."""

    def __init__(self, wanted: list[tuple], cuts: dict[str, np.ndarray], ends: dict[str, tuple]):
        self.slots = {key: i for i, key in enumerate(sorted({w[:3] for w in wanted}))}
        self.of: dict[int, list[tuple]] = {}
        for (k, kind, bin_), i in self.slots.items():
            if kind == "gust":
                low, high = bin_ * WIDTH, (bin_ + 1) * WIDTH
            else:
                edges = [ends[kind][0], *cuts[kind], ends[kind][1]]
                low, high = edges[bin_], edges[bin_ + 1]
            self.of.setdefault(k, []).append((KINDS.index(kind), bin_, i, low, PARTS / (high - low) if high > low else 0.0))
        self.cuts = cuts

    def found(self, c: dict[str, np.ndarray], sets: np.ndarray):
        """(slot, values in it, parts of the slot that they lie in) of a block of rows. A part grows with the value."""
        bins = [None, *(np.searchsorted(self.cuts[k], c[k], side="right") for k in KINDS[1:])]
        for k, (at, gust) in enumerate(gusts(c, sets)):
            strong, places = None, None
            for kind, bin_, slot, low, scale in self.of.get(k, ()):
                if kind == 0:
                    places = _bin(gust) if places is None else places
                    values = gust[places == bin_]
                else:
                    strong = at[gust >= 60] if strong is None else strong
                    values = c[KINDS[kind]][strong[bins[kind][strong] == bin_]]
                if len(values):
                    yield slot, values, np.clip((values - low) * scale, 0, PARTS - 1).astype(np.int64)


PARTS = 64


def _values_at(rows: DataFrame, sets: np.ndarray, cuts: dict[str, np.ndarray], ends: dict[str, tuple], wanted: list[tuple]) -> dict[tuple, float]:
    """{(place of the set, kind, bin, nth): value} of wanted: the nth smallest value of a bin. A pass counts the parts of
    these bins, and another fetches the values of the parts that are asked for, a few each."""
    bins, many = _Bins(wanted, cuts, ends), 1024
    asked: dict[int, list[int]] = {}
    for *key, nth in wanted:
        asked.setdefault(bins.slots[tuple(key)], []).append(nth)

    def counted(batches):
        total = np.zeros((len(bins.slots), PARTS + 1))
        for c in _columns(batches):
            for slot, _, part in bins.found(c, sets):
                total[slot, :PARTS] += np.bincount(part, minlength=PARTS)
        blocks = range(0, len(total), many)
        yield pa.RecordBatch.from_arrays([pa.array([b // many for b in blocks], pa.int64()), pa.array([total[b : b + many].tobytes() for b in blocks], pa.binary())], ["block", "counts"])

    def placed(batches):
        for batch in batches:
            out = []
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                for i, row in enumerate(np.frombuffer(counts.as_buffer()).reshape(-1, PARTS + 1)[:, :PARTS].astype(np.int64), block * many):
                    sums = np.cumsum(row)
                    for nth in asked.get(i, ()):
                        part = int(np.searchsorted(sums, nth, side="right"))
                        out.append((i, nth, part, nth - int(sums[part] - row[part])))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)] if out else [pa.array([], pa.int64())] * 4, ["slot", "nth", "part", "rank"])

    where = _added(rows.mapInArrow(counted, "block long, counts binary"), PARTS + 1).mapInArrow(placed, "slot long, nth long, part long, rank long").collect()  # a few rows a set
    parts: dict[int, list[int]] = {}
    for r in where:
        parts.setdefault(r.slot, []).append(r.part)

    def fetched(batches):
        out, size = [], 0
        for c in _columns(batches):
            for slot, values, part in bins.found(c, sets):
                for p in set(parts.get(slot, ())):
                    own, n = np.unique(values[part == p], return_counts=True)
                    out.append((np.full(len(own), slot), np.full(len(own), p), own, n))
                    size += len(own)
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["slot", "part", "value", "n"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["slot", "part", "value", "n"])

    got = rows.mapInArrow(fetched, "slot long, part long, value double, n long").groupBy("slot", "part", "value").agg(F.sum("n").alias("n"))
    ranked_ = got.withColumn("to", F.sum("n").over(Window.partitionBy("slot", "part").orderBy("value")))
    ranks = rows.sparkSession.createDataFrame([tuple(r) for r in where], "slot long, nth long, part long, rank long")
    hit = ranked_.join(F.broadcast(ranks), ["slot", "part"]).filter("rank < to and rank >= to - n").select("slot", "nth", "value").collect()  # ranks: a few a set
    keys = {i: key for key, i in bins.slots.items()}
    return {(*keys[r.slot], r.nth): r.value for r in hit}


def score(params: DataFrame, fields: DataFrame) -> DataFrame:
    """(seq, label, metrics, score) of every parameter set over fields (hour, cell, dcape, li, pbl, w850, w700, weight,
    coastal, period). Sets and hours are few (at most 100,000 and 10,000, else an error) and go to the tasks, which work on
    blocks of fields in vectors and send one matrix for each block of sets. Quantiles are exact, between neighbours by
    share: a second pass looks up their values in the bins that hold them."""
    spark = params.sparkSession
    given = params.select("seq", *NAMES).orderBy("seq").limit(100_001).collect()
    path = store.new_path(spark, "sweep-fields")
    weights = [F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight"), F.coalesce("coastal", F.lit(False)).cast("double").alias("coastal")]
    fields.filter(" and ".join(f"{k} is not null" for k in INPUTS)).select("hour", "period", *[F.col(k).cast("double") for k in INPUTS], *weights).write.parquet(path)
    good, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    hours = good.groupBy("hour", "period").agg(F.sum("weight").alias("all")).orderBy("hour", "period").limit(10_001).collect()
    if len(given) > 100_000 or len(hours) > 10_000:
        raise ValueError("a sweep takes at most 100,000 sets and 10,000 hours")
    seqs, sets = np.array([r.seq for r in given], np.int64), np.array([[float(r[k]) for k in NAMES] for r in given]).reshape(len(given), len(NAMES))
    split = good.rdd.getNumPartitions() < cores  # fields are few bytes for the work that all sets make of them
    index = spark.createDataFrame([(r.hour, r.period, i) for i, r in enumerate(hours)], good.select("hour", "period", F.lit(0).cast("long").alias("h")).schema)
    rows = (good.repartition(cores) if split else good).join(F.broadcast(index.withColumnsRenamed({"hour": "_h", "period": "_p"})), F.col("hour").eqNullSafe(F.col("_h")) & F.col("period").eqNullSafe(F.col("_p"))).select("h", *INPUTS, "weight", "coastal")
    edges = [F.percentile_approx(k, [i / OTHERS for i in range(1, OTHERS)]).alias(k) for k in KINDS[1:]]
    quantiles = good.agg(*edges, *[f(k).alias(f"{k}_{e}") for k in KINDS[1:] for e, f in (("low", F.min), ("high", F.max))]).first()
    cuts = {k: np.unique(np.array(quantiles[k] or [], float)) for k in KINDS[1:]}
    ends = {k: (quantiles[f"{k}_low"], quantiles[f"{k}_high"]) for k in KINDS[1:]}
    span = [(r.hour, r.period, float(r["all"] or 0)) for r in hours]
    found = _totals(rows, sets, cuts, len(hours)).mapInArrow(_metrics(span), METRIC_ROW).collect()  # a few numbers a set
    wanted = sorted({(r.k, p.kind, *end) for r in found for p in r.places for end in ((p.low, p.nth_low), (p.high, p.nth_high))})
    value = _values_at(rows, sets, cuts, ends, wanted) if wanted else {}
    measured = {r.k: r for r in found}
    out = []
    for k, seq in enumerate(seqs):
        r = measured.get(k)
        q = {p.name: value[k, p.kind, p.low, p.nth_low] * (1 - p.part) + value[k, p.kind, p.high, p.nth_high] * p.part for p in (r.places if r else [])}
        out.append((int(seq), *([r[c] for c in PLAIN] if r else [0.0] * 6 + [None]), span[r.hour if r else 0][0] if span else None, *(q.get(name) for _, _, name in QUANTILES)))
    names = [f"{c} double" for c in PLAIN] + [f"hour60 {fields.schema['hour'].dataType.simpleString()}"] + [f"{name} double" for _, _, name in QUANTILES]
    weighed = reduce(lambda a, b: a + b, [weight * penalty(F.col(k), low, high, scale) for k, (weight, low, high, scale) in PENALTIES.items()])
    return params.join(spark.createDataFrame(out, "seq long, " + ", ".join(names)), "seq").withColumn("score", weighed)


PLAIN = ("max60", "mean60", "max90", "mean90", "ratio", "coast60", "top")
METRIC_ROW = f"k long, {', '.join(c + ' double' for c in PLAIN)}, hour long, places array<struct<name:string,kind:string,part:double,low:long,nth_low:long,high:long,nth_high:long>>"


def _metrics(hours: list[tuple]):
    """Of blocks of counts: each set's metrics, the number of its worst hour, and where its quantiles lie: a bin and a rank
    in it, of both neighbours."""
    period, all_ = np.array([p for _, p, _ in hours], object), np.array([x for *_, x in hours])
    begin = {"gust": (0, GUSTS)} | {k: (GUSTS + i * OTHERS, OTHERS) for i, k in enumerate(KINDS[1:])}
    share = lambda a, b: float(a / b) if b else 0.0

    def one(k: int, row: np.ndarray) -> dict:
        w60, w90, c60 = row[GUSTS + 3 * OTHERS : -1].reshape(3, len(hours))
        f60, f90 = (np.divide(w, all_, out=np.zeros(len(hours)), where=all_ != 0) for w in (w60, w90))
        mean = lambda f, some: share(f[some].sum(), some.sum())
        m = {"k": k, "max60": float(f60.max(initial=0)), "mean60": share(f60.sum(), len(hours)), "max90": float(f90.max(initial=0)), "mean90": share(f90.sum(), len(hours))}
        m |= {"ratio": share(mean(f60, period == "morning"), mean(f60, period == "day")), "coast60": share(c60.sum(), w60.sum()), "top": float(row[-1] - 1) if row[-1] else None}
        m |= {"hour": int(f60.argmax()) if len(hours) else 0, "places": []}
        for kind, q, name in QUANTILES:
            first, n = begin[kind]
            counts = row[first : first + n].astype(np.int64)
            sums = np.cumsum(counts)
            if sums[-1]:
                at = q * (int(sums[-1]) - 1)
                (b, i), (c, j) = ((int(b), int(r - (sums[b] - counts[b]))) for r in (math.floor(at), math.ceil(at)) for b in [np.searchsorted(sums, r, side="right")])
                m["places"].append({"name": name, "kind": kind, "part": at - math.floor(at), "low": b, "nth_low": i, "high": c, "nth_high": j})
        return m

    width = GUSTS + 3 * OTHERS + 3 * len(hours) + 1

    def made(batches):
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [one(block * BLOCK + i, row) for i, row in enumerate(np.frombuffer(counts.as_buffer()).reshape(-1, width))]
                place = pa.struct([("name", pa.string()), ("kind", pa.string()), ("part", pa.float64()), *((c, pa.int64()) for c in ("low", "nth_low", "high", "nth_high"))])
                kinds = [("k", pa.int64()), *((c, pa.float64()) for c in PLAIN), ("hour", pa.int64()), ("places", pa.list_(place))]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in kinds], [c for c, _ in kinds])

    return made


def ranked(scored: DataFrame) -> DataFrame:
    """With rank by score (ties by seq), the baseline's rank, and whether a set is the best of those that vary its one
    parameter; a table of thousands, sorted once."""
    rows = scored.withColumn("rank", F.row_number().over(Window.orderBy("score", "seq")))
    own = F.row_number().over(Window.partitionBy("varied").orderBy("rank"))
    return rows.withColumns({"baseline_rank": F.max(F.when(F.col("seq") == 0, F.col("rank"))).over(Window.partitionBy()), "best_of_varied": F.col("varied").isNotNull() & (own == 1)})
