"""As-of choice of products, runs and states."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_before(wanted: DataFrame, products: DataFrame, on: list[str], as_of: str, init: str, fields: list[str], slices: int = 64) -> DataFrame:
    """wanted with the fields of the newest product with equal `on` and init <= as_of; null where there is none.

    A segmented scan: times are cut at quantiles into slices, and each (key, slice) is scanned by itself, so a key that holds
    all rows is as many tasks as slices. What a slice starts with is the newest product of the slices before, found
    by a scan over one row for each key and slice. Nothing is joined."""
    ids = wanted.columns
    keys = [f"_k_{c}" for c in on]
    some = F.col(init).isNotNull()
    for c in on:
        some = some & F.col(c).isNotNull()
    w = wanted.select(*[F.col(c).alias(f"_k_{c}") for c in on], F.col(as_of).alias("_t"), F.lit(2).alias("_asks"), F.struct(*ids).alias("_w"))
    p = products.filter(some).select(*[F.col(c).alias(f"_k_{c}") for c in on], F.col(init).alias("_t"), F.lit(1).alias("_asks"), F.struct(init, *fields).alias("_p"))
    rows = w.unionByName(p, allowMissingColumns=True)
    cuts = rows.agg(F.percentile_approx("_t", [i / slices for i in range(1, slices)])).first()[0] or []
    edges = F.array(*[F.lit(c).cast(rows.schema["_t"].dataType) for c in sorted(set(cuts))]) if cuts else F.array()
    rows = rows.withColumn("_s", F.size(F.filter(edges, lambda e: e < F.col("_t"))) if cuts else F.lit(0))
    # of every key and slice: whether it asks, and its newest product
    ends = rows.groupBy(*keys, "_s").agg(F.max(F.when(F.col("_asks") == 1, F.struct("_t", "_p"))).alias("_m"), F.max("_asks").alias("_x"))
    earlier = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_p", F.last("_m._p", ignorenulls=True).over(earlier)).filter("_x = 2 and _p is not null").select(*keys, "_s", F.lit(0).alias("_asks"), "_p")
    first = F.when(F.col("_asks") == 0, 0).otherwise(1)
    order = Window.partitionBy(*keys, "_s").orderBy(first, "_t", "_asks", "_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = rows.unionByName(carried, allowMissingColumns=True).withColumn("_p", F.last("_p", ignorenulls=True).over(order)).filter("_asks = 2")
    known = F.col("_t").isNotNull()
    return got.select(*[F.col(f"_w.{c}").alias(c) for c in ids], *[F.when(known, F.col(f"_p.{f}")).alias(f"found_{f}") for f in [init, *fields]])


def newest_with_days_back(wanted: DataFrame, products: DataFrame, on: list[str], day: str, as_of: str, init: str, back: int = 1) -> DataFrame:
    """(on, day, as_of, found_day, found_init): the newest product of the day with init <= as_of, else of up to `back` days
    before. Each of the back + 1 days asks for itself, in one scan."""
    w = wanted.select(*on, day, as_of).distinct().withColumn("_d", F.explode(F.sequence(F.date_sub(F.col(day), back), F.col(day))))
    found = newest_before(w, products.select(*on, F.col(day).alias("_d"), F.col(init).alias("_i")), [*on, "_d"], as_of, "_i", [])
    best = found.filter("found__i is not null").groupBy(*on, day, as_of).agg(F.max(F.struct("_d", "found__i")).alias("m"))
    return best.select(*on, day, as_of, F.col("m._d").alias("found_day"), F.col("m.found__i").alias("found_init"))


def anchor_days(runs: DataFrame, init: str, local_date: str, count: int = 4, hour: int = 20) -> DataFrame:
    """runs with anchor: the local date and the ones before it whose 20Z is not after init."""
    days = runs.withColumn("anchor", F.explode(F.sequence(F.date_sub(F.col(local_date), count - 1), F.col(local_date))))
    return days.filter(F.unix_timestamp(F.col("anchor").cast("timestamp")) + hour * 3600 <= F.unix_timestamp(F.col(init).cast("timestamp")))


def bridge_run(wanted: DataFrame, runs: DataFrame, on: list[str], anchor: str, target: str, init: str, reach_hours: int = 48) -> DataFrame:
    """(on, anchor, target, bridge): the newest run with init <= anchor that reaches target."""
    found = newest_before(wanted.select(*on, anchor, target).distinct(), runs, on, anchor, init, []).withColumnRenamed(f"found_{init}", "bridge")
    return found.filter(F.col("bridge") + F.make_dt_interval(hours=F.lit(reach_hours)) >= F.col(target))


def previous_state(wanted: DataFrame, states: DataFrame, on: list[str], hour: str, lags: tuple[int, ...] = (6, 12, 18, 24)) -> DataFrame:
    """(on, hour, lag, state): the state at the first of the lags that has one."""
    w = wanted.withColumn("lag", F.explode(F.array(*map(F.lit, lags)))).withColumn("_h", F.col(hour) - F.col("lag"))
    got = w.join(states.withColumnRenamed(hour, "_h"), [*on, "_h"])
    return got.groupBy(*on, hour).agg(F.min(F.struct("lag", "state")).alias("m")).select(*on, hour, "m.lag", "m.state")


def first_candidate(candidates: DataFrame, keys: list[str], priority: str, fields: list[str]) -> DataFrame:
    """The fields of each key's candidate of least priority (ties: the fields' order)."""
    return candidates.groupBy(*keys).agg(F.min(F.struct(priority, *fields)).alias("m")).select(*keys, "m.*")
