"""Usage reports and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock

# Billing classes of storage operations (names in lower case, letters and digits only), and free amounts.
CLASS_A = ["listbuckets", "putbucket", "listobjects", "listobjectsv2", "putobject", "copyobject", "completemultipartupload", "createmultipartupload", "lifecyclestoragetiertransition", "listmultipartuploads", "uploadpart", "uploadpartcopy", "listparts", "putbucketencryption", "putbucketcors", "putbucketlifecycleconfiguration"]
CLASS_B = ["headbucket", "headobject", "getobject", "usagesummary", "getbucketencryption", "getbucketlocation", "getbucketcors", "getbucketlifecycleconfiguration"]
FREE = ["deleteobject", "deletebucket", "abortmultipartupload"]
FREE_GB, FREE_A, FREE_B = 10.0, 1_000_000, 10_000_000


def billing_class(action: Column, a: list[str] = CLASS_A, b: list[str] = CLASS_B, free: list[str] = FREE) -> Column:
    name = F.regexp_replace(F.lower(action), "[^a-z0-9]", "")
    return F.when(name.isin(a), "class_a").when(name.isin(b), "class_b").when(name.isin(free), "free").otherwise("unknown")


def operation_totals(ops: DataFrame, **classes) -> DataFrame:
    """(billing_class, requests, actions map of the unknown ones)."""
    per = ops.withColumn("billing_class", billing_class(F.col("action"), **classes)).groupBy("billing_class", "action").agg(F.sum("requests").alias("n"))
    names = F.map_from_entries(F.sort_array(F.collect_list(F.when(F.col("billing_class") == "unknown", F.struct("action", "n")))))
    return per.groupBy("billing_class").agg(F.sum("n").alias("requests"), names.alias("actions"))


def storage_totals(rows: DataFrame) -> DataFrame:
    """Sums over the newest row of each bucket (bucket, observed_at, payload, metadata, objects, uploads)."""
    newest = rows.groupBy("bucket").agg(F.max(F.struct("observed_at", "payload", "metadata", "objects", "uploads")).alias("m"))
    total = lambda c: F.coalesce(F.sum(f"m.{c}"), F.lit(0)).alias(c)
    return newest.agg(*[total(c) for c in ("payload", "metadata", "objects", "uploads")], F.max("m.observed_at").alias("observed_at"))


def projected(observed: Column, now: Column, day: Column) -> Column:
    """The count at the period's end, with a floor of one day."""
    start, end = (F.unix_timestamp(f(now, day).cast("timestamp")) for f in (clock.billing_start, clock.billing_end))
    share = F.greatest(F.greatest(F.unix_timestamp(now) - start, F.lit(86400)) / (end - start), F.lit(1 / 31))
    return observed / share


def level(fraction: Column) -> Column:
    return F.when(fraction >= 0.9, "critical").when(fraction >= 0.7, "warning").otherwise("ok")


def alerts(checks: DataFrame, again_hours: int = 24) -> DataFrame:
    """Of (monitor, ts, level) the rows to notify: not ok, and the level is new or the last notice is a day old. A notice
    depends on the one before, so the rows of one run of equal levels are folded in order."""
    w = Window.partitionBy("monitor").orderBy("ts")
    runs = checks.withColumn("_new", F.coalesce(F.lag("level").over(w) != F.col("level"), F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(w))
    rows = runs.filter("level <> 'ok'").groupBy("monitor", "_run", "level").agg(F.sort_array(F.collect_list(F.unix_timestamp("ts"))).alias("t"))
    far = lambda a, x: F.coalesce(x - F.element_at(a, -1) >= again_hours * 3600, F.lit(True))
    told = F.aggregate("t", F.array().cast("array<long>"), lambda a, x: F.when((F.size(a) == 0) | far(F.when(F.size(a) > 0, a).otherwise(F.array(x)), x), F.concat(a, F.array(x))).otherwise(a))
    return rows.select("monitor", F.explode(told).alias("t"), "level").select("monitor", F.timestamp_seconds("t").alias("ts"), "level")
