"""Matching forecasts with observations, and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as P


def keep_one(df: DataFrame, keys: list[str], order: list, last: bool = True) -> DataFrame:
    """One row a key: the last (or first) by an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) if last else F.asc(c) for c in order])
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def matched(forecasts: list[DataFrame], observed: DataFrame) -> DataFrame:
    """All forecast sources (station, fire_date, lead, fclass, ...; missing columns null) with the day's observed class,
    the error and the lead group; leads outside the groups go."""
    all_ = forecasts[0]
    for more in forecasts[1:]:
        all_ = all_.unionByName(more, allowMissingColumns=True)
    days = all_.select("fire_date").distinct()
    obs = observed.join(days, "fire_date", "left_semi").select("station", "fire_date", "oclass").filter("oclass is not null")
    got = all_.filter("fclass is not null and lead >= 0").join(obs, ["station", "fire_date"])
    return got.withColumns({"error": F.col("fclass") - F.col("oclass"), "lead_group": P.lead_group(F.col("lead"))}).filter("lead_group is not null")


def metrics(pairs: DataFrame) -> DataFrame:
    """n, exact %, within one %, mean absolute error and bias by model and by (model, lead group), in one pass."""
    error = F.col("error")
    got = pairs.groupingSets([["model"], ["model", "lead_group"]], "model", "lead_group").agg(
        F.count(F.lit(1)).alias("n"), (100 * F.avg((error == 0).cast("double"))).alias("exact"), (100 * F.avg((F.abs(error) <= 1).cast("double"))).alias("within_one"),
        F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"))
    return got.withColumn("lead_group", F.coalesce("lead_group", F.lit("all")))


def coverage(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, first and last day, n, stations) of matched pairs."""
    return pairs.groupBy(*keys).agg(F.min("fire_date").alias("first"), F.max("fire_date").alias("last"), F.count(F.lit(1)).alias("n"), F.count_distinct("station").alias("stations"))


def confusion(pairs: DataFrame, classes: int = 5) -> DataFrame:
    """(oclass, fclass, n) with every cell of the square."""
    spark = pairs.sparkSession
    square = spark.range(1, classes + 1).select(F.col("id").alias("oclass"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(classes).cast("long"))).alias("fclass"))
    counts = pairs.groupBy(F.col("oclass").cast("long").alias("oclass"), F.col("fclass").cast("long").alias("fclass")).agg(F.count(F.lit(1)).alias("n"))
    return square.join(counts, ["oclass", "fclass"], "left").select("oclass", "fclass", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def latest(pairs: DataFrame) -> DataFrame:
    """Of each model, station and day the forecast with the smallest lead."""
    return keep_one(pairs, ["model", "station", "fire_date"], ["lead"], last=False)


def sampled(peaks: DataFrame, mapping: DataFrame, keys: list[str]) -> DataFrame:
    """peaks (keys, iy, ix, ...) at the cells of mapping (station, iy, ix, distance): a row for each station and key. Only
    mapped cells leave the scan of the grid."""
    cells = mapping.select("iy", "ix").distinct()
    return peaks.join(cells, ["iy", "ix"], "left_semi").join(mapping.select("station", "iy", "ix", "distance"), ["iy", "ix"]).select("station", *keys, *[c for c in peaks.columns if c not in {"iy", "ix", *keys}], "distance")


def kept_samples(samples: DataFrame, reach_km: float = 15.0) -> DataFrame:
    """The samples (fclass, distance, lead, ...) that count as forecasts: with a class, from a cell within reach, and not
    made after the day's target."""
    return samples.filter((F.col("fclass").isNotNull()) & (F.col("distance") <= reach_km) & (F.col("lead") >= 0))
