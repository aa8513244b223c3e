"""Days of hourly rows by the local clock: extremes, noon samples, seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import physics as P


def extremes(hours: DataFrame, keys: list[str], value: str, ts: str = "valid_ts", zone: str = clock.LOCAL) -> DataFrame:
    """(keys, local_date, top, top_hour, low, low_hour) from local midnight to midnight; the earliest hour on ties."""
    rows = hours.withColumn("_l", clock.local(F.col(ts), zone))
    order = -F.unix_timestamp(F.col(ts).cast("timestamp"))
    at = lambda v: F.hour(F.max_by("_l", F.when(v.isNotNull(), F.struct(v, order)))).cast("long")
    v = F.col(value)
    return rows.groupBy(*keys, F.to_date("_l").alias("local_date")).agg(F.max(v).alias("top"), at(v).alias("top_hour"), F.min(v).alias("low"), at(-v).alias("low_hour"))


def noon_samples(hours: DataFrame, keys: list[str], values: list[str], running_total: str, ts: str = "valid_ts", zone: str = clock.LOCAL, floor: float = 1e-4) -> DataFrame:
    """(keys, local_date, values at local noon, rain_24h, rain_tomorrow): rain from the noon before to this one by a running
    total (missing on the first day), and what falls from noon to the last hour that is there, 0 up to floor."""
    rows = hours.withColumn("_l", clock.local(F.col(ts), zone))
    noon = F.hour("_l") == 12
    late = F.max_by(running_total, ts)
    day = rows.groupBy(*keys, F.to_date("_l").alias("local_date")).agg(*[F.max(F.when(noon, F.col(c))).alias(c) for c in values], F.max(F.when(noon, F.col(running_total))).alias("_r"), late.alias("_e"))
    since, after = F.col("_r") - F.lag("_r").over(Window.partitionBy(*keys).orderBy("local_date")), F.col("_e") - F.col("_r")
    return day.withColumns({"rain_24h": P.at_least(since, 0.0), "rain_tomorrow": F.when(after > floor, after).when(after.isNotNull(), 0.0)}).drop("_r", "_e")


def seasons(days: DataFrame, keys: list[str], day: str, temp: Column, rain: Column, cold: float = 5.0, warm: float = 12.0) -> DataFrame:
    """days with season, onset, days_in and winter_rain: winter once the highest temperature of three days is below cold,
    summer once it is above warm, else as before; the counters begin anew at each onset. Rain counts in winter only. One
    shuffle, by keys."""
    w = Window.partitionBy(*keys).orderBy(day)
    rows = days.withColumns({"_t": temp, "_r": rain})
    top = F.max("_t").over(w.rowsBetween(-2, 0))
    rows = rows.withColumn("_c", F.when(top < cold, "winter").when(top > warm, "summer"))
    rows = rows.withColumn("season", F.last("_c", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("onset", ~F.lag("season").over(w).eqNullSafe(F.col("season")))
    rows = rows.withColumn("_s", F.sum(F.col("onset").cast("int")).over(w))
    spell = Window.partitionBy(*keys, "_s").orderBy(day)
    wet = F.sum(F.when(F.col("season") == "winter", F.col("_r")).otherwise(0.0)).over(spell.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({"days_in": F.row_number().over(spell).cast("long"), "winter_rain": wet}).drop("_t", "_r", "_c", "_s")
