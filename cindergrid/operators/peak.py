"""Peak-burn hour of each fire day: binomial wind smoother, best hour, low-moisture fallback, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import physics as P


def peak_days(hours: DataFrame, keys: list[str], ts: str = "valid_ts", zone: str = clock.LOCAL) -> DataFrame:
    """(keys, fire_date, fwi, bui, peak_hour, hour_count, complete, cutoff_reached, last_ts) of hours (keys, ts, wind_kmh,
    ffmc, fwi, bui). One shuffle by keys serves the windows and, with the same keys first, the aggregate."""
    rows = hours.withColumns({"local_ts": clock.local(F.col(ts), zone), "fire_date": clock.fire_date(F.col(ts), zone)})
    rows = rows.withColumn("local_hour", F.hour("local_ts"))
    day = Window.partitionBy(*keys, "fire_date").orderBy(ts)
    near = {i: F.lead("wind_kmh", i).over(day) for i in (1, 2)}
    back = {i: F.lag("wind_kmh", i).over(day) for i in (1, 2)}
    w = F.col("wind_kmh")
    rows = rows.withColumns({
        "seq": F.row_number().over(day), "n": F.count(F.lit(1)).over(Window.partitionBy(*keys, "fire_date")),
        "b1": back[1], "b2": back[2], "a1": near[1], "a2": near[2],
        "next_hour": F.lead("local_hour").over(Window.partitionBy(*keys).orderBy(ts)),
    })
    edge = (F.col("seq") == 1) | (F.col("seq") == F.col("n"))
    second = (F.col("seq") == 2) | (F.col("seq") == F.col("n") - 1)
    three = 0.25 * F.col("b1") + 0.5 * w + 0.25 * F.col("a1")
    five = (F.col("b2") + 4.0 * F.col("b1") + 6.0 * w + 4.0 * F.col("a1") + F.col("a2")) / 16.0
    smooth = F.when(edge, w).when(second, three).otherwise(five)
    rows = rows.withColumn("score", P.spread_index(F.col("ffmc"), smooth))
    good = F.col("score").isNotNull() & F.col("fwi").isNotNull() & F.col("bui").isNotNull()
    value = F.struct("fwi", "bui", F.col("local_hour").alias("hour"))
    days = rows.groupBy(*keys, "fire_date").agg(
        F.max_by(value, F.when(good, F.struct("score", -F.col("seq")))).alias("best"),
        F.max_by(value, F.when(F.col("local_hour") == clock.RESET_HOUR + 12, F.col("seq"))).alias("late"),
        F.max("ffmc").alias("max_ffmc"), F.count(F.lit(1)).alias("hour_count"), F.min_by("local_hour", "seq").alias("first_hour"),
        F.max_by("next_hour", "seq").alias("end_hour"), F.max(ts).alias("last_ts"), F.max("local_ts").alias("last_local"),
    )
    low = (F.col("max_ffmc") < 85) & F.col("late").isNotNull()
    peak = F.when(low, F.col("late")).otherwise(F.col("best"))
    cutoff = (F.to_date("last_local") > F.col("fire_date")) | (F.hour("last_local") >= 17)
    complete = (F.col("first_hour") == clock.RESET_HOUR) & (F.coalesce("end_hour", F.lit(-1)) == clock.RESET_HOUR) & F.col("hour_count").between(23, 25)
    return days.select(*keys, "fire_date", peak["fwi"].alias("fwi"), peak["bui"].alias("bui"), peak["hour"].alias("peak_hour"), "hour_count", complete.alias("complete"), cutoff.alias("cutoff_reached"), "last_ts")
