"""Peak-burn days of a stream of hourly codes, emitted when a fire day is over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import clock
from ..operators import peak

VALUES = ("valid_ts", "wind_kmh", "ffmc", "fwi", "bui")


def closed_days(hours: DataFrame, keys: list[str], delay: str = "3 hours", zone: str = clock.LOCAL) -> DataFrame:
    """(keys, fire_date, h): the hours of each fire day, emitted once the watermark has passed its end. An hour of five
    in the morning also goes to the day before, which it ends. The state holds 26 rows a cell and open day at most."""
    wall = clock.local(F.col("valid_ts"), zone) - F.make_dt_interval(hours=F.lit(clock.RESET_HOUR))
    ends = F.hour(wall) == 0
    both = F.when(ends, F.array(wall, wall - F.expr("interval 1 hour"))).otherwise(F.array(wall))
    rows = hours.select(*keys, *VALUES, F.explode(both).alias("_at")).withWatermark("_at", delay)
    days = rows.groupBy(*keys, F.window("_at", "1 day").alias("w")).agg(F.collect_list(F.struct(*VALUES)).alias("h"))
    return days.select(*keys, F.to_date("w.start").alias("fire_date"), "h")


def peaks_of(days: DataFrame, keys: list[str]) -> DataFrame:
    """The peak of each closed day, as peak_days finds it. A boundary counts only on the very next day."""
    rows = days.select(*keys, F.col("fire_date").alias("_day"), F.inline("h"))
    return peak.peak_days(rows, [*keys, "_day"]).filter("fire_date = _day").drop("_day")


def write_peaks(hours: DataFrame, keys: list[str], path: str, checkpoint: str, delay: str = "3 hours") -> StreamingQuery:
    """Appends the peaks of closed days to path; a batch that is run again replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        peaks_of(batch, keys).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return closed_days(hours, keys, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
