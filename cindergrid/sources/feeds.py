"""Readers of station, observation and forecast feeds. Where a feed says first or last line wins, lines are ordered by
file, block and position, so the choice does not hang on the order of tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock

ITEM = "struct<recordType:string,dailyTimestamp:string,dangerClass:string>"
COLLECTION = f"array<struct<stationCode:string,stationName:string,summaryData:array<{ITEM}>>>"
SNAPSHOT = f"snapshot_time_utc string, response struct<collection:{COLLECTION}>, collection {COLLECTION}"

# The record types that count as forecasts.
RECORD_TYPES = ["FORECAST", "ESTIMATE", "MANUAL"]


def _ordered(rows: DataFrame) -> DataFrame:
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    return rows.select("*", place.alias("_line"))


def _csv(spark: SparkSession, path) -> DataFrame:
    """All columns as text, named by the header that the files share."""
    return _ordered(spark.read.option("header", True).csv(path))


def _number(rows: DataFrame, name: str) -> Column:
    return (F.col(name).try_cast("double") if name in rows.columns else F.lit(None).cast("double"))


def stations(spark: SparkSession, path) -> DataFrame:
    """(station_code string, station_name, lat, lon): rows without code or place go, the first line of a code stays."""
    raw = _csv(spark, path)
    rows = raw.select(F.col("STATION_CODE").alias("station_code"), F.col("STATION_NAME").alias("station_name"), _number(raw, "LATITUDE").alias("lat"), _number(raw, "LONGITUDE").alias("lon"), "_line")
    best = rows.dropna(subset=["station_code", "lat", "lon"]).groupBy("station_code").agg(F.min_by(F.struct("station_name", "lat", "lon"), "_line").alias("m"))
    return best.select("station_code", "m.*")


def observations(spark: SparkSession, path) -> DataFrame:
    """(station_code, fire_date, station_name, observed_danger_class, observed_fwi, observed_bui) of the noon rows of daily
    files; the date is that of the file's name, or of the row where the name has none; the last line of a day stays."""
    raw = _csv(spark, path)
    stamp = F.regexp_replace("DATE_TIME", r"\.0$", "")
    stamp = F.when(F.length(stamp) < 10, F.lpad(stamp, 10, "0")).otherwise(stamp)
    named = F.regexp_extract(F.element_at(F.split(F.col("_line.file_path"), "/"), -1), r"^(\d{4}-\d{2}-\d{2})\.csv", 1)
    own = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2))
    rows = raw.filter(F.endswith(stamp, F.lit("12"))).select(
        F.col("STATION_CODE").alias("station_code"), F.coalesce(F.nullif(named, F.lit("")), own).alias("fire_date"), F.col("STATION_NAME").alias("station_name"),
        _number(raw, "DANGER_RATING").alias("observed_danger_class"), _number(raw, "FIRE_WEATHER_INDEX").alias("observed_fwi"), _number(raw, "BUILDUP_INDEX").alias("observed_bui"), "_line",
    )
    fields = F.struct("station_name", "observed_danger_class", "observed_fwi", "observed_bui")
    last = rows.dropna(subset=["observed_danger_class"]).groupBy("station_code", "fire_date").agg(F.max_by(fields, "_line").alias("m"))
    return last.select("station_code", "fire_date", "m.*")


def forecast_samples(spark: SparkSession, path, schema: str) -> DataFrame:
    """A tree of sample files as one table; unreadable files are passed over."""
    return spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).csv(path)


def forecast_snapshots(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """(station_code, station_name, run_init_utc, fire_date, lead_hours, forecast_danger_class) of nested snapshots: leads
    of zero hours or more, the last item of each station, date and snapshot."""
    raw = _ordered(spark.read.schema(SNAPSHOT).option("multiLine", multi_line).json(path))
    init = F.try_to_timestamp("snapshot_time_utc").alias("run_init_utc")
    own = raw.select(init, "_line", F.posexplode(F.coalesce("response.collection", "collection")).alias("_i", "s"))
    items = own.select("run_init_utc", "_line", "_i", "s.stationCode", "s.stationName", F.posexplode("s.summaryData").alias("_j", "d"))
    items = items.filter(F.upper("d.recordType").isin(RECORD_TYPES) & (F.length("d.dailyTimestamp") >= 8))
    stamp = F.col("d.dailyTimestamp")
    day = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substring(stamp, 7, 2))
    rows = items.select(
        F.col("stationCode").alias("station_code"), F.col("stationName").alias("station_name"), "run_init_utc", day.alias("fire_date"),
        clock.lead_hours(F.try_to_timestamp(day, F.lit("yyyy-MM-dd")), F.col("run_init_utc")).alias("lead_hours"),
        F.col("d.dangerClass").try_cast("double").alias("forecast_danger_class"), F.struct("_line", "_i", "_j").alias("_line"),
    )
    last = rows.filter("lead_hours >= 0").groupBy("station_code", "run_init_utc", "fire_date").agg(F.max_by(F.struct("station_name", "lead_hours", "forecast_danger_class"), "_line").alias("m"))
    return last.select("station_code", "run_init_utc", "fire_date", "m.*")


def obs_time(name: Column) -> Column:
    """The time that a file name holds; null where it holds none."""
    return F.try_to_timestamp(F.regexp_extract(name, r"(\d{8}T\d{4}Z)", 1), F.lit("yyyyMMdd'T'HHmm'Z'"))
