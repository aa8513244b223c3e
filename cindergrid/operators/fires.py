"""Fire detections: parsing, clustering, choice of source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The extent of requests and the size of cluster cells in degrees.
WEST, EAST, SOUTH, NORTH = -142.0, -108.0, 45.0, 61.0
LON_STEP, LAT_STEP = 0.12, 0.09

FEATURES = (
    "array<struct<geometry:struct<coordinates:array<double>>,properties:struct<FIRE_STATUS:string,FIRE_NUMBER:string,"
    "FIRE_OF_NOTE_IND:string,INCIDENT_NAME:string,CURRENT_SIZE:double>>>"
)


def active_fires(raw: DataFrame, column: str = "json") -> DataFrame:
    """Rows of JSON feature arrays; bad or outside coordinates and fires that are out go; a name equal to the id is blank."""
    f = raw.select(F.explode(F.from_json(column, FEATURES)).alias("f")).select("f.properties.*", F.get("f.geometry.coordinates", 0).alias("lon"), F.get("f.geometry.coordinates", 1).alias("lat"))
    f = f.filter(F.col("lon").between(WEST, EAST) & F.col("lat").between(SOUTH, NORTH) & (F.lower(F.trim(F.coalesce("FIRE_STATUS", F.lit("")))) != "out"))
    return f.select(
        F.col("FIRE_NUMBER").alias("fire_id"), "lon", "lat", F.col("FIRE_STATUS").alias("status"), F.col("CURRENT_SIZE").alias("size_ha"),
        F.when(F.col("INCIDENT_NAME") != F.col("FIRE_NUMBER"), F.col("INCIDENT_NAME")).alias("name"), (F.upper("FIRE_OF_NOTE_IND") == "Y").alias("of_note"),
    )


def clusters(spots: DataFrame) -> DataFrame:
    """(gx, gy, lon, lat, detections, frp, latest): power-weighted centres; missing or tiny power counts 0.1."""
    w = F.greatest(F.coalesce(F.nullif("frp", F.lit(0.0)), F.lit(0.1)), F.lit(0.1))
    inside = F.col("lon").between(WEST, EAST) & F.col("lat").between(SOUTH, NORTH)
    rows = spots.filter(inside).withColumn("w", w)
    cell = [F.floor((F.col("lon") - WEST) / LON_STEP).alias("gx"), F.floor((F.col("lat") - SOUTH) / LAT_STEP).alias("gy")]
    return rows.groupBy(*cell).agg(
        (F.sum(F.col("lon") * F.col("w")) / F.sum("w")).alias("lon"), (F.sum(F.col("lat") * F.col("w")) / F.sum("w")).alias("lat"),
        F.count(F.lit(1)).alias("detections"), F.sum("w").alias("frp"), F.max("ts").alias("latest"),
    )


def best_snapshot(snapshots: DataFrame, now, fresh_hours: float = 1.0, stale_hours: float = 12.0) -> DataFrame:
    """All rows of the best snapshot (snapshot_id, source primary|secondary, live, retrieved_at, ...): fresh before live,
    primary before secondary, then stale ones of at most stale_hours."""
    age = (F.unix_timestamp(now) - F.unix_timestamp("retrieved_at")) / 3600.0
    second = F.when(F.col("source") == "primary", 0).otherwise(2)
    rank = F.when(age <= fresh_hours, second).when(F.col("live"), second + 1).when(age <= stale_hours, F.when(F.col("source") == "primary", 4).otherwise(5))
    rows = snapshots.withColumn("_rank", rank).filter("_rank is not null")
    best = rows.agg(F.min(F.struct("_rank", -F.unix_timestamp("retrieved_at"), "snapshot_id")).alias("m")).select(F.col("m.snapshot_id"))
    return rows.join(F.broadcast(best), "snapshot_id", "left_semi").drop("_rank")  # one id
