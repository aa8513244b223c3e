"""Tables of forecast hours, partitioned by run and hour, with statistics of what was written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names for all executors. A local session that names none gets a new folder,
    once; on a cluster it is an error, since executors do not share local folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_hours(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces the partitions that df holds and leaves the others. Rebalancing keeps files few and splits a hot hour."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def check_schema(df: DataFrame, path: str) -> DataFrame:
    """df, if the table at path has its columns and types in any order; an error otherwise."""
    have = {f.name: f.dataType for f in df.sparkSession.read.parquet(path).schema}
    want = {f.name: f.dataType for f in df.schema}
    if have != want:
        raise ValueError(f"the table has another schema, so its version must change: {sorted(set(have) ^ set(want)) or 'types differ'}")
    return df


def hour_stats(df: DataFrame, by: list[str], value: str, low: float, high: float) -> DataFrame:
    """(by, cells, valid, nonzero, top, clipped) of each hour."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.count(v).alias("valid"), F.count_if(v != 0).alias("nonzero"), F.max(v).alias("top"), F.count_if((v < low) | (v > high)).alias("clipped"))


def partition_checks(df: DataFrame, by: list[str], value: str, fields: list[str]) -> DataFrame:
    """(by, cells, valid, nonzero, low, top, checksum) of each partition. The checksum is a sum of row digests over fields,
    so the order of rows and files does not matter and tasks sum first."""
    line = F.md5(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in fields]))
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.count(v).alias("valid"), F.count_if(v != 0).alias("nonzero"), F.min(v).alias("low"), F.max(v).alias("top"),
        F.sum(F.conv(F.substring(line, 1, 8), 16, 10).cast("long")).alias("checksum"))


def save_states(states: DataFrame, path: str, version: int = 1) -> None:
    """States (model, run, fhour, anchor, iy, ix, state) of model hours, to be handed over to later runs."""
    write_hours(states.withColumn("version", F.lit(version)), path, ["model", "run", "fhour"])


def load_states(spark: SparkSession, path: str, grid: DataFrame, version: int = 1, anchor: Column | None = None) -> DataFrame:
    """The stored states of this version (and anchor) of hours that have just the cells of grid (iy, ix)."""
    rows = spark.read.parquet(path).filter(F.col("version") == version)
    if anchor is not None:
        rows = rows.filter(F.col("anchor") == anchor)
    keys = ["model", "run", "fhour"]
    known = rows.join(grid.select("iy", "ix", F.lit(1).alias("_g")), ["iy", "ix"], "left").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count("_g").alias("_k"))
    size = grid.agg(F.count(F.lit(1)).alias("_size"))
    fit = known.join(F.broadcast(size)).filter("_n = _size and _k = _size")  # one row
    return rows.join(fit.select(*keys), keys, "left_semi").drop("version")


def save_baseline(hours: DataFrame, path: str, formula: str) -> None:
    """Potentials (run, fhour, iy, ix, lat, lon, potential) in half points, with the formula's version and the fingerprint of
    each hour's grid."""
    prints = grid_fingerprint(hours, ["run", "fhour"], ["iy", "ix"], ["lat", "lon"])
    rows = hours.select("run", "fhour", "iy", "ix", half_points(F.col("potential")).alias("potential")).withColumn("formula", F.lit(formula))
    write_hours(rows.join(prints.withColumnRenamed("fingerprint", "grid"), ["run", "fhour"]), path, ["run", "fhour"])


def with_complete(stats: DataFrame, run: list[str], hour: str, expected: list[int]) -> DataFrame:
    """stats with whether the run has exactly the expected hours."""
    runs = stats.groupBy(*run).agg(F.sort_array(F.collect_set(hour)).alias("_h"))
    want = F.array(*[F.lit(h) for h in sorted(expected)])
    return stats.join(runs.select(*run, (F.col("_h").cast("array<long>") == want.cast("array<long>")).alias("complete")), run)


def half_points(potential: Column) -> Column:
    """0 to 100 in steps of a half."""
    inside = F.when(potential < 0, 0.0).when(potential > 100, 100.0).otherwise(potential)
    return F.rint(inside * 2) / 2


def grid_fingerprint(cells: DataFrame, by: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """(by, fingerprint) of a grid: digests of its rows, in blocks of the first order column, then of the blocks, so that no
    task holds a whole grid's text."""
    line = F.sha2(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in [*order, *fields]]), 256)
    joined = lambda c: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*(order if c == "_l" else order[:1]), c))), lambda x: x[c]), ""), 256)
    blocks = cells.withColumn("_l", line).groupBy(*by, order[0]).agg(joined("_l").alias("_b"))  # by may be empty: one grid
    return blocks.groupBy(*by).agg(joined("_b").alias("fingerprint"))


def save_peaks(days: DataFrame, path: str, allow_partial: bool = False) -> None:
    """Days (model_key, fire_date, run_stamp, run_init, complete, cutoff_reached, danger, ...): a missing class is stored as
    0. Days that are neither complete nor (with allow_partial) past the guidance hour are an error."""
    reached = F.col("complete") | F.col("cutoff_reached")
    wrong = F.when(~F.col("complete") & F.lit(not allow_partial), "only complete days may be stored").when(~reached, "a partial day must reach the guidance hour")
    checked = F.when(wrong.isNotNull(), F.raise_error(wrong).cast("byte")).otherwise(F.coalesce("danger", F.lit(0)).cast("byte"))
    write_hours(days.withColumns({"danger": checked, "cutoff_reached": reached}), path, ["model_key", "fire_date", "run_stamp"])


def load_peaks(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """The newest run's rows of each model and day that began at or before as_of."""
    rows = spark.read.parquet(path).filter((F.col("run_init") <= as_of) & (F.col("complete") | F.col("cutoff_reached")))
    newest = rows.groupBy("model_key", "fire_date").agg(F.max("run_init").alias("run_init"))
    rows = rows.join(newest, ["model_key", "fire_date", "run_init"], "left_semi")
    return rows.withColumn("danger", F.nullif("danger", F.lit(0).cast("byte")))


def write_report(df: DataFrame, path: str, order: list[Column], limit: int | None = None) -> None:
    """One sorted table of text with a header; limit is that of a report."""
    rows = df.orderBy(*order)
    (rows if limit is None else rows.limit(limit)).write.mode("overwrite").option("header", True).csv(path)


def write_sweep_reports(scored: DataFrame, path: str, top: int = 50) -> None:
    """Of one ranked sweep (rank, label, varied, n_varied, score, ...): the full table by rank (path/full), its top (path/top)
    and the sets that vary one parameter, by parameter and value (path/one_at_a_time). A sweep is thousands of rows; it is
    stored once, and the reports read it."""
    spark, table = scored.sparkSession, f"{path}/scored"
    scored.write.mode("overwrite").parquet(table)
    rows = spark.read.parquet(table)
    write_report(rows, f"{path}/full", [F.asc("rank")])
    write_report(rows, f"{path}/top", [F.asc("rank")], top)
    write_report(rows.filter("n_varied = 1"), f"{path}/one_at_a_time", [F.asc("varied"), F.asc("value"), F.asc("rank")])
