"""Model runs: names, newest and complete ones, verification queue, hand-over hours, input signatures, the fire layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock

STAMP = r"^\d{8}T(00|06|12|18)Z$"


def level_tag(variable: Column, kind: Column, level: Column) -> Column:
    """A level as the newer file names write it."""
    kind = F.upper(kind)
    number = level.cast("int")
    surface = variable.isin("HLCY", "HPBL", "CAPE") | kind.isin("SFC", "ETAL", "EATM")
    return (
        F.when(surface, "Sfc").when(kind == "MSL", "MSL").when(kind == "TGL", F.format_string("AGL-%dm", number)).when(kind == "ISBL", F.format_string("ISBL_%04d", number))
        .otherwise(F.raise_error(F.concat(F.lit("no tag for the level "), kind)))
    )


def file_name(variable: Column, kind: Column, level: Column, stamp: Column, fhour: Column, grid: str, newer: bool = True) -> Column:
    """The name of a field's file, in the newer or the older style."""
    if newer:
        return F.format_string(f"%s_MSC_HRDPS_%s_%s_{grid}_PT%03dH.grib2", stamp, variable, level_tag(variable, kind, level), fhour.cast("int"))
    return F.format_string(f"CMC_hrdps_west_%s_%s_%s_{grid}_%s_P%03d-00.grib2", variable, kind, level.cast("string"), stamp, fhour.cast("int"))


def parsed_name(name: Column) -> Column:
    """struct(stamp, variable, level, fhour) of a file name of either style; null fields where it is of none."""
    new, old = r"^(\d{8}T\d{2}Z)_MSC_HRDPS_([^_]+)_(.+)_([^_]+)_PT(\d{3})H\.grib2$", r"^CMC_hrdps_west_(.+)_([A-Z]+)_([^_]+)_([^_]+)_(\d{8}T\d{2}Z)_P(\d{3})-00\.grib2$"
    pick = lambda i, j: F.when(name.rlike(new), F.regexp_extract(name, new, i)).when(name.rlike(old), F.regexp_extract(name, old, j))
    level = F.when(name.rlike(new), F.regexp_extract(name, new, 3)).when(name.rlike(old), F.concat_ws("_", F.regexp_extract(name, old, 2), F.regexp_extract(name, old, 3)))
    return F.struct(pick(1, 5).alias("stamp"), pick(2, 1).alias("variable"), level.alias("level"), pick(5, 6).cast("int").alias("fhour"))


def image_name(prefix: Column, stamp: Column, fhour: Column) -> Column:
    return F.format_string("%s_%s_f%03d.png", prefix, stamp, fhour.cast("int"))


def object_key(model: Column, product: Column, stamp: Column, filename: Column, verification: list[str]) -> Column:
    """Where a file is kept: by model, retention class, product and stamp."""
    kept = F.when(product.isin(verification), "verification").otherwise("forecast")
    return F.concat_ws("/", F.lit("models"), model, kept, product, stamp, filename)


def handoff_hours(cycles: DataFrame, model: str = "model", cycle: str = "cycle") -> DataFrame:
    """(model, hours): the smallest gap between the daily cycles of a model, around midnight too."""
    hour = F.col(cycle).cast("int")
    own = Window.partitionBy(model).orderBy("_h")
    rows = cycles.select(model, hour.alias("_h")).distinct()
    nxt = F.coalesce(F.lead("_h").over(own), F.first("_h").over(own))
    gaps = rows.withColumn("_g", F.pmod(nxt - F.col("_h"), F.lit(24))).filter("_g > 0")
    return gaps.groupBy(model).agg(F.min("_g").alias("hours"))


def newest_run(frames: DataFrame, needed: int, keys: list[str], stamp: str = "stamp", frame: str = "fhour") -> DataFrame:
    """(keys, stamp): the newest well-formed stamp with at least so many frames."""
    n = frames.filter(F.col(stamp).rlike(STAMP)).groupBy(*keys, stamp).agg(F.count_distinct(frame).alias("_n")).filter(F.col("_n") >= needed)
    return n.groupBy(*keys).agg(F.max(stamp).alias(stamp))


def latest_complete(runs: DataFrame, keys: list[str], init: str = "init", run: str = "run") -> DataFrame:
    """(keys, run, init) of the newest complete run; runs has complete."""
    return runs.filter("complete").groupBy(*keys).agg(F.max_by(run, init).alias(run), F.max(init).alias(init))


def cache_groups(cache: DataFrame, cutoff: Column, wanted: DataFrame | None = None) -> DataFrame:
    """(model, run, hours: map of forecast hour to path) of cached files (model, run, fhour, path) of runs from cutoff on;
    wanted (run) narrows them. Runs whose stamp is none go."""
    init = F.try_to_timestamp("run", F.lit("yyyyMMdd'T'HH'Z'"))
    rows = cache.filter(init >= cutoff)
    if wanted is not None:
        rows = rows.join(wanted.select("run").distinct(), "run", "left_semi")
    one = rows.groupBy("model", "run", "fhour").agg(F.max("path").alias("path"))
    return one.groupBy("model", "run").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("fhour", "path")))).alias("hours"))


def verification_states(groups: DataFrame, done: DataFrame, times: DataFrame, blocks: DataFrame, hours: Column, step_minutes: int = 10, block_hours: int = 3) -> DataFrame:
    """(model, run, start, end, state) of cache groups whose first 12Z to 12Z window lies within hours: waiting for cache,
    completed (in done: model, run), ready (all times (ts) of the window, or all its blocks (block_end), are there), or
    waiting for observations. Observations are counted by window once for all runs that share it."""
    ahead = clock.first_12z_hours(F.to_timestamp("run", "yyyyMMdd'T'HH'Z'"), hours)
    init = F.to_timestamp("run", "yyyyMMdd'T'HH'Z'")
    rows = groups.withColumn("_w", ahead).filter("_w is not null").withColumn("end", init + F.make_dt_interval(hours=F.element_at("_w", -1).cast("int")))
    rows = rows.withColumn("start", F.col("end") - F.make_dt_interval(hours=F.lit(24)))
    windows = rows.select("start", "end").distinct()
    have = lambda df, ts, seconds: (
        windows.withColumn("_t", F.explode(F.sequence(F.col("start") + F.make_dt_interval(secs=F.lit(seconds)), F.col("end"), F.make_dt_interval(secs=F.lit(seconds)))))
        .join(df.select(F.col(ts).cast("timestamp").alias("_t")).distinct().withColumn("_h", F.lit(1)), "_t", "left").groupBy("end").agg((F.count("_h") == F.count(F.lit(1))).alias("_all"))
    )
    raw, whole = have(times, "ts", 60 * step_minutes).withColumnRenamed("_all", "_raw"), have(blocks, "block_end", 3600 * block_hours).withColumnRenamed("_all", "_whole")
    rows = rows.join(raw, "end", "left").join(whole, "end", "left").join(done.select("model", "run").distinct().withColumn("_done", F.lit(True)), ["model", "run"], "left")
    cached = F.size(F.array_except("_w", F.transform(F.map_keys("hours"), lambda h: h.cast("int")))) == 0
    seen = F.coalesce("_raw", F.lit(False)) | F.coalesce("_whole", F.lit(False))
    state = F.when(~cached, "waiting for cache").when(F.col("_done"), "completed").when(seen, "ready").otherwise("waiting for observations")
    return rows.select("model", "run", "start", "end", state.alias("state"))


def queue_summary(states: DataFrame) -> DataFrame:
    """(state, n) with the candidates, all windows, as one state more."""
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n")).unionByName(states.agg(F.count(F.lit(1)).alias("n")).select(F.lit("candidates").alias("state"), "n"))


def signature(files: DataFrame, stamp: Column, now: Column, zone: str = clock.LOCAL) -> DataFrame:
    """One row: the newest change of each source of files (source, mtime), with the stamp and the local date."""
    per = files.groupBy("source").agg(F.max("mtime").alias("mtime"))
    return per.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", "mtime")))).alias("sources")).select(stamp.alias("stamp"), F.to_date(clock.local(now, zone)).alias("local_date"), "sources")


def signature_changed(new: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """new with changed: whether stored has no row of its keys or another signature."""
    text = F.concat_ws("|", "stamp", F.col("local_date").cast("string"), F.to_json("sources"))
    old = stored.select(*keys, text.alias("_old"))
    return new.join(old, keys, "left").withColumn("changed", ~F.col("_old").eqNullSafe(text)).drop("_old")


def dated_files(files: DataFrame, cutoff: Column, path: str = "path") -> DataFrame:
    """files whose date is not before cutoff: that of the name for tables (2026-07-14.csv), else of the three folders above
    (2026/07/14/x.json); files without a date go."""
    p = F.col(path)
    named, above = F.regexp_extract(p, r"(\d{4}-\d{2}-\d{2})\.csv$", 1), F.regexp_extract(p, r"(\d{4}/\d{2}/\d{2})/[^/]+\.json$", 1)
    day = F.coalesce(F.try_to_timestamp(F.nullif(named, F.lit("")), F.lit("yyyy-MM-dd")), F.try_to_timestamp(F.nullif(above, F.lit("")), F.lit("yyyy/MM/dd")))
    return files.withColumn("file_date", F.to_date(day)).filter(F.col("file_date") >= cutoff)


def fire_layer(snapshot: DataFrame, frames: DataFrame, stored: DataFrame, now: Column, fresh_hours: float = 1.0) -> DataFrame:
    """(product, available, source, observed_at, cached, stale, observations, version, changed) of the products of frames
    (product, sha) over one snapshot (source, retrieved_at, live, a row an observation; none: not available): cached where
    it was not live, stale where it is older than fresh_hours; changed against stored (product, sha)."""
    age = (F.unix_timestamp(now) - F.unix_timestamp("retrieved_at")) / 3600.0
    state = snapshot.agg(
        (F.count(F.lit(1)) > 0).alias("available"), F.max("source").alias("source"), F.max("retrieved_at").alias("observed_at"), F.coalesce(~F.bool_or("live"), F.lit(False)).alias("cached"),
        F.coalesce(F.min(age) > fresh_hours, F.lit(False)).alias("stale"), F.count(F.lit(1)).alias("observations"))
    old = stored.select("product", F.col("sha").alias("_old"))
    rows = frames.select("product", F.col("sha").alias("version")).join(old, "product", "left").withColumn("changed", ~F.col("_old").eqNullSafe(F.col("version"))).drop("_old")
    return rows.join(F.broadcast(state))  # one row


def publishable(ready: DataFrame, cooldown_minutes: int, deadline: str = "deadline", expected: int | None = None) -> DataFrame:
    """(run, at, hours, reason): when a run's ready hours (run, fhour, at, deadline) are published. An hour that becomes ready
    goes out at once if nothing was published in the last cooldown_minutes (open), or if the run then has all its expected
    hours (complete); otherwise together with what waits, when the cooldown since the last publish is over (timer) or at
    the deadline, whichever is first. Hours that are ready after the deadline go out as late. A run's hours, as many as its
    product has, are folded in one row; the same rule over a stream is in streaming/publishing.py."""
    gap, need = 60 * cooldown_minutes, -1 if expected is None else expected
    first = ready.groupBy("run", "fhour").agg(F.unix_timestamp(F.min("at")).alias("t"), F.unix_timestamp(F.max(deadline)).alias("end"))
    times = first.groupBy("run", "t").agg(F.collect_list(F.col("fhour").cast("long")).alias("fhours"), F.max("end").alias("end"))
    runs = times.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("t", "fhours"))).alias("hours"), F.max("end").alias("end"))
    out = lambda at, hours, reason: F.transform(hours, lambda h: F.struct(at.alias("at"), h.alias("fhour"), reason.alias("reason")))
    none = F.array().cast("array<long>")
    start = F.struct(F.lit(None).cast("long").alias("last"), none.alias("waiting"), F.lit(0).alias("n"), F.array().cast("array<struct<at:bigint,fhour:bigint,reason:string>>").alias("out"))
    due_of = lambda last: F.least(last + gap, F.col("end"))
    why = lambda last: F.when(last + gap <= F.col("end"), F.lit("timer")).otherwise(F.lit("deadline"))

    def settled(acc: Column, now: Column) -> Column:
        """The state once what was due before now has gone out."""
        over = (F.size(acc["waiting"]) > 0) & (due_of(acc["last"]) < now)
        gone = F.concat(acc["out"], out(due_of(acc["last"]), acc["waiting"], why(acc["last"])))
        return F.struct(F.when(over, due_of(acc["last"])).otherwise(acc["last"]).alias("last"), F.when(over, none).otherwise(acc["waiting"]).alias("waiting"), acc["n"].alias("n"), F.when(over, gone).otherwise(acc["out"]).alias("out"))

    def arrived(acc: Column, h: Column) -> Column:
        late = h["t"] > F.col("end")
        n = acc["n"] + F.when(late, 0).otherwise(F.size(h["fhours"]))
        free = acc["last"].isNull() | (h["t"] - acc["last"] >= gap)
        now = ~late & (free | (n == need))
        all_ = F.concat(acc["waiting"], h["fhours"])
        reason = F.when(late, F.lit("late")).when(n == need, F.lit("complete")).otherwise(F.lit("open"))
        gone = F.concat(acc["out"], out(h["t"], F.when(late, h["fhours"]).otherwise(all_), reason))
        return F.struct(
            F.when(now, h["t"]).otherwise(acc["last"]).alias("last"), F.when(now, none).when(late, acc["waiting"]).otherwise(all_).alias("waiting"),
            n.alias("n"), F.when(now | late, gone).otherwise(acc["out"]).alias("out"))

    step = lambda acc, h: F.element_at(F.transform(F.array(settled(acc, h["t"])), lambda s: arrived(s, h)), 1)
    ended = F.aggregate("hours", start, step, lambda acc: settled(acc, F.lit(1 << 60))["out"])
    rows = runs.select("run", F.inline(ended))
    return rows.groupBy("run", F.timestamp_seconds("at").alias("at"), "reason").agg(F.sort_array(F.collect_list("fhour")).alias("hours"))
