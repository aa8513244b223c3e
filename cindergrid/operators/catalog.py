"""Catalogue bookkeeping: readiness of hours, manifests, versions, retention, changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock


def missing_fields(required: DataFrame, listing: DataFrame) -> DataFrame:
    """(run, fhour, field) that are required (fhour, field) and not listed (run, fhour, field), for every listed run."""
    needs = required.agg(F.collect_set(F.struct("fhour", "field")).alias("needs"))  # a product's own list of fields: tens
    runs = listing.select("run").distinct().withColumn("one", F.lit(1)).join(F.broadcast(needs.withColumn("one", F.lit(1))), "one")
    return runs.select("run", F.explode("needs").alias("n")).select("run", "n.fhour", "n.field").join(listing, ["run", "fhour", "field"], "left_anti")


def complete_runs(required: DataFrame, listing: DataFrame) -> DataFrame:
    return listing.select("run").distinct().join(missing_fields(required, listing).select("run").distinct(), "run", "left_anti")


def ready_hours(requirements: DataFrame, listing: DataFrame) -> DataFrame:
    """(run, fhour) whose every requirement (fhour, need_hour, field) is listed: relational division by counts."""
    need = requirements.groupBy("fhour").agg(F.count(F.lit(1)).alias("need"))
    have = requirements.join(listing.select("run", F.col("fhour").alias("need_hour"), "field").distinct(), ["need_hour", "field"])
    return have.groupBy("run", "fhour").agg(F.count(F.lit(1)).alias("have")).join(need, "fhour").filter("have = need").select("run", "fhour")


def manifest(frames: DataFrame, wanted: int, share: float = 0.6) -> DataFrame:
    """(run, products map of sorted hours) of frames (run, product, fhour); products with fewer than ceil(share * wanted)
    frames go."""
    least = -(-int(wanted * share * 1000) // 1000)
    hours = frames.groupBy("run", "product").agg(F.sort_array(F.collect_set("fhour")).alias("hours")).filter(F.size("hours") >= least)
    return hours.groupBy("run").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("product", "hours")))).alias("products"))


def asset_version(frames: DataFrame) -> DataFrame:
    """(run, product, version): a digest of the ordered hours and digests."""
    rows = frames.groupBy("run", "product").agg(F.sort_array(F.collect_list(F.struct("fhour", "sha"))).alias("f"))
    text = F.array_join(F.transform("f", lambda x: F.concat_ws(":", x["fhour"].cast("string"), x["sha"])), ",")
    return rows.select("run", "product", F.sha2(text, 256).alias("version"))


def family_hours(frames: DataFrame, family: list[str]) -> DataFrame:
    """(run, fhour) that every product of the family has."""
    return frames.filter(F.col("product").isin(family)).groupBy("run", "fhour").agg(F.count_distinct("product").alias("n")).filter(F.col("n") == len(set(family))).select("run", "fhour")


def changed(current: DataFrame, stored: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows of current that stored lacks or has with other fields (nulls are equal)."""
    s = stored.select(F.col(key).alias("_k"), F.struct(*fields).alias("_s"))
    return current.join(s, F.col(key) == F.col("_k"), "left").filter(F.col("_k").isNull() | ~F.struct(*fields).eqNullSafe(F.col("_s"))).drop("_k", "_s")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key of both; of equally new ones, the one whose digest is largest, so runs agree."""
    both = stored.unionByName(incoming)
    return both.groupBy(key).agg(F.max_by(F.struct(*both.columns), F.struct(order, F.xxhash64(*both.columns))).alias("m")).select("m.*")


def retained(rows: DataFrame, now: Column, days: dict[str, int], product: str = "product", init: str = "init", default: int = 7) -> DataFrame:
    """Rows younger than their product's days."""
    limit = F.coalesce(*[F.when(F.col(product) == k, F.lit(v)) for k, v in days.items()], F.lit(default)) if days else F.lit(default)
    return rows.filter(F.col(init) >= now - F.make_dt_interval(days=limit))


def droppable_runs(runs: DataFrame, archived: DataFrame, keep: str) -> DataFrame:
    """Runs older than keep, without those of the cycles 00 and 12 whose archive is not complete."""
    cycle = F.substring("run", 10, 2)
    waiting = runs.filter(cycle.isin("00", "12")).join(archived, "run", "left_anti").select("run")
    return runs.filter(F.col("run") < keep).join(waiting, "run", "left_anti")


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.select("page_id", F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit('href="([^"]+)"'), F.lit(1))).alias("link"))


# Fixed value: the twelve bytes that end a whole image of the PNG kind.
IMAGE_END = "0000000049454E44AE426082"


def whole_images(files: DataFrame, content: str = "content") -> DataFrame:
    """Rows whose bytes end with the image's end marker."""
    return files.filter(F.substring(F.col(content), -12, 12) == F.unhex(F.lit(IMAGE_END)))


def superseded(frames: DataFrame, hours: Column, init: str = "init") -> DataFrame:
    """Frames (run, init, fhour) of runs that have a whole 12Z window, but for the frame of the window's end."""
    end = F.element_at(clock.first_12z_hours(F.col(init), hours), -1)
    return frames.withColumn("_end", end).filter("_end is not null and fhour <> _end").drop("_end")


def first_messages(messages: DataFrame, wanted: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """wanted (short_name, level_type, level, step) with the fields of each file's (keys) first message that fits, the name
    in any case. A file that lacks one stays, with found false."""
    on = ["short_name", "level_type", "level", "step"]
    want = wanted.withColumn("short_name", F.lower("short_name")).distinct()
    got = messages.withColumn("short_name", F.lower("short_name")).join(want, on, "left_semi")
    first = got.groupBy(*keys, *on).agg(F.min_by(F.struct(*fields), order).alias("_m"))
    listed = want.agg(F.collect_list(F.struct(*on)).alias("_w"))  # a product's own list of fields: tens
    every = messages.select(*keys).distinct().withColumn("_one", F.lit(1)).join(F.broadcast(listed.withColumn("_one", F.lit(1))), "_one").select(*keys, F.inline("_w"))
    return every.join(first, [*keys, *on], "left").select(*keys, *on, F.col("_m").isNotNull().alias("found"), *[F.col(f"_m.{f}").alias(f) for f in fields])
