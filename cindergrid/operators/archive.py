"""Archives of model hours and observations: packing, wide and long tables, status, what is still to be stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import physics as P

# Packing of fields as 16-bit integers.
FILL, TOP = -32768, 32767
PROFILE_LEVELS = (1000, 985, 970, 950, 925, 900, 875, 850, 800, 750, 700, 650, 600, 550, 500, 450, 400, 350, 300, 250)
PROFILE_PACKING = {"tmp": (273.15, 0.05), "spfh": (0.0, 1.0e-5)}
CYCLES = ("00", "12")


def profile_fields(levels: tuple[int, ...] = PROFILE_LEVELS, packing: dict[str, tuple[float, float]] | None = None) -> dict[str, tuple[float, float]]:
    """Name, offset and scale of the fields that every level has; other fields come from the caller."""
    return {f"{name}_{level}": p for level in levels for name, p in (PROFILE_PACKING if packing is None else packing).items()}


# The archive's other fields, as name, variable, level, unit, offset, scale; those of several levels by rule.
WINDS, LIFTS = (850, 700, 500, 250), (1000, 850, 700, 500, 250)
SINGLE = (
    ("cape", "CAPE", "Sfc", "J kg-1", 0.0, 1.0), ("mu_li", "MU-VT-LI", "ISBL_0500", "K", 0.0, 0.05), ("lifted_index", "LFTX", "ISBL_0500", "K", 0.0, 0.05),
    ("surface_pressure", "PRES", "Sfc", "Pa", 100000.0, 10.0), ("mslp", "PRMSL", "MSL", "Pa", 100000.0, 10.0), ("tmp_2m", "TMP", "AGL-2m", "K", 273.15, 0.05), ("dpt_2m", "DPT", "AGL-2m", "K", 273.15, 0.05),
    ("ugrd_10m", "UGRD", "AGL-10m", "m s-1", 0.0, 0.1), ("vgrd_10m", "VGRD", "AGL-10m", "m s-1", 0.0, 0.1), ("pbl_height", "HPBL", "Sfc", "m", 0.0, 1.0), ("storm_relative_helicity", "HLCY", "Sfc", "m2 s-2", 0.0, 0.1),
    ("precip_rate", "PRATE", "Sfc", "kg m-2 s-1", 0.0, 2.0e-6), ("precip_accum", "APCP", "Sfc", "kg m-2", 0.0, 0.05), ("column_cloud_water", "CWAT", "EATM", "kg m-2", 0.0, 0.01),
    ("total_cloud_cover", "TCDC", "Sfc", "%", 0.0, 0.01), ("height_500", "HGT", "ISBL_0500", "gpm", 5500.0, 0.5), ("absolute_vorticity_500", "ABSV", "ISBL_0500", "s-1", 0.0, 1.0e-6),
)
NOT_AT_START = ("precip_rate", "precip_accum")


def dimension(spark: SparkSession) -> DataFrame:
    """The archive's fields, a row each: field, variable, level, unit, offset, scale, at_start (whether hour 0 has it)."""
    units = {"tmp": ("TMP", "K"), "spfh": ("SPFH", "kg kg-1")}
    rows = [(name, *_of_level(name, units), offset, scale) for name, (offset, scale) in profile_fields().items()]
    rows += [(f"{v.lower()}_{level}", v, f"ISBL_{level:04d}", "m s-1", 0.0, 0.1) for v in ("UGRD", "VGRD") for level in WINDS]
    rows += [(f"vvel_{level}", "VVEL", f"ISBL_{level:04d}", "Pa s-1", 0.0, 0.01) for level in LIFTS]
    rows += list(SINGLE)
    return spark.createDataFrame([(*r, r[0] not in NOT_AT_START) for r in rows], "field string, variable string, level string, unit string, offset double, scale double, at_start boolean")


def _of_level(name: str, units: dict[str, tuple[str, str]]) -> tuple[str, str, str]:
    kind, _, level = name.rpartition("_")
    return units[kind][0], f"ISBL_{int(level):04d}", units[kind][1]


def pack_long(fields: DataFrame, dim: DataFrame) -> DataFrame:
    """fields (..., field, value) with packed and clipped (whether packing cuts the value) by the dimension; a field that
    the dimension has not is an error."""
    rows = fields.join(F.broadcast(dim.select("field", "offset", "scale")), "field", "left")  # tens of rows
    steps = F.rint((F.col("value") - F.col("offset")) / F.col("scale"))
    known = F.when(F.col("scale").isNull(), F.raise_error(F.concat(F.lit("no field of the archive is named "), F.col("field"))).cast("int"))
    whole = F.coalesce(known, P.clip(steps, float(-TOP), float(TOP)).cast("int"), F.lit(FILL))
    return rows.withColumns({"packed": whole, "clipped": F.coalesce(F.abs(steps) > TOP, F.lit(False))}).drop("offset", "scale")


def unpack_long(fields: DataFrame, dim: DataFrame) -> DataFrame:
    """fields (..., field, packed) with value."""
    rows = fields.join(F.broadcast(dim.select("field", "offset", "scale")), "field")
    return rows.withColumn("value", F.when(F.col("packed") != FILL, F.col("packed") * F.col("scale") + F.col("offset"))).drop("offset", "scale")


def missing_names(fields: DataFrame, keys: list[str], dim: DataFrame) -> DataFrame:
    """(keys, missing): of each hour (keys, fhour among them) with any field, the sorted names that it should have and has not."""
    names = [(r.field, r.at_start) for r in dim.select("field", "at_start").collect()]  # tens of rows
    must = field_names(sorted(n for n, _ in names), F.col("fhour"), [n for n, first in names if not first])
    have = fields.groupBy(*keys).agg(F.collect_set("field").alias("_have"))
    return have.select(*keys, F.sort_array(F.array_except(must, "_have")).alias("missing"))


def packed(value: Column, offset: float, scale: float) -> Column:
    """value as an integer of (value - offset) / scale, half to even, at most TOP on either side; FILL where it is missing."""
    steps = F.rint((value - F.lit(offset)) / F.lit(scale))
    return F.coalesce(P.clip(steps, float(-TOP), float(TOP)).cast("int"), F.lit(FILL))


def unpacked(value: Column, offset: float, scale: float) -> Column:
    return F.when(value != FILL, value * F.lit(scale) + F.lit(offset))


def pack(fields: DataFrame, specs: dict[str, tuple[float, float]]) -> DataFrame:
    """fields with the columns of specs packed."""
    return fields.withColumns({k: packed(F.col(k), *s) for k, s in specs.items()})


def clip_counts(fields: DataFrame, keys: list[str], specs: dict[str, tuple[float, float]]) -> DataFrame:
    """(keys, field, valid, clipped): how many values of each field packing would cut."""
    out = lambda k, s: F.abs(F.rint((F.col(k) - F.lit(s[0])) / F.lit(s[1]))) > TOP
    counts = fields.groupBy(*keys).agg(*[F.count(k).alias(f"n_{k}") for k in specs], *[F.count_if(out(k, s)).alias(f"c_{k}") for k, s in specs.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"n_{k}").alias("valid"), F.col(f"c_{k}").alias("clipped")) for k in specs])
    return counts.select(*keys, F.inline(rows))


def wide(fields: DataFrame, keys: list[str], names: list[str], field: str = "field", value: str = "value") -> DataFrame:
    """One row a key with a column for each named field of the long table; one shuffle, and no look for the names first."""
    return fields.filter(F.col(field).isin(names)).groupBy(*keys).pivot(field, names).agg(F.first(value))


def field_names(all_names: list[str], fhour: Column, not_at_start: list[str]) -> Column:
    """The names that an hour must have: amounts since the start are none at hour 0."""
    return F.when(fhour == 0, F.array(*[F.lit(k) for k in all_names if k not in set(not_at_start)])).otherwise(F.array(*map(F.lit, all_names)))


def eligible(runs: DataFrame, model: str = "model", stamp: str = "run", wanted: str = "continental", cycles: tuple[str, ...] = CYCLES) -> DataFrame:
    """Runs of the model whose cycle is archived."""
    return runs.filter((F.col(model) == wanted) & F.substring(stamp, 10, 2).isin(*cycles))


def status(spark: SparkSession, blocks: DataFrame, runs: DataFrame, hours: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row for the archive: of blocks (block_end, bytes), runs (run, complete), hours and baseline (run, fhour, bytes)."""
    parts = [
        blocks.agg(F.count(F.lit(1)).alias("observation_blocks"), F.max("block_end").alias("latest_observation_block"), F.sum("bytes").alias("bytes")),
        runs.agg(F.count(F.lit(1)).alias("model_runs"), F.count_if("complete").alias("complete_model_runs"), F.max("run").alias("latest_model_run")),
        hours.agg(F.count(F.lit(1)).alias("model_hours"), F.sum("bytes").alias("bytes")),
        baseline.agg(F.count(F.lit(1)).alias("baseline_hours"), F.sum("bytes").alias("bytes")),
    ]  # one row each
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    first = [c for c in rows.columns if c != "bytes"]
    return rows.agg(*[F.max(c).alias(c) for c in first], F.coalesce(F.sum("bytes"), F.lit(0)).alias("archive_bytes"))


def unarchived(times: DataFrame, blocks: DataFrame, sidecars: DataFrame, ts: str = "ts") -> DataFrame:
    """times whose block is not yet in both blocks and sidecars (block_end)."""
    done = blocks.select("block_end").distinct().join(sidecars.select("block_end").distinct(), "block_end", "left_semi")
    return times.withColumn("block_end", clock.block_end(F.col(ts))).join(done, "block_end", "left_anti")


def block_ends(times: DataFrame, ts: str = "ts") -> DataFrame:
    return times.select(clock.block_end(F.col(ts)).alias("block_end")).distinct()
