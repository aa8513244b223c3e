"""Amounts over step ranges, and choices between sources of a field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import physics as P

RANGE = r"^(\d+)-(\d+)$"


def bounds(step: Column) -> Column:
    """struct(a, b) of a range such as 0-6; null where the step is a single hour."""
    part = lambda i: F.regexp_extract(step, RANGE, i).cast("long")
    return F.when(step.rlike(RANGE), F.struct(part(1).alias("a"), part(2).alias("b")))


def three_hour_precip(fields: DataFrame, keys: list[str], scale: float = 1.0) -> DataFrame:
    """(keys, fhour, precip) of accumulated amounts (fhour, value, step_range): the amount three hours before is taken
    off where both start together and the range is longer than three hours, or where a step has no range. Negative
    amounts are zero, missing ones stay missing. One shuffle, by keys."""
    w = Window.partitionBy(*keys).orderBy("fhour")
    now = F.struct("fhour", "value", bounds(F.col("step_range")).alias("r"))
    rows = fields.withColumns({"_c": now, "_p": F.lag(now).over(w)})
    before = F.col("_p.fhour") == F.col("fhour") - 3
    c, p = F.col("_c.r"), F.col("_p.r")
    together = (c["b"] - c["a"] > 3) & (p["a"] == c["a"]) & (p["b"] < c["b"])
    minus = F.coalesce(before, F.lit(False)) & F.when(c.isNull(), True).when(p.isNotNull(), together).otherwise((c["a"] == 0) & (c["b"] > 3))
    amount = F.when(minus, F.col("value") - F.col("_p.value")).otherwise(F.col("value"))
    return rows.select(*keys, "fhour", (P.at_least(amount, 0.0) * scale).alias("precip"))


def first_source(base: DataFrame, candidates: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """base with value of the first candidate (keys, value) that has one."""
    names = [f"_v{i}" for i in range(len(candidates))]
    for name, other in zip(names, candidates):
        base = base.join(other.select(*keys, F.col(value).alias(name)), keys, "left")
    return base.withColumn(value, F.coalesce(*map(F.col, names))).drop(*names)


def cleaned(fields: DataFrame, value: str = "value", lon: str = "lon") -> DataFrame:
    """Values beyond 1e20 are missing, and longitudes run from -180 to 180."""
    v, x = F.col(value), F.col(lon)
    return fields.withColumns({value: F.when(F.abs(v) <= 1e20, v), lon: F.when(x > 180, x - 360).otherwise(x)})


def hourly_amount(totals: DataFrame, keys: list[str], hour: str = "fhour", value: str = "value") -> DataFrame:
    """totals (running sums since hour 0) with amount, that of the hour: hour 0 has none, hour 1 its whole total, others the
    rise since the hour before, at least 0. Where that hour is not there, the amount is missing: gaps are not bridged."""
    w = Window.partitionBy(*keys).orderBy(hour)
    rise = F.when(F.lag(hour).over(w) == F.col(hour) - 1, P.at_least(F.col(value) - F.lag(value).over(w), 0.0))
    return totals.withColumn("amount", F.when(F.col(hour) == 0, F.when(F.col(value).isNotNull(), 0.0)).when(F.col(hour) == 1, F.col(value)).otherwise(rise))


def amount_since(totals: DataFrame, keys: list[str], hours: int = 3, hour: str = "fhour", value: str = "value") -> DataFrame:
    """totals with amount: the rise over so many hours, at least 0; the whole total where that earlier hour is not there."""
    w = Window.partitionBy(*keys).orderBy(hour).rangeBetween(-hours, -hours)
    return totals.withColumn("amount", P.at_least(F.col(value) - F.coalesce(F.first(value).over(w), F.lit(0.0)), 0.0))


def rises(totals: DataFrame, keys: list[str], order: str, value: str = "value") -> DataFrame:
    """totals with amount: the difference from the row before, the first row's whole value."""
    return totals.withColumn("amount", F.col(value) - F.lag(value, 1, 0.0).over(Window.partitionBy(*keys).orderBy(order)))
