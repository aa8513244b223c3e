"""Folds of long histories in rounds: a state carried over segments, so no history stands in one array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import store
from . import moisture, seasonal

#: What folds one segment: rows, keys (the start among them), order, start -> rows with the state after each.
Fold = Callable[[DataFrame, list[str], str, Column], DataFrame]


def in_rounds(rows: DataFrame, keys: list[str], order: str, fold: Fold, start: Column, state: Column, size: int = 2000) -> DataFrame:
    """What fold gives for all rows. Each key's rows are numbered in their order and cut into segments of `size`; a round
    folds one segment of every key and hands the states after it to the next, as a table. Rounds are as many as the longest
    history has segments, and a key without more rows costs a round nothing. Each round reads and writes its segment only."""
    spark = rows.sparkSession
    cut, done, handed = (store.new_path(spark, x) for x in ("segments", "folded", "states"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    numbered = rows.withColumn("_segment", F.floor((nth - 1) / size).cast("long"))
    numbered.write.partitionBy("_segment").parquet(cut)
    segments = spark.read.schema(numbered.schema).parquet(cut)
    last = segments.agg(F.max("_segment")).first()[0]
    if last is None:
        return fold(rows.withColumn("_start", start), [*keys, "_start"], order, F.col("_start")).drop("_start")
    for k in range(last + 1):
        part = segments.filter(F.col("_segment") == k).drop("_segment")
        if k:
            part = part.join(spark.read.parquet(f"{handed}/{k - 1}"), keys)
        else:
            part = part.withColumn("_start", start)
        fold(part, [*keys, "_start"], order, F.col("_start")).drop("_start").write.parquet(f"{done}/segment={k}")
        after = spark.read.parquet(f"{done}/segment={k}")
        after.groupBy(*keys).agg(F.max_by(state, order).alias("_start")).write.parquet(f"{handed}/{k}")
    return spark.read.parquet(done).drop("segment")


def evolve(hours: DataFrame, keys: list[str], order: str, start: Column | None = None, size: int = 2000) -> DataFrame:
    """``moisture.evolve`` for histories of any length."""
    first = moisture.start_state() if start is None else start
    return in_rounds(hours, keys, order, moisture.evolve, first, F.struct(*moisture.STATE), size)


def daily_codes(days: DataFrame, keys: list[str], order: str, first: Column | None = None, size: int = 2000) -> DataFrame:
    """``seasonal.daily_codes`` for histories of any length."""
    begun = seasonal.start() if first is None else first
    return in_rounds(days, keys, order, seasonal.daily_codes, begun, F.struct(*seasonal.CODES), size)
