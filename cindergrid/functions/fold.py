"""Folds of ordered arrays that keep every state on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def states(items: Column, first: Column, step: Callable[[Column, Column], Column], kind: str, chunk: int = 48) -> Column:
    """The states (of this type) after each of items, where step(state, item) gives the next. States are gathered chunk by
    chunk and the chunks put together, so an array of n items costs about n * chunk copies, not n squared."""

    def one(acc: Column, item: Column) -> Column:
        return F.element_at(F.transform(F.array(step(acc["s"], item)), lambda s: F.struct(s.alias("s"), F.concat(acc["all"], F.array(s)).alias("all"))), 1)

    def many(acc: Column, part: Column) -> Column:
        done = F.aggregate(part, F.struct(acc["s"].alias("s"), F.array().cast(f"array<{kind}>").alias("all")), one)
        return F.element_at(F.transform(F.array(done), lambda d: F.struct(d["s"].alias("s"), F.concat(acc["all"], F.array(d["all"])).alias("all"))), 1)

    last = F.greatest(F.ceil(F.size(items) / chunk).cast("int") - 1, F.lit(0))
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * chunk + 1, F.lit(chunk)))
    return F.flatten(F.aggregate(parts, F.struct(first.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("all")), many)["all"])
