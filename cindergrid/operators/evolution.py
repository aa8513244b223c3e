"""A whole run of fuel moisture: start states, advance, requested hours, peak days, states to hand over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import moisture, peak


def start_states(own: DataFrame, prior: DataFrame, anchored: DataFrame, bootstrap: DataFrame | None = None) -> DataFrame:
    """(cell, run, anchor, lead, state, source): the newest anchor's first of the run's own checkpoint, an earlier run's,
    and an analysis brought forward over a bridge; a bootstrap, which starts later, only where there is none of them. Each
    has (cell, run, anchor, lead, state). A run and cell that has no row cannot start."""
    parts = [own, prior, anchored] + ([] if bootstrap is None else [bootstrap])
    named = [p.select("cell", "run", "anchor", "lead", "state", F.lit(i).alias("rank")) for i, p in enumerate(parts)]
    rows = named[0]
    for more in named[1:]:
        rows = rows.unionByName(more)
    order = F.struct(F.col("rank") == 3, -F.unix_timestamp(F.col("anchor").cast("timestamp")), "rank")
    best = rows.filter("state is not null").groupBy("cell", "run").agg(F.min_by(F.struct("anchor", "lead", "state", "rank"), order).alias("m"))
    names = F.array(*map(F.lit, ("own", "prior", "bridge", "bootstrap")))
    return best.select("cell", "run", "m.anchor", "m.lead", "m.state", F.get(names, F.col("m.rank")).alias("source"))


def advance(states: DataFrame, hours: DataFrame, start: str, end: str, reach: int = 48) -> DataFrame:
    """Each hour after start up to end (columns of states: cell, run, state, start and end as forecast hours) with its state
    and codes. Going backwards, or beyond the hours 1 to reach, is an error."""
    a, b = F.col(start), F.col(end)
    wrong = F.when(b < a, "a state cannot go backwards").when((b > a) & ((a < 0) | (b > reach)), "an hour lies outside the run")
    ok = states.filter(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(True))
    rows = hours.join(ok.select("cell", "run", "state", a.alias("_a"), b.alias("_b")), ["cell", "run"]).filter("fhour > _a and fhour <= _b")
    return moisture.evolve(rows, ["cell", "run", "state"], "fhour", F.col("state")).drop("state")


def states_at(evolved: DataFrame, hour: int) -> DataFrame:
    """(cell, run, fhour, state) to hand over."""
    return evolved.filter(F.col("fhour") == hour).select("cell", "run", "fhour", F.struct(*moisture.STATE).alias("state"))


def frames(evolved: DataFrame, wanted: list[int]) -> DataFrame:
    return evolved.filter(F.col("fhour").isin(wanted))


def peaks(evolved: DataFrame, init: str = "init") -> DataFrame:
    """Peak days of every run; init is the run's first hour."""
    return peak.peak_days(evolved.withColumn("valid_ts", F.col(init) + F.make_dt_interval(hours=F.col("fhour").cast("int"))), ["cell", "run"])
