"""Lightning observations and potential: blocks, windows, daily maxima, hazard windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..functions import physics as P
from . import grid as G


def slot(ts: Column, step_minutes: int) -> Column:
    """Number, from 1, of the step of its three-hour block that a time falls into; a time on a boundary ends the step."""
    start = F.unix_timestamp(clock.block_end(ts)) - 10800
    return F.ceil((F.unix_timestamp(ts.cast("timestamp")) - start) / (60 * step_minutes)).cast("int")


def three_hour_blocks(flashes: DataFrame, step_minutes: int = 10) -> DataFrame:
    """(block_end, cell, density) of the right-closed blocks of (cell, ts, rate): the sum of rate * step_minutes over the
    block's steps. Missing unless every step of the block is there, each once however often it is told, and has a valid
    rate. Negative rates are valid zeros; of repeats of a step the largest valid rate counts."""
    rate = F.when(~F.isnan("rate") & (F.abs("rate") != float("inf")), F.col("rate"))
    steps = flashes.groupBy(clock.block_end(F.col("ts")).alias("block_end"), "cell", slot(F.col("ts"), step_minutes).alias("_step")).agg(F.max(rate).alias("rate"))
    rows = steps.groupBy("block_end", "cell").agg(F.sum(F.greatest("rate", F.lit(0.0)) * step_minutes).alias("total"), F.count("rate").alias("n"))
    return rows.select("block_end", "cell", F.when(F.col("n") == 180 // step_minutes, F.col("total")).alias("density"))


def window_total(blocks: DataFrame, start, end) -> DataFrame:
    """(cell, total) over the blocks in (start, end]; missing ones count nothing."""
    inside = (F.col("block_end") > start) & (F.col("block_end") <= end)
    return blocks.filter(inside).groupBy("cell").agg(F.sum(F.coalesce(F.greatest("density", F.lit(0.0)), F.lit(0.0))).alias("total"))


def missing_times(times: DataFrame, windows: DataFrame, step_minutes: int = 10) -> DataFrame:
    """(window_id, expected, present, complete) of windows (window_id, start, end)."""
    want = windows.select("window_id", F.explode(F.sequence(F.col("start") + F.make_dt_interval(mins=F.lit(step_minutes)), F.col("end"), F.make_dt_interval(mins=F.lit(step_minutes)))).alias("ts"))
    have = times.select("ts").distinct().withColumn("here", F.lit(1))
    got = want.join(have, "ts", "left").groupBy("window_id").agg(F.count(F.lit(1)).alias("expected"), F.count("here").alias("present"))
    return got.withColumn("complete", F.col("expected") == F.col("present"))


def daily_potential(hours: DataFrame, wanted: DataFrame) -> DataFrame:
    """(run, cell, potential): the largest over the wanted hours (run, fhour) of runs that have them all in one formula."""
    need = wanted.groupBy("run").agg(F.count(F.lit(1)).alias("need"))
    rows = hours.join(wanted, ["run", "fhour"])
    ok = rows.groupBy("run").agg(F.count_distinct("fhour").alias("n"), F.count_distinct("formula").alias("kinds")).join(need, "run").filter("n = need and kinds = 1")
    return rows.join(ok.select("run"), "run", "left_semi").groupBy("run", "cell").agg(F.max(F.nanvl("potential", F.lit(None))).alias("potential"))


def readiness(blocks: DataFrame, minimum_days: float = 21.0, coverage: float = 0.95, active: int = 12, hours: int = 3) -> DataFrame:
    """One row of (block_end, nonzero): span in days, coverage, active blocks and whether they suffice."""
    got = blocks.agg(F.min("block_end").alias("a"), F.max("block_end").alias("b"), F.count_distinct("block_end").alias("n"), F.count_if(F.col("nonzero") > 0).alias("active_blocks"))
    span = (F.unix_timestamp("b") - F.unix_timestamp("a")) / 86400.0
    expected = F.floor(span * 24 / hours) + 1
    share = F.coalesce(F.try_divide(F.col("n"), expected), F.lit(0.0))
    out = got.select(F.coalesce(span, F.lit(0.0)).alias("span_days"), share.alias("coverage"), "active_blocks")
    return out.withColumn("ready", (F.col("span_days") >= minimum_days) & (F.col("coverage") >= coverage) & (F.col("active_blocks") >= active))


def hazard_windows(snapshots: DataFrame, plot_hours: DataFrame, back: int = 2) -> DataFrame:
    """Per (run, fhour, cell): the largest potential and dry potential over fhour-back..fhour (hour 0 alone), the strongest
    gust, and the wind at its hour (the earliest on ties). Dry potential takes the end hour's precipitation."""
    start = F.when(F.col("fhour") == 0, 0).otherwise(F.greatest(F.col("fhour") - back, F.lit(0)))
    want = plot_hours.withColumn("h", F.explode(F.sequence(start.cast("long"), F.col("fhour").cast("long"))))
    rows = want.join(snapshots.withColumnRenamed("fhour", "h"), ["run", "h"])
    wind = F.max_by(F.struct("u", "v"), F.when(F.col("gust").isNotNull(), F.struct("gust", -F.col("h"))))
    got = rows.groupBy("run", "fhour", "cell").agg(
        F.max("potential").alias("potential"), F.max(F.col("potential") * P.ramp(55.0 - F.col("rh"), 0.0, 25.0)).alias("_dry"),
        F.max_by("precip", "h").alias("_p"), F.max("gust").alias("gust"), wind.alias("_w"),
    )
    dry = F.when(F.col("potential") >= 25, F.col("_dry") * (1 - P.ramp(F.col("_p"), 0.25, 2.5))).otherwise(0.0)
    return got.select("run", "fhour", "cell", "potential", dry.alias("dry"), "gust", F.col("_w.u").alias("u"), F.col("_w.v").alias("v"))


def potential(c: dict, charge_factor, mid_rh, precip_3h, prate, upward):
    """Lightning potential 0 to 100 before its smoothing, of columns li and cape."""
    li = F.when(F.abs(c["li"]) <= 50, c["li"])
    cape = F.when((c["cape"] >= 0) & (c["cape"] < 20000), c["cape"])
    of_li, of_cape = P.clip((1.0 - li) / 6.0, 0.0, 1.0), P.ramp(cape, 75.0, 800.0)
    unstable = P.clip(of_li * (0.8 + 0.2 * of_cape), 0.0, 1.0)
    moist = P.clip(charge_factor * (0.85 + 0.15 * P.ramp(mid_rh, 35.0, 75.0)), 0.0, 1.0)
    signal = F.greatest(P.ramp(precip_3h, 0.05, 1.5), P.ramp(prate, 0.02, 0.8))
    trigger = F.greatest(signal, P.ramp(upward, 0.005, 0.05) * charge_factor)
    value = 100.0 * unstable * moist * F.sqrt(P.clip(trigger, 0.0, 1.0))
    return F.when(((of_li < 0.05) & (of_cape < 0.08)) | (moist < 0.08), 0.0).otherwise(value)


def smoothed_potential(grid: DataFrame, keys: list[str], resolution_km: float, value: str = "potential", target_km: float = 1.2) -> DataFrame:
    """The potential smoothed over a target distance, 0 to 100. Upward motion is smoothed alike, over 1.4 km, beforehand."""
    got = G.gaussian(grid, keys, value, G.sigma_for(target_km, resolution_km))
    return got.withColumn(value, P.clip(F.col(value), 0.0, 100.0))


# Levels of observed density that are reported.
LEVELS = (0.05, 0.5, 2.0)


def exceedance(blocks: DataFrame, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """(block_end, level, cells) of each level that a cell of the block reaches."""
    counts = blocks.groupBy("block_end").agg(*[F.count_if(F.col("density") >= v).alias(f"n{i}") for i, v in enumerate(levels)])
    pairs = F.array(*[F.struct(F.lit(v).alias("level"), F.col(f"n{i}").alias("cells")) for i, v in enumerate(levels)])
    return counts.select("block_end", F.inline(pairs)).filter("cells > 0")
