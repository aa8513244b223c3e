"""Notices of monitors: state per monitor across batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "monitor string, ts timestamp, level string, reason string"
STATE = "level string, told double, failures int"


def _fold(again_hours: int, after_failures: int):
    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, told, failures = state.get if state.exists else (None, None, 0)
        out = []
        for r in pd.concat(list(parts)).sort_values("ts", kind="stable").itertuples(index=False):
            if r.level is None or pd.isna(r.level):  # a check that failed
                failures += 1
                if failures == after_failures:
                    out.append((key[0], r.ts, level, "failures"))
                continue
            at, failures = float(int(r.ts.timestamp())), 0
            if r.level != "ok" and (r.level != level or told is None or at - told >= again_hours * 3600):
                out.append((key[0], r.ts, r.level, "level"))
                told = at
            elif r.level != level:
                told = None
            level = r.level
        state.update((level, told, failures))
        yield pd.DataFrame(out, columns=["monitor", "ts", "level", "reason"])

    return step


def notices(checks: DataFrame, again_hours: int = 24, after_failures: int = 3) -> DataFrame:
    """(monitor, ts, level, reason) of a stream of checks (monitor, ts, level; a null level is a check that failed): a level
    other than ok that is new or was told a day ago, and the third failure in a row. Checks are taken in the order of ts
    within a batch. The state is one small row a monitor, kept for good."""
    keyed = checks.selectExpr("cast(monitor as string) monitor", "ts", "level").groupBy("monitor")
    return keyed.applyInPandasWithState(_fold(again_hours, after_failures), OUT, STATE, "append", GroupStateTimeout.NoTimeout)
