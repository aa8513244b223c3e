"""Publishing of a run's ready hours as they arrive, with a cooldown that timers end."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .state import started, transformed

OUT = "run string, at timestamp, hours array<long>, reason string"
STATE = "last long, waiting array<long>, done array<long>, deadline long"
INPUT = "run", "fhour", "unix_timestamp(at) at", "unix_timestamp(deadline) deadline"


class Publisher(StatefulProcessor):
    """The rule of ``operators.runs.publishable``, keyed by run. The state is the time of the last publish, the hours that
    wait, those that were seen, and the deadline; a timer stands where waiting hours are due."""

    def __init__(self, gap: int, expected: int | None):
        self.gap, self.expected = gap, expected

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("run", STATE)

    def _row(self, run: str, at: int, hours: list[int], reason: str) -> Row:
        return Row(run=run, at=started(at), hours=sorted(hours), reason=reason)

    def _due(self, run: str, now: int | None) -> Iterator[Row]:
        """What waits, if it was due before now."""
        if self.waiting:
            due = min(self.last + self.gap, self.deadline)
            if now is None or due < now:
                yield self._row(run, due, self.waiting, "timer" if self.last + self.gap <= self.deadline else "deadline")
                self.last, self.waiting = due, []

    def _load(self) -> bool:
        there = self.state.exists()
        last, waiting, done, self.deadline = self.state.get() if there else (None, [], [], None)
        self.last, self.waiting, self.done = last, list(waiting), list(done)
        return there

    def _keep(self) -> None:
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if self.waiting:
            self.handle.registerTimer(1000 * min(self.last + self.gap, self.deadline))
        self.state.update((self.last, self.waiting, self.done, self.deadline))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        self._load()
        told = (r for r in rows if r.fhour is not None and r.fhour not in self.done)  # not a tick of the clock, nor told again
        for now, new in groupby(sorted(told, key=lambda r: (r.at, r.fhour)), key=lambda r: r.at):
            new = list(new)
            hours = [h for h in dict.fromkeys(r.fhour for r in new) if h not in self.done]
            self.deadline = new[0].deadline if self.deadline is None else self.deadline
            yield from self._due(key[0], now)
            self.done += hours
            if hours and now > self.deadline:
                yield self._row(key[0], now, hours, "late")
                continue
            self.waiting += hours
            complete = len(self.done) == self.expected
            if hours and (complete or self.last is None or now - self.last >= self.gap):
                yield self._row(key[0], now, self.waiting, "complete" if complete else "open")
                self.last, self.waiting = now, []
        self._keep()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._load():
            yield from self._due(key[0], None)
            self._keep()

    def close(self) -> None:
        pass


def published(ready: DataFrame, cooldown_minutes: int, expected: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """(run, at, hours, reason) of a stream of ready hours (run, fhour, at, deadline), in the batch that publishes them. The
    clock is the greatest ``at`` so far: a feed lists hours as they become ready, so at never falls by more than delay from
    batch to batch (Spark drops rows that do). A row without an hour only moves the clock on."""
    rows = ready.withWatermark("at", delay).select("at", "run", "fhour", "deadline")
    keyed = rows.selectExpr("at as listed", *INPUT)
    return transformed(keyed.groupBy("run"), Publisher(60 * cooldown_minutes, expected), OUT, "EventTime")


def write_published(ready: DataFrame, cooldown_minutes: int, path: str, checkpoint: str, expected: int | None = None, delay: str = "0 seconds") -> StreamingQuery:
    """Appends what is published to the table at path. A restart goes on from the checkpoint, timers included."""
    stream = published(ready, cooldown_minutes, expected, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).format("parquet").start(path)
