"""Streams in several batches with restarts: whole blocks and publishing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cindergrid.operators import lightning, runs
from cindergrid.streaming import blocks, publishing

START = dt.datetime(2026, 7, 1)
FLASHES = "cell long, ts timestamp, rate double"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def feed(spark, path, rows, kind):
    """One more file."""
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)


def test_seventeen_times_and_a_repeat_are_not_whole(spark):
    whole = [(1, at(10 * i), 0.1) for i in range(1, 19)]
    short = [(2, at(10 * i), 0.1) for i in range(1, 18)] + [(2, at(170), 0.1)]
    missing = [(3, at(10 * i), None if i == 4 else 0.1) for i in range(1, 19)]
    repeats = [(4, at(10 * i), r) for i in range(1, 19) for r in (0.1, -999.0, None, float("nan"), 0.05)]
    got = lightning.three_hour_blocks(spark.createDataFrame(whole + short + missing + repeats, FLASHES)).collect()
    assert {r.cell: r.density and round(r.density, 6) for r in got} == {1: 18.0, 2: None, 3: None, 4: 18.0}


def test_whole_blocks_leave_once(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / x) for x in ("src", "out", "checkpoint"))
    cell = lambda c, steps, rate=0.1: [(c, at(10 * i), rate) for i in steps]

    def run():
        stream = spark.readStream.schema(FLASHES).option("maxFilesPerTrigger", 1).parquet(src)
        blocks.waiting_blocks(stream, out, checkpoint).awaitTermination()
        rows = spark.read.parquet(out).collect()
        return sorted((r.cell, r.block_end.hour, r.total and round(r.total, 6)) for r in rows)

    # cell 1 comes in three files, the last of them after a restart; 2 lacks a time and repeats one; 3 has a missing rate; 5000 is another tile
    feed(spark, src, cell(1, range(1, 10)) + cell(2, [*range(1, 18), 17]) + cell(5000, range(1, 19), 0.2), FLASHES)
    feed(spark, src, cell(1, range(9, 15)) + cell(3, [1], None) + cell(3, range(2, 19)), FLASHES)
    assert run() == [(3, 3, None), (5000, 3, 36.0)]
    waiting = sorted((r.cell, r.n, round(r.total, 6)) for r in blocks.open_blocks(spark, checkpoint).collect())
    assert waiting == [(1, 14, 14.0), (2, 17, 17.0)]
    feed(spark, src, cell(3, [1], 5.0) + cell(5000, [3], None) + cell(1, range(15, 19)) + cell(1, [19]), FLASHES)
    assert run() == [(1, 3, 18.0), (3, 3, None), (5000, 3, 36.0)]
    feed(spark, src, cell(1, range(1, 19), 9.0), FLASHES)
    assert run() == [(1, 3, 18.0), (3, 3, None), (5000, 3, 36.0)]
    assert sorted((r.cell, r.block_end.hour, r.n) for r in blocks.open_blocks(spark, checkpoint).collect()) == [(1, 6, 1), (2, 3, 17)]


def published(rows, cooldown, end, expected):
    """By the rule, minute by minute."""
    out, last, waiting, done = [], None, [], set()
    ready = {}
    for hour, minute in sorted(rows, key=lambda r: (r[1], r[0])):
        if hour not in done:
            done.add(hour)
            ready.setdefault(minute, []).append(hour)
    n = 0
    for m in range(0, 3000):
        new = ready.get(m, [])
        if m > end:
            out += [(m, [h], "late") for h in new]
            continue
        waiting += new
        n += len(new)
        if not waiting:
            continue
        if new and n == expected:
            reason = "complete"
        elif last is None or new and m - last >= cooldown:
            reason = "open"
        elif m - last >= cooldown:
            reason = "timer"
        elif m == end:
            reason = "deadline"
        else:
            continue
        out.append((m, sorted(waiting), reason))
        last, waiting = m, []
    return sorted(out)


CASES = {
    "cooldown counts from the last publish": ([(0, 0), (3, 45), (6, 50), (9, 76)], 30, 720, 17),
    "complete": ([(0, 0), (3, 5), (6, 10)], 30, 720, 3),
    "timer": ([(0, 0), (3, 5), (6, 10)], 30, 720, 17),
    "deadline": ([(0, 0), (3, 5), (6, 100), (9, 110)], 30, 115, 17),
    "late": ([(0, 0), (3, 20), (6, 130), (9, 140), (12, 140)], 30, 120, 5),
    "told again": ([(0, 0), (0, 10), (3, 40), (3, 60), (0, 200)], 30, 720, 2),
    "at the same time": ([(0, 0), (3, 0), (6, 30), (9, 30)], 30, 720, 17),
    "in the minute it is due": ([(0, 0), (3, 10), (6, 30), (9, 40), (12, 61)], 30, 720, 17),
    "never before the deadline": ([(0, 800), (3, 801)], 30, 720, 2),
}


def in_minutes(rows):
    return sorted((round((r["at"].replace(tzinfo=None) - START).total_seconds() / 60), list(r.hours), r.reason) for r in rows)


def test_publishing_follows_the_rule(spark):
    ready = spark.createDataFrame([(name, h, at(m), at(end)) for name, (rows, _, end, _) in CASES.items() for h, m in rows], "run string, fhour long, at timestamp, deadline timestamp")
    for name, (rows, cooldown, end, expected) in CASES.items():
        merged = {}
        for m, hours, reason in published(rows, cooldown, end, expected):
            merged.setdefault((m, reason), []).extend(hours)
        want = sorted((m, sorted(h), reason) for (m, reason), h in merged.items())
        assert in_minutes(runs.publishable(ready.filter(F.col("run") == name), cooldown, expected=expected).collect()) == want, name


@pytest.mark.parametrize("cuts", [(4, 45, 100), (0, 10, 30)])
def test_streamed_publishing_follows_the_rule(spark, tmp_path, cuts):
    """Four batches, with a restart after the second, and a tick of the clock."""
    kind, (src, out, checkpoint) = "run string, fhour long, at timestamp, deadline timestamp", (str(tmp_path / x) for x in ("src", "out", "checkpoint"))
    names = [x for x, c in CASES.items() if c[3] == 17]
    rows = [(x, h, m, CASES[x][2]) for x in names for h, m in CASES[x][0]]
    edges = [-1, *cuts, 10_000]
    for k in range(4):
        part = [(x, h, at(m), at(e)) for x, h, m, e in rows if edges[k] < m <= edges[k + 1]] + ([("", None, at(5000), at(0))] if k == 3 else [])
        feed(spark, src, part, kind)
        if k in (1, 3):
            stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
            publishing.write_published(stream, 30, out, checkpoint, expected=17).awaitTermination()
    got = spark.read.parquet(out).collect()
    for x in names:
        assert in_minutes(r for r in got if r.run == x) == published(*CASES[x]), x
