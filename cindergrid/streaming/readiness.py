"""Hours that become ready as a stream of listed fields arrives."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "seen array<string>, told array<long>"


def _fold(needs: dict[int, frozenset[str]]):
    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, told = (set(x) for x in state.get) if state.exists else (set(), set())
        for part in parts:
            seen.update(f"{hour}/{field}" for hour, field in zip(part.fhour, part.field))
        now = sorted(hour for hour, need in needs.items() if hour not in told and need <= seen)
        state.update((sorted(seen), sorted(told.union(now))))
        yield pd.DataFrame({"run": [key[0]] * len(now), "fhour": pd.Series(now, dtype="int64")})

    return step


def ready_stream(listing: DataFrame, requirements: DataFrame) -> DataFrame:
    """(run, fhour), each once, from a stream of listed fields (run, fhour, field): in the batch that completes the hour's
    requirements (fhour, need_hour, field). These are a product's own list, tens of fields for each of its hours, and are
    fetched. The state of a run is what it has listed and told, so a batch looks at nothing but itself."""
    needs: dict[int, set[str]] = defaultdict(set)
    for r in requirements.select("fhour", "need_hour", "field").distinct().toLocalIterator():
        needs[r.fhour].add(f"{r.need_hour}/{r.field}")
    keyed = listing.selectExpr("run", "cast(fhour as long) fhour", "field").groupBy("run")
    return keyed.applyInPandasWithState(_fold({k: frozenset(v) for k, v in needs.items()}), "run string, fhour long", STATE, "append", GroupStateTimeout.NoTimeout)


def write_ready(listing: DataFrame, requirements: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the ready hours of the stream as a table at path/ready."""
    stream = ready_stream(listing, requirements).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).format("parquet").start(f"{path}/ready")
