"""Keyed state of streams: what all processors of this package share."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql.streaming import StatefulProcessor

#: The store that Spark asks for where processors hold several kinds of state or timers.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def started(seconds: int) -> dt.datetime:
    """A time in UTC from seconds of the epoch, as Spark takes it from Python rows."""
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc)


def transformed(keyed: GroupedData, processor: StatefulProcessor, kind: str, time: str = "None", frames: bool = False) -> DataFrame:
    """The rows that a processor makes of each key; frames: it takes pandas frames. The session's state store is set, since
    such processors need it."""
    keyed._df.sparkSession.conf.set(STORE, ROCKS)
    how = keyed.transformWithStateInPandas if frames else keyed.transformWithState
    return how(processor, kind, "append", time)
