"""Three-hour lightning blocks of a stream of ten-minute rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import clock
from ..operators import lightning
from .state import ROCKS, STORE, transformed


def block_sums(flashes: DataFrame, delay: str = "3 hours", minutes: float = 10.0) -> DataFrame:
    """(block_end, cell, total, n): a stream of (cell, ts, rate) summed by right-closed blocks, each emitted once the
    watermark has passed it. The state holds one row a cell and open block. Rows behind the watermark are lost, and
    repeats count; ``whole_blocks`` loses nothing."""
    early = flashes.withColumn("_at", F.col("ts").cast("timestamp") - F.expr("interval 1 microsecond")).withWatermark("_at", delay)
    rate = F.col("rate")
    got = early.groupBy(F.window("_at", "3 hours").alias("w"), "cell").agg(F.sum(F.when(rate > 0, rate * minutes).otherwise(0.0)).alias("total"), F.count(rate).alias("n"))
    return got.select(F.col("w.end").alias("block_end"), "cell", "total", "n")


def route_blocks(flashes: DataFrame, path: str, checkpoint: str, expected: int = 18, delay: str = "3 hours") -> StreamingQuery:
    """Writes closed blocks with their state: whole, or partial for those that lack rows and must be looked at again. A batch
    that is run again after a failure replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumn("state", F.when(F.col("n") == expected, "whole").otherwise("partial"))
        named.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return block_sums(flashes, delay).writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


class WholeBlocks(StatefulProcessor):
    """Keyed by block and tile of cells: for each cell a bitmap of the steps that have arrived, with one bit more once it has
    been told, and the rates of those that have not. Arrays, so that a tile's state is one value however many cells it has."""

    def __init__(self, steps: int, minutes: float):
        self.steps, self.minutes = steps, minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("tile", TILE_STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows))
        cells, mask, waiting, rates = unpacked(self.state.get() if self.state.exists() else None, self.steps)
        held = np.full((len(cells), self.steps), np.nan)
        held[waiting] = rates
        every = np.union1d(cells, new.cell.to_numpy(np.int64))
        old = np.searchsorted(every, cells)
        grown, bits = np.full((len(every), self.steps), np.nan), np.zeros(len(every), np.int64)
        grown[old], bits[old] = held, mask
        at, step, rate = np.searchsorted(every, new.cell.to_numpy(np.int64)), new.step.to_numpy(np.int64) - 1, new.rate.to_numpy(float)
        np.fmax.at(grown, (at, step), np.where(np.isfinite(rate), rate, np.nan))
        np.bitwise_or.at(bits, at, 1 << step)
        told, all_ = 1 << self.steps, (1 << self.steps) - 1
        whole = (bits & all_ == all_) & (bits & told == 0)
        bits[whole] |= told
        open_ = bits & told == 0
        self.state.update((every.tobytes(), bits.tobytes(), grown[open_].tobytes()))
        density = (np.maximum(grown[whole], 0) * self.minutes).sum(axis=1)
        yield pd.DataFrame({"block": np.full(int(whole.sum()), key[0], np.int64), "cell": every[whole], "density": density})

    def close(self) -> None:
        pass


TILE_STATE = "cells binary, bits binary, rates binary"


def unpacked(state: tuple | None, steps: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells, their bits, which of them wait, and the rates of those."""
    if state is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros((0, steps))
    cells, bits, rates = (np.frombuffer(x, kind) for x, kind in zip(state, (np.int64, np.int64, float)))
    return cells, bits, bits & (1 << steps) == 0, rates.reshape(-1, steps)


def whole_blocks(flashes: DataFrame, step_minutes: int = 10, tile: int = 4096) -> DataFrame:
    """(block_end, cell, total): of a stream of (cell, ts, rate), each block once, in the batch in which the last of its steps
    arrives, in any order. A missing rate has arrived, and makes its cell's total missing; of repeats of a step, as long as
    the block waits, the largest valid rate counts; what comes after a block was told changes nothing. Blocks wait without
    an end, so nothing late is lost; ``open_blocks`` lists those that wait. The state is a bitmap a cell and block, with
    rates as long as it waits."""
    block = F.unix_timestamp(clock.block_end(F.col("ts")))
    rows = flashes.select(block.alias("block"), F.floor(F.col("cell") / tile).alias("tile"), F.col("cell").cast("long").alias("cell"), lightning.slot(F.col("ts"), step_minutes).alias("step"), F.col("rate").cast("double").alias("rate"))
    processor = WholeBlocks(180 // step_minutes, step_minutes)
    got = transformed(rows.groupBy("block", "tile"), processor, "block long, cell long, density double", frames=True)
    return got.select(F.timestamp_seconds("block").alias("block_end"), "cell", F.when(~F.isnan("density"), F.col("density")).alias("total"))


def open_blocks(spark: SparkSession, checkpoint: str, step_minutes: int = 10) -> DataFrame:
    """(block_end, cell, total, n): blocks that wait, with the sum over the valid rates that are there and the number of steps that
    have arrived, read from the state at a checkpoint of whole_blocks."""
    steps = 180 // step_minutes

    def listed(batches):
        for batch in batches:
            for block, *state in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "bits", "rates"))):
                cells, bits, waiting, rates = unpacked(tuple(state), steps)
                n = [int(b).bit_count() for b in bits[waiting]]
                total = np.nansum(np.maximum(rates, 0), axis=1) * step_minutes
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), block)), pa.array(cells[waiting]), pa.array(total), pa.array(n, pa.int64())], ["block", "cell", "total", "n"])

    spark.conf.set(STORE, ROCKS)
    state = spark.read.format("statestore").option("stateVarName", "tile").load(checkpoint)
    rows = state.select("key.block", "value.*").mapInArrow(listed, "block long, cell long, total double, n long")
    return rows.select(F.timestamp_seconds("block").alias("block_end"), "cell", "total", "n")


def waiting_blocks(flashes: DataFrame, path: str, checkpoint: str, step_minutes: int = 10) -> StreamingQuery:
    """Appends whole blocks to the table at path; a restart goes on from the checkpoint."""
    stream = whole_blocks(flashes, step_minutes).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).format("parquet").start(path)
