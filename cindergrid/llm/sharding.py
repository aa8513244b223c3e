"""Sharding by histogram sort: exact counts below probe keys, refined until every splitter is good, then one exchange.

Rows are ordered by a 64-bit key (CRC-32 of the text above 32 hashed bits of the id), so shards are ranges of keys and
copies of a text lie side by side without being bound to one shard. Each round counts bytes and rows in the cells of
a few open intervals (a partial sum in each task, at most ``probes`` cells for each splitter that is still open),
keeps, for each splitter, the cell that holds its target; a splitter is done when the bytes below a cell's boundary are within
``tolerance`` of a shard's size, or the cell is a single key. Then ranges are dealt out once, in ``parts`` pieces a
shard, each sorted by itself; the exact row counts of the pieces give every row its place in its shard.

Law ``bytes``: sizes are near equal. Size: UTF-8 bytes of the text plus 8. Nulls and edges: a null text is empty, a null
id is hashed like the text ``null``; rows equal in id and text have one key and stay in one shard, in any order; an
empty table gives no rows; tables with fewer keys than shards leave shards empty. Extra columns stay; columns of the
input named size, text_crc32, shard or slot are replaced by the result's.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, utf8_size

TOP = 1 << 62


def key_of(text: Column, doc_id: Column) -> Column:
    """0 to 2**62 - 1: CRC-32 of the text, then 30 bits of a hash of the id."""
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    return F.shiftleft(crc, 30) + F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("null"))), F.lit(1 << 30))


def _cells(edges: list[int]):
    """The column function key -> how many edges are at or below it."""
    sorted_edges = np.array(edges, np.int64)

    @F.pandas_udf("int")
    def cell(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sorted_edges, key.to_numpy(), side="right").astype(np.int32))

    return cell


def _looked_up(values: list[int], kind: str):
    """The column function number of a piece -> its value."""
    held = np.array(values, np.int64)

    @F.pandas_udf(kind)
    def pick(piece: pd.Series) -> pd.Series:
        return pd.Series(held[piece.to_numpy()])

    return pick


def _histogram(keys: DataFrame, edges: list[int]) -> dict[int, int]:
    """Bytes in each cell between edges: sums in each task, then over tasks."""
    sorted_edges = np.array(edges, np.int64)

    def sums(batches):
        total = np.zeros(len(sorted_edges) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(sorted_edges, batch.column(0).to_numpy(), side="right")
            np.add.at(total, at, batch.column(1).to_numpy())
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], ["cell", "n"])

    parts = keys.select("key", "size").mapInArrow(sums, "cell int, n long")
    return {r.cell: r.n for r in parts.groupBy("cell").agg(F.sum("n").alias("n")).collect()}


def splitters(keys: DataFrame, targets: list[float], slack: float, probes: int = 64, max_rounds: int = 14) -> list[int]:
    """For each target the key such that the bytes below it are within slack of the target, or nearest to it. keys has
    (key, size)."""
    open_: dict[int, tuple[int, int, int]] = {i: (0, TOP, 0) for i in range(len(targets))}  # key range, bytes below it
    found: dict[int, int] = {}
    for _ in range(max_rounds):
        if not open_:
            break
        edges = sorted({a + (b - a) * j // probes for a, b, _ in open_.values() for j in range(probes + 1)} - {0, TOP})
        counts = _histogram(keys, edges)
        left = {}
        for i, (a, b, below) in open_.items():
            own = [a, *edges[bisect.bisect_right(edges, a) : bisect.bisect_left(edges, b)], b]
            for lo, hi in zip(own, own[1:]):
                n = counts.get(bisect.bisect_right(edges, lo), 0)
                if below + n >= targets[i]:
                    break
                below += n
            if targets[i] - below <= slack:
                found[i] = lo
            elif below + n - targets[i] <= slack:
                found[i] = hi
            elif hi - lo <= 1:
                found[i] = lo if targets[i] - below <= below + n - targets[i] else hi
            else:
                left[i] = (lo, hi, below)
        open_ = left
    found |= {i: lo for i, (lo, _, _) in open_.items()}
    return [found[i] for i in range(len(targets))]


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.01, parts: int | None = None, part_bytes: int = 1 << 28) -> DataFrame:
    """docs with size, text_crc32, shard and slot (gapless from 0 in each shard), sorted by key within each piece.
    A shard has so many pieces that one holds about part_bytes, 16 at least, unless parts says how many."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = docs.withColumns({"size": utf8_size(F.col("text")) + 8, "text_crc32": crc, "_key": key_of(F.col("text"), F.col("doc_id"))})
    keys = stash(rows.select(F.col("_key").alias("key"), "size"), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    pieces = shards * (parts or max(16, -(-total // (shards * part_bytes))))
    cut = splitters(keys, [total * i / shards for i in range(1, shards)], tolerance * total / shards / 2)
    # pieces inside a shard need no exactness: keys are hashed bits, but copies pile up, so they are found by counts too
    loose = splitters(keys, [total * i / pieces for i in range(1, pieces)], 0.25 * total / pieces, probes=16, max_rounds=14)
    edges = sorted({*cut, *loose} - {0})
    piece = _cells(edges)
    counts = {r.piece: r.n for r in keys.groupBy(piece("key").alias("piece")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shard_of, first, at, last = [], [], 0, -1
    for p in range(len(edges) + 1):
        s = bisect.bisect_right(cut, edges[p - 1] if p else 0) if cut else 0
        at = at if s == last else 0
        shard_of.append(s)
        first.append(at)
        at, last = at + counts.get(p, 0), s
    own = Window.partitionBy("_piece").orderBy("_key", "doc_id")
    placed = rows.withColumn("_piece", piece("_key")).withColumn("_row", F.row_number().over(own))
    return placed.withColumns({"shard": _looked_up(shard_of, "int")("_piece"), "slot": _looked_up(first, "long")("_piece") + F.col("_row") - 1}).drop("_key", "_piece", "_row")
