"""Ten-minute lightning rasters as a stream of rows: a folder tree of text grids, each file once, faulty ones listed."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import feeds

FILE = "path string, modificationTime timestamp, length long, content binary"
ROWS = "name string, valid_ts timestamp, iy long, ix long, flash_rate double, fault string"
_KIND = pa.schema([("name", pa.string()), ("valid_ts", pa.timestamp("us", "UTC")), ("iy", pa.int64()), ("ix", pa.int64()), ("flash_rate", pa.float64()), ("fault", pa.string())])


def parsed(content: bytes, shape: tuple[int, int] | None) -> Iterator[tuple[int, list[float | None]]]:
    """(iy, rates) of each line of a text grid: lines of a name and a number (ncols, nrows, nodata_value, ...), then the
    rows, from the first one down. A missing or non-finite value is None. A ValueError says what is wrong."""
    head: dict[str, float] = {}
    lines = content.split(b"\n")
    at = 0
    while at < len(lines) and lines[at][:1].isalpha():
        name, _, value = lines[at].strip().partition(b" ")
        head[name.decode().lower()] = float(value)
        at += 1
    if not {"ncols", "nrows"} <= set(head):
        raise ValueError("no size in the header")
    size, missing = (int(head["nrows"]), int(head["ncols"])), head.get("nodata_value", -999.0)
    if shape is not None and size != shape:
        raise ValueError(f"the grid is {size[0]} x {size[1]}, not {shape[0]} x {shape[1]}")
    rows = [x for x in lines[at:] if x.strip()]
    if len(rows) != size[0]:
        raise ValueError(f"{len(rows)} lines of {size[0]}")
    for iy, line in enumerate(rows):
        values = [float(x) for x in line.split()]
        if len(values) != size[1]:
            raise ValueError(f"{len(values)} values of {size[1]} in line {iy}")
        yield iy, [v if math.isfinite(v) and v != missing else None for v in values]


def files(spark: SparkSession, path: str, glob: str = "*.asc", per_trigger: int = 1000) -> DataFrame:
    """A stream of the files of a folder tree."""
    source = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return source.option("maxFilesPerTrigger", per_trigger).load(path)


def flash_rows(source: DataFrame, shape: tuple[int, int] | None = None, level: int = 1) -> DataFrame:
    """(name, valid_ts, iy, ix, flash_rate, fault) of a stream of files: the cells of good ones, and a row with a fault for
    each that has no time in its name, cannot be read, or has another shape than is asked for. A name comes out once,
    from whichever folder and however often it is delivered; names are the stream's state. The name is a file's own, or with
    level 2 its folder's, such as Spark's writers make (name=value)."""
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -level), "^[^=]*=", "")
    once = source.select(name.alias("name"), "content").dropDuplicates(["name"])
    timed = once.withColumn("valid_ts", feeds.obs_time(F.col("name")))

    def made(batches):
        for batch in batches:
            for name, content, ts in zip(*(batch.column(c) for c in ("name", "content", "valid_ts"))):
                try:
                    if not ts.is_valid:
                        raise ValueError("no time in the name")
                    lines = list(parsed(content.as_py(), shape))  # one file; none of its rows if any of it is wrong
                except ValueError as e:  # UnicodeDecodeError is one
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((name.as_py(), ts.as_py(), None, None, None, str(e)), _KIND)], schema=_KIND)
                    continue
                for iy, rates in lines:
                    n = len(rates)
                    yield pa.RecordBatch.from_arrays([pa.array([v] * n, f.type) for v, f in zip((name.as_py(), ts.as_py(), iy), _KIND)] + [pa.array(range(n), pa.int64()), pa.array(rates, pa.float64()), pa.nulls(n, pa.string())], schema=_KIND)

    return timed.select("name", "content", "valid_ts").mapInArrow(made, ROWS)


def write_rasters(source: DataFrame, path: str, checkpoint: str, shape: tuple[int, int] | None = None, level: int = 1) -> StreamingQuery:
    """Writes (valid_ts, iy, ix, flash_rate) to path/rows and (name, fault) to path/faults, by batch: one that is run again
    after a failure replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.filter("fault is null").select("valid_ts", "iy", "ix", "flash_rate").write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        batch.filter("fault is not null").select("name", "fault").write.mode("overwrite").parquet(f"{path}/faults/batch={batch_id}")

    return flash_rows(source, shape, level).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
