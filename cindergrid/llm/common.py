"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Maps ASCII upper case to lower case and nothing else.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. A local session that names none gets a new one; elsewhere that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_made: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _made:
        paths.append(path)
    return path


@contextmanager
def scratch() -> Iterator[list[str]]:
    """The paths that are handed out inside, to be dropped by the caller once nothing reads them any more."""
    paths: list[str] = []
    _made.append(paths)
    try:
        yield paths
    finally:
        _made[:] = [x for x in _made if x is not paths]


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Deletes these tables of the shared folder."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it again: the lineage ends there, and a lost
    executor costs a re-read only."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, n: int) -> Column:
    """crc32(id as text) mod n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(n))


def utf8_size(col: Column) -> Column:
    return F.octet_length(F.coalesce(col, F.lit(""))).cast("long")


def slices(batches, rows: int = 1000):
    """Arrow batches cut to at most so many rows, so that a task holds few texts as Python objects at once. At the end
    Arrow gives back what it keeps for later, since a worker lives on for tasks of other kinds."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)
    pa.default_memory_pool().release_unused()


def bind(value: Column, body) -> Column:
    """body(value) with value evaluated once, even where body uses it inside another lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)
