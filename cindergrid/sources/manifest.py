"""A table whose appends are seen whole or not at all: numbered manifests, each written by one writer only.

``path/data/<token>`` holds the files of an append, ``path/manifest/<number>`` names the appends of a version, with the
schema and the grid that all of them share. A writer puts its files in place first, then makes the next manifest with an
exclusive create. If another was first, it checks its rows against that one and tries the number after; so of two first
writers one makes the archive and the other is held against it. Readers take the files that the newest manifest names, and never
see an append in the making, or what a failed one left. The create is exclusive where the file system's is (as HDFS).
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from . import store

#: Seconds after which a manifest without contents belongs to a writer that has died, and may be written again.
ABANDONED = 60.0


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _versions(spark: SparkSession, path: str) -> list[tuple[int, float, dict | None]]:
    """(number, age in seconds, contents) of the manifests, oldest first; None for one that is being written."""
    fs, folder = _path(spark, f"{path}/manifest")
    if not fs.exists(folder):
        return []
    found = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.isdigit():
            text = "".join(r.value for r in spark.read.text(str(status.getPath().toString())).collect())  # one small file
            found.append((int(name), time.time() - status.getModificationTime() / 1000, json.loads(text) if text.endswith("}") else None))
    return sorted(found, key=lambda v: v[0])


def newest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """The newest whole manifest and its number."""
    whole = [(n, held) for n, _, held in _versions(spark, path) if held is not None]
    return whole[-1] if whole else None


def _claim(spark: SparkSession, path: str, number: int, held: dict, again: bool) -> bool:
    """Writes a manifest, unless that number is taken."""
    fs, file = _path(spark, f"{path}/manifest/{number:08d}")
    try:
        out = fs.create(file, again)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception.getMessage()):
            return False
        raise
    out.write(bytearray(json.dumps(held, sort_keys=True).encode()))
    out.close()
    return True


def _schema(df: DataFrame) -> list[list[str]]:
    return sorted([f.name, f.dataType.simpleString()] for f in df.schema)


def append(df: DataFrame, path: str, by: list[str], grid: list[str], token: str, wait: float = 0.2) -> int:
    """Adds df to the archive at path and gives the version that has it. It must have the archive's columns and types, and its
    grid (the set of cells, by these columns); otherwise an error, and nothing of it is ever seen. The first append makes the
    archive. A token that is there already is not added again, so an append can be run again after any failure."""
    spark = df.sparkSession
    if not token.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a token is made of letters, digits, - and _")
    own = {"schema": _schema(df), "grid": store.grid_fingerprint(df.select(*grid).distinct(), [], grid, []).first().fingerprint}

    def checked(before: dict | None) -> None:
        for what in ("schema", "grid"):
            if before is not None and before[what] != own[what]:
                raise ValueError(f"the archive has another {what}, so its version must change")

    before = newest(spark, path)
    if before is not None and token in before[1]["appends"]:
        return before[0]
    checked(before and before[1])
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/data/{token}")
    while True:
        versions = _versions(spark, path)
        number, again = (versions[-1][0] + 1 if versions else 1), False
        if versions and versions[-1][2] is None:  # another writer is at it, or was
            if versions[-1][1] < ABANDONED:
                time.sleep(wait)
                continue
            number, again = versions[-1][0], True
        last = [held for _, _, held in versions if held is not None]
        try:
            checked(last[-1] if last else None)
        except ValueError:
            fs, folder = _path(spark, f"{path}/data/{token}")
            fs.delete(folder, True)
            raise
        appends = last[-1]["appends"] if last else []
        if token in appends:
            return versions[-1][0]
        if _claim(spark, path, number, own | {"by": by, "appends": [*appends, token]}, again):
            return number


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of the newest version, or of an earlier one."""
    found = [(n, held) for n, _, held in _versions(spark, path) if held is not None and version in (None, n)]
    if not found:
        raise ValueError("no such version of the archive" if version else "there is no archive")
    held = found[-1][1]
    rows = [spark.read.parquet(f"{path}/data/{token}") for token in held["appends"]]
    columns = [f"cast(`{name}` as {kind}) as `{name}`" for name, kind in held["schema"]]  # folder names are read as other types
    out = rows[0].selectExpr(*columns)
    for more in rows[1:]:
        out = out.unionByName(more.selectExpr(*columns))
    return out
