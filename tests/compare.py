"""Rows of two frames as sorted tuples of text, missing values alike."""

import math

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return "∅"
        if isinstance(v, bool | np.bool_):
            return str(bool(v))
        return repr(float(v) + 0.0) if isinstance(v, int | float | np.number) else str(v)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con
