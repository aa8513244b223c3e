"""Vorticity at a pole, where a degree of longitude has all but no length."""

import math

import duckdb
from pyspark.sql import functions as F

from cindergrid.plans import registry, weather
from tests.compare import rows


def test_vorticity_at_a_pole_equals_sql(spark, tmp_path):
    part = "select i + 9851 as p_partkey, cast(1 + i * 37 % 50 as int) as p_size, 900.0::double + i * 13 % 1000 as p_retailprice from range(250) t(i)"  # lines 197 to 201: 89.25 to 90.25 degrees
    duckdb.sql(f"copy ({part}) to '{tmp_path}/part.parquet' (format parquet)")
    got = registry.QUERIES["vorticity"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{tmp_path}/part.parquet'")
    assert rows(got) == rows(con.execute(registry.ORACLES["vorticity"]).df())
    assert got[got.iy == 200].absv.abs().max() > 2.0**63 / 1e4 > got[got.iy != 200].absv.abs().max()


def test_floor_stays_a_double(spark):
    values = [-2.0, -1.5, -0.2, 0.0, 0.3, 0.5, 1.5, 2.5, 7.0, -(2.0**52) - 1, 2.0**52 - 0.5, 2.0**53, 3e21, -3e21, 1e300]
    got = spark.createDataFrame([(v,) for v in [*values, None, math.inf]], "v double").select(weather._floor(F.col("v")).alias("v")).collect()
    assert [r.v for r in got] == [*(float(math.floor(v)) for v in values), None, math.inf]
