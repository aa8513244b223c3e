"""Weather-like views on the supplied tables, in SQL that both engines read. Every view grows with its table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    # n-th event of a user: n-th hour of a cell
    "wx": """select user_id as cell, timestamp '2026-07-01 12:00:00' + (n - 1) * interval '1' hour as valid_ts, cast(n as bigint) as hour_no,
        cast(5 + least(value / 20, 30) as double) as temp_c, cast(greatest(5, least(100, 20 + value / 5)) as double) as rh,
        cast(least(value / 8, 60) as double) as wind_kmh, cast(case when event_type = 'error' then least(value / 50, 8) else 0 end as double) as precip_mm,
        (n + 5) % 24 between 6 and 20 as daylight
        from (select *, row_number() over (partition by user_id order by ts, event_id) as n from {events}) e""",
    "grid": """select cast(floor((p_partkey - 1) / 50) as bigint) as iy, cast((p_partkey - 1) % 50 as bigint) as ix,
        cast(case when p_size >= 5 then p_retailprice end as double) as v, cast(p_retailprice / 2 + p_size * 20 as double) as terrain, cast(p_size as bigint) as size from {part}""",
    "profile": """select cell, p_hpa, height, temp, rh, surface_t, surface_p, level from (
        select l_orderkey as cell, cast(l_linenumber as bigint) as level, cast(1050 - 90 * l_linenumber - l_quantity / 10 as double) as p_hpa,
            cast(l_linenumber * 150 + l_quantity as double) as height, cast(290 - l_linenumber * 2 + l_discount * 60 as double) as temp,
            cast(case when l_quantity < 48 then 30 + l_quantity end as double) as rh, cast(288.5 as double) as surface_t, cast(850 + (l_orderkey % 17) * 10 as double) as surface_p,
            row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) as r from {lineitem}) q where r = 1""",
    "forecast": """select cast(o_custkey as bigint) as station, case when o_orderkey % 2 = 0 then 'continental' else 'west' end as model, cast(o_orderdate as date) as fire_date,
        cast(o_orderkey % 73 as double) as lead, cast(1 + (o_orderkey * 7) % 5 as double) as fclass, cast(o_orderkey as bigint) as id from {orders}""",
    "observed": """select distinct cast(o_custkey as bigint) as station, cast(o_orderdate as date) as fire_date, cast(1 + (o_custkey + extract(day from o_orderdate)) % 5 as double) as oclass from {orders}
        where (o_custkey + extract(day from o_orderdate)) % 3 <> 0""",
    "hotspot": """select cast(event_id * 37 % 3300 - 14100 as double) / 100 as lon, cast(4550 + user_id * 53 % 1500 as double) / 100 as lat,
        cast(case when event_id % 11 = 0 then null else value end as double) as frp, cast(event_id as bigint) as ts from {events}""",
    "flash10": """select cast(user_id % 20 as bigint) as cell, timestamp '2024-01-01 00:00:00' + cast(floor(extract(epoch from ts) / 600) - 2840112 as bigint) * interval '10' minute as ts,
        max(case when event_id % 97 = 0 then null else value / 1000 end) as rate from {events} group by 1, 2""",
    "artifact": """select stamp, product, fhour, max(l_orderkey) as size_bytes, max(l_partkey) as mtime from (
        select *, concat(l_returnflag, l_linestatus) as product, cast(l_linenumber * 3 as bigint) as fhour, cast(cast(l_shipdate as date) as varchar(10)) as stamp from {lineitem}) a group by stamp, product, fhour""",
    "run_file": """select case when floor(event_id / 4) % 2 = 0 then 'continental' else 'west' end as model, concat('202401', lpad(cast(5 + user_id % 5 as varchar(2)), 2, '0'), 'T', lpad(cast((event_id % 4) * 6 as varchar(2)), 2, '0'), 'Z') as run,
        cast(floor(value) as bigint) % 17 * 3 as fhour, cast(event_id as bigint) as id, timestamp '2024-01-05 00:00:00' + (user_id % 5) * interval '24' hour + (event_id % 4) * interval '6' hour as init from {events}""",
    "sounding": """select cast(hour_no as bigint) as hour, cell, cast(temp_c * 60 as double) as dcape, cast(2 - rh / 15 as double) as li, cast(temp_c * 70 as double) as pbl,
        cast(wind_kmh / 2 as double) as w850, cast(wind_kmh / 1.5 as double) as w700, cast(1 + cell % 3 as double) as weight, cell % 4 = 0 as coastal,
        case when hour_no % 24 between 8 and 16 then 'day' when hour_no % 24 < 8 then 'morning' else 'other' end as period from ({wx}) w""",
}


def _filled(sql: str, tables: dict[str, str]) -> str:
    while True:
        new = re.sub(r"\{(\w+)\}", lambda m: VIEWS[m[1]] if m[1] in VIEWS else tables.get(m[1], f"\0{m[1]}\1"), sql)
        if new == sql:
            return sql.replace("\0", "{").replace("\1", "}")
        sql = new


def duck(sql: str) -> str:
    """SQL for DuckDB: views spelled out, tables by name."""
    return _filled(sql, {t: t for t in ("events", "part", "lineitem", "orders", "customer", "supplier", "nation", "region", "documents", "pages")})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = _filled(f"select * from {{{name}}}" if name not in VIEWS else VIEWS[name], {})
    if name == "flash10":
        sql = sql.replace("extract(epoch from ts)", "unix_timestamp(cast(ts as timestamp))")
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})
