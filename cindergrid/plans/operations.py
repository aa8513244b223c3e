"""Queries: streams of peaks, readiness and notices, state hand-over, stores, reports, images, messages, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, geo
from ..operators import catalog, evolution, moisture, steps, synoptic
from ..sources import feeds, manifest, store
from ..streaming import notices, peaks, rasters, readiness
from . import bookkeeping, danger
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r4 = lambda c, a=None: (F.floor((F.col(c) if isinstance(c, str) else c) * 1e4 + 0.5) / 1e4).alias(a or c)
R4 = lambda x, a: f"floor(({x}) * 1e4 + 0.5) / 1e4 as {a}"


def _streamed(spark, df, name, files=None):
    path = store.new_path(spark, name)
    (df if files is None else df.repartition(files)).write.parquet(path)
    reader = spark.readStream.schema(df.schema) if files is None else spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def streamed_peaks(spark, sf_dir):
    wx = view(spark, sf_dir, "wx").select("cell", F.col("valid_ts").cast("timestamp").alias("valid_ts"), "wind_kmh", (62 + F.col("temp_c")).alias("ffmc"), (F.col("temp_c") / 2).alias("fwi"), F.col("rh").alias("bui"))
    out = store.new_path(spark, "peaks")
    peaks.write_peaks(_streamed(spark, wx, "hours"), ["cell"], out, store.new_path(spark, "stream")).awaitTermination()
    got = spark.read.parquet(out)
    return got.select("cell", F.col("fire_date").cast("string").alias("fire_date"), r4("fwi"), r4("bui"), F.col("peak_hour").cast("long").alias("peak_hour"), "hour_count", "complete")


QUERIES["streamed_peaks"] = streamed_peaks
ORACLES["streamed_peaks"] = duck("""with codes as (select cell, hour_no, wind_kmh as wind, 62 + temp_c as ffmc, temp_c / 2 as fwi, rh as bui, 14875.0::double / 101 * (101 - ffmc) / (59.5 + ffmc) as m from ({wx}) x), """ + danger.PEAK_SQL + """, z as (select max(loc) as last from h)
select cell, cast(fire_date as varchar) as fire_date, floor(fwi * 1e4 + 0.5) / 1e4 as fwi, floor(bui * 1e4 + 0.5) / 1e4 as bui, cast(peak_hour as bigint) as peak_hour, hour_count, fh = 5 and coalesce(eh, -1) = 5 and hour_count between 23 and 25 as complete
from p, z where cast(fire_date as timestamp) + interval 24 hour <= last - interval 5 hour - interval 3 hour""")


def streamed_readiness(spark, sf_dir):
    listing = bookkeeping._listing(spark, sf_dir).withColumn("fhour", F.col("fhour").cast("long"))
    hours = listing.select("fhour").distinct()
    needs = hours.withColumn("need_hour", F.explode(F.array(F.col("fhour"), F.greatest(F.col("fhour") - 3, F.lit(3).cast("long"))))).withColumn("field", F.lit("NO")).distinct()
    out = store.new_path(spark, "readiness")
    readiness.write_ready(_streamed(spark, listing, "listing", 3), needs, out, store.new_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(f"{out}/ready").select("run", "fhour")


QUERIES["streamed_readiness"] = streamed_readiness
ORACLES["streamed_readiness"] = bookkeeping.ORACLES["ready_hours"]


def streamed_notices(spark, sf_dir):
    e = view(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("monitor"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("value") > 488, "critical").when(F.col("value") > 60, "warning").otherwise("ok").alias("level"))
    e = e.groupBy("monitor", "ts").agg(F.max("level").alias("level"))
    out = store.new_path(spark, "notices")
    stream = notices.notices(_streamed(spark, e, "checks")).writeStream.outputMode("append").option("checkpointLocation", store.new_path(spark, "stream")).trigger(availableNow=True)
    stream.format("parquet").start(out).awaitTermination()
    return spark.read.parquet(out).select("monitor", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "level", "reason")


QUERIES["streamed_notices"] = streamed_notices
ORACLES["streamed_notices"] = "select cast(monitor as varchar) as monitor, ts, level, 'level' as reason from (" + bookkeeping.ORACLES["usage_alerts"] + ") q"


def state_handover(spark, sf_dir):
    """Two legs of a run: the first from the chosen start, the second from the stored state of hour 12."""
    hours = view(spark, sf_dir, "wx").withColumns({"run": F.lit("r"), "fhour": F.col("hour_no")})
    cells = hours.select("cell", "run").distinct().select("*", F.lit("2026-07-01").cast("date").alias("anchor"), F.lit(0).cast("long").alias("lead"), moisture.start_state().alias("state"))
    begin = evolution.start_states(cells.filter("cell % 4 = 0"), cells.filter("cell % 3 = 0"), cells.filter("cell % 5 = 0"), cells)
    first = evolution.advance(begin.withColumn("until", F.lit(12).cast("long")), hours, "lead", "until")
    path = store.new_path(spark, "states")
    store.write_hours(evolution.states_at(first, 12), path, ["run", "fhour"])
    held = spark.read.parquet(path).withColumns({"fhour": F.col("fhour").cast("long"), "until": F.lit(48).cast("long")}).withColumnRenamed("fhour", "from")
    second = evolution.advance(held, hours, "from", "until").join(begin.select("cell", "source"), "cell")
    return second.select("cell", F.col("fhour").alias("hour_no"), "source", *[(F.floor(F.col(c) * 1e3 + 0.5) / 1e3).alias(c) for c in ("ffmc", "dmc", "dc", "fwi")])


QUERIES["state_handover"] = state_handover
ORACLES["state_handover"] = duck("with recursive " + danger.FWI_SQL + " select cell, hour_no, case when cell % 4 = 0 then 'own' when cell % 3 = 0 then 'prior' when cell % 5 = 0 then 'bridge' else 'bootstrap' end as source, "
    + ", ".join(f"floor({c} * 1e3 + 0.5) / 1e3 as {c}" for c in ("ffmc", "dmc", "dc", "fwi")) + " from codes where hour_no between 13 and 48")


def peak_store(spark, sf_dir):
    o, k = view(spark, sf_dir, "orders"), F.col("o_orderkey")
    days = o.select(
        F.when(k % 2 == 0, "west").otherwise("continental").alias("model_key"), F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("fire_date"), (k % 4).cast("string").alias("run_stamp"),
        F.timestamp_seconds(k % 4 * 21600).alias("run_init"), (k % 3 == 0).alias("complete"), (k % 3 <= 1).alias("cutoff_reached"), F.when(k % 7 != 0, k % 5 + 1).alias("danger"), k.alias("cell")).filter("complete or cutoff_reached")
    path = store.new_path(spark, "peak-days")
    store.save_peaks(days, path, allow_partial=True)
    got = store.load_peaks(spark, path, F.timestamp_seconds(F.lit(50000)))
    return got.select("model_key", F.col("fire_date").cast("string").alias("fire_date"), "cell", F.col("danger").cast("long").alias("danger"), "complete")


QUERIES["peak_store"] = peak_store
ORACLES["peak_store"] = """with d as (select case when o_orderkey % 2 = 0 then 'west' else 'continental' end as model_key, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as fire_date, o_orderkey % 4 as run, o_orderkey as cell, case when o_orderkey % 7 <> 0 then o_orderkey % 5 + 1 end as danger, o_orderkey % 3 = 0 as complete
from orders where o_orderkey % 3 <= 1 and o_orderkey % 4 * 21600 <= 50000) select model_key, fire_date, cell, danger, complete from d qualify run = max(run) over (partition by model_key, fire_date)"""


def grid_fingerprints(spark, sf_dir):
    g = view(spark, sf_dir, "grid").withColumn("layer", F.col("ix") % 3)
    return store.grid_fingerprint(g, ["layer"], ["iy", "ix"], ["size"])


QUERIES["grid_fingerprints"] = grid_fingerprints
ORACLES["grid_fingerprints"] = duck("""with b as (select ix % 3 as layer, iy, sha256(string_agg(sha256(concat_ws(',', iy, ix, size)), '' order by iy, ix)) as b from ({grid}) x group by 1, 2) select layer, sha256(string_agg(b, '' order by iy)) as fingerprint from b group by 1""")


def artifact_report(spark, sf_dir):
    """The fifty largest artifacts, written as a report and read back."""
    path = store.new_path(spark, "report")
    store.write_report(bookkeeping.frames(spark, sf_dir).select("run", "product", "fhour", "size_bytes"), path, [F.desc("size_bytes"), F.asc("run"), F.asc("product"), F.asc("fhour")], 50)
    return spark.read.schema("run string, product string, fhour long, size_bytes long").option("header", True).csv(path)


QUERIES["artifact_report"] = artifact_report
ORACLES["artifact_report"] = duck("select stamp as run, product, fhour, size_bytes from ({artifact}) a order by size_bytes desc, stamp, product, fhour limit 50")


def whole_images(spark, sf_dir):
    html = F.coalesce("html", F.lit("")).cast("binary")
    p = view(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.concat(html, F.unhex(F.lit(catalog.IMAGE_END)))).otherwise(html).alias("content"))
    return catalog.whole_images(p).select("page_id", F.length("content").cast("long").alias("bytes"))


QUERIES["whole_images"] = whole_images
ORACLES["whole_images"] = "select page_id, cast(octet_length(encode(coalesce(html, ''))) + 12 as bigint) as bytes from pages where page_id % 3 = 0"


def superseded_frames(spark, sf_dir):
    cycle = F.when(F.col("product") == "AF", 0).when(F.col("product") == "NF", 6).when(F.col("product") == "NO", 12).otherwise(18)
    f = bookkeeping.frames(spark, sf_dir).select("run", "product", (F.col("fhour") * 2).alias("fhour"), (F.col("run").cast("timestamp") + F.make_dt_interval(hours=cycle)).alias("init"))
    return catalog.superseded(f, F.sequence(F.lit(0), F.lit(48), F.lit(3))).select("run", "product", "fhour")


QUERIES["superseded_frames"] = superseded_frames
ORACLES["superseded_frames"] = duck("select stamp as run, product, fhour * 2 as fhour from ({artifact}) a where fhour * 2 <> case product when 'AF' then 36 when 'NF' then 30 when 'NO' then 24 else 42 end")


def first_messages(spark, sf_dir):
    m = view(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("file"), F.col("l_returnflag").alias("short_name"), F.col("l_linestatus").alias("level_type"), (F.col("l_linenumber") % 2).cast("long").alias("level"), F.lit(3).cast("long").alias("step"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("at"), F.col("l_extendedprice").alias("value"))
    wanted = spark.createDataFrame([("n", "O", 1, 3), ("R", "F", 0, 3)], "short_name string, level_type string, level long, step long")
    return catalog.first_messages(m, wanted, ["file"], "at", ["value"]).select("file", "short_name", "level_type", "level", "found", r4("value"))


QUERIES["first_messages"] = first_messages
ORACLES["first_messages"] = """with w(short_name, level_type, level) as (values ('n', 'O', 1), ('r', 'F', 0)), f as (select distinct l_orderkey as file from lineitem), m as (select * from lineitem qualify row_number() over (partition by l_orderkey, l_returnflag, l_linestatus, l_linenumber % 2 order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1)
select file, short_name, level_type, cast(level as bigint) as level, l_orderkey is not null as found, floor(l_extendedprice * 1e4 + 0.5) / 1e4 as value from f cross join w left join m on l_orderkey = file and lower(l_returnflag) = short_name and l_linestatus = level_type and l_linenumber % 2 = level"""

_SYNOPTIC = ("vorticity_e5", "height500_km", "pressure_kpa", "temp_c", "wind_kmh", "lifted_index", "cape", "rh_mean")


def synoptic_frames(spark, sf_dir):
    t, h, n = F.col("temp_c"), F.col("rh"), F.col("hour_no")
    f = view(spark, sf_dir, "wx").select(
        "cell", "hour_no", (t * 1e-6).alias("absv"), (5000 + t * 10).alias("hgt500"), (100000 + h * 20).alias("prmsl_pa"), (t + 273.15).alias("temp_k"), (F.col("wind_kmh") / 4).alias("u"), (t / 5).alias("v"), (t - 6).alias("terrain_m"),
        (t * 3 - 30).alias("li"), (t * 800 - 4800).alias("cape"), h.alias("rh850"), F.when(n % 6 != 0, h / 2).alias("rh700")).drop("_")
    return synoptic.frame(f).select("cell", "hour_no", "land", *map(r4, _SYNOPTIC))


QUERIES["synoptic_frames"] = synoptic_frames
ORACLES["synoptic_frames"] = duck("select cell, hour_no, temp_c - 6 > 0.5 as land, " + ", ".join(R4(x, a) for x, a in zip(
    ["temp_c * 1e-6::double * 1e5::double", "(5000 + temp_c * 10) / 1000", "(100000 + rh * 20) / 1000", "temp_c + 273.15 - 273.15", "sqrt(wind_kmh / 4 * (wind_kmh / 4) + temp_c / 5 * (temp_c / 5)) * 3.6", "case when abs(temp_c * 3 - 30) <= 50 then temp_c * 3 - 30 end",
     "case when temp_c * 800 - 4800 >= 0 and temp_c * 800 - 4800 < 20000 then temp_c * 800 - 4800 end", "0.5 * (rh + case when hour_no % 6 <> 0 then rh / 2 end)"], _SYNOPTIC)) + " from ({wx}) x")


def features_in_extent(spark, sf_dir):
    """Diamonds of several sizes around the customers, as JSON, that meet a box."""
    k = F.col("c_custkey")
    x, y, h = k * 37 % 200 / 10 - 133.0, k * 53 % 130 / 10 + 46.0, k % 5 + 0.33
    point = lambda a, b: F.array(a.cast("double"), b.cast("double"))
    ring = F.array(point(x - h, y), point(x, y - h), point(x + h, y), point(x, y + h), point(x - h, y))
    f = F.struct(F.struct(F.concat(F.lit("W"), k).alias("name")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    raw = view(spark, sf_dir, "customer").select(F.to_json(F.array(f)).alias("json"))
    return synoptic.features_in(synoptic.vertices(raw), -126.0, -124.0, 49.0, 50.0).select("name")


QUERIES["features_in_extent"] = features_in_extent
ORACLES["features_in_extent"] = """with c as (select c_custkey as k, c_custkey * 37 % 200 / 10.0 - 133.0 as x, c_custkey * 53 % 130 / 10.0 + 46.0 as y, c_custkey % 5 + 0.33 as h from customer)
select 'W' || k as name from c where greatest(-126 - x, 0, x + 124) + greatest(49 - y, 0, y - 50) <= h"""


def file_times(spark, sf_dir):
    e = view(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("x/"), F.date_format(F.col("ts").cast("timestamp"), "yyyyMMdd'T'HHmm'Z'"), F.lit("_flash.tif"))).otherwise("none.tif").alias("name"))
    return e.select("event_id", F.date_format(feeds.obs_time(F.col("name")), "yyyy-MM-dd HH:mm:ss").alias("valid"))


QUERIES["file_times"] = file_times
ORACLES["file_times"] = "select event_id, case when event_id % 7 <> 0 then strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') end as valid from events"


def first_sources(spark, sf_dir):
    wx = view(spark, sf_dir, "wx")
    part = lambda cond, c: wx.filter(cond).select("cell", "hour_no", F.col(c).alias("ipw"))
    got = steps.first_source(wx.select("cell", "hour_no"), [part("hour_no % 3 = 0", "temp_c"), part("hour_no % 2 = 0", "rh"), part("hour_no % 5 = 0", "wind_kmh")], ["cell", "hour_no"], "ipw")
    return got.select("cell", "hour_no", r4("ipw"))


QUERIES["first_sources"] = first_sources
ORACLES["first_sources"] = duck("select cell, hour_no, " + R4("case when hour_no % 3 = 0 then temp_c when hour_no % 2 = 0 then rh when hour_no % 5 = 0 then wind_kmh end", "ipw") + " from ({wx}) x")


def cleaned_fields(spark, sf_dir):
    rows = view(spark, sf_dir, "wx").select("cell", "hour_no", F.when(F.col("hour_no") % 5 == 0, 1e21).otherwise(F.col("temp_c")).alias("value"), (F.col("hour_no") * 37 % 360).cast("double").alias("lon"))
    return steps.cleaned(rows).select("cell", "hour_no", r4("value"), "lon")


QUERIES["cleaned_fields"] = cleaned_fields
ORACLES["cleaned_fields"] = duck("select cell, hour_no, " + R4("case when hour_no % 5 <> 0 then temp_c end", "value") + ", cast(case when hour_no * 37 % 360 > 180 then hour_no * 37 % 360 - 360 else hour_no * 37 % 360 end as double) as lon from ({wx}) x")


def lambert_places(spark, sf_dir):
    k = F.col("c_custkey")
    rows = view(spark, sf_dir, "customer").select(k.alias("id"), (k * 37 % 400 / 10 - 140.0).alias("lon"), (k * 53 % 200 / 10 + 45.0).alias("lat"))
    x, y = geo.lambert(F.col("lon"), F.col("lat"))
    rows = rows.select("*", x.alias("x"), y.alias("y"))
    lon, lat = geo.lambert_inverse(F.col("x"), F.col("y"))
    return rows.select("id", r4(F.col("x") / 1e3, "x_km"), r4(F.col("y") / 1e3, "y_km"), ((F.abs(lon - F.col("lon")) < 1e-8) & (F.abs(lat - F.col("lat")) < 1e-8)).alias("back"))


_N, _F, _RHO0 = geo._cone(geo.LAMBERT)
QUERIES["lambert_places"] = lambert_places
ORACLES["lambert_places"] = f"""with c as (select c_custkey as id, c_custkey * 37 % 400 / 10::double - 140 as lon, radians(c_custkey * 53 % 200 / 10::double + 45) as lat from customer),
p as (select *, {geo.A}::double * {_F}::double * pow(tan(pi() / 4 - lat / 2) / pow((1 - {geo.E1}::double * sin(lat)) / (1 + {geo.E1}::double * sin(lat)), {geo.E1 / 2}::double), {_N}::double) as rho, {_N}::double * radians(lon + 95) as th from c)
select id, floor(rho * sin(th) / 1e3 * 1e4 + 0.5) / 1e4 as x_km, floor(({_RHO0}::double - rho * cos(th)) / 1e3 * 1e4 + 0.5) / 1e4 as y_km, true as back from p"""


def noon_windows(spark, sf_dir):
    """The forecast hours of each run's first 12Z to 12Z window; runs of five hours lack them."""
    k = F.col("o_orderkey")
    init = F.date_trunc("day", F.col("o_orderdate").cast("timestamp")) + F.make_dt_interval(hours=(k % 24).cast("int"))
    last = F.when(k % 5 == 0, 30).otherwise(48)
    hours = clock.first_12z_hours(init, F.sequence(F.lit(0), last, F.lit(3)))
    return view(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.transform(hours, lambda h: h.cast("string")), ",").alias("hours"))


QUERIES["noon_windows"] = noon_windows
ORACLES["noon_windows"] = """with o as (select o_orderkey, (36 - o_orderkey % 24) % 24 as a, case when o_orderkey % 5 = 0 then 30 else 48 end as m from orders)
select o_orderkey, case when a % 3 = 0 and a + 24 <= m then array_to_string([a + 3 * i for i in range(1, 9)], ',') end as hours from o"""


def sample_trees(spark, sf_dir):
    f = view(spark, sf_dir, "forecast").select(F.col("model").alias("m"), F.year("fire_date").alias("y"), F.col("station").cast("string").alias("station_code"), "lead", "id")
    path = store.new_path(spark, "samples")
    f.write.partitionBy("m", "y").option("header", True).csv(path)
    return feeds.forecast_samples(spark, path, "station_code string, lead double, id long").select("station_code", "lead", "id")


QUERIES["sample_trees"] = sample_trees
ORACLES["sample_trees"] = duck("select cast(station as varchar) as station_code, lead, id from ({forecast}) f")


def upserted(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("at"), F.col("o_orderstatus").alias("status"))
    return catalog.upsert(o.filter("at % 2 = 0"), o.filter("at % 2 = 1"), "key", "at")


QUERIES["upserted"] = upserted
ORACLES["upserted"] = 'select o_custkey as key, o_orderkey as "at", o_orderstatus as status from orders qualify row_number() over (partition by o_custkey order by o_orderkey desc) = 1'


def guarded_archive(spark, sf_dir):
    """The seven hours of lines appended one after another, each twice; between them appends of another schema and of another
    grid, which are refused; then all that readers see, with the version that brought each hour."""
    rows = view(spark, sf_dir, "lineitem").select((F.col("l_linenumber") * 3).cast("long").alias("fhour"), F.pmod("l_orderkey", F.lit(50)).cast("long").alias("cell"), F.col("l_quantity").alias("value"))
    full = rows.select("cell").distinct()
    path = store.new_path(spark, "guarded")
    for k in range(1, 8):
        hour = full.withColumn("fhour", F.lit(3 * k).cast("long")).join(rows.filter(F.col("fhour") == 3 * k), ["fhour", "cell"], "left").groupBy("fhour", "cell").agg(F.sum("value").alias("value"))
        for again in (False, True):
            manifest.append(hour, path, ["fhour"], ["cell"], f"hour-{3 * k}")
        for wrong in (hour.withColumn("more", F.lit(1)), hour.withColumn("cell", F.col("cell") + 1)):
            try:
                manifest.append(wrong, path, ["fhour"], ["cell"], f"wrong-{k}")
            except ValueError:
                continue
            raise AssertionError("an append of another kind went through")
    return manifest.read(spark, path).groupBy("fhour").agg(F.count(F.lit(1)).alias("cells"), F.sum("value").cast("double").alias("total")).withColumn("version", (F.col("fhour") / 3).cast("long"))


QUERIES["guarded_archive"] = guarded_archive
ORACLES["guarded_archive"] = """with c as (select distinct l_orderkey % 50 as cell from lineitem), h as (select range * 3 as fhour from range(1, 8)), v as (select l_linenumber * 3 as fhour, l_orderkey % 50 as cell, sum(l_quantity) as value from lineitem group by 1, 2)
select h.fhour, count(*) as cells, cast(sum(v.value) as double) as total, cast(h.fhour / 3 as bigint) as version from h cross join c left join v on v.fhour = h.fhour and v.cell = c.cell group by h.fhour"""


def lightning_rasters(spark, sf_dir):
    """The grid's values as ten-minute rasters, one for each of its part sizes, written as files of text and read as a stream in
    several batches; some are cut off, one has no time in its name, and one is delivered in two folders."""
    g = view(spark, sf_dir, "grid").select("iy", "ix", F.coalesce(F.col("v") / 1000, F.lit(-999.0)).alias("v"))
    span = g.agg(F.max("iy").alias("y"), F.max("ix").alias("x")).first()
    ny, nx = (span.y or 0) + 1, (span.x or 0) + 1
    every = g.join(spark.range(1, 13).select(F.col("id").alias("k")))
    lines = every.groupBy("k", "iy").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ix", (F.col("v") * F.col("k")).cast("string").alias("s")))), lambda x: x["s"]), " ").alias("line"), F.count(F.lit(1)).alias("n"))
    whole = lines.filter(F.col("n") == nx).filter(~((F.col("k") == 7) & (F.col("iy") == 0)))
    head = F.concat(F.lit(f"ncols {nx}\nnrows {ny}\nNODATA_value -999\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("iy", "line"))), lambda x: x["line"]), "\n"))
    name = F.when(F.col("k") == 9, "none_flash.asc").otherwise(F.concat(F.lit("20260708T"), F.lpad(F.col("k").cast("string"), 2, "0"), F.lit("10Z_flash.asc")))
    texts = whole.groupBy("k").agg(head.alias("value")).withColumn("day", F.explode(F.when(F.col("k") == 3, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a")))))
    folder, out = store.new_path(spark, "rasters"), store.new_path(spark, "flashes")
    texts.select("value", "day", name.alias("name")).write.partitionBy("day", "name").text(folder)
    rasters.write_rasters(rasters.files(spark, folder, "*.txt", per_trigger=5), out, store.new_path(spark, "stream"), (ny, nx), level=2).awaitTermination()
    good = spark.read.parquet(f"{out}/rows").groupBy(F.date_format("valid_ts", "yyyy-MM-dd HH:mm:ss").alias("valid_ts")).agg(F.count(F.lit(1)).alias("cells"), F.count("flash_rate").alias("valid"), r4(F.sum("flash_rate"), "total"))
    bad = spark.read.parquet(f"{out}/faults").select("name").withColumns({"cells": F.lit(0).cast("long"), "valid": F.lit(0).cast("long"), "total": F.lit(None).cast("double")})
    return good.unionByName(bad.withColumnRenamed("name", "valid_ts"))


QUERIES["lightning_rasters"] = lightning_rasters
# A grid whose last line is short is faulty in every file, since a line is missing.
ORACLES["lightning_rasters"] = duck("""with g as ({grid}), s as (select max(iy) + 1 as ny, max(ix) + 1 as nx from g), w as (select iy from g, s group by iy, nx having count(*) = nx), ok as (select count(*) = min(ny) as ok from w, s),
k as (select range as k from range(1, 13)), n as (select k, case when k = 9 then 'none_flash.asc' else '20260708T' || lpad(cast(k as varchar), 2, '0') || '10Z_flash.asc' end as name, k not in (7, 9) and ok as good from k, ok)
select case when good then '2026-07-08 ' || lpad(cast(k as varchar), 2, '0') || ':10:00' else name end as valid_ts, cast(case when good then count(*) else 0 end as bigint) as cells, cast(case when good then count(v) else 0 end as bigint) as valid, case when good then floor(sum(v / 1000 * k) * 1e4 + 0.5) / 1e4 end as total from n, g group by k, name, good""")
