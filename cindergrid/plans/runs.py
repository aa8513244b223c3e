"""Queries: runs, their names, queue and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import archive, asof, catalog, lightning, runs, spatial, verify
from ..sources import store
from ..streaming import publishing
from .standins import duck, view

QUERIES, ORACLES = {}, {}
text = lambda c, a=None: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(a or c)
SAY = lambda x, a: f"strftime({x}, '%Y-%m-%d %H:%M:%S') as {a}"
HOURS = lambda: F.sequence(F.lit(0), F.lit(48), F.lit(3))

QUERIES["eligible_runs"] = lambda spark, sf_dir: archive.eligible(view(spark, sf_dir, "run_file")).groupBy("run").agg(F.count_distinct("fhour").alias("hours"))
ORACLES["eligible_runs"] = duck("select run, count(distinct fhour) as hours from ({run_file}) where model = 'continental' and substr(run, 10, 2) in ('00', '12') group by 1")


def _queue(spark, sf_dir):
    files = view(spark, sf_dir, "run_file").withColumn("path", F.concat_ws("/", "model", "run", F.col("fhour").cast("string")))
    groups = runs.cache_groups(files, F.lit("2024-01-06 00:00:00").cast("timestamp"))
    done = files.filter("model = 'west' and run like '%T00Z'").select("model", "run").distinct()
    flashes = view(spark, sf_dir, "flash10")
    ends = archive.block_ends(flashes).filter(F.dayofmonth("block_end") % 3 != 0)
    return runs.verification_states(groups, done, flashes.select("ts"), ends, HOURS())


QUEUE = """f as (select distinct model, run, fhour, init from ({run_file}) where init >= timestamp '2024-01-06 00:00:00'), r as (select model, run, init, list(fhour) as have, init + ((36 - extract(hour from init)) % 24 + 24) * interval 1 hour as e, (36 - extract(hour from init)) % 24 as ahead from f group by 1, 2, 3),
t as (select distinct ts from ({flash10})), b as (select distinct timestamp '2024-01-01 00:00:00' + cast(ceil((epoch(ts) - 1704067200) / 10800) as bigint) * interval 3 hour as b from t), k as (select b from b where extract(day from b) % 3 <> 0),
w as (select distinct e from r), o as (select e, (select count(*) from t where ts > e - interval 24 hour and ts <= e) = 144 or (select count(*) from k where b > e - interval 24 hour and b <= e) = 8 as seen from w),
s as (select model, run, r.e - interval 24 hour as start, r.e as fin, case when not list_has_all(have, range(ahead + 3, ahead + 25, 3)) then 'waiting for cache' when model = 'west' and run like '%T00Z' then 'completed' when seen then 'ready' else 'waiting for observations' end as state from r join o on o.e = r.e)"""
QUERIES["verification_states"] = lambda spark, sf_dir: _queue(spark, sf_dir).select("model", "run", text("start"), text("end", "fin"), "state")
ORACLES["verification_states"] = duck("with " + QUEUE + " select model, run, " + SAY("start", "start") + ", " + SAY("fin", "fin") + ", state from s")
QUERIES["verification_queue"] = lambda spark, sf_dir: runs.queue_summary(_queue(spark, sf_dir))
ORACLES["verification_queue"] = duck("with " + QUEUE + " select state, count(*) as n from s group by 1 union all select 'candidates', count(*) from s")


def newest_runs(spark, sf_dir):
    """The newest run with ten frames and more, and the newest one whose frames lack nothing up to hour 12."""
    f = view(spark, sf_dir, "run_file")
    newest = runs.newest_run(f, 10, ["model"], "run")
    need = spark.range(5).select((F.col("id") * 3).alias("fhour"), F.lit("frame").alias("field"))
    listing = f.select(F.concat_ws("/", "model", "run").alias("run"), "fhour", F.lit("frame").alias("field")).distinct()
    whole = catalog.complete_runs(need, listing).select(F.split("run", "/")[0].alias("model"), F.split("run", "/")[1].alias("run"), F.lit(True).alias("complete"))
    latest = runs.latest_complete(whole.withColumn("init", clock.parse_stamp(F.col("run"))), ["model"])
    return newest.join(latest.withColumnRenamed("run", "complete_run"), "model", "full").select("model", "run", "complete_run", text("init"))


QUERIES["newest_runs"] = newest_runs
ORACLES["newest_runs"] = duck("""with f as (select distinct model, run, fhour, init from ({run_file})), n as (select model, max(run) as run from (select model, run from f group by 1, 2 having count(*) >= 10) group by 1),
c as (select model, max(run) as complete_run, max(init) as init from (select model, run, init from f where fhour <= 12 group by 1, 2, 3 having count(*) = 5) group by 1)
select coalesce(n.model, c.model) as model, run, complete_run, """ + SAY("init", "init") + " from n full join c on c.model = n.model")

QUERIES["handoff_hours"] = lambda spark, sf_dir: runs.handoff_hours(view(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 6).alias("model"), (F.col("s_suppkey") * 5 % 24).alias("cycle"))).select("model", F.col("hours").cast("long").alias("hours"))
ORACLES["handoff_hours"] = duck("""with c as (select distinct s_nationkey % 6 as model, s_suppkey * 5 % 24 as h from supplier), g as (select a.model, a.h, min((b.h - a.h + 24) % 24) as gap from c a join c b on b.model = a.model and b.h <> a.h group by 1, 2)
select model, cast(min(gap) as bigint) as hours from g group by 1""")


def file_names(spark, sf_dir):
    """Names of both styles for every file, read back; the image's name and the object's key."""
    f = view(spark, sf_dir, "run_file").withColumn("k", F.pmod("id", F.lit(5)).cast("int"))
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), F.col("k") + 1)
    f = f.withColumns({"variable": pick("TMP", "UGRD", "CAPE", "PRMSL", "GUST-Max"), "kind": pick("ISBL", "TGL", "ISBL", "MSL", "TGL"), "level": pick(850, 10, 500, 0, 10)})
    args = [F.col(c) for c in ("variable", "kind", "level", "run", "fhour")]
    f = f.withColumns({"newer": runs.file_name(*args, "RLatLon0.0225"), "older": runs.file_name(*args, "ps2.5km", newer=False)})
    f = f.withColumns({"a": runs.parsed_name(F.col("newer")), "b": runs.parsed_name(F.col("older")), "image": runs.image_name(F.col("model"), F.col("run"), F.col("fhour"))})
    key = runs.object_key(F.col("model"), F.col("variable"), F.col("run"), F.col("image"), ["TMP", "CAPE"])
    read = lambda c: F.concat_ws(" ", f"{c}.stamp", f"{c}.variable", f"{c}.level", F.col(f"{c}.fhour").cast("string")).alias(f"read_{c}")
    return f.select("id", "newer", "older", read("a"), read("b"), key.alias("key"))


QUERIES["file_names"] = file_names
ORACLES["file_names"] = duck("""with f as (select *, ['TMP', 'UGRD', 'CAPE', 'PRMSL', 'GUST-Max'][id % 5 + 1] as v, ['ISBL', 'TGL', 'ISBL', 'MSL', 'TGL'][id % 5 + 1] as k, [850, 10, 500, 0, 10][id % 5 + 1] as l, ['ISBL_0850', 'AGL-10m', 'Sfc', 'MSL', 'AGL-10m'][id % 5 + 1] as tag from ({run_file}))
select id, printf('%s_MSC_HRDPS_%s_%s_RLatLon0.0225_PT%03dH.grib2', run, v, tag, fhour) as newer, printf('CMC_hrdps_west_%s_%s_%d_ps2.5km_%s_P%03d-00.grib2', v, k, l, run, fhour) as older, concat_ws(' ', run, v, tag, fhour) as read_a, concat_ws(' ', run, v, k || '_' || l, fhour) as read_b,
    printf('models/%s/%s/%s/%s/%s_%s_f%03d.png', model, case when v in ('TMP', 'CAPE') then 'verification' else 'forecast' end, v, run, model, run, fhour) as key from f""")

QUERIES["valid_headers"] = lambda spark, sf_dir: view(spark, sf_dir, "run_file").select("id", clock.valid_header(F.col("init"), F.col("fhour"), "HRDPS").alias("header"))
ORACLES["valid_headers"] = duck("""with f as (select id, init + fhour * interval 1 hour as v, v - interval 8 hour as l from ({run_file})) select id, 'HRDPS  |  ' || strftime(l, '%a %H:%M') || 'PST ' || upper(strftime(l, '%d%b%Y')) || '  |  ' || strftime(v, '%H:%M') || 'UTC ' || upper(strftime(v, '%d%b%Y')) as header from f""")
QUERIES["cycle_stamps"] = lambda spark, sf_dir: view(spark, sf_dir, "events").select("event_id", clock.stamp_of_cycle(F.col("event_id") % 4 * 6, F.col("ts").cast("timestamp")).alias("stamp"))
ORACLES["cycle_stamps"] = duck("""with e as (select event_id, ts, date_trunc('day', ts) + (event_id % 4) * interval 6 hour as c from events) select event_id, strftime(case when c > ts then c - interval 1 day else c end, '%Y%m%dT%HZ') as stamp from e""")


def input_signatures(spark, sf_dir):
    """The signature of all events as files against that of those before the last day."""
    e = view(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("mtime"), "ts")
    now = F.lit("2024-02-01 03:00:00").cast("timestamp")
    of = lambda df: runs.signature(df, F.lit("20240131T12Z"), now).withColumn("k", F.lit(1))
    got = runs.signature_changed(of(e), of(e.filter("ts < timestamp_ntz '2024-01-31 00:00:00'")), ["k"])
    return got.select("stamp", F.col("local_date").cast("string").alias("local_date"), F.explode("sources").alias("source", "mtime"), "changed")


QUERIES["input_signatures"] = input_signatures
ORACLES["input_signatures"] = duck("""with a as (select event_type as source, max(event_id) as mtime, max(case when ts < timestamp '2024-01-31 00:00:00' then event_id end) as old from events group by 1)
select '20240131T12Z' as stamp, '2024-01-31' as local_date, source, mtime, (select bool_or(old is distinct from mtime) from a) as changed from a""")


def dated_files(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    path = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("daily/"), F.date_format("d", "yyyy"), F.lit("/"), F.date_format("d", "yyyy-MM-dd"), F.lit(".csv")))
    path = path.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("snapshots/"), F.date_format("d", "yyyy/MM/dd"), F.lit("/s.json"))).otherwise(F.concat(F.lit("other/2000-13-45.csv")))
    return runs.dated_files(o.withColumn("path", path), F.lit("1998-05-01").cast("date")).select("o_orderkey", "path", F.col("file_date").cast("string").alias("file_date"))


QUERIES["dated_files"] = dated_files
ORACLES["dated_files"] = duck("""with o as (select o_orderkey, cast(o_orderdate as date) as d from orders where o_orderkey % 3 < 2) select o_orderkey, case when o_orderkey % 3 = 0 then 'daily/' || strftime(d, '%Y') || '/' || strftime(d, '%Y-%m-%d') || '.csv' else 'snapshots/' || strftime(d, '%Y/%m/%d') || '/s.json' end as path, cast(d as varchar) as file_date from o where d >= date '1998-05-01'""")


def fire_layer(spark, sf_dir):
    """The layer of all events as the snapshot; products and digests from the line items."""
    e = view(spark, sf_dir, "events").select(F.lit("primary").alias("source"), F.lit("2024-01-31 20:00:00").cast("timestamp").alias("retrieved_at"), F.lit(False).alias("live"))
    sha = lambda df: df.groupBy("product").agg(F.sha2(F.max("size_bytes").cast("string"), 256).alias("sha"))
    a = view(spark, sf_dir, "artifact")
    got = runs.fire_layer(e, sha(a), sha(a.filter("fhour > 6 and product <> 'AF'")), F.lit("2024-01-31 23:00:00").cast("timestamp"))
    return got.select("product", "available", "source", text("observed_at"), "cached", "stale", "observations", "version", "changed")


QUERIES["fire_layer"] = fire_layer
ORACLES["fire_layer"] = duck("""with a as (select product, sha256(cast(max(size_bytes) as varchar)) as version, sha256(cast(max(case when fhour > 6 and product <> 'AF' then size_bytes end) as varchar)) as old from ({artifact}) group by 1)
select product, n > 0 as available, case when n > 0 then 'primary' end as source, case when n > 0 then '2024-01-31 20:00:00' end as observed_at, n > 0 as cached, n > 0 as stale, n as observations, version, old is distinct from version as changed from a, (select count(*) as n from events)""")


def anchor_days(spark, sf_dir):
    r = view(spark, sf_dir, "run_file").select("model", "run", "init").distinct().withColumn("d", F.to_date(clock.local(F.col("init"))))
    return asof.anchor_days(r, "init", "d").select("model", "run", F.col("anchor").cast("string").alias("anchor"))


QUERIES["anchor_days"] = anchor_days
ORACLES["anchor_days"] = duck("""with r as (select distinct model, run, init, cast(init - interval 8 hour as date) as d from ({run_file})) select model, run, cast(d - k.range::int as varchar) as anchor from r, range(4) k where d - k.range::int + interval 20 hour <= init""")


def _ready_hours(spark, sf_dir):
    """Each run's hours with the time, in minutes after its start, when they are ready."""
    f = view(spark, sf_dir, "run_file").groupBy(F.concat_ws("/", "model", "run").alias("run"), "fhour").agg(F.min("init").alias("init"), F.min("id").alias("id"))
    return f.select("run", "fhour", (F.col("init") + F.make_dt_interval(mins=(F.col("id") % 900).cast("int"))).alias("at"), (F.col("init") + F.make_dt_interval(hours=F.lit(12))).alias("deadline"))


def _published(df):
    return df.select("run", text("at", "published"), F.array_join(F.transform("hours", lambda h: h.cast("string")), ",").alias("hours"), "reason")


def published_hours(spark, sf_dir):
    """When the hours of runs are published: half an hour apart, until 12 hours after the run began."""
    return _published(runs.publishable(_ready_hours(spark, sf_dir), 30, expected=17))


def streamed_publishing(spark, sf_dir):
    """The same from a stream: the hours in the order in which they are ready, in four batches, with a restart after the second
    and a tick of the clock at the end."""
    ready, last = _ready_hours(spark, sf_dir), F.col("at") + F.expr("interval 2 days")
    source, out, checkpoint = (store.new_path(spark, x) for x in ("ready", "published", "stream"))
    kind = "run string, fhour long, at timestamp, deadline timestamp"
    cuts = ready.select(F.percentile_approx(F.unix_timestamp("at"), [0.25, 0.5, 0.75])).first()[0] or [0, 0, 0]
    edges = [-1, *cuts, 1 << 60]
    for k in range(4):
        t = F.unix_timestamp("at")
        rows = ready.filter((t > edges[k]) & (t <= edges[k + 1]))
        if k == 3:
            rows = rows.unionByName(ready.groupBy().agg(F.max("at").alias("at"), F.max("deadline").alias("deadline")).select(F.lit("").alias("run"), F.lit(None).cast("long").alias("fhour"), last.alias("at"), "deadline").filter("at is not null"))
        rows.selectExpr("run", "cast(fhour as long) fhour", "cast(at as timestamp) at", "cast(deadline as timestamp) deadline").coalesce(1).write.parquet(f"{source}/part={k}")
        if k in (1, 3):
            stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{source}/part=*")
            publishing.write_published(stream, 30, out, checkpoint, expected=17).awaitTermination()
    return _published(spark.read.parquet(out))


QUERIES["published_hours"], QUERIES["streamed_publishing"] = published_hours, streamed_publishing
# A run's times one after another. last: of the last publish; due: when what waits goes out.
ORACLES["published_hours"] = ORACLES["streamed_publishing"] = duck("""with recursive f as (select model || '/' || run as run, fhour, min(init) as init, min(id) % 900 as m from ({run_file}) group by 1, 2),
g as (select run, m, min(init) as init, list(fhour) as hs, count(*) as c from f group by 1, 2), a as (select *, row_number() over (partition by run order by m) as i, m > 720 as late, sum(c) over (partition by run order by m) = 17 and m <= 720 as whole from g),
r as (select a.*, case when not late then m end as last, cast(null as bigint) as due, m as out, case when late then 'late' when whole then 'complete' else 'open' end as reason from a where i = 1 union all
    select q.* exclude (l, d, free), case when not late and (free or whole) then m else l end, case when late then d when not free and not whole then least(l + 30, 720) end, case when late or free or whole then m else least(l + 30, 720) end,
        case when late then 'late' when whole then 'complete' when free then 'open' when l + 30 <= 720 then 'timer' else 'deadline' end
    from (select *, l is null or m - l >= 30 as free from (select a.*, case when r.due < a.m then r.due else r.last end as l, case when r.due < a.m then null else r.due end as d from r join a on a.run = r.run and a.i = r.i + 1)) q),
x as (select w.run, w.i, min(b.i) as bi from r w join r b on b.run = w.run and b.i > w.i and b.m <= w.out and b.reason in ('open', 'complete') where w.reason in ('timer', 'deadline') group by 1, 2),
o as (select w.run, w.init, unnest(w.hs) as fhour, coalesce(b.m, w.out) as moment, coalesce(b.reason, w.reason) as reason from r w left join x on x.run = w.run and x.i = w.i left join r b on b.run = x.run and b.i = x.bi)
select run, """ + SAY("init + moment * interval 1 minute", "published") + ", string_agg(cast(fhour as varchar), ',' order by fhour) as hours, reason from o group by run, init, moment, reason")


def peak_samples(spark, sf_dir):
    """A class of each cell and day at the cells that customers are mapped to."""
    wx = view(spark, sf_dir, "wx").groupBy((F.floor(F.col("cell") / 10)).alias("iy"), (F.col("cell") % 10).alias("ix"), F.to_date("valid_ts").cast("string").alias("fire_date")).agg(F.max("temp_c").alias("peak"))
    c = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station"), (F.col("c_custkey") % 7).alias("iy"), (F.col("c_custkey") % 11).alias("ix"), (F.col("c_custkey") % 3 * 1.5).alias("distance"))
    return verify.sampled(wx, c, ["fire_date"]).select("station", "fire_date", (F.floor(F.col("peak") * 1e4 + 0.5) / 1e4).alias("peak"), "distance")


QUERIES["peak_samples"] = peak_samples
ORACLES["peak_samples"] = duck("""with p as (select cast(floor(cell / 10) as bigint) as iy, cell % 10 as ix, cast(cast(valid_ts as date) as varchar) as fire_date, max(temp_c) as peak from ({wx}) group by 1, 2, 3)
select c_custkey as station, fire_date, floor(peak * 1e4 + 0.5) / 1e4 as peak, c_custkey % 3 * 1.5::double as distance from customer join p on p.iy = c_custkey % 7 and p.ix = c_custkey % 11""")


def province_points(spark, sf_dir):
    """Customers inside the diamond around each nation's place."""
    p = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 37 % 1000) / 20.0 + 0.013).alias("x"), ((F.col("c_custkey") * 53 % 700) / 20.0 + 0.007).alias("y"))
    n = view(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") % 5 * 10 + 5.0).alias("cx"), (F.floor(F.col("n_nationkey") / 5) * 7 + 3.5).alias("cy"))
    c = F.explode(F.array(*[F.struct(*[F.lit(float(v)).alias(k) for k, v in zip("abcd", q)]) for q in ((-4, 0, 0, -3), (0, -3, 4, 0), (4, 0, 0, 3), (0, 3, -4, 0))])).alias("q")
    e = n.select(F.col("k").cast("long").alias("polygon"), "cx", "cy", c).select("polygon", (F.col("cx") + F.col("q.a")).alias("x1"), (F.col("cy") + F.col("q.b")).alias("y1"), (F.col("cx") + F.col("q.c")).alias("x2"), (F.col("cy") + F.col("q.d")).alias("y2"))
    return spatial.in_polygons(p, e)


QUERIES["province_points"] = province_points
ORACLES["province_points"] = duck("""with p as (select c_custkey as id, (c_custkey * 37 % 1000) / 20.0 + 0.013 as x, (c_custkey * 53 % 700) / 20.0 + 0.007 as y from customer)
select id, cast(n_nationkey as bigint) as polygon from p join nation on abs(x - (n_nationkey % 5 * 10 + 5.0)) / 4 + abs(y - (floor(n_nationkey / 5) * 7 + 3.5)) / 3 < 1""")


def archive_state(spark, sf_dir):
    """The archive's one row, where users' hours count as blocks and files as hours; and blocks that are still to be stored."""
    f = view(spark, sf_dir, "run_file")
    hours = f.groupBy("model", "run", "fhour").agg(F.sum("id").alias("bytes"))
    whole = f.groupBy("run").agg((F.count_distinct("fhour") == 17).alias("complete"))
    b = lightning.three_hour_blocks(view(spark, sf_dir, "flash10"), step_minutes=60).groupBy("block_end").agg(F.count(F.lit(1)).alias("bytes"))
    got = archive.status(spark, b, whole, hours.filter("model = 'west'"), hours.filter("model <> 'west'"))
    return got.select(*[text(c) if c == "latest_observation_block" else F.col(c) for c in got.columns])


QUERIES["archive_status"] = archive_state
ORACLES["archive_status"] = duck("""with f as ({run_file}), h as (select model, run, fhour, sum(id) as b from f group by 1, 2, 3), w as (select run, count(distinct fhour) = 17 as c from f group by 1), k as (select timestamp '2024-01-01 00:00:00' + cast(ceil((epoch(ts) - 1704067200) / 10800) as bigint) * interval 3 hour as e, cell from ({flash10}) group by 1, 2)
select (select count(distinct e) from k) as observation_blocks, (select strftime(max(e), '%Y-%m-%d %H:%M:%S') from k) as latest_observation_block, (select count(*) from w) as model_runs, (select count(*) filter (c) from w) as complete_model_runs, (select max(run) from w) as latest_model_run,
    (select count(*) from h where model = 'west') as model_hours, (select count(*) from h where model <> 'west') as baseline_hours, cast((select count(*) from k) + (select sum(b) from h) as bigint) as archive_bytes""")


def unarchived_times(spark, sf_dir):
    t = view(spark, sf_dir, "flash10").select("ts").distinct()
    ends = archive.block_ends(t)
    return archive.unarchived(t, ends.filter(F.dayofmonth("block_end") % 2 == 0), ends.filter(F.hour("block_end") != 6)).select(text("ts"), text("block_end"))


QUERIES["unarchived_times"] = unarchived_times
ORACLES["unarchived_times"] = duck("""with t as (select distinct ts, timestamp '2024-01-01 00:00:00' + cast(ceil((epoch(ts) - 1704067200) / 10800) as bigint) * interval 3 hour as b from ({flash10})) select """ + SAY("ts", "ts") + ", " + SAY("b", "block_end") + " from t where not (extract(day from b) % 2 = 0 and extract(hour from b) <> 6)")

SPECS = {"temp": (273.15, 0.05), "rh": (0.0, 0.5), "height": (0.0, 0.02)}
QUERIES["packed_fields"] = lambda spark, sf_dir: archive.pack(view(spark, sf_dir, "profile"), SPECS).select("cell", "level", *[F.col(c).cast("long").alias(c) for c in SPECS], *[(F.floor(archive.unpacked(F.col(c), *s) * 1e4 + 0.5) / 1e4).alias(f"{c}_back") for c, s in SPECS.items()])
_PACK = lambda c, o, s: f"coalesce(greatest(least(round_even(({c} - {o}) / {s}::double, 0), 32767), case when {c} is not null then -32767 end), -32768)"
ORACLES["packed_fields"] = duck("with p as (select cell, level, " + ", ".join(f"case when {c} is not null then cast({_PACK(c, *s)} as bigint) else -32768 end as {c}" for c, s in SPECS.items()) + " from ({profile})) select *, " + ", ".join(f"floor(case when {c} <> -32768 then {c} * {s[1]}::double + {s[0]} end * 1e4 + 0.5) / 1e4 as {c}_back" for c, s in SPECS.items()) + " from p")
QUERIES["clipped_fields"] = lambda spark, sf_dir: archive.clip_counts(view(spark, sf_dir, "profile"), ["level"], SPECS)
ORACLES["clipped_fields"] = duck(" union all ".join(f"select level, '{c}' as field, count({c}) as valid, count(*) filter (abs(round_even(({c} - {s[0]}) / {s[1]}::double, 0)) > 32767) as clipped from ({{profile}}) group by 1" for c, s in SPECS.items()))


def field_table(spark, sf_dir):
    """The long table of profile fields as a wide one, a column for each level."""
    long = view(spark, sf_dir, "profile").select((F.col("cell") % 4).alias("run"), "cell", F.concat(F.lit("tmp_"), F.col("level").cast("string")).alias("field"), F.col("temp").alias("value"))
    return archive.wide(long, ["run", "cell"], [f"tmp_{k}" for k in range(1, 8)])


QUERIES["field_table"] = field_table
ORACLES["field_table"] = duck("select cell % 4 as run, cell, " + ", ".join(f"max(case when level = {k} then temp end) as tmp_{k}" for k in range(1, 8)) + " from ({profile}) group by 1, 2")


def kept_samples(spark, sf_dir):
    """Forecasts with a distance of their station's cell that count."""
    f = view(spark, sf_dir, "forecast").withColumns({"distance": F.col("station") % 31 * 1.0, "lead": F.col("lead") - 3, "fclass": F.when(F.col("id") % 13 != 0, F.col("fclass"))})
    return verify.kept_samples(f).groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("farthest"), F.min("lead").alias("least_lead"))


QUERIES["kept_samples"] = kept_samples
ORACLES["kept_samples"] = duck("select model, count(*) as n, max(station % 31 * 1.0) as farthest, min(lead - 3) as least_lead from ({forecast}) where id % 13 <> 0 and station % 31 <= 15 and lead >= 3 group by 1")


def _profile_names(spark, sf_dir):
    """Temperature and humidity of each profile as fields of hours 0, 3 and 6, its levels named as the archive's first ones."""
    p = view(spark, sf_dir, "profile").filter(F.col("level") <= len(archive.PROFILE_LEVELS))
    level = F.element_at(F.array(*map(F.lit, archive.PROFILE_LEVELS)), F.col("level").cast("int")).cast("string")
    both = F.inline(F.array(F.struct(F.concat(F.lit("tmp_"), level).alias("field"), F.col("temp").alias("value")), F.struct(F.concat(F.lit("spfh_"), level).alias("field"), (F.col("rh") / 100).alias("value"))))
    return p.select((F.col("cell") % 3 * 3).alias("fhour"), "cell", both)


def dimension_packing(spark, sf_dir):
    """Fields of hours packed and unpacked by the dimension of all fields, counted by field; and what each hour lacks."""
    long, dim = _profile_names(spark, sf_dir), archive.dimension(spark)
    back = archive.unpack_long(archive.pack_long(long, dim).drop("value"), dim)
    counts = back.groupBy("fhour", "field").agg(F.count("value").alias("valid"), F.count_if("clipped").alias("clipped"), (F.floor(F.max("value") * 1e4 + 0.5) / 1e4).alias("top"))
    lacks = archive.missing_names(long, ["fhour"], dim).select("fhour", F.size("missing").cast("long").alias("n_missing"), F.element_at("missing", 1).alias("first_missing"))
    return counts.join(lacks, "fhour")


QUERIES["dimension_packing"] = dimension_packing
_LEVELS = str(list(archive.PROFILE_LEVELS))
_ALL = [f"{k}_{x}" for x in archive.PROFILE_LEVELS for k in ("tmp", "spfh")] + [f"{k}_{x}" for k in ("ugrd", "vgrd") for x in archive.WINDS] + [f"vvel_{x}" for x in archive.LIFTS] + [r[0] for r in archive.SINGLE]
ORACLES["dimension_packing"] = duck(f"""with p as (select cell % 3 * 3 as fhour, {_LEVELS}[level] as lev, temp, rh / 100 as q from ({{profile}}) where level <= {len(archive.PROFILE_LEVELS)}), l as (select fhour, 'tmp_' || lev as field, temp as value, 273.15::double as o, 0.05::double as s from p union all select fhour, 'spfh_' || lev, q, 0::double, 1.0e-5::double from p),
k as (select *, round_even((value - o) / s, 0) as st from l), u as (select *, case when value is not null then greatest(least(st, 32767), -32767) * s + o end as back from k), c as (select fhour, field, count(back) as valid, count(*) filter (abs(st) > 32767) as clipped, floor(max(back) * 1e4 + 0.5) / 1e4 as top from u group by 1, 2),
d as (select unnest({_ALL}) as name), h as (select distinct fhour from l), m as (select h.fhour, count(*) as n_missing, min(name) as first_missing from h cross join d where not exists (select 1 from l where l.fhour = h.fhour and l.field = d.name) and not (h.fhour = 0 and name in ('precip_rate', 'precip_accum')) group by 1)
select c.*, n_missing, first_missing from c join m on m.fhour = c.fhour""")
