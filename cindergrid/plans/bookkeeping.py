"""Queries: catalogue, usage, sweep."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import catalog, sweep, usage
from ..sources import store
from .standins import duck, view

QUERIES, ORACLES = {}, {}
r4 = lambda c, a=None: (F.floor((F.col(c) if isinstance(c, str) else c) * 1e4 + 0.5) / 1e4).alias(a or c)


def frames(spark, sf_dir):
    return view(spark, sf_dir, "artifact").select(F.col("stamp").alias("run"), "product", "fhour", F.sha2(F.col("size_bytes").cast("string"), 256).alias("sha"), "size_bytes", "mtime")


def run_manifest(spark, sf_dir):
    m = catalog.manifest(frames(spark, sf_dir), 7)
    return m.select("run", F.explode("products").alias("product", "hours")).select("run", "product", F.array_join(F.transform("hours", lambda h: h.cast("string")), ",").alias("hours"))


QUERIES["run_manifest"] = run_manifest
ORACLES["run_manifest"] = duck("select stamp as run, product, string_agg(cast(fhour as varchar), ',' order by fhour) as hours from ({artifact}) group by 1, 2 having count(*) >= 5")
QUERIES["asset_versions"] = lambda spark, sf_dir: catalog.asset_version(frames(spark, sf_dir))
ORACLES["asset_versions"] = duck("select stamp as run, product, sha256(string_agg(cast(fhour as varchar) || ':' || sha256(cast(size_bytes as varchar)), ',' order by fhour)) as version from ({artifact}) group by 1, 2")
QUERIES["family_hours"] = lambda spark, sf_dir: catalog.family_hours(frames(spark, sf_dir), ["AF", "NO", "RF"])
ORACLES["family_hours"] = duck("select stamp as run, fhour from ({artifact}) where product in ('AF', 'NO', 'RF') group by 1, 2 having count(distinct product) = 3")


def _listing(spark, sf_dir):
    return frames(spark, sf_dir).select("run", "fhour", F.col("product").alias("field"))


def incomplete_runs(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    required = listing.filter("fhour <= 6 and field in ('NO', 'AF')").select("fhour", "field").distinct()
    return catalog.missing_fields(required, listing).groupBy("run").agg(F.count(F.lit(1)).alias("missing"))


QUERIES["incomplete_runs"] = incomplete_runs
ORACLES["incomplete_runs"] = duck("""with l as (select stamp as run, fhour, product as field from ({artifact})), q as (select distinct fhour, field from l where fhour <= 6 and field in ('NO', 'AF')), r as (select distinct run from l)
select r.run, count(*) as missing from r cross join q where not exists (select 1 from l where l.run = r.run and l.fhour = q.fhour and l.field = q.field) group by 1""")


def ready_hours(spark, sf_dir):
    listing = _listing(spark, sf_dir)
    hours = listing.select("fhour").distinct()
    needs = hours.withColumn("need_hour", F.explode(F.array(F.col("fhour"), F.greatest(F.col("fhour") - 3, F.lit(3))))).withColumn("field", F.lit("NO")).distinct()
    return catalog.ready_hours(needs, listing)


QUERIES["ready_hours"] = ready_hours
ORACLES["ready_hours"] = duck("""with l as (select stamp as run, fhour from ({artifact}) where product = 'NO') select a.run, a.fhour from l a where exists (select 1 from l b where b.run = a.run and b.fhour = greatest(a.fhour - 3, 3))""")


def changed_artifacts(spark, sf_dir):
    f = frames(spark, sf_dir).select(F.concat_ws("/", "run", "product", F.col("fhour").cast("string")).alias("key"), "size_bytes", "mtime")
    stored = f.filter("size_bytes % 5 <> 0").withColumn("mtime", F.when(F.col("mtime") % 7 == 0, F.col("mtime") + 1).otherwise(F.col("mtime")))
    return catalog.changed(f, stored, "key", ["size_bytes", "mtime"])


QUERIES["changed_artifacts"] = changed_artifacts
ORACLES["changed_artifacts"] = duck("select concat_ws('/', stamp, product, cast(fhour as varchar)) as key, size_bytes, mtime from ({artifact}) where size_bytes % 5 = 0 or mtime % 7 = 0")


def retained_artifacts(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("init", F.col("run").cast("timestamp"))
    return catalog.retained(f, F.lit("1996-06-30").cast("timestamp"), {"NO": 60, "AF": 30}).select("run", "product", "fhour")


QUERIES["retained_artifacts"] = retained_artifacts
ORACLES["retained_artifacts"] = duck("select stamp as run, product, fhour from ({artifact}) where cast(stamp as date) >= date '1996-06-30' - case product when 'NO' then 60 when 'AF' then 30 else 7 end")


def droppable_runs(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(clock.format_stamp(F.date_trunc("day", F.col("o_orderdate").cast("timestamp")) + F.make_dt_interval(hours=(F.col("o_orderkey") % 4 * 6).cast("int"))).alias("run"), "o_orderkey")
    runs = o.select("run").distinct()
    return catalog.droppable_runs(runs, o.filter("o_orderkey % 3 = 0").select("run").distinct(), "19970101T00Z")


QUERIES["droppable_runs"] = droppable_runs
ORACLES["droppable_runs"] = duck("""with o as (select strftime(date_trunc('day', o_orderdate) + (o_orderkey % 4 * 6) * interval 1 hour, '%Y%m%dT%HZ') as run, o_orderkey from orders) select distinct run from o
where run < '19970101T00Z' and (substr(run, 10, 2) not in ('00', '12') or run in (select run from o where o_orderkey % 3 = 0))""")

QUERIES["page_links"] = lambda spark, sf_dir: catalog.links(view(spark, sf_dir, "pages"))
ORACLES["page_links"] = """select page_id, unnest(regexp_extract_all(coalesce(html, ''), 'href="([^"]+)"', 1)) as link from pages"""


def operation_totals(spark, sf_dir):
    ops = view(spark, sf_dir, "events").select(F.initcap(F.concat("event_type", F.lit("-Object"))).alias("action"), F.lit(1).cast("long").alias("requests"))
    got = usage.operation_totals(ops, a=["clickobject", "signupobject"], b=["viewobject"], free=["errorobject"])
    return got.select("billing_class", "requests", F.array_join(F.transform(F.map_entries("actions"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("unknown"))


QUERIES["operation_totals"] = operation_totals
ORACLES["operation_totals"] = duck("""with o as (select event_type, count(*) as n, case when event_type in ('click', 'signup') then 'class_a' when event_type = 'view' then 'class_b' when event_type = 'error' then 'free' else 'unknown' end as billing_class from events group by 1)
select billing_class, cast(sum(n) as bigint) as requests, coalesce(string_agg(upper(event_type[1]) || event_type[2:] || '-object=' || cast(n as varchar), ',' order by event_type) filter (billing_class = 'unknown'), '') as unknown from o group by 1""")


def storage_totals(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select(F.col("o_custkey").alias("bucket"), F.col("o_orderdate").cast("string").alias("observed_at"), F.col("o_orderkey").alias("payload"), (F.col("o_orderkey") % 100).alias("metadata"), (F.col("o_orderkey") % 10).alias("objects"), (F.col("o_orderkey") % 3).alias("uploads"))
    return usage.storage_totals(o)


QUERIES["storage_totals"] = storage_totals
ORACLES["storage_totals"] = duck("""with n as (select *, cast(o_orderdate as varchar) as t from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
select cast(sum(o_orderkey) as bigint) as payload, cast(sum(o_orderkey % 100) as bigint) as metadata, cast(sum(o_orderkey % 10) as bigint) as objects, cast(sum(o_orderkey % 3) as bigint) as uploads, max(t) as observed_at from n""")


def billing_periods(spark, sf_dir):
    o = view(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("now"), (F.col("o_orderkey") % 31 + 1).cast("int").alias("day"))
    p = usage.projected(F.col("o_orderkey").cast("double"), F.col("now"), F.col("day"))
    return o.select("o_orderkey", clock.billing_start(F.col("now"), F.col("day")).cast("string").alias("start"), clock.billing_end(F.col("now"), F.col("day")).cast("string").alias("end"), r4(p, "projected"), usage.level(p / 1e6).alias("level"))


QUERIES["billing_periods"] = billing_periods
ORACLES["billing_periods"] = duck("""with o as (select o_orderkey, o_orderdate as now, o_orderkey % 31 + 1 as day, cast(date_trunc('month', now) as date) as m), a as (select *, cast(date_trunc('month', now) as date) as m from (select o_orderkey, o_orderdate as now, o_orderkey % 31 + 1 as day from orders)),
b as (select *, m + cast(least(day, extract(day from last_day(m))) as int) - 1 as anchor, cast(m - interval 1 month as date) as pm, pm + cast(least(day, extract(day from last_day(pm))) as int) - 1 as before, case when cast(now as date) >= anchor then anchor else before end as start, cast(date_trunc('month', start) + interval 1 month as date) as nm, nm + cast(least(day, extract(day from last_day(nm))) as int) - 1 as fin from a),
c as (select *, o_orderkey / greatest(greatest(epoch(now) - epoch(start), 86400) / (epoch(fin) - epoch(start)), 1 / 31.0::double) as p from b)
select o_orderkey, cast(start as varchar) as start, cast(fin as varchar) as end, floor(p * 1e4 + 0.5) / 1e4 as projected, case when p / 1e6 >= 0.9 then 'critical' when p / 1e6 >= 0.7 then 'warning' else 'ok' end as level from c""".replace("with o as (select o_orderkey, o_orderdate as now, o_orderkey % 31 + 1 as day, cast(date_trunc('month', now) as date) as m), a as", "with a as"))


def alerts(spark, sf_dir):
    e = view(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("monitor"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("value") > 488, "critical").when(F.col("value") > 60, "warning").otherwise("ok").alias("level"))
    e = e.groupBy("monitor", "ts").agg(F.max("level").alias("level"))
    return usage.alerts(e).select("monitor", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "level")


QUERIES["usage_alerts"] = alerts
ORACLES["usage_alerts"] = duck("""with recursive e as (select user_id % 5 as monitor, date_trunc('second', ts) as ts, ts as t0, case when value > 488 then 'critical' when value > 60 then 'warning' else 'ok' end as level from events), d as (select monitor, t0 as ts, max(level) as level from e group by 1, 2),
n as (select *, row_number() over (partition by monitor order by ts) as k from d),
f as (select monitor, k, ts, level, level <> 'ok' as told, case when level <> 'ok' then ts end as last from n where k = 1 union all
    select n.monitor, n.k, n.ts, n.level, n.level <> 'ok' and (n.level <> f.level or f.last is null or floor(epoch(n.ts)) - floor(epoch(f.last)) >= 86400) as tell, case when n.level <> 'ok' and (n.level <> f.level or f.last is null or floor(epoch(n.ts)) - floor(epoch(f.last)) >= 86400) then n.ts when n.level = 'ok' then null else f.last end from f join n on n.monitor = f.monitor and n.k = f.k + 1)
select monitor, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, level from f where told""")

METRICS = ("max60", "mean60", "max90", "mean90", "p99", "p995", "top", "coast60", "dcape_strong", "li_strong", "pbl_strong", "score")


def sweep_scores(spark, sf_dir):
    """Every parameter set: the baseline, one parameter at a time, and 6,000 random ones."""
    params = sweep.varied(sweep.candidates(spark))
    got = sweep.ranked(sweep.score(params, view(spark, sf_dir, "sounding")))
    return got.select("seq", "label", F.col("n_varied").cast("long").alias("n_varied"), "varied", "hour60", *[(F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c) for c in METRICS], "best_of_varied")


REPORT = "rank long, seq long, label string, n_varied long, varied string, value double, score double"


def sweep_reports(spark, sf_dir):
    """The three reports of a sweep, written from one scored table and read back, with the baseline's rank."""
    path = store.new_path(spark, "sweep")
    got = sweep.ranked(sweep.score(sweep.varied(sweep.candidates(spark)), view(spark, sf_dir, "sounding")))
    value = F.coalesce(*[F.when(F.col("varied") == k, F.col(k)) for k in sweep.NAMES])
    store.write_sweep_reports(got.select(F.col("rank").cast("long").alias("rank"), "seq", "label", F.col("n_varied").cast("long").alias("n_varied"), "varied", value.alias("value"), (F.floor(F.col("score") * 1e4 + 0.5) / 1e4).alias("score")), path)
    parts = [spark.read.schema(REPORT).option("header", True).csv(f"{path}/{name}").withColumn("report", F.lit(name)) for name in ("full", "top", "one_at_a_time")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.groupBy("report").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("label") == "baseline", F.col("rank"))).alias("baseline_rank"), F.min_by("label", "rank").alias("best"), F.count_distinct("varied", "value").alias("values"), F.max("rank").alias("last"))


def _sweep_sql(random_samples: int = 6000, seed: int = 20260629, reports: bool = False) -> str:
    sets = [("baseline", dict(sweep.BASELINE)), *((f"one_at_a_time_{k}_{v}", {**sweep.BASELINE, k: v}) for k in sweep.NAMES for v in sweep.RANGES[k])]
    rows = ", ".join(f"({seq}, '{label}', {', '.join(f'{v!r}::double' for v in values.values())})" for seq, (label, values) in enumerate(sets))
    pick = lambda i, k: f"[{', '.join(f'{v!r}::double' for v in sweep.RANGES[k])}][cast(('0x' || substr(md5('{seed}-' || i || '-{i}'), 1, 8))::ubigint % {len(sweep.RANGES[k])} as bigint) + 1] as {k}"
    off = {k: f"abs({k} - {v!r}::double) > 1e-6" for k, v in sweep.BASELINE.items()}
    pen = lambda x, a, b, s: f"case when {x} is null then 999 when {x} between {a} and {b} then 0 when {x} < {a} then pow(({a} - {x}) / {s}::double, 2) else pow(({x} - {b}) / {s}::double, 2) end"
    score = " + ".join(f"{w} * {pen(k, *x)}" for k, (w, *x) in sweep.PENALTIES.items())
    names = ", ".join(sweep.NAMES)
    last = f"""select cast(seq as bigint) as seq, label, cast(n_varied as bigint) as n_varied, varied, hour60, {', '.join(f'floor({x} * 1e4 + 0.5) / 1e4 as {x}' for x in METRICS)}, varied is not null and row_number() over (partition by varied order by score, seq) = 1 as best_of_varied from z"""
    if reports:
        of = "case varied " + " ".join(f"when '{k}' then p.{k}" for k in sweep.NAMES) + " end"
        last = f""", k9 as (select z.seq, z.label, z.n_varied, z.varied, {of.replace('varied', 'z.varied', 1)} as value, row_number() over (order by z.score, z.seq) as rank from z join p on p.seq = z.seq),
        r9 as (select 'full' as report, * from k9 union all select 'top', * from k9 where rank <= 50 union all select 'one_at_a_time', * from k9 where n_varied = 1)
        select report, count(*) as n, max(case when label = 'baseline' then rank end) as baseline_rank, min_by(label, rank) as best, count(distinct case when varied is not null and value is not null then varied || '/' || value end) as values, max(rank) as last from r9 group by 1"""
    return f"""with a(seq, label, {names}) as (values {rows}), b0 as (select {len(sets)} + i as seq, 'random_' || lpad(cast(i as varchar), 5, '0') as label, {', '.join(pick(i, k) for i, k in enumerate(sweep.NAMES))} from (select range as i from range({random_samples}))),
    b as (select seq, label, {', '.join('least(li_gate, li_start + 0.75) as li_gate' if k == 'li_gate' else k for k in sweep.NAMES)} from b0), u as (select * from (select * from a union all select * from b) x qualify row_number() over (partition by {names} order by seq) = 1),
    p as (select *, {' + '.join(f'cast({c} as int)' for c in off.values())} as n_varied, case when n_varied = 1 then case {' '.join(f"when {c} then '{k}'" for k, c in off.items())} end end as varied from u), s as ({{sounding}}),
    r as (select seq, hour, period, weight, coastal, dcape, li, pbl, 3.6 * least(greatest((li_start - li) / li_span, 0), 1) * least(greatest((pbl - pbl_base_m) / pbl_span_m, 0), 1) * (dcape_coeff * sqrt(greatest(2 * dcape, 0)) + greatest(w850_coeff * w850, w700_coeff * w700)) as gust from s, p where dcape >= dcape_min and li <= li_gate),
    g as (select * from r where gust >= 60), h as (select hour, period, sum(weight) as al from s group by 1, 2), o0 as (select seq, hour, period, sum(weight) as w60, sum(case when gust >= 90 then weight else 0 end) as w90, sum(case when coastal then weight else 0 end) as c60 from g group by 1, 2, 3),
    o1 as (select o0.*, w60 / al as f60, w90 / al as f90 from o0 join h on h.hour = o0.hour and h.period = o0.period), o as (select seq, max(f60) as max60, sum(f60) as s60, max(f90) as max90, sum(f90) as s90, sum(case when period = 'day' then f60 else 0 end) as d60, sum(case when period = 'morning' then f60 else 0 end) as m60, sum(w60) as w60, sum(c60) as c60 from o1 group by 1),
    k as (select seq, hour as hour60 from o1 qualify row_number() over (partition by seq order by f60 desc, hour) = 1), n as (select count(*) as n, count(*) filter (period = 'day') as nd, count(*) filter (period = 'morning') as nm, min(hour) as h0 from h),
    q1 as (select seq, quantile_cont(gust, 0.99) as p99, quantile_cont(gust, 0.995) as p995, max(gust) as top from r group by 1), q2 as (select seq, quantile_cont(dcape, 0.5) as dcape_strong, quantile_cont(li, 0.5) as li_strong, quantile_cont(pbl, 0.5) as pbl_strong from g group by 1), q as (select * from q1 left join q2 using (seq)),
    m as (select p.seq, label, n_varied, varied, coalesce(hour60, h0) as hour60, coalesce(max60, 0) as max60, coalesce(s60 / n, 0) as mean60, coalesce(max90, 0) as max90, coalesce(s90 / n, 0) as mean90, coalesce(coalesce(m60 / nullif(nm, 0), 0) / nullif(coalesce(d60 / nullif(nd, 0), 0), 0), 0) as ratio, coalesce(c60 / nullif(w60, 0), 0) as coast60, p99, p995, top, dcape_strong, li_strong, pbl_strong
        from p left join o on o.seq = p.seq left join k on k.seq = p.seq left join q on q.seq = p.seq, n), z as (select *, {score} as score from m)
    {last}"""


QUERIES["sweep_scores"] = sweep_scores
ORACLES["sweep_scores"] = duck(_sweep_sql())
QUERIES["sweep_reports"] = sweep_reports
ORACLES["sweep_reports"] = duck(_sweep_sql(reports=True))
