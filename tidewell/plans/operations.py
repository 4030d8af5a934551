"""Registered queries of skew analysis, metric samples, storage and sources over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalar import haversine_km, sampled
from tidewell.functions.scalar import latency_base as scalar_latency_base
from tidewell.operators import maintenance as mt
from tidewell.operators import metrics as mx
from tidewell.operators import retention, skew
from tidewell.operators.kpi import kpi_with_cfg
from tidewell.params import DAY, HOUR
from tidewell.plans.registry import query
from tidewell.plans.telemetry import _KPI, _kpi, geohash_sql, rounded
from tidewell.plans.telemetry import _LATEST as _CFG_LATEST
from tidewell.sources import readers, sinks
from tidewell.sources.adapters import events, view
from tidewell.sources.workdir import new_folder

N = 64
_VB = f"cast(('0x' || substr(md5(cell_id), 1, 8))::bigint % {N} as int)"


def _routing(spark: SparkSession, d: str) -> DataFrame:
    """Routing rows as CSV lines, made from the configurations."""
    lines = view(spark, d, "cfg").select(F.concat_ws(",", "cell_id", F.pmod("cfg_seq", F.lit(7)).cast("string"), F.col("cfg_seq").cast("string")).alias("value"))
    return skew.latest_routing(lines)


_ROUTING = "routing as (select cell_id, cast(arg_max(cfg_seq % 7, cfg_seq) as int) as shift, max(cfg_seq) as routing_version from cfg group by 1)"


@query(f"{_ROUTING} select * from routing")
def routing_latest(spark, d):
    """The routing table's latest row of each key."""
    return _routing(spark, d)


@query(f"{_ROUTING} select chr_id, cell_id, coalesce(shift, 0) as shift, xor({_VB}, coalesce(shift, 0)) & {N - 1} as vbucket from chr left join routing using (cell_id)")
def routed_events(spark, d):
    """Events with the bucket that the routing table gives them."""
    return skew.routed(view(spark, d, "chr"), _routing(spark, d), N).select("chr_id", "cell_id", "shift", "vbucket")


_LOAD = f"load as (select event_ts - event_ts % {DAY} as slot_ts, {_VB} as vbucket, cell_id, count(*) as n from chr group by all)"


@query(f"{_LOAD} select slot_ts, vbucket, cast(sum(n) as bigint) as events, round(sum(n) / 86400.0, 6) as eps from load group by all")
def vbucket_load(spark, d):
    """Events of each virtual bucket and slot."""
    return rounded(skew.bucket_load(view(spark, d, "chr"), N, DAY).drop("hot_key"))


@query(f"{_LOAD} select slot_ts, vbucket, cell_id as hot_key from (select *, row_number() over (partition by slot_ts, vbucket order by n desc, cell_id desc) as r from load) where r = 1")
def vbucket_hot_key(spark, d):
    """The hottest key of each virtual bucket and slot."""
    return skew.bucket_load(view(spark, d, "chr"), N, DAY).select("slot_ts", "vbucket", "hot_key")


def _heartbeats(spark: SparkSession, d: str) -> DataFrame:
    """Heartbeat lines of four workers, made from the events."""
    e = events(spark, d)
    line = F.concat_ws(",", (F.col("user_id") % 4).cast("string"), F.round("value", 3).cast("string"), F.col("ts").cast("string"), F.col("k").cast("string"), (F.col("k") % 5).cast("string"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("site=S"), (F.col("user_id") % 9).cast("string"), F.lit(",vb="), (F.col("k") % 8).cast("string"))))
    return e.select(line.alias("value"))


_HB = "hb as (select cast(user_id % 4 as int) as worker, round(value, 3) as eps, ts, [cast(k as double), cast(k % 5 as double)] as loads, case when event_id % 2 = 0 then 'S' || (user_id % 9) end as hot_key, case when event_id % 2 = 0 then cast(k % 8 as int) end as hot_bucket from ev)"


@query(f"{_HB} select worker, eps, ts, list_sum(loads) as load, hot_key, hot_bucket from hb")
def heartbeat_parse(spark, d):
    """Heartbeat lines parsed."""
    rows = skew.parse_heartbeats(_heartbeats(spark, d))
    return rows.select("worker", "eps", "ts", F.aggregate("loads", F.lit(0.0), lambda a, x: a + x).alias("load"), "hot_key", "hot_bucket")


@query(f"{_HB} select worker, ts - ts % {DAY} as slot_ts, round(sum(eps), 6) as eps, sum(loads[1]) as load_0, sum(loads[2]) as load_1 from hb group by all")
def heartbeat_merge(spark, d):
    """Heartbeats of a worker and slot merged."""
    rows = skew.merge_heartbeats(skew.parse_heartbeats(_heartbeats(spark, d)), DAY)
    return rounded(rows.select("worker", "slot_ts", "eps", F.col("loads")[0].alias("load_0"), F.col("loads")[1].alias("load_1")))


def _worker_load(spark: SparkSession, d: str, slot: int = DAY) -> DataFrame:
    return view(spark, d, "chr").groupBy(F.pmod(F.col("eci"), F.lit(7)).cast("int").alias("worker"), (F.col("event_ts") - F.pmod("event_ts", F.lit(slot))).alias("slot_ts")).agg(F.count("*").cast("double").alias("eps"))


_WL = f"wl as (select cast(eci % 7 as int) as worker, event_ts - event_ts % {DAY} as slot_ts, cast(count(*) as double) as eps from chr group by all), imb as (select w.*, median_eps, case when median_eps > 0 then max_eps / median_eps else 1.0 end as imbalance, median_eps > 0 and eps > 1.5 * median_eps as overloaded from wl w join (select slot_ts, median(eps) as median_eps, max(eps) as max_eps from wl group by 1) using (slot_ts))"
_SINCE = f"{_WL}, isl as (select *, sum(case when overloaded then 0 else 1 end) over (partition by worker order by slot_ts) as i from imb), since as (select * exclude (i), case when overloaded then min(case when overloaded then slot_ts end) over (partition by worker, i) end as since from isl)"


@query(f"{_WL} select worker, slot_ts, eps, median_eps, round(imbalance, 6) as imbalance, overloaded from imb")
def imbalance(spark, d):
    """Load of the workers against the median."""
    return rounded(skew.imbalance(_worker_load(spark, d)).select("worker", "slot_ts", "eps", "median_eps", "imbalance", "overloaded"))


@query(f"{_SINCE} select worker, slot_ts, overloaded, since from since")
def overload_since(spark, d):
    """Since when each worker has been overloaded."""
    return skew.overload_since(_worker_load(spark, d)).select("worker", "slot_ts", "overloaded", "since")


def _buckets(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "chr").groupBy(F.pmod(F.col("eci"), F.lit(7)).cast("int").alias("worker"), (F.col("event_ts") - F.pmod("event_ts", F.lit(DAY))).alias("slot_ts"), F.col("pci").alias("vbucket")).agg(F.count("*").alias("load"))


_TOP = f"top as (select * from (select *, row_number() over (partition by worker, slot_ts order by load desc, vbucket) as rank from (select cast(eci % 7 as int) as worker, event_ts - event_ts % {DAY} as slot_ts, pci as vbucket, count(*) as load from chr group by all)) where rank <= 3)"


@query(f"{_TOP} select worker, slot_ts, vbucket, load, cast(rank as int) as rank from top")
def top_buckets(spark, d):
    """The three most loaded buckets of each worker and slot."""
    return skew.top_buckets(_buckets(spark, d))


#: Workers of a skewed deployment: the first of them has eight of twenty cells.
_WORKER = "case when pci < 8 then 0 else pci % 6 + 1 end"
_SKEWED = f"""sb as (select cast({_WORKER} as int) as worker, event_ts - event_ts % {DAY} as slot_ts, pci as vbucket, count(*) as load from chr group by all),
 sl as (select worker, slot_ts, cast(sum(load) as double) as eps from sb group by all), sm as (select slot_ts, median(eps) as med from sl group by 1), so as (select sl.*, med, med > 0 and eps > 1.5 * med as over_ from sl join sm using (slot_ts)),
 si as (select *, sum(case when over_ then 0 else 1 end) over (partition by worker order by slot_ts) as i from so), ss as (select *, case when over_ then min(case when over_ then slot_ts end) over (partition by worker, i) end as since from si),
 due as (select * from ss where slot_ts % 300000 = 0 and slot_ts - since >= 60000), st as (select *, row_number() over (partition by worker, slot_ts order by load desc, vbucket) as rank from sb),
 give as (select due.worker, due.slot_ts, rank, case when due.slot_ts // {DAY} % 2 = 0 then 'CELL-' || vbucket else 'VB-' || vbucket end as key, vbucket, cast(load as double) as load from due join st on due.worker = st.worker and due.slot_ts = st.slot_ts and rank <= case when due.slot_ts // {DAY} % 2 = 0 then 1 else 3 end),
 og as (select *, row_number() over (partition by slot_ts order by worker, rank) as o from give), oi as (select slot_ts, worker as target, row_number() over (partition by slot_ts order by worker) as o from so where eps <= 0.8 * med)"""


@query(f"""{_SKEWED} select slot_ts, worker, key, vbucket, load, target, cast((select min(s) from unnest(range({N})) as r(s) where (xor(('0x' || substr(md5(key), 1, 8))::bigint % {N}, s) & {N - 1}) % 7 = target) as int) as shift from og join oi using (slot_ts, o)""")
def rebalance_plan(spark, d):
    """Which key should move from an overloaded to an idle worker, by which shift; heartbeats name the hotspot on every other day."""
    chr_ = view(spark, d, "chr").select(F.expr(f"cast({_WORKER} as int)").alias("worker"), (F.col("event_ts") - F.pmod("event_ts", F.lit(DAY))).alias("slot_ts"), F.col("pci").alias("vbucket"))
    buckets = chr_.groupBy("worker", "slot_ts", "vbucket").agg(F.count("*").alias("load"))
    loads = buckets.groupBy("worker", "slot_ts").agg(F.sum("load").cast("double").alias("eps"))
    hot = skew.top_buckets(buckets).where((F.col("rank") == 1) & (F.floor(F.col("slot_ts") / DAY) % 2 == 0))
    return skew.rebalance(loads, buckets, hot.select("worker", "slot_ts", F.concat(F.lit("CELL-"), "vbucket").alias("hot_key"), F.col("vbucket").alias("hot_bucket")), N, 7)


@query(f"select key, target, cast(min(shift) as int) as shift from (select cell_id as key, cast(pci % 4 as int) as target, {_VB} as b from (select distinct cell_id, pci from chr)), unnest(range({N})) as r(shift) where (xor(b, shift::int) & {N - 1}) % 4 = target group by all")
def slot_shift(spark, d):
    """The smallest shift that brings each key to its partition."""
    keys = view(spark, d, "chr").select(F.col("cell_id").alias("key"), F.pmod("pci", F.lit(4)).cast("int").alias("target")).distinct()
    return skew.slot_shift(keys, N, 4)


_LATEST = "latest as (select * from (select *, row_number() over (partition by stage_id, sink, \"window\", subtask order by case when status = 'unknown' then 1 else 0 end, updated_at desc, sample_id desc) as r from samples) where r = 1)"
_RANK = "case status when 'healthy' then 1 when 'warning' then 3 when 'critical' then 4 else 2 end"
_SOURCE = "case when stage_id in ('source-chr', 'source-pm', 'source-cfg') then substr(stage_id, 8, 3) else '' end"


def _stages_sql(keys: str = "stage_id", where: str = "true") -> str:
    """The roll-up of the latest samples by keys; placeholders count only where a group has nothing else."""
    latest = _LATEST.replace("from samples)", f"from (select *, {_SOURCE} as source from samples) where {where})")
    sums = ", ".join(f"cast(sum({x}) as bigint) as {x}" for x in ("records", "bytes", "errors", "failures", "dlq", "rebalances"))
    worst = ", ".join(f"coalesce(max(case when {x} >= 0 then {x} end), -1) as {x}" for x in ("p95_ms", "p50_ms", "p99_ms", "checkpoint_id"))
    return f"""{latest}, eff as (select * from (select *, bool_or(status <> 'unknown') over (partition by {keys}) as some_real from latest) where status <> 'unknown' or not some_real),
 stages as (select {keys}, count(*) as subtasks, round(sum(eps), 6) as eps, round(sum(in_eps), 6) as in_eps, round(sum(out_eps), 6) as out_eps, {sums}, {worst}, max(lag_ms) as lag_ms, max(duration_ms) as duration_ms,
 ['healthy', 'unknown', 'warning', 'critical'][max({_RANK})] as status, coalesce(arg_max(error_text, (updated_at, sample_id)) filter (error_text <> ''), '') as last_error, max(updated_at) as updated_at from eff group by {keys})"""


_STAGES = _stages_sql()


@query(f"{_STAGES} select * from stages")
def stage_rollup(spark, d):
    """The latest samples rolled up by stage."""
    return rounded(mx.stage_rollup(view(spark, d, "samples")))


@query(f"{_stages_sql('source', _SOURCE + " <> ''")} select source, status, eps, lag_ms, records, updated_at from stages")
def source_summaries(spark, d):
    """The roll-up by source."""
    return rounded(mx.source_summaries(view(spark, d, "samples")))


@query(f"""{_stages_sql('stage_id, "window"', '"window" <> ' + "''")} select stage_id, "window", status, records, bytes, duration_ms, p95_ms, failures, last_error, updated_at from stages""")
def sink_summaries(spark, d):
    """The roll-up by sink stage and window."""
    return mx.sink_summaries(view(spark, d, "samples"))


@query(f"""{_stages_sql('stage_id, sink, "window"', "sink <> ''")} select stage_id, sink, "window", records, bytes, duration_ms, p50_ms, p95_ms, p99_ms, failures, last_error, checkpoint_id, updated_at from stages""")
def sink_latencies(spark, d):
    """Latencies and the latest checkpoint by stage, sink and window."""
    return mx.sink_latencies(view(spark, d, "samples"))


@query(f"{_stages_sql(where="stage_id = 'kpi-5m'")} select stage_id, rebalances, status, updated_at from stages")
def rebalance_summary(spark, d):
    """How often keys were moved, by the latest samples of the stage that moves them."""
    return mx.rebalance_summary(view(spark, d, "samples"), "kpi-5m")


_NAMED = "case when event_id % 3 = 0 then 'parquet-' when event_id % 3 = 1 then 'Kafka-' else '' end || event_type || case when event_id % 5 = 0 then '-dlq' when event_id % 7 = 0 then '-late' else '' end"


@query(f"st as (select event_id as sample_id, {_NAMED} as stage_id from ev) select * from st where (lower(stage_id) like '%parquet%' or not lower(stage_id) similar to '.*(parquet|table|upsert|kafka).*') and not stage_id like '%-dlq' and not stage_id like '%-late'")
def relevant_stages(spark, d):
    """Samples of the stages that belong to the active result sink."""
    e = events(spark, d)
    i = F.col("event_id")
    stage = F.concat(F.when(i % 3 == 0, "parquet-").when(i % 3 == 1, "Kafka-").otherwise(""), "event_type", F.when(i % 5 == 0, "-dlq").when(i % 7 == 0, "-late").otherwise(""))
    return mx.relevant(e.select(i.alias("sample_id"), stage.alias("stage_id")), "Parquet")


@query("lat as (select stage_id, case when source_ts > 0 then greatest(observed_ts - source_ts, 0) end as l from samples) select stage_id, count(l) as samples, quantile_disc(l, 0.5) as p50, quantile_disc(l, 0.95) as p95, quantile_disc(l, 0.99) as p99, max(l) as max from lat group by 1")
def stage_percentiles(spark, d):
    """Nearest-rank latency percentiles by stage."""
    return mx.percentiles(view(spark, d, "samples"))


_SKETCHED = "select stage_id, count(l) as samples, max(l) as max, true as close from (select stage_id, case when source_ts > 0 then greatest(observed_ts - source_ts, 0) end as l from samples) group by 1"


@query(_SKETCHED)
def stage_percentiles_merged(spark, d):
    """Latency percentiles by stage from merged daily sketches: samples, the greatest, and whether all ranks are within 1 %."""
    samples = view(spark, d, "samples")
    found = mx.rank_errors(samples, mx.merged_percentiles(mx.latency_sketches(samples, DAY), "stage_id"))
    return found.select("stage_id", "samples", "max", (F.col("error") <= 0.01).alias("close"))


@query(f"select stage_id, subtask, updated_at - updated_at % {DAY} as slot_ts, cast(sum(records) as bigint) as records, round(sum(records) / 86400.0, 6) as eps, max(lag_ms) as lag_ms from samples group by all")
def stage_throughput(spark, d):
    """Records a second by stage, subtask and day."""
    return rounded(mx.throughput(view(spark, d, "samples"), DAY))


@query(f"{_KPI} select window_kind, window_end_ts, count(*) as n, cast(sum(source_event_ts_avg) // count(*) as bigint) as source_ts, cast(window_end_ts - sum(source_event_ts_avg) // count(*) as bigint) as latency_ms from kpi group by window_kind, window_end_ts")
def window_materialization(spark, d):
    """Rows and age of each window."""
    return mx.materialization(_kpi(spark, d))


@query(f"{_KPI} select window_kind, count(*) as windows, count(*) filter (n >= 14) as closed, cast(700 as bigint) as expected, count(*) filter (n >= 14) >= 700 as healthy, case when count(*) filter (n >= 14) >= 700 then '' else printf('closed %d of %d windows', count(*) filter (n >= 14), 700) end as reason from (select window_kind, window_end_ts, count(*) as n from kpi group by all) group by all")
def window_completeness(spark, d):
    """How many windows have a row of enough cells."""
    return mx.completeness(_kpi(spark, d), 14, 700)


@query("select event_type as source, count(*) as observed, 1500 as target, count(*) / 20.0 as per_cell, round(count(*) / 1500.0, 6) as delivery from ev group by 1")
def source_density(spark, d):
    """Events a cell and the delivered share of the target, by source."""
    totals = events(spark, d).groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("observed")).withColumn("target", F.lit(1500))
    return rounded(mx.source_density(totals, 20))


def _runs(spark: SparkSession, d: str) -> DataFrame:
    """A run for each customer: readings made from the customer's numbers."""
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.selectExpr(*(f"{e} as {n}" for n, e in _RUN.items()))


_RUN = {
    "run_id": "concat('run-', cast(c_custkey as string))",
    "sink": "case c_custkey % 3 when 0 then 'parquet' when 1 then 'table' else 'none' end",
    "level": "cast(c_custkey % 6 + 1 as int) * 1000",
    "job_status": "case when c_custkey % 41 = 0 then 'UNKNOWN' when c_custkey % 37 = 0 then 'FAILED' else 'RUNNING' end",
    "has_source": "c_custkey % 29 <> 0",
    "delivery": "case when c_custkey % 11 = 0 then 0.5 else 0.99 end",
    "backlog": "case when c_custkey % 31 = 0 then 5 else 0 end",
    "backpressure": "cast(c_custkey % 10 as double) / 40",
    "checkpoint_failures": "case when c_custkey % 43 = 0 then 2 else 0 end",
    "checkpoint_ms": "c_custkey * 977 % 130000",
    "kpi_p95": "c_custkey * 1511 % 200000 - 1",
    "sink_p95": "c_custkey * 1871 % 190000 - 1",
    "sink_failures": "case when c_custkey % 47 = 0 then 1 else 0 end",
    "lag": "c_custkey * 2011 % 185000",
    "has_events": "c_custkey % 53 <> 0",
    "windows_applicable": "c_custkey % 3 <> 2",
    "windows_closed": "case when c_custkey % 19 = 0 then 7 else 12 end",
    "windows_expected": "12",
    "write_p95": "c_custkey * 2203 % 186000 - 1",
    "commit_p95": "c_custkey * 2311 % 184000 - 1",
    "storage_ok": "c_custkey % 23 <> 0",
    "storage_summary": "concat('probe ', cast(c_custkey % 4 as string))",
}
_RUNS = f"runs as (select {', '.join(f'{e} as {n}' for n, e in _RUN.items())} from customer)"
_VERDICTS = f"""{_RUNS}, judged as (select *, case when job_status = 'UNKNOWN' then 'job status UNKNOWN' when job_status <> 'RUNNING' then 'job status ' || job_status when not has_source then 'source metrics missing' when not has_events then 'event source metrics missing' when windows_applicable and windows_closed < windows_expected then 'closed ' || windows_closed || ' of ' || windows_expected || ' windows' when delivery < 0.98 then 'source throughput attainment'
 when backlog > 0 then 'source backlog' when backpressure > 0.2 then 'sustained backpressure' when checkpoint_failures >= 2 then 'checkpoint failures' when checkpoint_ms > 120000 then 'checkpoint duration' when kpi_p95 > 180000 then 'KPI availability p95 over threshold' when sink_p95 > 180000 then 'sink p95 over threshold' when write_p95 > 180000 then 'connector write p95 over threshold' when commit_p95 > 180000 then 'connector commit p95 over threshold' when sink_failures > 0 then 'sink failures' when lag > 180000 then 'watermark lag' when not storage_ok then 'storage unhealthy: ' || storage_summary else 'all thresholds healthy' end as reason,
 case when job_status not in ('UNKNOWN', 'RUNNING') then 'FAILED' end as f from runs), verdicts as (select * exclude (f), coalesce(f, case when reason = 'all thresholds healthy' then 'STABLE' else 'UNSTABLE' end) as verdict from judged)"""


@query(f"{_VERDICTS} select run_id, verdict, reason from verdicts")
def run_verdict(spark, d):
    """Pass or fail of each run, with the first rule that it breaks."""
    return mx.verdicts(_runs(spark, d)).select("run_id", "verdict", "reason")


_GATES = {
    "job_status": ("case when job_status = 'RUNNING' then 1 else 0 end", 1, "o >= 1", "FAILED"),
    "source": ("case when has_source then 1 else 0 end", 1, "o >= 1", "UNSTABLE"),
    "delivery": ("case when has_source then delivery else -1 end", 0.98, "o >= 0.98", "UNSTABLE"),
    **{n: (n, t, f"o <= {t}", "UNSTABLE") for n, t in (("backlog", 0), ("backpressure", 0.2), ("checkpoint_ms", 120000), ("kpi_p95", 180000), ("sink_p95", 180000), ("write_p95", 180000), ("commit_p95", 180000), ("lag", 180000), ("sink_failures", 0))},
    "windows": ("case when windows_applicable then windows_closed else -1 end", "case when windows_applicable then windows_expected else 0 end", "not windows_applicable or o >= windows_expected", "UNSTABLE"),
    "storage": ("case when storage_ok then 1 else 0 end", 1, "o >= 1", "UNSTABLE"),
    "checkpoint_failures": ("checkpoint_failures", 2, "o < 2", "UNSTABLE"),
}


@query(f"{_RUNS}, g as (" + " union all ".join(f"select run_id, '{n}' as gate, cast({o} as double) as o, cast({t} as double) as threshold, {ok} as ok, '{bad}' as bad from (select *, cast({o} as double) as o from runs)" for n, (o, t, ok, bad) in _GATES.items()) + ") select run_id, gate, o as observed, threshold, case when o < 0 then 'NA' when ok then 'HEALTHY' else bad end as state from g")
def gate_table(spark, d):
    """A row for each gate of each run."""
    return mx.gate_table(_runs(spark, d))


@query(f"{_VERDICTS} select sink, coalesce(max(level) filter (verdict = 'STABLE'), 0) as bound, count(*) filter (verdict = 'STABLE') as stable, count(*) filter (verdict = 'UNSTABLE') as unstable, count(*) filter (verdict = 'FAILED') as failed, (list(reason order by level, run_id) filter (verdict <> 'STABLE'))[1] as first_bottleneck from verdicts group by 1")
def stable_bounds(spark, d):
    """The highest stable level of each sink."""
    return mx.stable_bounds(mx.verdicts(_runs(spark, d)))


@query("select run_id, stage_id, max(lag_ms) as lag_ms, round(coalesce(avg(case when p95_ms > 0 then p95_ms end), arg_max(p95_ms, updated_at)), 6) as p95_ms, arg_max(records, updated_at) as records from samples group by all")
def measurement_window(spark, d):
    """Readings of a run and stage summed up."""
    return rounded(mx.measurement_window(view(spark, d, "samples")))


_READ = "rd as (select stage_id as vertex, unnest([{'metric': 'backpressure_ratio', 'value': (records % 7) / 7.0::double}, {'metric': 'in_watermark', 'value': (records % 50 - 5)::double}, {'metric': 'records_in', 'value': records::double}], recursive := true) from samples)"


@query(f"{_READ} select vertex, metric, round(case when metric like '%ratio' then avg(value) when metric like '%watermark' then coalesce(min(case when value >= 0 then value end), max(value), -1) else sum(value) end, 6) as value from rd group by vertex, metric")
def subtask_fold(spark, d):
    """Subtask readings folded by the metric's class."""
    r = F.col("records")
    reading = lambda n, v: F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value"))
    rows = view(spark, d, "samples").select(F.col("stage_id").alias("vertex"), F.explode(F.array(reading("backpressure_ratio", (r % 7) / 7.0), reading("in_watermark", r % 50 - 5), reading("records_in", r))).alias("r")).select("vertex", "r.*")
    return rounded(mx.subtask_fold(rows))


#: Edges between stages.
EDGES = (("source-chr", "kpi-1m"), ("source-cfg", "kpi-1m"), ("kpi-1m", "kpi-5m"), ("kpi-5m", "sink-grid"))


@query("select stage_id as source_id, run_id as target_id, max(p95_ms) as latency_ms from samples group by all")
def marker_max(spark, d):
    """The greatest marker of each pair."""
    return mx.marker_max(view(spark, d, "samples").select(F.col("stage_id").alias("source_id"), F.col("run_id").alias("target_id"), F.col("p95_ms").alias("latency_ms")))


@query("""l as (select stage_id, max(p95_ms) as p95_ms from samples group by 1), e(source_id, target_id) as (values ('source-chr', 'kpi-1m'), ('source-cfg', 'kpi-1m'), ('kpi-1m', 'kpi-5m'), ('kpi-5m', 'sink-grid')), u as (select target_id, max(case when p95_ms >= 0 then p95_ms end) as up from e join l on stage_id = source_id group by 1)
 select stage_id, p95_ms, up as up_ms, case when p95_ms < 0 then -1 when up is null then p95_ms when p95_ms - up < -1000 then -1 else greatest(p95_ms - up, 0) end as delay_ms from l left join u on stage_id = target_id""")
def operator_delay(spark, d):
    """Own delay of each stage, by its worst reading of all subtasks."""
    lat = view(spark, d, "samples").groupBy("stage_id").agg(F.max("p95_ms").alias("p95_ms"))
    return mx.operator_delay(lat, spark.createDataFrame(EDGES, "source_id string, target_id string"))


@query(f"{_LATEST} select coalesce(max(p95_ms) filter (stage_id like '%source%' and p95_ms >= 0), -1) as source_p95, coalesce(max(p95_ms) filter (stage_id like '%1m%' and p95_ms >= 0), -1) as kpi_1m_p95, coalesce(max(p95_ms) filter (stage_id like '%5m%' and p95_ms >= 0), -1) as kpi_5m_p95, coalesce(max(p95_ms) filter (stage_id like '%sink%' and not stage_id like '%connector-%' and p95_ms >= 0), -1) as sink_p95, coalesce(max(p95_ms) filter (stage_id like '%connector-write' and p95_ms >= 0), -1) as connector_write_p95, coalesce(max(p95_ms) filter (stage_id like '%connector-commit' and p95_ms >= 0), -1) as connector_commit_p95, cast(sum(failures) as bigint) as failures, max(lag_ms) as lag_ms from latest")
def metrics_snapshot(spark, d):
    """The worst readings of all stages."""
    return mx.snapshot(view(spark, d, "samples"))


@query(f"{_LATEST} select stage_id, count(*) as subtasks, count(*) filter (p95_ms >= 0) as with_latency, count(*) filter (records > 0) as with_records, count(*) filter (source_ts > 0) as with_source_time from latest group by 1")
def metric_coverage(spark, d):
    """How many subtasks of each stage have each metric."""
    return mx.coverage(view(spark, d, "samples"))


@query("select * from samples where not (status = 'unknown' or (records = 0 and p95_ms <= 0 and errors = 0))")
def real_samples_only(spark, d):
    """Samples without placeholders."""
    return mx.real_samples(view(spark, d, "samples"))


@query(f"{_STAGES} select * from stages where p95_ms > 0 or errors > 0 order by p95_ms desc, stage_id limit 5")
def bottleneck_top5(spark, d):
    """The five slowest stages (a top-k report)."""
    return rounded(mx.bottlenecks(view(spark, d, "samples")))


@query(f"{_STAGES} select stage_id, unnest(list_filter([case when status in ('warning', 'critical') then 'status ' || status end, case when p95_ms >= 1000 then 'p95' end, case when lag_ms >= 60000 then 'lag' end, case when dlq > 0 then 'dlq' end], lambda x: x is not null)) as flag from stages")
def bottleneck_flags(spark, d):
    """Why each stage is a bottleneck."""
    return mx.bottleneck_flags(view(spark, d, "samples"))


@query(f"{_STAGES} select stage_id, cast(case stage_id when 'source-chr' then 1 when 'source-pm' then 2 when 'source-cfg' then 3 when 'kpi-1m' then 4 when 'kpi-5m' then 5 when 'sink-grid' then 6 else 100 end as int) as ord from stages")
def stage_order(spark, d):
    """Stages with their place in the display."""
    return mx.in_order(mx.stage_rollup(view(spark, d, "samples")).select("stage_id"))


@query("a as (select stage_id, min(p95_ms) as v from samples group by 1), b as (select stage_id, max(lag_ms) as v from samples group by 1) select stage_id, coalesce(case when a.v >= 0 then a.v end, b.v) as value from a full join b using (stage_id)")
def metric_fallback(spark, d):
    """A stage's reading, from another source where the first has none."""
    s = view(spark, d, "samples")
    return mx.with_fallback(s.groupBy("stage_id").agg(F.min("p95_ms").alias("value")), s.groupBy("stage_id").agg(F.max("lag_ms").alias("value")))


@query("select stage_id, count(*) as records, cast(sum(116 + strlen(run_id) + strlen(error_text)) as bigint) as bytes, round(count(*) / ((max(updated_at) - min(updated_at)) / 1000.0), 6) as eps from samples group by 1")
def sink_bytes(spark, d):
    """Records, approximate bytes and records a second of each stage."""
    return rounded(mx.sink_throughput(view(spark, d, "samples"), "stage_id", mx.sink_bytes(None, 116, ["run_id", "error_text"]), "updated_at"))


@query("select stage_id, sample_id, observed_ts - source_ts as latency_ms from samples where source_ts > 0 and ('0x' || substr(md5(cast(sample_id as string)), 1, 8))::bigint % 10 = 0")
def sampled_latency(spark, d):
    """Latency of one record in ten, which a hash picks (a sampling operator)."""
    rows = view(spark, d, "samples").where((F.col("source_ts") > 0) & sampled(F.col("sample_id"), 10))
    return rows.select("stage_id", "sample_id", (F.col("observed_ts") - F.col("source_ts")).alias("latency_ms"))


_KPI_TS = "select 'KPI' as kind, source_event_ts_avg as base from kpi"


@query(f"{_KPI}, b as (select 'CHR' as kind, event_ts as base from chr union all select 'PM', window_end_ts from pm union all select 'CFG', effective_ts from cfg union all {_KPI_TS}) select kind, count(*) as n, count(base) as based, cast(sum(base) as bigint) as total from b group by 1")
def latency_base(spark, d):
    """The times from which latencies count, by kind of record."""
    none = F.lit(None).cast("long")
    row = lambda df, kind, **at: df.select(F.lit(kind).alias("kind"), *(at.get(x, none).alias(x) for x in ("event_ts", "window_end_ts", "effective_ts", "source_ts")))
    rows = row(view(spark, d, "chr"), "CHR", event_ts=F.col("event_ts")).unionByName(row(view(spark, d, "pm"), "PM", event_ts=F.col("event_ts"), window_end_ts=F.col("window_end_ts")))
    rows = rows.unionByName(row(view(spark, d, "cfg"), "CFG", effective_ts=F.col("effective_ts"))).unionByName(row(_kpi(spark, d), "KPI", source_ts=F.col("source_event_ts_avg")))
    base = scalar_latency_base(F.col("kind"), F.col("event_ts"), F.col("window_end_ts"), F.col("effective_ts"), F.col("source_ts"))
    return rows.withColumn("base", base).groupBy("kind").agg(F.count("*").alias("n"), F.count("base").alias("based"), F.sum("base").alias("total"))


@query("c as (select stage_id, sample_id, duration_ms, failures, case when stage_id like '%connector-write' then 'write' when stage_id like '%connector-commit' then 'commit' end as scope from samples) select stage_id, scope, count(*) as samples, quantile_disc(duration_ms, 0.5) as p50, quantile_disc(duration_ms, 0.95) as p95, quantile_disc(duration_ms, 0.99) as p99, cast(sum(failures) as bigint) as failures, case when sum(failures) > 0 then 'warning' else 'healthy' end as status, coalesce(max(case when scope = 'commit' then sample_id end), -1) as last_commit from c where scope is not null group by 1, 2")
def connector_latency(spark, d):
    """Durations, failures and latest commit of the connector stages."""
    return mx.connectors(view(spark, d, "samples"))


@query(f"{_stages_sql('run_id')} select run_id, subtasks, records, errors, lag_ms from stages")
def summaries(spark, d):
    """The roll-up by run instead of stage."""
    return mx.stage_rollup(view(spark, d, "samples"), ("run_id",)).select("run_id", "subtasks", "records", "errors", "lag_ms")


@query(f"{_KPI}, {_CFG_LATEST} select window_kind, count(*) as n, min(window_start_ts) as first_ts, max(window_end_ts) as last_ts, count(distinct k.site_id) as sites, count(distinct cell_id) as cells, count(distinct {geohash_sql('center_lat', 'center_lon')}) as grids from kpi k left join latest l using (cell_id) group by 1")
def kpi_table_profile(spark, d):
    """The KPI table in figures."""
    return mt.profile(kpi_with_cfg(_kpi(spark, d), view(spark, d, "cfg")))


@query("select 'chr' as name, count(*) as n, min(event_ts) as first_ts, max(event_ts) as last_ts from chr union all select 'pm', count(*), min(event_ts), max(event_ts) from pm union all select 'cfg', count(*), min(effective_ts), max(effective_ts) from cfg")
def table_status(spark, d):
    """Rows and time range of each table."""
    return mt.table_status({"chr": (view(spark, d, "chr"), "event_ts"), "pm": (view(spark, d, "pm"), "event_ts"), "cfg": (view(spark, d, "cfg"), "effective_ts")})


@query("select (select count(*) from chr) + (select count(*) from pm) + (select count(*) from cfg) as n")
def business_rows(spark, d):
    """Rows of all tables."""
    return table_status(spark, d).agg(F.sum("n").alias("n"))


@query("select event_type as topic, user_id % 4 as partition, max(event_id) - min(event_id) + 1 as records from ev group by all")
def topic_counts(spark, d):
    """Records of each topic and partition by its offsets."""
    return readers.topic_counts(events(spark, d).select(F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset")))


def _files(spark: SparkSession, d: str) -> DataFrame:
    """A file for each order: a path in day and hour partitions, bytes and a time."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.selectExpr(*(f"{e} as {n}" for n, e in _FILE.items()))


_FILE = {
    "path": "concat(case o_orderkey % 3 when 0 then 'kpi' when 1 then 'cell' else 'user' end, '/dt=2024-01-', lpad(cast(o_orderkey % 28 + 1 as string), 2, '0'), '/hour=', lpad(cast(o_custkey % 24 as string), 2, '0'), '/part-', cast(o_orderkey as string), case when o_orderkey % 17 = 0 then '.inprogress.1' else '.parquet' end)",
    "bytes": "o_orderkey * 37 % 100000 + 1",
    "modified": "1704067200000 + o_orderkey % 28 * 86400000 + o_custkey % 24 * 3600000",
}
_FILES = f"files as (select {', '.join(f'{e} as {n}' for n, e in _FILE.items())} from orders)"
CUT = 1705276800000 + 5 * HOUR


@query(f"{_FILES} select f.* from files f where path like '%.parquet' and modified < {CUT - DAY} and not exists (select 1 from orders o where o_orderstatus = 'F' and f.path like 'kpi/%' and f.path = concat('kpi', '/dt=2024-01-', lpad(cast(o_orderkey % 28 + 1 as string), 2, '0'), '/hour=', lpad(cast(o_custkey % 24 as string), 2, '0'), '/part-', cast(o_orderkey as string), '.parquet'))")
def orphan_files(spark, d):
    """Old finished files that nothing refers to; the files of finished KPI orders count as referred to."""
    orders = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'F'")
    used = orders.selectExpr(f"{_FILE['path']} as path").where("path like 'kpi/%'")
    return mt.orphan_files(_files(spark, d), used, CUT, DAY, allow=True)


@query(f"{_FILES} select split_part(path, '/', 1) as root, count(*) as files, cast(sum(bytes) as bigint) as bytes, count(distinct regexp_extract(path, '^(.*)/[^/]*$', 1)) as folders, min(regexp_extract(path, '^(.*)/[^/]*$', 1)) as first_folder, max(regexp_extract(path, '^(.*)/[^/]*$', 1)) as last_folder, count(*) filter (path like '%.inprogress%') as in_progress from files group by 1")
def storage_inventory(spark, d):
    """Files, bytes and folders of each table."""
    return mt.inventory(_files(spark, d))


_INVENTORY = "inv as (select split_part(path, '/', 1) as root, count(*) as files, sum(bytes) as bytes, count(distinct regexp_extract(path, '^(.*)/[^/]*$', 1)) as folders, count(*) filter (path like '%.inprogress%') as in_progress from files group by 1)"
_FIGURES = " union all ".join(f"select '{c}' as figure, cast(coalesce(sum({c}) filter (root = 'kpi'), 0) as bigint) as first, cast(coalesce(sum({c}) filter (root = 'cell'), 0) as bigint) as second from inv" for c in ("files", "bytes", "folders", "in_progress"))


@query(f"{_FILES}, {_INVENTORY}, f as ({_FIGURES}) select *, second - first as difference, round(second / nullif(first, 0), 6) as share from f")
def storage_comparison(spark, d):
    """The inventories of two tables side by side."""
    return rounded(mt.compare(mt.inventory(_files(spark, d)), "kpi", "cell"))


@query(f"{_KPI} select window_start_ts, cell_id from kpi where window_end_ts >= {CUT}")
def retention_keep(spark, d):
    """KPI rows in the table after retention has acted on it."""
    folder = new_folder(spark, "retention")
    _kpi(spark, d).withColumn("dt", sinks.day_and_hour("window_start_ts")["dt"]).repartition("dt").write.partitionBy("dt").parquet(folder)
    retention.retain_rows(spark, folder, "window_end_ts", CUT, ["dt"], act=True)
    return retention.table_at(spark, folder, ["dt"]).select("window_start_ts", "cell_id")


@query(f"{_KPI}, p as (select strftime(make_timestamp(window_start_ts * 1000), '%Y-%m-%d') as dt, count(*) as n, count(*) filter (window_end_ts < {CUT}) as expired from kpi group by 1) select *, case when expired = 0 then 'keep' when expired < n then 'rewrite' else 'drop' end as action from p")
def retention_plan(spark, d):
    """What retention does to each day of the KPI table."""
    return retention.partition_plan(_kpi(spark, d).withColumns(sinks.day_and_hour("window_start_ts")), "window_end_ts", CUT, ["dt"])


@query(f"{_FILES} select distinct regexp_extract(path, '/dt=([^/]+)/', 1) as dt, regexp_extract(path, '/hour=([^/]+)/', 1) as hour from files where regexp_extract(path, '/dt=([^/]+)/', 1) || '-' || regexp_extract(path, '/hour=([^/]+)/', 1) < '2024-01-15-05'")
def expired_partitions(spark, d):
    """Partitions before the cutoff."""
    return mt.expired_partitions(_files(spark, d), CUT)


@query(f"{_FILES} select * from files where case when path like '%.inprogress%' then modified < {CUT - 7 * DAY} else modified < {CUT} end")
def stale_files(spark, d):
    """Files that are due for deletion."""
    return mt.stale_files(_files(spark, d), CUT, CUT - 7 * DAY)


@query(f"{_FILES} select cast(sum(bytes) as bigint) as bytes, cast(1000000000 as bigint) as budget, sum(bytes) <= 1000000000 as within from files")
def byte_budget(spark, d):
    """Bytes of all files against a budget."""
    return mt.byte_budget(_files(spark, d), 1_000_000_000)


def _topology(spark: SparkSession, d: str) -> DataFrame:
    """A topology record for each supplier."""
    return spark.read.parquet(f"{d}/supplier.parquet").selectExpr(*(f"{e} as {n}" for n, e in _TOPO.items()))


_TOPO = {"cell_id": "concat('C-', cast(s_suppkey % 60 as string))", "site_id": "concat('S-', cast(s_suppkey % 12 as string))", "site_lat": "cast(31 as double) + cast(s_suppkey % 50 as double) / 100", "site_lon": "cast(121 as double) + cast(s_suppkey % 40 as double) / 100", "frequency_band": "concat('n', cast(s_nationkey as string))", "version": "s_suppkey"}
_TOPOLOGY = f"topo as (select {', '.join(f'{e} as {n}' for n, e in _TOPO.items())} from supplier), tl as (select * from (select *, row_number() over (partition by cell_id order by version desc) as r from topo) where r = 1)"


@query(f"{_TOPOLOGY} select cell_id, site_id, site_lat, site_lon, frequency_band, version from tl")
def topology_latest(spark, d):
    """The last record of each cell."""
    return readers.latest_topology(_topology(spark, d))


@query(f"{_TOPOLOGY} select site_id, array_to_string(list_sort(list(cell_id)), ',') as cells from tl group by 1")
def cells_by_site(spark, d):
    """The cells of each site by its latest topology."""
    return readers.cells_by_site(readers.latest_topology(_topology(spark, d))).withColumn("cells", F.array_join("cells", ","))


@query(f"{_TOPOLOGY} select count(*) as records, count(distinct site_id) as sites, count(distinct frequency_band) as bands, min(site_lat) as min_site_lat, min(site_lon) as min_site_lon, max(site_lat) as max_site_lat, max(site_lon) as max_site_lon from topo")
def topology_stats(spark, d):
    """The topology in figures."""
    return mt.topology_stats(_topology(spark, d))


#: Zones: order, name, latitude, longitude, radius in km, weight.
ZONES = ((1, "center", 31.2, 121.2, 12.0, 3.0), (2, "station", 31.25, 121.25, 6.0, 5.0))


def hot_zones(cells: DataFrame, zones: tuple = ZONES) -> DataFrame:
    """cells with the zone they lie in and its weight; the last one listed wins, outside all it is 1."""
    zone, weight = F.lit(None).cast("string"), F.lit(1.0)
    for _, name, lat, lon, radius, w in sorted(zones):
        inside = haversine_km(F.col("site_lat"), F.col("site_lon"), F.lit(lat), F.lit(lon)) < radius
        zone, weight = F.when(inside, name).otherwise(zone), F.when(inside, w).otherwise(weight)
    return cells.withColumns({"zone": zone, "weight": weight})


def _km_sql(lat: float, lon: float) -> str:
    return f"2 * 6371 * asin(sqrt(pow(sin(radians(({lat} - site_lat)) / 2), 2) + cos(radians(site_lat)) * cos(radians({lat})) * pow(sin(radians(({lon} - site_lon)) / 2), 2)))"


@query(f"{_TOPOLOGY} select cell_id, version, case when {_km_sql(31.25, 121.25)} < 6 then 'station' when {_km_sql(31.2, 121.2)} < 12 then 'center' end as zone, cast(case when {_km_sql(31.25, 121.25)} < 6 then 5 when {_km_sql(31.2, 121.2)} < 12 then 3 else 1 end as double) as weight from topo")
def hot_zone_cells(spark, d):
    """Cells within the radius of hot zones."""
    return hot_zones(_topology(spark, d)).select("cell_id", "version", "zone", "weight")


@query("select stage_id, subtask, updated_at, case when sample_id % 5 = 0 then k2 else records end as records, case when sample_id % 4 = 0 then -1 else p95_ms end as p95_ms, lag_ms, errors, case when sample_id % 6 = 0 then 'unknown' else status end as status from (select *, records + 1 as k2 from samples) where sample_id % 13 <> 0")
def samples_from_json(spark, d):
    """Metric samples from JSON lines, of which some lack fields or are broken."""
    s = view(spark, d, "samples")
    i = F.col("sample_id")
    fields = F.struct("stage_id", "subtask", "updated_at", F.when(i % 5 != 0, F.col("records")).otherwise(0).alias("records"), (F.col("records") + F.when(i % 5 == 0, 1).otherwise(0)).alias("rows_written"), F.when(i % 4 != 0, F.col("p95_ms")).alias("p95_ms"), "lag_ms", "errors", F.when(i % 6 != 0, F.col("status")).otherwise(" ").alias("status"))
    return readers.samples_from_json(s.select(F.when(i % 13 == 0, F.lit("{broken")).otherwise(F.to_json(fields)).alias("value")))


@query("select count(*) filter (sample_id % 13 <> 0) as valid, count(*) filter (sample_id % 13 = 0) as invalid, (select count(*) > 500 from samples) as truncated from (select * from samples order by sample_id limit 500)")
def jsonl_quality(spark, d):
    """Valid and broken lines among the first 500 (the reader's own limit)."""
    s = view(spark, d, "samples")
    line = F.when(F.col("sample_id") % 13 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("stage_id", "records")))
    return readers.jsonl_quality(s.select(F.col("sample_id").alias("number"), line.alias("value")), 500)


@query("select stage_id as section, 'p95' as metric, cast(p95_ms as string) as value from samples where sample_id % 3 = 0")
def run_log_metrics(spark, d):
    """Summary lines of a run's log."""
    s = view(spark, d, "samples")
    line = F.when(F.col("sample_id") % 3 == 0, F.concat(F.lit("[summary] "), "stage_id", F.lit(" | p95 | "), F.col("p95_ms").cast("string"))).when(F.col("sample_id") % 3 == 1, F.lit("[summary] === stages ===")).otherwise("noise")
    return readers.log_metrics(s.select(line.alias("value")))


@query(f"{_RUNS} select case when level = 1000 then 'f' || run_id else run_id end as run_id, sink, case when level = 2000 then 'unknown' else job_status end as status, case when level = 3000 then null else level end as started_at from runs")
def run_metadata(spark, d):
    """Metadata of runs from JSON files, of which some lack fields."""
    r = _runs(spark, d)
    value = F.to_json(F.struct(F.when(F.col("level") != 1000, F.col("run_id")).alias("runId"), "sink", F.when(F.col("level") != 2000, F.col("job_status")).alias("status"), F.when(F.col("level") != 3000, F.col("level")).alias("startedAt")))
    out = readers.run_metadata(r.select(F.concat(F.lit("runs/f"), "run_id", F.lit("/meta.json")).alias("path"), value.alias("value")))
    return out.withColumn("started_at", F.col("started_at").cast("int"))


@query(f"{_RUNS} select run_id, level as started_at, case when level <> 3000 then job_status when level = 3000 and has_source then 'p95 ' || kpi_p95 end as headline from runs order by level desc nulls last, run_id")
def run_list(spark, d):
    """Runs, the newest first, with their headline."""
    r = _runs(spark, d)
    row = lambda keep, section, ord_, metric, value: F.when(keep, F.struct(F.lit(section).alias("section"), F.lit(ord_).alias("ord"), F.lit(metric).alias("metric"), F.col(value).cast("string").alias("value")))
    rows = F.array_compact(F.array(row(F.col("level") != 3000, "run", 0, "status", "job_status"), row(F.col("has_source"), "kpi", 2, "lag", "lag"), row(F.col("has_source"), "kpi", 1, "p95", "kpi_p95")))
    metrics = r.select("run_id", F.explode(rows).alias("m")).select("run_id", "m.*")
    return readers.run_list(r.select("run_id", F.col("level").alias("started_at")), metrics)


@query("select run_id, cast(coalesce(sum(records) filter (source = 'chr'), 0) as bigint) as chr, cast(coalesce(sum(records) filter (source = 'pm'), 0) as bigint) as pm, cast(coalesce(sum(records) filter (source = 'cfg'), 0) as bigint) as cfg from (select run_id, case when stage_id like 'source-chr%' then 'chr' when stage_id like 'source-cfg%' then 'cfg' end as source, records from samples) group by 1")
def source_metrics_pivot(spark, d):
    """Events of each source side by side."""
    s = view(spark, d, "samples").select("run_id", F.when(F.col("stage_id").startswith("source-chr"), "chr").when(F.col("stage_id").startswith("source-cfg"), "cfg").alias("source"), F.col("records").alias("events"))
    return readers.source_metrics_pivot(s)
