"""Registered queries of the KPI, enrichment and anomaly paths over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.functions import scalar
from tidewell.operators import anomaly, enrich, kpi
from tidewell.params import DAY, SPARSE
from tidewell.plans.registry import query
from tidewell.sources.adapters import view

R = SPARSE
W, RW, UW, CW = R.fact_ms, R.rollup_ms, R.user_window_ms, R.cell_window_ms


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """df with its doubles rounded, so that engines that add in another order agree."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def half_up(df: DataFrame) -> DataFrame:
    """df with its doubles rounded half up at the sixth digit, as decimals of ten digits: a mean of many values often lies half way, where the last bits of a sum, which depend on the order of adding, would decide."""
    return df.select(*(F.round(F.col(c).cast("decimal(38,10)"), 6).cast("double").alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def _half_up_sql(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38, 10)), 6) as double)"


def _kpi(spark: SparkSession, d: str) -> DataFrame:
    return kpi.kpi(view(spark, d, "chr"), view(spark, d, "pm"), R)


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich(view(spark, d, "chr"), view(spark, d, "pm"), view(spark, d, "cfg"), R)


_CHRF = f"""chrf as (select cell_id, event_ts - event_ts % {W} as minute_ts, min(site_id) as site_id, count(*) as n, count(distinct imsi) as users,
 sum(rsrp) as rsrp_sum, count(rsrp) as rsrp_n, sum(sinr) as sinr_sum, count(sinr) as sinr_n,
 count(*) filter (event_type = 'ATTACH') as attach_n, count(*) filter (event_type = 'ATTACH' and result_code = 0) as attach_ok,
 sum(event_ts) // count(*) as ts_avg, min(event_ts) as ts_min, max(event_ts) as ts_max from chr group by all)"""
_PMF = f"""pmf as (select cell_id, (window_end_ts - 1) - (window_end_ts - 1) % {W} as minute_ts, min(site_id) as site_id, count(*) as n, sum(prb_usage_dl) as prb_sum, sum(throughput_dl_mbps) as tput_sum,
 sum(greatest(active_users, 0)) as active_sum, sum(dropped_connections) as drops, sum(handover_success) as ho_ok, sum(handover_failure) as ho_bad,
 sum(event_ts) // count(*) as ts_avg, min(event_ts) as ts_min, max(event_ts) as ts_max from pm where window_end_ts > window_start_ts group by all)"""
_KPI = f"""{_CHRF}, {_PMF}, kpi as (select minute_ts as window_start_ts, minute_ts + {W} as window_end_ts, 'MIN_1' as window_kind,
 case when c.n is null then 'PM_ONLY' when p.n is null then 'CHR_ONLY' else 'JOINED' end as join_quality, coalesce(c.site_id, p.site_id) as site_id, cell_id,
 coalesce(c.n, 0) as num_chr_events, coalesce(users, 0) as num_users, coalesce(rsrp_n, 0) as rsrp_sample_count, coalesce(sinr_n, 0) as sinr_sample_count, coalesce(attach_n, 0) as attach_attempts,
 coalesce(rsrp_sum / nullif(rsrp_n, 0), 0) as avg_rsrp, coalesce(sinr_sum / nullif(sinr_n, 0), 0) as avg_sinr, coalesce(prb_sum / nullif(p.n, 0), 0) as avg_prb_usage_dl, coalesce(tput_sum / nullif(p.n, 0), 0) as throughput_dl_mbps_avg,
 coalesce(cast(drops as double) / nullif(active_sum, 0), 0) as drop_rate, coalesce(cast(ho_ok as double) / nullif(ho_ok + ho_bad, 0), 0) as ho_success_rate, coalesce(cast(attach_ok as double) / nullif(attach_n, 0), 0) as attach_success_rate,
 cast((coalesce(c.ts_avg * c.n, 0) + coalesce(p.ts_avg * p.n, 0)) // (coalesce(c.n, 0) + coalesce(p.n, 0)) as bigint) as source_event_ts_avg,
 least(c.ts_min, p.ts_min) as source_event_ts_min, greatest(c.ts_max, p.ts_max) as source_event_ts_max, coalesce(c.n, 0) + coalesce(p.n, 0) as source_event_count
 from chrf c full join pmf p using (cell_id, minute_ts))"""
_DOUBLES = "avg_rsrp avg_sinr avg_prb_usage_dl throughput_dl_mbps_avg drop_rate ho_success_rate attach_success_rate".split()
_ROUNDED = "replace (" + ", ".join(f"round({c}, 6) as {c}" for c in _DOUBLES) + ")"


def geohash_sql(lat: str, lon: str, precision: int = 6) -> str:
    """The geohash as DuckDB SQL, bit by bit by halving steps written out as integer arithmetic."""
    n_lon, n_lat = (5 * precision + 1) // 2, 5 * precision // 2
    x, y = f"cast(floor(({lon} + 180) / 360 * {1 << n_lon}) as bigint)", f"cast(floor(({lat} + 90) / 180 * {1 << n_lat}) as bigint)"
    chars = []
    for k in range(precision):
        bits = [f"(({x} >> {n_lon - 1 - (5 * k + j) // 2}) & 1) * {16 >> j}" if (5 * k + j) % 2 == 0 else f"(({y} >> {n_lat - 1 - (5 * k + j) // 2}) & 1) * {16 >> j}" for j in range(5)]
        chars.append(f"substr('{scalar.BASE32}', cast({' + '.join(bits)} + 1 as bigint), 1)")
    return " || ".join(chars)


@query(f"{_KPI} select * {_ROUNDED} from kpi")
def kpi_1m_full_join(spark, d):
    """Event and counter facts joined into one KPI row a cell and window."""
    return rounded(_kpi(spark, d))


_LATEST = "latest as (select * from (select *, row_number() over (partition by cell_id order by version desc, cfg_seq) as r from cfg) where r = 1 and not tombstone)"


@query(f"{_KPI}, {_LATEST} select k.window_start_ts, k.cell_id, k.site_id, k.join_quality, coalesce({geohash_sql('center_lat', 'center_lon')}, '') as grid_id from kpi k left join latest l using (cell_id)")
def kpi_1m_cfg(spark, d):
    """KPI rows with the grid of the cell's latest configuration."""
    return kpi.kpi_with_cfg(_kpi(spark, d), view(spark, d, "cfg")).select("window_start_ts", "cell_id", "site_id", "join_quality", "grid_id")


_ROLLUP = f"""roll as (select cell_id, (window_end_ts - 1) - (window_end_ts - 1) % {RW} as window_start_ts, 'MIN_5' as window_kind,
 case when bool_and(join_quality = 'JOINED') then 'JOINED' when bool_and(join_quality = 'CHR_ONLY') then 'CHR_ONLY' when bool_and(join_quality = 'PM_ONLY') then 'PM_ONLY' else 'JOINED' end as join_quality, min(site_id) as site_id,
 cast(sum(num_chr_events) as bigint) as num_chr_events, cast(sum(num_users) as bigint) as num_users, cast(sum(rsrp_sample_count) as bigint) as rsrp_sample_count, cast(sum(sinr_sample_count) as bigint) as sinr_sample_count, cast(sum(attach_attempts) as bigint) as attach_attempts, cast(sum(source_event_count) as bigint) as source_event_count,
 coalesce(sum(avg_rsrp * rsrp_sample_count) / nullif(sum(rsrp_sample_count), 0), 0) as avg_rsrp, coalesce(sum(avg_sinr * sinr_sample_count) / nullif(sum(sinr_sample_count), 0), 0) as avg_sinr, coalesce(sum(attach_success_rate * attach_attempts) / nullif(sum(attach_attempts), 0), 0) as attach_success_rate,
 coalesce(avg(case when join_quality <> 'CHR_ONLY' then avg_prb_usage_dl end), 0) as avg_prb_usage_dl, coalesce(avg(case when join_quality <> 'CHR_ONLY' then throughput_dl_mbps_avg end), 0) as throughput_dl_mbps_avg, coalesce(avg(case when join_quality <> 'CHR_ONLY' then drop_rate end), 0) as drop_rate, coalesce(avg(case when join_quality <> 'CHR_ONLY' then ho_success_rate end), 0) as ho_success_rate,
 cast(sum(source_event_ts_avg * source_event_count) // sum(source_event_count) as bigint) as source_event_ts_avg, min(source_event_ts_min) as source_event_ts_min, max(source_event_ts_max) as source_event_ts_max from kpi group by all)"""


@query(f"{_KPI}, {_ROLLUP} select * {_ROUNDED} from roll")
def kpi_5m_rollup(spark, d):
    """Rollup of the KPI rows into longer windows."""
    return rounded(kpi.rollup(_kpi(spark, d), R))


@query(f"{_KPI}, {_LATEST} select distinct (window_end_ts - 1) - (window_end_ts - 1) % {RW} as window_start_ts, cell_id, coalesce({geohash_sql('center_lat', 'center_lon')}, '') as grid_id from kpi k left join latest l using (cell_id)")
def kpi_5m_grid(spark, d):
    """Rollup of KPI rows that have a grid."""
    return kpi.rollup(kpi.kpi_with_cfg(_kpi(spark, d), view(spark, d, "cfg")), R).select("window_start_ts", "cell_id", "grid_id")


@query(f"{_KPI} select cell_id, window_start_ts, 'length' as reason from kpi where cell_id like '%7' union all select cell_id, window_start_ts, 'kind' from kpi where cell_id like '%3'")
def rollup_violations(spark, d):
    """Rows that a rollup rejects, among KPI rows of which some were given another kind or no length."""
    spoilt = _kpi(spark, d).withColumns({"window_kind": F.when(F.col("cell_id").endswith("3"), "MIN_5").otherwise(F.col("window_kind")), "window_end_ts": F.when(F.col("cell_id").endswith("7"), F.col("window_start_ts")).otherwise(F.col("window_end_ts"))})
    return kpi.rollup_violations(spoilt, R).select("cell_id", "window_start_ts", "reason")


_ASOF_PM = f"pmx as (select *, row_number() over (partition by cell_id, event_ts order by window_end_ts desc) as r from pm), asof_pm as (select c.*, case when c.event_ts - p.event_ts <= {R.pm_ttl_ms} then p.window_end_ts end as pm_window_end_ts, case when c.event_ts - p.event_ts <= {R.pm_ttl_ms} then p.prb_usage_dl end as pm_prb_usage_dl, case when c.event_ts - p.event_ts <= {R.pm_ttl_ms} then p end as pm from chr c asof left join (select * from pmx where r = 1) p on c.cell_id = p.cell_id and c.event_ts >= p.event_ts)"


@query(f"{_ASOF_PM} select chr_id, cell_id, event_ts, pm_window_end_ts, pm_prb_usage_dl from asof_pm")
def enrich_asof_pm(spark, d):
    """Each event with the latest counters of its cell."""
    return _enriched(spark, d).select("chr_id", "cell_id", "event_ts", F.col("pm.window_end_ts").alias("pm_window_end_ts"), F.col("pm.prb_usage_dl").alias("pm_prb_usage_dl"))


_ASOF_CFG = f"""env as (select cell_id, event_ts as ts, 2 as ord, cast(chr_id as bigint) as seq, false as tombstone, cast(null as bigint) as version from chr union all select cell_id, effective_ts, 0, cfg_seq, tombstone, version from cfg),
 cut as (select *, case when tombstone or ts - lag(ts) over w > {R.cfg_ttl_ms} then 1 else 0 end as cleared from env window w as (partition by cell_id order by ts, ord, seq)),
 seg as (select *, sum(cleared) over (partition by cell_id order by ts, ord, seq rows unbounded preceding) as segment from cut),
 live as (select *, max(case when ord = 0 and not tombstone then version * 1000000000 - seq end) over (partition by cell_id, segment order by ts, ord, seq rows unbounded preceding) as best from seg),
 asof_cfg as (select cell_id, cast(seq as string) as chr_id, ts as event_ts, cast(ceil(best / 1000000000) as bigint) as cfg_version from live where ord = 2)"""

_ASOF_FULL = _ASOF_CFG.replace("then version * 1000000000 - seq end", "then {'v': version, 's': -seq} end").replace("cast(ceil(best / 1000000000) as bigint) as cfg_version from live", "cast(best.v as bigint) as cfg_version, cast(-best.s as bigint) as cfg_seq from live").replace("asof_cfg as", "asof_full as")
#: Counters of one cell and time with one window's end: the greatest load counts, then the greatest of the other columns in their order.
_PM_TIES = "order by window_end_ts desc, " + ", ".join(f"{c} desc nulls last" for c in "prb_usage_dl site_id window_start_ts throughput_dl_mbps active_users dropped_connections handover_success handover_failure".split())
_ASOF_PM_FULL = _ASOF_PM.replace("order by window_end_ts desc", _PM_TIES)


@query(f"{_ASOF_CFG} select * from asof_cfg")
def enrich_asof_cfg(spark, d):
    """Each event with the version of its cell's configuration at that time."""
    return _enriched(spark, d).select("cell_id", "chr_id", "event_ts", F.col("cfg.version").cast("long").alias("cfg_version"))


@query(f"{_ASOF_CFG} select cell_id, chr_id, event_ts from asof_cfg where cfg_version is null")
def enrichment_late(spark, d):
    """Events for whose cell no configuration was known."""
    return enrich.split_late(_enriched(spark, d))[1].select("cell_id", "chr_id", "event_ts")


_OWN = f"""own as (select a.cell_id, a.event_ts - a.event_ts % {RW} as window_start_ts, arg_min(a.site_id, (a.event_ts, cast(a.chr_id as bigint))) as site_id, coalesce(arg_min({geohash_sql('f.center_lat', 'f.center_lon')}, (a.event_ts, cast(a.chr_id as bigint))) filter (f.cell_id is not null), '') as grid_id,
 count(*) as num_chr_events, count(distinct imsi) as num_users, count(rsrp) as rsrp_sample_count, count(sinr) as sinr_sample_count, count(*) filter (event_type = 'ATTACH') as attach_attempts, coalesce(avg(rsrp), 0) as avg_rsrp, coalesce(avg(sinr), 0) as avg_sinr,
 coalesce(cast(count(*) filter (event_type = 'ATTACH' and result_code = 0) as double) / nullif(count(*) filter (event_type = 'ATTACH'), 0), 0) as attach_success_rate, sum(a.event_ts) as s, min(a.event_ts) as lo, max(a.event_ts) as hi, count(*) as n
 from chr a join asof_full x using (chr_id) left join cfg f on f.cell_id = a.cell_id and f.cfg_seq = x.cfg_seq group by all),
 theirs as (select cell_id, window_start_ts, count(*) as pm_windows, avg(p.prb_usage_dl) as avg_prb_usage_dl, avg(p.throughput_dl_mbps) as throughput_dl_mbps_avg, coalesce(cast(sum(p.dropped_connections) as double) / nullif(sum(greatest(p.active_users, 0)), 0), 0) as drop_rate,
 coalesce(cast(sum(p.handover_success) as double) / nullif(sum(p.handover_success + p.handover_failure), 0), 0) as ho_success_rate, sum(p.event_ts) as s, min(p.event_ts) as lo, max(p.event_ts) as hi from (select cell_id, event_ts - event_ts % {RW} as window_start_ts, pm_window_end_ts, arg_min(pm, (event_ts, cast(chr_id as bigint))) as p from asof_pm where pm_window_end_ts is not null group by all) group by all)"""


@query(f"""{_ASOF_PM_FULL}, {_ASOF_FULL}, {_OWN} select window_start_ts, window_start_ts + {RW} as window_end_ts, 'MIN_5' as window_kind, 'JOINED' as join_quality, site_id, cell_id, grid_id, num_chr_events, num_users, rsrp_sample_count, sinr_sample_count, attach_attempts, {_half_up_sql('avg_rsrp')} as avg_rsrp, {_half_up_sql('avg_sinr')} as avg_sinr,
 {_half_up_sql('coalesce(avg_prb_usage_dl, 0)')} as avg_prb_usage_dl, {_half_up_sql('coalesce(throughput_dl_mbps_avg, 0)')} as throughput_dl_mbps_avg, {_half_up_sql('coalesce(drop_rate, 0)')} as drop_rate, {_half_up_sql('coalesce(ho_success_rate, 0)')} as ho_success_rate, {_half_up_sql('attach_success_rate')} as attach_success_rate, coalesce(pm_windows, 0) as pm_windows,
 cast((own.s + coalesce(theirs.s, 0)) // (n + coalesce(pm_windows, 0)) as bigint) as source_event_ts_avg, least(own.lo, theirs.lo) as source_event_ts_min, greatest(own.hi, theirs.hi) as source_event_ts_max, n + coalesce(pm_windows, 0) as source_event_count from own left join theirs using (cell_id, window_start_ts)""")
def kpi_enriched_window(spark, d):
    """KPI measures straight from enriched events."""
    return half_up(kpi.kpi_from_enriched(_enriched(spark, d), RW, "MIN_5"))


@query(f"select cell_id, event_ts - event_ts % {7 * DAY} as window_start_ts, count(distinct imsi) as users, true as close from chr group by all")
def distinct_users_merged(spark, d):
    """Distinct users of long windows, and whether the merged sketches of short ones come close."""
    chr_ = view(spark, d, "chr")
    exact = kpi.distinct_users(chr_, 7 * DAY).select("cell_id", "window_start_ts", "users")
    merged = kpi.distinct_users_merged(chr_, DAY, 7 * DAY)
    return exact.join(merged, ["cell_id", "window_start_ts"]).select("cell_id", "window_start_ts", "users", (F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.col("users") * 0.1, F.lit(1.0))).alias("close"))


@query(f"select cell_id, event_ts - event_ts % {DAY} as window_start_ts, count(distinct imsi) as users, true as close from chr group by all")
def distinct_users_exact_vs_hll(spark, d):
    """Exact distinct users, and whether a mergeable sketch comes close."""
    return kpi.distinct_users(view(spark, d, "chr"), DAY).drop("estimate")


@query(f"{_CHRF} select cell_id, minute_ts, site_id, n, users, round(rsrp_sum, 6) as rsrp_sum, rsrp_n, round(sinr_sum, 6) as sinr_sum, sinr_n, attach_n, attach_ok, cast(ts_avg as bigint) as chr_ts_avg, ts_min as chr_ts_min, ts_max as chr_ts_max, n as chr_ts_count from chrf")
def chr_minute_fact(spark, d):
    """Event facts by cell and window."""
    return rounded(kpi.chr_facts(view(spark, d, "chr"), R))


@query(f"{_PMF} select cell_id, minute_ts, site_id, n, round(prb_sum, 6) as prb_sum, round(tput_sum, 6) as tput_sum, cast(active_sum as bigint) as active_sum, cast(drops as bigint) as drops, cast(ho_ok as bigint) as ho_ok, cast(ho_bad as bigint) as ho_bad, cast(ts_avg as bigint) as pm_ts_avg, ts_min as pm_ts_min, ts_max as pm_ts_max, n as pm_ts_count from pmf")
def pm_minute_fact(spark, d):
    """Counter facts by cell and window."""
    return rounded(kpi.pm_facts(view(spark, d, "pm"), R))


_CELL_EV = f"""cev as (select 'CELL' as entity_type, cell_id as entity_id, window_end_ts as event_ts, cast(0 as bigint) as seq, window_start_ts, window_end_ts, site_id, cell_id, 'radio' as dimension,
 (rsrp_sample_count > 0 and avg_rsrp < {R.rsrp_min}) or (sinr_sample_count > 0 and avg_sinr < {R.sinr_min}) as abnormal, 'CELL_RADIO_BAD' as anomaly_type, 'MEDIUM' as severity,
 case when m then 'avgRsrp' else 'avgSinr' end as metric, cast(case when m then {R.rsrp_min} else {R.sinr_min} end as double) as threshold, case when m then avg_rsrp else avg_sinr end as observed
 from (select *, (rsrp_sample_count > 0 and avg_rsrp < {R.rsrp_min}) or (not (sinr_sample_count > 0 and avg_sinr < {R.sinr_min}) and rsrp_sample_count > 0) as m from kpi)
 union all select 'CELL', cell_id, window_end_ts, 0, window_start_ts, window_end_ts, site_id, cell_id, 'service', a or b, 'CELL_SERVICE_BAD', 'HIGH', case when a then 'attachSuccessRate' when b then 'dropRate' else 'service' end,
 cast(case when a then {R.attach_success_min} when b then {R.drop_rate_max} else 0.0 end as double), case when a then attach_success_rate when b then drop_rate else 0.0 end
 from (select *, attach_attempts > 0 and attach_success_rate < {R.attach_success_min} as a, drop_rate > {R.drop_rate_max} as b from kpi))"""
_USER_ROW = "'USER' as entity_type, imsi as entity_id, event_ts, cast(chr_id as bigint) as seq, event_ts - %d as window_start_ts, event_ts as window_end_ts, site_id, cell_id, event_type, result_code" % UW


def _user(dimension: str, bad: str, kind: str, severity: str, metric: str, threshold: str, observed: str, where: str) -> str:
    return f"select {_USER_ROW}, '{dimension}' as dimension, {bad} as abnormal, '{kind}' as anomaly_type, '{severity}' as severity, '{metric}' as metric, cast({threshold} as double) as threshold, cast({observed} as double) as observed from chr where {where}"


_USER_EV = "uev as (" + " union all ".join((
    _user("accessFailure", "result_code <> 0", "USER_FAILURE", "HIGH", "resultCode", "0", "result_code", "event_type in ('ATTACH', 'SERVICE_REQUEST', 'RRC_SETUP_FAIL')"),
    _user("handoverFailure", "result_code <> 0", "USER_FAILURE", "HIGH", "resultCode", "0", "result_code", "event_type = 'HANDOVER'"),
    _user("rsrp", f"rsrp < {R.rsrp_min}", "USER_QOE_BAD", "MEDIUM", "rsrp", str(R.rsrp_min), "rsrp", "rsrp is not null"),
    _user("sinr", f"sinr < {R.sinr_min}", "USER_QOE_BAD", "MEDIUM", "sinr", str(R.sinr_min), "sinr", "sinr is not null"),
    _user("latencyMs", f"latency_ms > {R.latency_max}", "USER_QOE_BAD", "MEDIUM", "latencyMs", str(R.latency_max), "latency_ms", "latency_ms is not null"),
)) + ")"
_CELL_JSON = """printf('{"metric":"%s","threshold":%.6f,"observed":%.6f,"windowKind":"MIN_1"}', metric, cast(threshold as double), cast(observed as double)) as context_json"""
_USER_JSON = """printf('{"metric":"%s","threshold":%.6f,"observed":%.6f,"eventType":"%s","resultCode":%d}', metric, threshold, observed, event_type, result_code) as context_json"""
_EV = "entity_type, entity_id, dimension, abnormal, event_ts, seq, anomaly_type, metric, round(threshold, 6) as threshold, round(observed, 6) as observed"


@query(f"{_KPI}, {_CELL_EV} select {_EV} from cev")
def cell_rule_evaluations(spark, d):
    """Radio and service evaluations of each KPI row."""
    return rounded(anomaly.cell_evaluations(_kpi(spark, d), R).selectExpr(*"entity_type entity_id dimension abnormal event_ts seq anomaly_type metric threshold observed".split()))


@query(f"{_USER_EV} select {_EV}, {_USER_JSON} from uev")
def user_rule_evaluations(spark, d):
    """Up to five evaluations of each event."""
    return rounded(anomaly.user_evaluations(view(spark, d, "chr"), R).selectExpr(*"entity_type entity_id dimension abnormal event_ts seq anomaly_type metric threshold observed context_json".split()))


def _streak_sql(source: str, name: str, needed: int, window: int) -> str:
    """The state machine row by row as a recursive query."""
    fresh = f"s.n = 0 or o.event_ts - s.first > {window}"
    return f"""{name}_o as materialized (select *, row_number() over (partition by entity_id, dimension order by event_ts, seq) as i from {source}),
 {name} as (select o.i, o.entity_id, o.dimension, case when o.abnormal then 1 else 0 end as n, o.event_ts as first, o.abnormal and {needed} <= 1 as active, o.abnormal and {needed} <= 1 as hit from {name}_o o where o.i = 1
 union all select o.i, o.entity_id, o.dimension, case when not o.abnormal then 0 when {fresh} then 1 else s.n + 1 end, case when not o.abnormal then 0 when {fresh} then o.event_ts else s.first end,
 o.abnormal and (s.active or (case when {fresh} then 1 else s.n + 1 end) >= {needed}), o.abnormal and not s.active and (case when {fresh} then 1 else s.n + 1 end) >= {needed}
 from {name} s join {name}_o o on o.entity_id = s.entity_id and o.dimension = s.dimension and o.i = s.i + 1),
 {name}_hits as (select o.* from {name} s join {name}_o o using (entity_id, dimension, i) where s.hit)"""


_CELL_HITS, _USER_HITS = _streak_sql("cev", "cs", R.cell_consecutive, CW), _streak_sql("uev", "us", R.user_consecutive, UW)
_HIT = "entity_type, entity_id, dimension, event_ts, anomaly_type, severity, metric, round(observed, 6) as observed"


@query(f"{_KPI}, {_CELL_EV}, {_CELL_HITS} select {_HIT} from cs_hits")
def cell_anomalies(spark, d):
    """Streaks of bad windows of a cell."""
    return rounded(anomaly.streaks(anomaly.cell_evaluations(_kpi(spark, d), R), R.cell_consecutive, CW).selectExpr(*"entity_type entity_id dimension event_ts anomaly_type severity metric observed".split()))


@query(f"{_USER_EV}, {_USER_HITS} select {_HIT} from us_hits")
def user_anomalies(spark, d):
    """Streaks of bad events of a user."""
    return rounded(anomaly.streaks(anomaly.user_evaluations(view(spark, d, "chr"), R), R.user_consecutive, UW).selectExpr(*"entity_type entity_id dimension event_ts anomaly_type severity metric observed".split()))


_GRID = f"""grid as (select *, event_ts - event_ts % {R.coverage_ms} as window_start_ts, row_number() over (partition by grid_id, event_ts - event_ts % {R.coverage_ms} order by event_ts, cast(chr_id as bigint)) as n
 from (select *, {geohash_sql('latitude', 'longitude')} as grid_id from chr where rsrp < {R.rsrp_min})),
 gev as (select 'GRID' as entity_type, grid_id as entity_id, event_ts, window_start_ts, window_start_ts + {R.coverage_ms} as window_end_ts, site_id, cell_id, 'COVERAGE_HOLE' as anomaly_type, 'HIGH' as severity, latitude, longitude, printf('{{"low_signal_count":%d,"window_ms":%d}}', n, {R.coverage_ms}) as context_json from grid where n = {R.coverage_count})"""


@query(f"{_GRID} select * from gev")
def coverage_holes(spark, d):
    """Geohash cells where weak signals pile up."""
    return anomaly.coverage_holes(view(spark, d, "chr"), R)


@query(f"select chr_id, event_ts, cell_id, rsrp, sinr from chr where rsrp is not null and sinr is not null and (rsrp < {R.rsrp_min} or sinr < {R.sinr_min})")
def low_signal(spark, d):
    """Events with a measure under its threshold."""
    return anomaly.low_signal(view(spark, d, "chr"), R).select("chr_id", "event_ts", "cell_id", "rsrp", "sinr")


@query(f"select chr_id, cell_id, event_ts from chr where rsrp is not null and rsrp < {R.rsrp_min}")
def weak_signal(spark, d):
    """Events whose signal is weak."""
    return view(spark, d, "chr").where(scalar.weak_signal(F.col("rsrp"), R.rsrp_min)).select("chr_id", "cell_id", "event_ts")


@query(f"select * from (select chr_id, cell_id, event_ts, row_number() over (partition by cell_id, event_ts // {R.burst_ms} order by event_ts, cast(chr_id as bigint)) as failures from chr where event_type = 'ATTACH' and result_code <> 0) where failures >= 3")
def attach_bursts(spark, d):
    """Failed attaches past the count of their cell and bucket."""
    return anomaly.attach_bursts(view(spark, d, "chr"), _with(burst_failures=3)).select("chr_id", "cell_id", "event_ts", F.col("failures").cast("long").alias("failures"))


def _with(**changes):
    from dataclasses import replace

    return replace(R, **changes)


_HANDOVER = f"""h as (select *, event_ts // {R.burst_ms} as b, case when result_code <> 0 then 1 else 0 end as f from chr where event_type = 'HANDOVER'),
 p as (select x.chr_id, x.cell_id, x.event_ts, count(*) as attempts, cast(sum(y.f) as bigint) as failures from h x join h y on x.cell_id = y.cell_id and y.b between x.b - {R.handover_buckets - 1} and x.b and (y.b < x.b or (y.event_ts, cast(y.chr_id as bigint)) <= (x.event_ts, cast(x.chr_id as bigint))) group by all)
 select * from p where attempts >= {R.handover_attempts} and failures / attempts > {R.handover_rate}"""


@query(_HANDOVER)
def handover_fail_pattern(spark, d):
    """Handovers at which the recent failure rate of the cell is too high."""
    return anomaly.handover_patterns(view(spark, d, "chr"), R).select("chr_id", "cell_id", "event_ts", "attempts", "failures")


@query(f"""{_ASOF_CFG}, mm as (select a.cell_id, a.chr_id, a.event_ts, concat_ws(',', case when c.tac <> right(c.site_id, 1)::int then 'tac' end, case when c.arfcn <> c.pci then 'arfcn' end) as fields from asof_cfg a join chr c using (chr_id) where cfg_version is not null)
 select cell_id, chr_id, event_ts, fields from (select *, row_number() over (partition by cell_id order by event_ts, cast(chr_id as bigint)) as r from mm where fields <> '') where r = 1""")
def config_mismatch(spark, d):
    """The first event of each cell that contradicts its configuration."""
    return anomaly.config_mismatch(_enriched(spark, d)).select("cell_id", "chr_id", "event_ts", "fields")


_FEED = "entity_type, entity_id, event_ts, window_start_ts, window_end_ts, site_id, cell_id, anomaly_type, severity, context_json"
_FEED_SQL = f"feed as (select {_FEED} from (select *, {_CELL_JSON} from cs_hits) union all select {_FEED} from (select *, {_USER_JSON} from us_hits) union all select {_FEED} from gev)"
_ID_SQL = f"lower(entity_type) || ':' || sha256(concat_ws(chr(31), lower(entity_type), cast(event_ts as string), entity_type, entity_id, anomaly_type, '{R.version}', sha256(context_json)))"


def _feed(spark: SparkSession, d: str) -> DataFrame:
    chr_ = view(spark, d, "chr")
    cells = anomaly.streaks(anomaly.cell_evaluations(_kpi(spark, d), R), R.cell_consecutive, CW)
    users = anomaly.streaks(anomaly.user_evaluations(chr_, R), R.user_consecutive, UW)
    return anomaly.feed(R, cells, users, anomaly.coverage_holes(chr_, R))


@query(f"{_KPI}, {_CELL_EV}, {_CELL_HITS}, {_USER_EV}, {_USER_HITS}, {_GRID}, {_FEED_SQL} select *, {_ID_SQL} as anomaly_id from feed")
def anomaly_feed_with_ids(spark, d):
    """All anomalies as one feed with stable ids."""
    return _feed(spark, d)


@query("select window_end_ts - 1 as pm_event_ts, window_end_ts > window_start_ts as valid, cell_id from pm")
def pm_event_time(spark, d):
    """The event time of counters, and whether their window is sound."""
    return kpi.valid_pm(view(spark, d, "pm")).select("pm_event_ts", "valid", "cell_id")


@query("select 'CHR' as kind, event_ts as ts, cell_id from chr union all select 'PM', event_ts, cell_id from pm union all select 'CFG', effective_ts, cell_id from cfg")
def envelope_union(spark, d):
    """All three streams as one tagged stream."""
    return enrich.envelopes(view(spark, d, "chr"), view(spark, d, "pm"), view(spark, d, "cfg")).select("kind", "ts", "cell_id")


@query(f"{_KPI} select window_start_ts, cell_id, site_id, join_quality, num_chr_events, round(avg_rsrp, 6) as avg_rsrp from kpi where window_start_ts >= 1704067200000 and window_end_ts <= 1706659200000 and site_id = 'SITE-1' and join_quality = 'CHR_ONLY' order by window_start_ts desc, cell_id limit 100")
def kpi_query(spark, d):
    """The newest KPI rows of a site in a time range."""
    from tidewell.operators.search import query_kpis

    found = query_kpis(_kpi(spark, d), start_ts=1704067200000, end_ts=1706659200000, site_id="SITE-1", join_quality="CHR_ONLY")
    return rounded(found.select("window_start_ts", "cell_id", "site_id", "join_quality", "num_chr_events", "avg_rsrp"))


@query(f"{_KPI}, {_CELL_EV}, {_CELL_HITS}, {_USER_EV}, {_USER_HITS}, {_GRID}, {_FEED_SQL} select entity_type, entity_id, event_ts, anomaly_type, severity, {_ID_SQL} as anomaly_id from feed where event_ts >= 1704067200000 and severity = 'HIGH' and site_id = 'SITE-2' order by event_ts desc, anomaly_id limit 50")
def anomaly_query(spark, d):
    """The newest severe anomalies of a site."""
    from tidewell.operators.search import query_anomalies

    found = query_anomalies(_feed(spark, d), time_col="event_ts", start_ts=1704067200000, limit=50, severity="HIGH", site_id="SITE-2")
    return found.select("entity_type", "entity_id", "event_ts", "anomaly_type", "severity", "anomaly_id")


@query(f"""select cell_id, count(*) as events, {geohash_sql('31.2', '121.4')} as grid, '1m' as label, 'write' as scope, case when count(*) < 30 then 'low' when count(*) < 100 then 'medium' else 'high' end as confidence,
 (('0x' || substr(md5(cell_id), 1, 8))::bigint % 1024)::int as bucket, xor(('0x' || substr(md5(cell_id), 1, 8))::bigint % 1024, 5)::int & 1023 as shifted, 'r_n_1' as run, 'warning' as worst, round(2 * 6371 * asin(sqrt(pow(sin(radians(0.5)), 2) + cos(radians(31)) * cos(radians(32)) * pow(sin(radians(0.5)), 2))), 6) as km from chr group by cell_id""")
def scalar_functions(spark, d):
    """The scalar functions beside each other."""
    s = scalar
    key = F.col("cell_id")
    out = view(spark, d, "chr").groupBy("cell_id").agg(F.count("*").alias("events"))
    bucket = s.virtual_bucket(key, 1024)
    return rounded(out.select(
        "cell_id", "events", s.geohash(F.lit(31.2), F.lit(121.4)).alias("grid"), s.window_label(F.lit("MIN_1")).alias("label"), s.sink_scope(F.lit("kpi-connector-write")).alias("scope"), s.confidence(F.col("events")).alias("confidence"),
        bucket.alias("bucket"), s.shifted_bucket(bucket, F.lit(5), 1024).alias("shifted"), s.run_id(F.lit(" r/n 1 ")).alias("run"), s.status_of(F.greatest(s.status_rank(F.lit("warning")), s.status_rank(F.lit("healthy")))).alias("worst"), s.haversine_km(F.lit(31.0), F.lit(121.0), F.lit(32.0), F.lit(122.0)).alias("km")))


@query("select distinct imsi from chr where ('0x' || substr(md5(imsi), 1, 8))::bigint % 10000 < 2500")
def cohort(spark, d):
    """A fixed quarter of the users."""
    return view(spark, d, "chr").where(scalar.cohort(F.col("imsi"), 0.25)).select("imsi").distinct()


@query(f"""{_KPI} select cell_id, window_start_ts, rank from (select cell_id, window_start_ts, row_number() over (partition by cell_id order by avg_prb_usage_dl desc, window_start_ts) as rank from kpi) where rank <= 3""")
def busiest_windows(spark, d):
    """The three busiest windows of each cell."""
    w = Window.partitionBy("cell_id").orderBy(F.desc("avg_prb_usage_dl"), "window_start_ts")
    return _kpi(spark, d).withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 3").select("cell_id", "window_start_ts", "rank")
