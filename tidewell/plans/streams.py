"""Registered streaming twins: each reads the events as a file stream, runs over all there is and gives the sink's table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import anomaly, kpi
from tidewell.plans import operations
from tidewell.plans import telemetry as t
from tidewell.plans.registry import query
from tidewell.sources import adapters, sinks
from tidewell.sources.workdir import new_folder
from tidewell.streaming import pipelines as st
from tidewell.streaming import timers

R, W = t.R, t.W


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    return adapters.streamed_view(spark, d, name)


def _sink(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    folder = new_folder(spark, name)
    st.state_settings(spark)
    st.run_once(df, f"{folder}/out", f"{folder}/checkpoint").stop()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


_SEEN = "seen as (select greatest((select max(event_ts) from chr), (select max(window_end_ts) - 1 from pm)) - 12000 as mark)"


def _kpis(spark: SparkSession, d: str) -> DataFrame:
    return st.kpis(st.sides(_stream(spark, d, "chr"), _stream(spark, d, "pm")), R)


@query(f"{t._KPI}, {_SEEN} select * {t._ROUNDED} from (select kpi.* from kpi, seen where window_end_ts <= mark)")
def stream_kpi_1m(spark, d):
    """KPIs of the windows that the watermark has closed."""
    return t.rounded(_sink(spark, _kpis(spark, d).drop("w"), "stream-kpi"))


@query(f"{t._KPI}, {t._ROLLUP}, {_SEEN} select * {t._ROUNDED} from (select roll.* from roll, seen where window_start_ts + {t.RW} <= mark)")
def stream_kpi_5m(spark, d):
    """Rollup chained on the KPI stream, of the windows that the watermark has closed."""
    return t.rounded(_sink(spark, st.rollups(_kpis(spark, d), R), "stream-rollup"))


_EARLY = "mark as (select greatest((select max(event_ts) from chr), (select max(window_end_ts) - 1 from pm)) - 2000 as mark)"
_OUT = "window_end_ts + case when join_quality = 'JOINED' then 0 else 10000 end <= mark"


@query(f"{t._KPI}, {_EARLY} select * {t._ROUNDED} from (select kpi.* from kpi, mark where {_OUT})")
def stream_kpi_early(spark, d):
    """KPIs by timers: joined windows that the watermark has passed, one-sided ones whose wait is over."""
    return t.rounded(_sink(spark, timers.early_kpis(_stream(spark, d, "chr"), _stream(spark, d, "pm"), R), "stream-early"))


@query(f"{t._KPI}, {_EARLY}, {t._LATEST} select k.window_start_ts, k.cell_id, k.site_id, k.join_quality, coalesce({t.geohash_sql('center_lat', 'center_lon')}, '') as grid_id from (select kpi.* from kpi, mark where {_OUT}) k left join latest l using (cell_id)")
def stream_kpi_cfg(spark, d):
    """KPIs by timers with the grid of the cell's configuration, kept by version in the stream's state."""
    rows = timers.early_kpis(_stream(spark, d, "chr"), _stream(spark, d, "pm"), R, _stream(spark, d, "cfg"))
    return _sink(spark, rows, "stream-cfg").select("window_start_ts", "cell_id", "site_id", "join_quality", "grid_id")


@query(f"{t._KPI}, {_SEEN} select cell_id, event_ts - event_ts % {t.RW} as window_start_ts, count(distinct imsi) as users, true as close from chr, seen where event_ts - event_ts % {t.RW} + {t.RW} <= mark group by all")
def stream_distinct_users(spark, d):
    """Distinct users of the rollup's windows from sketches that the stream merges, held against exact numbers."""
    rolled = _sink(spark, st.rollups(st.kpis(st.sides(_stream(spark, d, "chr"), _stream(spark, d, "pm")), R, users=True), R), "stream-users").select("cell_id", "window_start_ts", "distinct_users")
    exact = kpi.distinct_users(adapters.view(spark, d, "chr"), t.RW).select("cell_id", "window_start_ts", "users")
    near = F.abs(F.col("distinct_users") - F.col("users")) <= F.col("users") * 0.02
    return rolled.join(exact, ["cell_id", "window_start_ts"]).select("cell_id", "window_start_ts", "users", near.alias("close"))


@query(f"{t._GRID} select grid_id, window_start_ts, event_ts, cast(chr_id as bigint) as seq, site_id, cell_id, latitude, longitude from grid where n = {R.coverage_count}")
def stream_coverage_holes(spark, d):
    """Coverage holes by a counter for each grid cell and bucket."""
    return _sink(spark, timers.coverage_holes(_stream(spark, d, "chr"), R), "stream-holes")


@query(t._HANDOVER)
def stream_handover_pattern(spark, d):
    """Handover patterns by the counts of a cell's latest buckets."""
    return _sink(spark, timers.handover_patterns(_stream(spark, d, "chr"), R), "stream-handover").select("cell_id", "chr_id", "event_ts", "attempts", "failures")


_ROUTES = f"env as (select cell_id, event_ts as ts, 1 as ord, chr_id, cast(null as bigint) as v from chr union all select cell_id, effective_ts, 0, null, cfg_seq from cfg), route as (select cell_id, chr_id, ts as event_ts, max(v) over (partition by cell_id order by ts, ord) as v, ord from env)"


@query(f"{_ROUTES} select cell_id, chr_id, event_ts, coalesce(cast(v % 7 as int), 0) as shift, xor({operations._VB}, coalesce(cast(v % 7 as int), 0)) & {operations.N - 1} as vbucket from route where ord = 1")
def stream_routed_events(spark, d):
    """Events with the bucket that the routing table gave them at their time; each configuration makes a new version of its cell's route."""
    routes = _stream(spark, d, "cfg").select("cell_id", (F.col("cfg_seq") % 7).cast("int").alias("shift"), F.col("cfg_seq").alias("routing_version"), F.col("effective_ts").alias("ts"))
    return _sink(spark, timers.routed(_stream(spark, d, "chr"), routes, operations.N), "stream-routed")


_CLOSED = t._KPI.replace("kpi as (select", "kpi_all as (select", 1)


@query(f"{_CLOSED}, {_SEEN}, kpi as (select kpi_all.* from kpi_all, seen where window_end_ts <= mark), {t._CELL_EV}, {t._CELL_HITS} select entity_id, dimension, event_ts, seq from cs_hits")
def stream_cell_anomalies(spark, d):
    """Streaks of bad windows of a cell, by state on the KPI stream."""
    rows = anomaly.cell_evaluations(_kpis(spark, d), R).select("entity_id", "dimension", "event_ts", "seq", "abnormal")
    return _sink(spark, st.streaks(rows, R.cell_consecutive, R.cell_window_ms, bounded=True), "stream-cell")


@query(f"{t._USER_EV}, {t._USER_HITS} select entity_id, dimension, event_ts, seq from us_hits")
def stream_user_anomalies(spark, d):
    """Streaks of bad events of a user, by state."""
    rows = anomaly.user_evaluations(_stream(spark, d, "chr"), R).select("entity_id", "dimension", "event_ts", "seq", "abnormal")
    return _sink(spark, st.streaks(rows, R.user_consecutive, R.user_window_ms, bounded=True), "stream-user")


@query(f"{t._ASOF_CFG}, {t._ASOF_PM} select c.cell_id, c.chr_id, c.event_ts, c.cfg_version, round(p.pm_prb_usage_dl, 6) as pm_prb_usage_dl from asof_cfg c join asof_pm p using (chr_id)")
def stream_enrich(spark, d):
    """Events with configuration and counters, by state."""
    return t.rounded(_sink(spark, st.enrich(_stream(spark, d, "chr"), _stream(spark, d, "pm"), _stream(spark, d, "cfg"), R), "stream-enrich"))


@query(f"{t._KPI} select window_start_ts, cell_id, join_quality, strftime(make_timestamp(window_start_ts * 1000), '%Y-%m-%d') as dt, num_chr_events + case when join_quality = 'JOINED' then 1 else 0 end as num_chr_events from kpi")
def sink_round_trip(spark, d):
    """KPI rows written by key, joined ones written again with a change, and read back."""
    folder = new_folder(spark, "round-trip")
    rows = t._kpi(spark, d)
    sinks.write_results({"kpi": rows}, "upsert", folder)
    changed = rows.where("join_quality = 'JOINED'").withColumn("num_chr_events", F.col("num_chr_events") + 1)
    sinks.write_results({"kpi": changed}, "upsert", folder)
    back = spark.read.option("basePath", f"{folder}/kpi").parquet(f"{folder}/kpi")
    return back.select("window_start_ts", "cell_id", "join_quality", F.col("dt").cast("string").alias("dt"), "num_chr_events")
