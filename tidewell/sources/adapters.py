"""Views of the driver's tables in the telemetry schemas.

Each column is one expression that Spark SQL and DuckDB read alike, so that an oracle starts from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: event_id, ts (epoch ms), user_id, event_type, value and k (from props) of events.
CHR = {
    "chr_id": "cast(event_id as string)",
    "event_ts": "ts",
    "imsi": "concat('46000', lpad(cast(user_id as string), 10, '0'))",
    "cell_id": "concat('CELL-', cast(user_id % 20 as string))",
    "site_id": "concat('SITE-', cast(user_id % 5 as string))",
    "event_type": "case event_type when 'signup' then 'ATTACH' when 'error' then 'RRC_SETUP_FAIL' when 'click' then 'SERVICE_REQUEST' when 'view' then 'DATA_SESSION' else 'HANDOVER' end",
    "result_code": "case when event_type = 'error' or event_id % 4 = 0 then 1 else 0 end",
    "rsrp": "case when event_id % 7 = 0 then null else -90 - value / 3 end",
    "sinr": "case when event_id % 5 = 0 then null else 12 - value / 6 end",
    "latency_ms": "case when event_id % 2 = 0 then value * 6 end",
    "latitude": "cast(round(31.2 + (user_id % 10) * 0.002, 4) as double)",
    "longitude": "cast(round(121.4 + (user_id % 4) * 0.002, 4) as double)",
    "pci": "cast(user_id % 20 as int)",
    "tac": "cast(user_id % 5 + case when event_id % 11 = 0 then 1 else 0 end as int)",
    "eci": "user_id % 20 + 1000",
    "arfcn": "case when event_id % 3 = 1 then cast(user_id % 20 + case when event_id % 13 = 0 then 7 else 0 end as int) end",
}
PM = {
    "site_id": "concat('SITE-', cast(user_id % 5 as string))",
    "cell_id": "concat('CELL-', cast(user_id % 20 as string))",
    "window_start_ts": "ts - ts % 10000",
    "window_end_ts": "ts - ts % 10000 + 10000",
    "event_ts": "ts",
    "prb_usage_dl": "value / 2",
    "throughput_dl_mbps": "value * 3",
    "active_users": "cast(k % 13 - 1 as int)",
    "dropped_connections": "cast(k % 3 as int)",
    "handover_success": "cast(k % 7 as int)",
    "handover_failure": "cast(k % 2 as int)",
}
CFG = {
    "site_id": "concat('SITE-', cast(user_id % 5 as string))",
    "cell_id": "concat('CELL-', cast(user_id % 20 as string))",
    "effective_ts": "ts",
    "version": "event_id % 97 + cast(floor(event_id / 50) as bigint)",
    "tombstone": "event_id % 9 = 0",
    "center_lat": "cast(round(31.2 + (event_id % 10) * 0.01, 4) as double)",
    "center_lon": "cast(round(121.4 + (user_id % 20) * 0.01, 4) as double)",
    "pci": "cast(user_id % 20 as int)",
    "tac": "cast(user_id % 5 as int)",
    "eci": "user_id % 20 + 1000",
    "arfcn": "cast(user_id % 20 as int)",
    "cfg_seq": "event_id",
}
#: Metric samples: a stage's reading at a time.
SAMPLES = {
    "sample_id": "event_id",
    "stage_id": "concat(case event_type when 'signup' then 'source-cfg' when 'error' then 'sink-grid' when 'click' then 'source-chr' when 'view' then 'kpi-1m' else 'kpi-5m' end, case event_id % 10 when 3 then '-sink-front' when 5 then '-connector-write' when 7 then '-connector-commit' else '' end)",
    "window": "case when event_id % 10 in (3, 5, 7) then case when event_id % 4 < 2 then '1m' else '5m' end else '' end",
    "sink": "case when event_id % 10 in (3, 5, 7) then case event_id % 3 when 0 then 'parquet' when 1 then 'kafka' else 'table' end else '' end",
    "eps": "value * 8",
    "in_eps": "value * 9",
    "out_eps": "value * 7",
    "p50_ms": "case when event_id % 6 = 0 then -1 else cast(floor(value * 40) as bigint) end",
    "p99_ms": "case when event_id % 6 = 0 then -1 else cast(floor(value * 130) as bigint) end",
    "checkpoint_id": "case when event_id % 10 = 7 then event_id else -1 end",
    "rebalances": "event_id % 3",
    "duration_ms": "cast(floor(value * 7) as bigint)",
    "failures": "case when event_id % 29 = 0 then 1 else 0 end",
    "dlq": "case when event_id % 37 = 0 then 1 else 0 end",
    "subtask": "user_id % 4",
    "updated_at": "ts",
    "observed_ts": "ts + cast(floor(value * 100) as bigint) - 100",
    "source_ts": "case when event_id % 17 = 0 then 0 else ts end",
    "records": "k",
    "bytes": "k * 120",
    "p95_ms": "case when event_id % 6 = 0 then -1 else cast(floor(value * 100) as bigint) end",
    "lag_ms": "cast(floor(value * 40) as bigint)",
    "errors": "case when event_id % 19 = 0 then 1 else 0 end",
    "status": "case when event_id % 23 = 0 then 'critical' when event_id % 7 = 0 then 'warning' when event_id % 31 = 0 then 'unknown' else 'healthy' end",
    "error_text": "case when event_id % 19 = 0 then concat('e', cast(event_id % 5 as string)) else '' end",
    "run_id": "concat('run-', cast(user_id % 6 as string))",
}
_WHERE = {"chr": "event_id % 3 <> 0", "pm": "event_id % 3 = 0", "cfg": "event_type = 'signup'", "samples": "true"}
_COLUMNS = {"chr": CHR, "pm": PM, "cfg": CFG, "samples": SAMPLES}


def _shape(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return raw.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), "user_id", "event_type", "value", k.alias("k"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _view(rows: DataFrame, name: str) -> DataFrame:
    return rows.where(_WHERE[name]).selectExpr(*(f"{e} as {c}" for c, e in _COLUMNS[name].items()))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of chr, pm, cfg or samples."""
    return _view(events(spark, sf_dir), name)


def streamed_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """view() over the events as a file stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # The file source takes a folder or a pattern, and the table may be a single file.
    return _view(_shape(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")), name)


def duckdb_views() -> str:
    """The same views as common table expressions of DuckDB SQL, to go on with after a comma."""
    base = "ev as (select event_id, epoch_us(ts) // 1000 as ts, user_id, event_type, value, cast(json_extract_string(props, '$.k') as bigint) as k from events)"
    views = [f"{n} as (select {', '.join(f'{e} as {c}' for c, e in _COLUMNS[n].items())} from ev where {_WHERE[n]})" for n in _COLUMNS]
    return f"with recursive {base}, {', '.join(views)}"
