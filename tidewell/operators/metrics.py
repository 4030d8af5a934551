"""Queries over metric samples: latest readings, roll-ups, percentiles, completeness and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalar import bucket_start, sink_scope, source_name, status_of, status_rank

#: Thresholds of a run's verdict.
GATES = {"backlog_max": 0, "backpressure_max": 0.2, "checkpoint_failures_max": 2, "checkpoint_ms_max": 120_000, "kpi_p95_max": 180_000, "sink_p95_max": 180_000, "lag_max": 180_000, "delivery_min": 0.98}
#: Names by which a stage tells that it belongs to one result sink.
RESULT_SINKS = ("parquet", "table", "upsert", "kafka")
#: Stages in the order in which they are shown; others come last.
STAGE_ORDER = ("source-chr", "source-pm", "source-cfg", "kpi-1m", "kpi-5m", "sink-grid")


def available(x: str) -> Column:
    return F.when(F.col(x) >= 0, F.col(x))


def real_samples(samples: DataFrame) -> DataFrame:
    """Samples without placeholders: unknown status, or nothing counted and no latency."""
    return samples.where(~((F.col("status") == "unknown") | ((F.col("records") == 0) & (F.col("p95_ms") <= 0) & (F.col("errors") == 0))))


def latest_samples(samples: DataFrame) -> DataFrame:
    """The newest sample of each stage, sink, window and subtask; real ones before placeholders, later arrivals before earlier ones at the same time. Samples without a column `sink` have none."""
    w = Window.partitionBy("stage_id", *(["sink"] if "sink" in samples.columns else []), "window", "subtask").orderBy((F.col("status") == "unknown").cast("int"), F.desc("updated_at"), F.desc("sample_id"))
    return samples.withColumn("rank", F.row_number().over(w)).where("rank = 1").drop("rank")


def stage_rollup(samples: DataFrame, keys: tuple[str, ...] = ("stage_id",)) -> DataFrame:
    """Latest samples rolled up: rates, records, bytes, errors and failures summed, latencies at their worst (-1 if none) like lag and duration, the worst status, the latest error text.

    Placeholders (unknown status) count only in groups that have nothing else. Rates in and out, the 50th and 99th
    percentile, rebalances and the latest checkpoint are rolled up where the samples have them.
    """
    more = lambda *names: [x for x in names if x in samples.columns]
    text = F.when(F.trim("error_text") != "", F.col("error_text"))
    real = F.col("status") != "unknown"
    at = F.struct("updated_at", "sample_id")

    def fold(f, x):  # noqa: ANN001, ANN202
        """f over the real samples of a group, or over all if none is real."""
        x = F.col(x) if isinstance(x, str) else x
        return F.when(F.count_if(real) > 0, f(F.when(real, x))).otherwise(f(x))

    last = lambda x: F.max_by(x, F.when(x.isNotNull(), at))
    return latest_samples(samples).groupBy(*keys).agg(
        F.when(F.count_if(real) > 0, F.count_if(real)).otherwise(F.count("*")).alias("subtasks"),
        *(fold(F.sum, x).alias(x) for x in ("eps", *more("in_eps", "out_eps"), "records", "bytes", "errors", "failures", "dlq", *more("rebalances"))),
        *(F.coalesce(fold(F.max, available(x)), F.lit(-1)).alias(x) for x in ("p95_ms", *more("p50_ms", "p99_ms", "checkpoint_id"))), fold(F.max, "lag_ms").alias("lag_ms"), fold(F.max, "duration_ms").alias("duration_ms"),
        status_of(fold(F.max, status_rank(F.col("status")))).alias("status"), F.coalesce(fold(last, text), F.lit("")).alias("last_error"), fold(F.max, "updated_at").alias("updated_at"))


def source_summaries(samples: DataFrame) -> DataFrame:
    """The roll-up by source, of the stages that read one."""
    named = samples.withColumn("source", source_name(F.col("stage_id"))).where("source != ''")
    return stage_rollup(named, ("source",)).select("source", "status", "eps", "lag_ms", "records", "updated_at")


def sink_summaries(samples: DataFrame) -> DataFrame:
    """The roll-up by sink stage and window: what was written, how late, and what failed."""
    return stage_rollup(samples.where("window != ''"), ("stage_id", "window")).select("stage_id", "window", "status", "records", "bytes", "duration_ms", "p95_ms", "failures", "last_error", "updated_at")


def sink_latencies(samples: DataFrame) -> DataFrame:
    """The roll-up by stage, sink and window of samples that name a sink: what was written, its latencies, and the latest checkpoint."""
    rows = stage_rollup(samples.where("trim(sink) != ''"), ("stage_id", "sink", "window"))
    return rows.select("stage_id", "sink", "window", "records", "bytes", "duration_ms", "p50_ms", "p95_ms", "p99_ms", "failures", "last_error", "checkpoint_id", "updated_at")


def rebalance_summary(samples: DataFrame, coordinator: str) -> DataFrame:
    """One row if the coordinator's stage has samples: how often keys were moved, its status, and when that was told."""
    return stage_rollup(samples.where(F.col("stage_id") == coordinator)).select("stage_id", "rebalances", "status", "updated_at")


def relevant(samples: DataFrame, sink: str) -> DataFrame:
    """Samples of stages that belong to the active result sink, or to none in particular; auxiliary ones (dead letters, metrics, late rows) are left out.

    A stage that names a result sink belongs to that sink only; with the sink `none` no such stage is left.
    """
    stage = F.lower("stage_id")
    named = F.lit(False)
    for name in RESULT_SINKS:
        named = named | stage.contains(name)
    mine = F.lit(sink.lower() != "none") & stage.contains(sink.lower())
    auxiliary = F.lit(False)
    for name in ("dlq", "metrics", "late"):
        auxiliary = auxiliary | (stage == name) | stage.endswith(f"-{name}")
    return samples.where((~named | mine) & ~auxiliary)


def percentiles(samples: DataFrame) -> DataFrame:
    """Nearest-rank percentiles of max(0, observed - source time) by stage; samples without a source time are left out, -1 where none is left.

    Exact, so a stage's distinct latencies are held in one place; merged_percentiles() has a state of bounded size.
    """
    rows = samples.withColumn("latency", _latency())
    at = lambda p: F.expr(f"coalesce(percentile_disc({p}) within group (order by latency), -1)").cast("long")
    return rows.groupBy("stage_id").agg(F.count("latency").alias("samples"), at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"), F.coalesce(F.max("latency"), F.lit(-1)).alias("max"))


#: Size of a latency sketch: up to so many latencies it is exact, beyond them its ranks are within 0.3 % or so, whatever their number.
SKETCH = 1024


def _latency() -> Column:
    return F.when(F.col("source_ts") > 0, F.greatest(F.col("observed_ts") - F.col("source_ts"), F.lit(0)))


def latency_sketches(samples: DataFrame, interval_ms: int) -> DataFrame:
    """(stage_id, slot_ts, sketch, max): the latencies of each stage and interval as a mergeable sketch of bounded size; batch or streaming (then samples need a watermark on event_time and slot is a window)."""
    if samples.isStreaming:
        w = F.window("event_time", f"{interval_ms} milliseconds")
        rows = samples.groupBy("stage_id", w.alias("w"))
        slot = F.unix_millis("w.start").alias("slot_ts")
    else:
        rows, slot = samples.groupBy("stage_id", bucket_start("updated_at", interval_ms).alias("slot_ts")), F.col("slot_ts")
    return rows.agg(F.kll_sketch_agg_bigint(_latency(), SKETCH).alias("sketch"), F.max(_latency()).alias("max")).select("stage_id", slot, "sketch", "max")


def merged_percentiles(sketches: DataFrame, *keys: str) -> DataFrame:
    """(keys, samples, p50, p95, p99, max) of merged sketches: nearest ranks, -1 where there is no latency."""
    out = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch", SKETCH).alias("s"), F.max("max").alias("max"))
    n = F.coalesce(F.kll_sketch_get_n_bigint("s"), F.lit(0))
    at = lambda p: F.when(n > 0, F.kll_sketch_get_quantile_bigint("s", F.lit(p).cast("double"))).otherwise(-1)
    return out.select(*keys, n.alias("samples"), at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"), F.coalesce("max", F.lit(-1)).alias("max"))


def rank_errors(samples: DataFrame, found: DataFrame) -> DataFrame:
    """found with `error`: by how much the worst of its percentiles misses its rank among the stage's latencies, as a share."""
    rows = samples.withColumn("latency", _latency()).where("latency is not null")
    rows = rows.join(found.select("stage_id", "p50", "p95", "p99"), "stage_id")
    misses = []
    for p, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        below, upto = (F.count_if(F.col("latency") < F.col(name)) / F.count("*"), F.count_if(F.col("latency") <= F.col(name)) / F.count("*"))
        misses.append(F.greatest(below - p, p - upto, F.lit(0.0)))
    return found.join(rows.groupBy("stage_id").agg(F.greatest(*misses).alias("error")), "stage_id", "left").na.fill(0.0, ["error"])


def throughput(samples: DataFrame, interval_ms: int) -> DataFrame:
    """Records a second and worst lag by stage, subtask and interval."""
    slot = bucket_start("updated_at", interval_ms).alias("slot_ts")
    return samples.groupBy("stage_id", "subtask", slot).agg(F.sum("records").alias("records"), (F.sum("records") / (interval_ms / 1000)).alias("eps"), F.max("lag_ms").alias("lag_ms"))


def materialization(kpis: DataFrame) -> DataFrame:
    """Rows and mean source time of each window of each kind, and how long after that the window ends."""
    out = kpis.groupBy("window_kind", "window_end_ts").agg(F.count("*").alias("n"), F.expr("sum(source_event_ts_avg) div count(*)").alias("source_ts"))
    return out.withColumn("latency_ms", F.col("window_end_ts") - F.col("source_ts"))


def completeness(kpis: DataFrame, cells: int, expected: int) -> DataFrame:
    """By kind: windows, those closed (as many rows as cells), those expected, and whether enough are closed."""
    out = kpis.groupBy("window_kind", "window_end_ts").agg(F.count("*").alias("n")).groupBy("window_kind").agg(F.count("*").alias("windows"), F.count_if(F.col("n") >= cells).alias("closed"))
    out = out.withColumns({"expected": F.lit(expected).cast("long"), "healthy": F.col("closed") >= expected})
    return out.withColumn("reason", F.when(F.col("healthy"), "").otherwise(F.format_string("closed %d of %d windows", "closed", "expected")))


def source_density(totals: DataFrame, cells: int) -> DataFrame:
    """(source, observed, target) with the events of a cell and the delivered share of the target (1 without a target)."""
    return totals.withColumns({"per_cell": F.col("observed") / F.lit(float(max(cells, 1))), "delivery": F.when(F.col("target") > 0, F.col("observed") / F.col("target")).otherwise(1.0)})


def verdicts(runs: DataFrame) -> DataFrame:
    """FAILED, UNSTABLE or STABLE for each run by the first rule that it breaks, with the reason.

    Runs have windows_applicable, windows_closed and windows_expected (completeness() of the run), and storage_ok with
    storage_summary. Negative latencies are not available and break no rule.
    """
    g = GATES
    rules = [
        (F.col("job_status") == "UNKNOWN", "UNSTABLE", F.lit("job status UNKNOWN")),
        (F.col("job_status") != "RUNNING", "FAILED", F.concat(F.lit("job status "), "job_status")),
        (~F.col("has_source"), "UNSTABLE", F.lit("source metrics missing")),
        (~F.col("has_events"), "UNSTABLE", F.lit("event source metrics missing")),
        (F.col("windows_applicable") & (F.col("windows_closed") < F.col("windows_expected")), "UNSTABLE", F.format_string("closed %d of %d windows", "windows_closed", "windows_expected")),
        (F.col("delivery") < g["delivery_min"], "UNSTABLE", F.lit("source throughput attainment")),
        (F.col("backlog") > g["backlog_max"], "UNSTABLE", F.lit("source backlog")),
        (F.col("backpressure") > g["backpressure_max"], "UNSTABLE", F.lit("sustained backpressure")),
        (F.col("checkpoint_failures") >= g["checkpoint_failures_max"], "UNSTABLE", F.lit("checkpoint failures")),
        (F.col("checkpoint_ms") > g["checkpoint_ms_max"], "UNSTABLE", F.lit("checkpoint duration")),
        (F.col("kpi_p95") > g["kpi_p95_max"], "UNSTABLE", F.lit("KPI availability p95 over threshold")),
        (F.col("sink_p95") > g["sink_p95_max"], "UNSTABLE", F.lit("sink p95 over threshold")),
        (F.col("write_p95") > g["sink_p95_max"], "UNSTABLE", F.lit("connector write p95 over threshold")),
        (F.col("commit_p95") > g["sink_p95_max"], "UNSTABLE", F.lit("connector commit p95 over threshold")),
        (F.col("sink_failures") > 0, "UNSTABLE", F.lit("sink failures")),
        (F.col("lag") > g["lag_max"], "UNSTABLE", F.lit("watermark lag")),
        (~F.col("storage_ok"), "UNSTABLE", F.concat(F.lit("storage unhealthy: "), "storage_summary")),
    ]
    status, reason = F, F
    for bad, name, why in rules:
        status, reason = status.when(bad, name), reason.when(bad, why)
    return runs.withColumns({"verdict": status.otherwise("STABLE"), "reason": reason.otherwise("all thresholds healthy")})


def gate_table(runs: DataFrame) -> DataFrame:
    """A row for each gate of each run: observed, threshold and HEALTHY, UNSTABLE, FAILED (the job isn't running) or NA (a negative reading is none)."""
    at = lambda n: F.col(n).cast("double")
    gate = lambda n, observed, threshold, ok, bad="UNSTABLE": F.struct(F.lit(n).alias("gate"), observed.alias("observed"), F.lit(float(threshold)).alias("threshold"), F.when(observed < 0, "NA").when(ok, "HEALTHY").otherwise(bad).alias("state"))
    yes = lambda c: c.cast("int").cast("double")
    running = F.col("job_status") == "RUNNING"
    gates = [gate("job_status", yes(running), 1, running, "FAILED"), gate("source", yes(F.col("has_source")), 1, F.col("has_source")), gate("delivery", F.when(F.col("has_source"), at("delivery")).otherwise(-1.0), GATES["delivery_min"], at("delivery") >= GATES["delivery_min"])]
    gates += [gate(n, at(n), GATES[t], at(n) <= GATES[t]) for n, t in (("backlog", "backlog_max"), ("backpressure", "backpressure_max"), ("checkpoint_ms", "checkpoint_ms_max"), ("kpi_p95", "kpi_p95_max"), ("sink_p95", "sink_p95_max"), ("write_p95", "sink_p95_max"), ("commit_p95", "sink_p95_max"), ("lag", "lag_max"))]
    gates += [gate("checkpoint_failures", at("checkpoint_failures"), GATES["checkpoint_failures_max"], at("checkpoint_failures") < GATES["checkpoint_failures_max"]), gate("sink_failures", at("sink_failures"), 0, at("sink_failures") <= 0)]
    # The windows' threshold is the run's own.
    expected = F.when(F.col("windows_applicable"), at("windows_expected")).otherwise(0.0)
    closed = F.when(F.col("windows_applicable"), at("windows_closed")).otherwise(-1.0)
    gates += [gate("windows", closed, 0, closed >= expected).withField("threshold", expected), gate("storage", yes(F.col("storage_ok")), 1, F.col("storage_ok"))]
    return runs.select("run_id", F.explode(F.array(*gates)).alias("g")).select("run_id", "g.*")


def stable_bounds(judged: DataFrame) -> DataFrame:
    """By sink: the highest level that was STABLE (0 if none), runs by verdict, and the reason of the lowest level that wasn't."""
    bad = F.col("verdict") != "STABLE"
    return judged.groupBy("sink").agg(F.coalesce(F.max(F.when(~bad, F.col("level"))), F.lit(0)).alias("bound"), *(F.count_if(F.col("verdict") == v).alias(v.lower()) for v in ("STABLE", "UNSTABLE", "FAILED")), F.min_by(F.when(bad, F.col("reason")), F.when(bad, F.struct("level", "run_id"))).alias("first_bottleneck"))


def measurement_window(samples: DataFrame) -> DataFrame:
    """By run and stage over repeated readings: the worst lag, the mean of positive latencies (else the last), the last total."""
    last = lambda x: F.max_by(x, F.struct("updated_at", "sample_id"))
    return samples.groupBy("run_id", "stage_id").agg(F.max("lag_ms").alias("lag_ms"), F.coalesce(F.avg(F.when(F.col("p95_ms") > 0, F.col("p95_ms"))), last("p95_ms").cast("double")).alias("p95_ms"), last("records").alias("records"))


def subtask_fold(readings: DataFrame) -> DataFrame:
    """(vertex, metric, value) folded by the metric's class: ratios averaged, watermarks at their least of those available (else their greatest, else -1), others summed."""
    value = F.col("value")
    ratio_like, watermark = F.col("metric").endswith("ratio"), F.col("metric").endswith("watermark")
    out = readings.groupBy("vertex", "metric").agg(F.avg(value).alias("mean"), F.coalesce(F.min(F.when(value >= 0, value)), F.max(value), F.lit(-1.0)).alias("least"), F.sum(value).alias("total"))
    return out.select("vertex", "metric", F.when(ratio_like, F.col("mean")).when(watermark, F.col("least")).otherwise(F.col("total")).alias("value"))


def marker_max(markers: DataFrame) -> DataFrame:
    """The greatest latency marker of each edge."""
    return markers.groupBy("source_id", "target_id").agg(F.max("latency_ms").alias("latency_ms"))


def operator_delay(latencies: DataFrame, edges: DataFrame) -> DataFrame:
    """Own delay of each operator: its cumulative p95 less the greatest of its inputs'.

    Without a known input it is the operator's own value; unknown (-1) if its own value is, or if an input is over
    a second ahead (readings of different times); 0 if an input is slightly ahead.
    """
    up = edges.join(latencies.select(F.col("stage_id").alias("source_id"), F.col("p95_ms").alias("up_ms")), "source_id").groupBy(F.col("target_id").alias("stage_id")).agg(F.max(available("up_ms")).alias("up_ms"))
    delta = F.col("p95_ms") - F.col("up_ms")
    delay = F.when(F.col("p95_ms") < 0, -1).when(F.col("up_ms").isNull(), F.col("p95_ms")).when(delta < -1000, -1).otherwise(F.greatest(delta, F.lit(0)))
    return latencies.join(up, "stage_id", "left").withColumn("delay_ms", delay.cast("long"))


def snapshot(samples: DataFrame) -> DataFrame:
    """One row: worst p95 of source, 1m and 5m stages, of sinks by scope (connector write and commit apart from the rest), failures and worst lag over the latest samples."""
    over = lambda keep: F.coalesce(F.max(F.when(keep, available("p95_ms"))), F.lit(-1))
    worst = lambda part: over(F.col("stage_id").contains(part))
    scope = sink_scope(F.col("stage_id"))
    return latest_samples(samples).agg(
        worst("source").alias("source_p95"), worst("1m").alias("kpi_1m_p95"), worst("5m").alias("kpi_5m_p95"), over(F.col("stage_id").contains("sink") & ~scope.isin("write", "commit")).alias("sink_p95"),
        over(scope == "write").alias("connector_write_p95"), over(scope == "commit").alias("connector_commit_p95"), F.sum("failures").alias("failures"), F.max("lag_ms").alias("lag_ms"))


def connectors(samples: DataFrame) -> DataFrame:
    """Connector stages: samples, nearest-rank percentiles of their durations, failures, the latest commit and `warning` if anything failed."""
    rows = samples.withColumn("scope", sink_scope(F.col("stage_id"))).where("scope in ('write', 'commit')")
    at = lambda p: F.expr(f"percentile_disc({p}) within group (order by duration_ms)").cast("long")
    commit = F.when(F.col("scope") == "commit", F.col("sample_id"))
    return rows.groupBy("stage_id", "scope").agg(F.count("*").alias("samples"), at(0.5).alias("p50"), at(0.95).alias("p95"), at(0.99).alias("p99"), F.sum("failures").alias("failures"), F.when(F.sum("failures") > 0, "warning").otherwise("healthy").alias("status"), F.coalesce(F.max(commit), F.lit(-1)).alias("last_commit"))


def coverage(samples: DataFrame) -> DataFrame:
    """By stage, how many subtasks have each metric."""
    return latest_samples(samples).groupBy("stage_id").agg(F.count("*").alias("subtasks"), F.count_if(F.col("p95_ms") >= 0).alias("with_latency"), F.count_if(F.col("records") > 0).alias("with_records"), F.count_if(F.col("source_ts") > 0).alias("with_source_time"))


def bottlenecks(samples: DataFrame, k: int = 5) -> DataFrame:
    """The k stages with the highest p95 among those with a latency or errors."""
    return stage_rollup(samples).where("p95_ms > 0 or errors > 0").orderBy(F.desc("p95_ms"), "stage_id").limit(k)


def bottleneck_flags(samples: DataFrame) -> DataFrame:
    """A row for each reason why a stage is a bottleneck."""
    rows = stage_rollup(samples)
    flags = F.array_compact(F.array(F.when(F.col("status").isin("warning", "critical"), F.concat(F.lit("status "), "status")), F.when(F.col("p95_ms") >= 1000, "p95"), F.when(F.col("lag_ms") >= 60_000, "lag"), F.when(F.col("dlq") > 0, "dlq")))
    return rows.select("stage_id", F.explode(flags).alias("flag"))


def in_order(stages: DataFrame) -> DataFrame:
    """stages with ord, their place in STAGE_ORDER; 100 for those not in it."""
    at = F.array_position(F.array(*map(F.lit, STAGE_ORDER)), F.col("stage_id"))
    return stages.withColumn("ord", F.when(at > 0, at).otherwise(100).cast("int"))


def with_fallback(primary: DataFrame, other: DataFrame) -> DataFrame:
    """(stage_id, value) of primary, from other where primary has none or no reading."""
    joined = primary.alias("a").join(other.alias("b"), "stage_id", "full_outer")
    return joined.select("stage_id", F.coalesce(F.when(F.col("a.value") >= 0, F.col("a.value")), F.col("b.value")).alias("value"))


def sink_bytes(rows: DataFrame, fixed: int, texts: list[str]) -> Column:
    """Approximate bytes of a row: a fixed part and the UTF-8 length of its texts."""
    return F.lit(fixed) + sum((F.coalesce(F.octet_length(t), F.lit(0)) for t in texts), F.lit(0))


def sink_throughput(rows: DataFrame, key: str, size: Column, ts: str) -> DataFrame:
    """By key: records, bytes, and records a second between the first and the last record (0 if at one time)."""
    seconds = (F.max(ts) - F.min(ts)) / 1000
    return rows.groupBy(key).agg(F.count("*").alias("records"), F.sum(size).alias("bytes"), F.when(seconds > 0, F.count("*") / seconds).otherwise(0.0).alias("eps"))
