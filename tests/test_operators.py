"""Operators on hand-made rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions import scalar
from tidewell.operators import anomaly, enrich, kpi, maintenance, metrics, search, skew
from tidewell.params import Rules
from tidewell.sources import readers, sinks

R = Rules()
KPI = "window_start_ts long, window_end_ts long, window_kind string, join_quality string, site_id string, cell_id string, num_chr_events long, num_users long, rsrp_sample_count long, sinr_sample_count long, attach_attempts long, avg_rsrp double, avg_sinr double, avg_prb_usage_dl double, throughput_dl_mbps_avg double, drop_rate double, ho_success_rate double, attach_success_rate double, source_event_ts_avg long, source_event_ts_min long, source_event_ts_max long, source_event_count long"


def _kpi(start, quality="JOINED", events=1, rsrp=(-80.0, 1), sinr=(10.0, 1), attach=(1.0, 1), pm=(0.0, 0.0, 0.0, 0.0), kind="MIN_1", ts=(0, 0, 0, 0), end=None):
    return (start, end or start + 60_000, kind, quality, "S", "C", events, 1, rsrp[1], sinr[1], attach[1], rsrp[0], sinr[0], *map(float, pm), attach[0], *ts)


def test_geohash(spark):
    row = spark.range(1).select(scalar.geohash(F.lit(0.0), F.lit(0.0), 5).alias("a"), scalar.geohash(F.lit(37.7749), F.lit(-122.4194), 5).alias("b"), scalar.geohash(F.lit(None).cast("double"), F.lit(0.0)).alias("c"), scalar.geohash(F.lit(90.0), F.lit(180.0), 3).alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == ("s0000", "9q8yy", None, "zzz")
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(scalar.geohash(F.lit(91.0), F.lit(0.0))).collect()
    with pytest.raises(ValueError):
        scalar.geohash(F.lit(0.0), F.lit(0.0), 13)


def test_buckets_and_labels(spark):
    with pytest.raises(ValueError):
        scalar.virtual_bucket(F.lit("a"), 0)
    with pytest.raises(ValueError):
        scalar.shifted_bucket(F.lit(1), F.lit(1), 6)
    row = spark.range(1).select(scalar.shifted_bucket(F.lit(5), F.lit(3), 8).alias("s"), scalar.run_id(F.lit(" ")).alias("r"), scalar.first_non_blank(F.lit(" "), F.lit(None), F.lit("x")).alias("f"), scalar.cohort(F.lit(" "), 1.0).alias("blank"), scalar.cohort(F.lit("u"), 1.0).alias("all"), scalar.cohort(F.lit("u"), 0.0).alias("none")).first()
    assert tuple(row) == (6, "unknown-run", "x", False, True, False)


def test_join_labels_and_weights(spark):
    chr_ = spark.createDataFrame([("1", 60_000, "u", "C", "S", "ATTACH", 0, -80.0, None)], "chr_id string, event_ts long, imsi string, cell_id string, site_id string, event_type string, result_code int, rsrp double, sinr double")
    pm = spark.createDataFrame([("S", "C", 60_000, 70_000, 61_000, 50.0, 9.0, -4, 1, 1, 1), ("S", "C", 180_000, 190_000, 181_000, 30.0, 9.0, 10, 1, 3, 1), ("S", "C", 5, 5, 6, 1.0, 1.0, 1, 1, 1, 1)], "site_id string, cell_id string, window_start_ts long, window_end_ts long, event_ts long, prb_usage_dl double, throughput_dl_mbps double, active_users int, dropped_connections int, handover_success int, handover_failure int")
    rows = {r.window_start_ts: r for r in kpi.kpi(chr_, pm, R).collect()}
    assert {k: r.join_quality for k, r in rows.items()} == {60_000: "JOINED", 180_000: "PM_ONLY"}
    assert rows[60_000].drop_rate == 0.0 and rows[60_000].attach_success_rate == 1.0
    assert (rows[60_000].source_event_ts_avg, rows[60_000].source_event_ts_min, rows[60_000].source_event_ts_max) == (60_500, 60_000, 61_000)
    assert (rows[180_000].drop_rate, rows[180_000].ho_success_rate, rows[180_000].avg_rsrp) == (0.1, 0.75, 0.0)
    assert [r.join_quality for r in kpi.kpi(chr_, pm.limit(0), R).collect()] == ["CHR_ONLY"]


def test_rollup_weights(spark):
    rows = [_kpi(0, rsrp=(-80.0, 1), sinr=(10.0, 1), attach=(1.0, 1), pm=(10.0, 0, 0, 0)), _kpi(60_000, rsrp=(-85.0, 4), sinr=(20.0, 4), attach=(0.75, 4), pm=(20.0, 0, 0, 0)), _kpi(120_000, "CHR_ONLY", rsrp=(0.0, 0), sinr=(0.0, 0), attach=(0.0, 0))]
    out = kpi.rollup(spark.createDataFrame(rows, KPI), R).first()
    assert (out.avg_rsrp, out.avg_sinr, round(out.attach_success_rate, 6), out.avg_prb_usage_dl, out.join_quality) == (-84.0, 18.0, 0.8, 15.0, "JOINED")
    only = kpi.rollup(spark.createDataFrame([_kpi(0, "CHR_ONLY"), _kpi(60_000, "PM_ONLY", events=0, pm=(8.0, 0, 0, 0))], KPI), R).first()
    assert only.join_quality == "JOINED"
    bad = kpi.rollup_violations(spark.createDataFrame([_kpi(0, kind="MIN_5"), _kpi(290_000, end=310_000), _kpi(0)], KPI), R).collect()
    assert sorted(r.reason for r in bad) == ["kind", "outside"]


EVAL = "entity_type string, entity_id string, dimension string, event_ts long, seq long, abnormal boolean"


def _streak(rows, needed, window):
    """The state machine, row by row."""
    out, n, first, active = [], 0, 0, False
    for ts, bad in rows:
        if not bad:
            n, first, active = 0, 0, False
            continue
        n, first = (1, ts) if n == 0 or ts - first > window else (n + 1, first)
        if n >= needed and not active:
            active = True
            out.append(ts)
    return out


def test_streaks_equal_state_machine(spark):
    import random

    rng = random.Random(3)
    cases = {f"e{k}": [(t * 10 + rng.randint(0, 9), rng.random() < 0.7) for t in range(40)] for k in range(12)}
    df = spark.createDataFrame([("CELL", k, "d", ts, 0, bad) for k, rows in cases.items() for ts, bad in rows], EVAL)
    got: dict = {}
    for r in anomaly.streaks(df, 3, 40).collect():
        got.setdefault(r.entity_id, []).append(r.event_ts)
    assert {k: sorted(v) for k, v in got.items()} == {k: x for k, rows in cases.items() if (x := _streak(rows, 3, 40))}
    assert anomaly.streaks(df.limit(0), 3, 40).count() == 0


def test_config_rules(spark):
    cfg = spark.createDataFrame([("C", 0, 5, False, 1), ("C", 10, 4, False, 2), ("C", 20, 9, True, 3), ("C", 30, 2, False, 4)], "cell_id string, effective_ts long, version long, tombstone boolean, cfg_seq long")
    chr_ = spark.createDataFrame([(str(i), t, "C") for i, t in enumerate((5, 15, 25, 35))], "chr_id string, event_ts long, cell_id string")
    pm = spark.createDataFrame([("C", 12, 20, 1.0)], "cell_id string, event_ts long, window_end_ts long, prb_usage_dl double")
    rows = {r.event_ts: r for r in enrich.enrich(chr_, pm, cfg, Rules(pm_ttl_ms=10)).collect()}
    assert [rows[t].cfg and rows[t].cfg.version for t in (5, 15, 25, 35)] == [5, 5, None, 2]
    assert [rows[t].pm is not None for t in (5, 15, 25)] == [False, True, False]
    assert kpi.latest_cfg(cfg).count() == 0  # the tombstone has the highest version
    expired = enrich.enrich(chr_, pm, cfg, Rules(cfg_ttl_ms=4)).orderBy("event_ts").collect()
    assert [r.cfg is not None for r in expired] == [False, False, False, False]


def test_overload_and_rebalance(spark):
    loads = spark.createDataFrame([(w, s * 60_000, e) for s, es in enumerate(((10, 10, 40, 2), (10, 10, 50, 2), (10, 10, 10, 10))) for w, e in enumerate(map(float, es))], "worker int, slot_ts long, eps double")
    since = {(r.worker, r.slot_ts): r.since for r in skew.overload_since(loads).collect()}
    assert since[2, 0] == 0 and since[2, 60_000] == 0 and since[2, 120_000] is None
    buckets = spark.createDataFrame([(2, 60_000, 7, 30), (2, 60_000, 8, 20), (2, 60_000, 9, 0)], "worker int, slot_ts long, vbucket int, load long")
    none = spark.createDataFrame([], "worker int, slot_ts long, hot_key string, hot_bucket int")
    rows = skew.rebalance(loads, buckets, none, 8, 4, every_ms=60_000).collect()
    assert [tuple(r)[:6] for r in rows] == [(60_000, 2, "VB-7", 7, 30.0, 3)]
    moved = spark.range(1).select(scalar.shifted_bucket(scalar.virtual_bucket(F.lit("VB-7"), 8), F.lit(rows[0].shift), 8)).first()[0]
    assert moved % 4 == 3 and skew.rebalance(loads, buckets, none, 8, 4).count() == 0  # no slot starts five minutes
    named = spark.createDataFrame([(2, 60_000, "C-9", 8)], none.schema)
    assert [tuple(r)[:6] for r in skew.rebalance(loads, buckets, named, 8, 4, every_ms=60_000).collect()] == [(60_000, 2, "C-9", 8, 20.0, 3)]
    with pytest.raises(Exception, match="no shift"):
        skew.rebalance(loads, buckets, none, 2, 4, every_ms=60_000).collect()
    shifts = skew.slot_shift(spark.createDataFrame([("k", 1)], "key string, target int"), 8, 4).collect()
    assert len(shifts) == 1


def test_metric_rules(spark):
    lat = spark.createDataFrame([("a", 100), ("b", 5000), ("c", 4500), ("d", -1), ("e", 100)], "stage_id string, p95_ms long")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("b", "e")], "source_id string, target_id string")
    assert {r.stage_id: r.delay_ms for r in metrics.operator_delay(lat, edges).collect()} == {"a": 100, "b": 4900, "c": 0, "d": -1, "e": -1}
    good = {"run_id": "r", "sink": "s", "level": 1, "job_status": "RUNNING", "has_source": True, "has_events": True, "delivery": 1.0, "backlog": 0, "backpressure": 0.1, "checkpoint_failures": 0, "checkpoint_ms": 10, "kpi_p95": 10, "sink_p95": 10, "write_p95": -1, "commit_p95": 10, "sink_failures": 0, "lag": 10, "windows_applicable": True, "windows_closed": 4, "windows_expected": 4, "storage_ok": True, "storage_summary": "down"}
    # In the order of the rules, so that each row breaks its own rule and those after it.
    bad = [("job_status", "UNKNOWN", "job status UNKNOWN"), ("job_status", "FAILED", "job status FAILED"), ("has_source", False, "source metrics missing"), ("has_events", False, "event source metrics missing"), ("windows_closed", 3, "closed 3 of 4 windows"), ("delivery", 0.9, "source throughput attainment"), ("backlog", 1, "source backlog"), ("backpressure", 0.3, "sustained backpressure"), ("checkpoint_failures", 2, "checkpoint failures"), ("checkpoint_ms", 130_000, "checkpoint duration"), ("kpi_p95", 200_000, "KPI availability p95 over threshold"), ("sink_p95", 200_000, "sink p95 over threshold"), ("write_p95", 200_000, "connector write p95 over threshold"), ("commit_p95", 200_000, "connector commit p95 over threshold"), ("sink_failures", 1, "sink failures"), ("lag", 200_000, "watermark lag"), ("storage_ok", False, "storage unhealthy: down")]
    rows = [good]
    for i in range(len(bad)):
        rows.append(good | {k: v for k, v, _ in reversed(bad[i:])})
    runs = spark.createDataFrame([tuple(r.values()) for r in rows], list(good))
    got = [(r.verdict, r.reason) for r in metrics.verdicts(runs).collect()]
    assert got == [("STABLE", "all thresholds healthy"), *(("FAILED" if v == "FAILED" else "UNSTABLE", why) for _, v, why in bad)]
    none = good | {"windows_applicable": False, "windows_closed": 0}
    judged = spark.createDataFrame([tuple(none.values())], list(good))
    assert metrics.verdicts(judged).first().verdict == "STABLE"
    states = {r.gate: (r.observed, r.threshold, r.state) for r in metrics.gate_table(judged).collect()}
    assert states["windows"] == (-1.0, 0.0, "NA") and states["write_p95"][2] == "NA" and states["storage"] == (1.0, 1.0, "HEALTHY")
    gates = {r.gate: r.state for r in metrics.gate_table(runs.where("windows_closed = 3").limit(1)).collect()}
    assert gates["windows"] == gates["storage"] == gates["commit_p95"] == "UNSTABLE" and len(gates) == 15


def test_sketched_percentiles(spark):
    """Few latencies are exact; many are within 1 % of their rank, however the sketches were cut; no latency gives -1."""
    rng = random.Random(1)
    rows = [("many", i % 50, 1000, 1000 + int(rng.paretovariate(1.2) * 10)) for i in range(30_000)] + [("few", i, 1000, 1000 + 7 * i) for i in range(101)] + [("none", 1, 0, 5), ("late", 1, 1000, 900)]
    samples = spark.createDataFrame(rows, "stage_id string, updated_at long, source_ts long, observed_ts long")
    exact = {r.stage_id: r for r in metrics.percentiles(samples).collect()}
    for interval in (1, 10, 1000):
        found = metrics.rank_errors(samples, metrics.merged_percentiles(metrics.latency_sketches(samples, interval), "stage_id"))
        got = {r.stage_id: r for r in found.collect()}
        assert all((got[s].samples, got[s].max) == (exact[s].samples, exact[s].max) for s in exact) and all(r.error <= 0.01 for r in got.values())
        assert all(tuple(got[s])[2:5] == tuple(exact[s])[2:5] for s in ("few", "none", "late"))
    size = metrics.latency_sketches(samples, 10**6).where("stage_id = 'many'").select(F.octet_length("sketch")).first()[0]
    assert size < 40_000


def test_limits():
    assert [search.limit_of(x) for x in (None, "x", 0, -3, 5, "7", 5000)] == [100, 100, 100, 100, 5, 7, 1000]


def test_search_filters(spark):
    rows = spark.createDataFrame([_kpi(0), _kpi(60_000), _kpi(120_000, "PM_ONLY")], KPI)
    assert [r.window_start_ts for r in search.query_kpis(rows, start_ts=60_000, limit=1).collect()] == [120_000]
    assert search.query_kpis(rows, join_quality="PM_ONLY", site_id="").count() == 1
    with pytest.raises(ValueError):
        search.query_anomalies(rows, nonsense="x")


def test_upsert_keeps_latest(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([("a", "d1", 1, 10), ("b", "d2", 1, 20)], "k string, dt string, at int, v int")
    sinks.upsert(first, path, ("k",), ["dt"], "at")
    again = spark.createDataFrame([("a", "d1", 2, 11), ("c", "d1", 1, 30)], "k string, dt string, at int, v int")
    for _ in range(2):  # repeating a batch changes nothing
        sinks.upsert(again, path, ("k",), ["dt"], "at")
        assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [("a", 11), ("b", 20), ("c", 30)]


def test_partitioned_sinks_and_dispatch(spark, tmp_path):
    rows = spark.createDataFrame([_kpi(1_704_067_200_000), _kpi(1_704_074_400_000)], KPI)
    sinks.write_results({"kpi": rows}, "unheard-of", str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/kpi")
    assert sorted((r.dt.isoformat() if hasattr(r.dt, "isoformat") else r.dt, int(r.hour)) for r in back.collect()) == [("2024-01-01", 0), ("2024-01-01", 2)]
    sinks.write_results({"kpi": rows}, "none", "")
    sinks.write_results({"kpi": rows}, "upsert", f"{tmp_path}/u")
    assert spark.read.parquet(f"{tmp_path}/u/kpi").count() == 2
    readers.kind_views(spark, back)
    assert spark.sql("select count(*) from kpi_1m").first()[0] == 2 and spark.sql("select count(*) from kpi_5m").first()[0] == 0
    assert readers.listing(spark, f"{tmp_path}/kpi").count() == 2
    assert sinks.to_kafka(rows, "cell_id").first().key == "C"


def test_table_schema_converges(spark):
    spark.sql("drop table if exists converge")
    sinks.ensure_table(spark, "converge", spark.range(1), {"team": "t"})
    sinks.ensure_table(spark, "converge", spark.range(1).withColumn("more", F.lit("x")))
    assert spark.table("converge").columns == ["id", "more"]
    spark.range(3).withColumn("more", F.lit("x")).write.mode("append").insertInto("converge")
    sinks.reset_table(spark, "converge")
    assert spark.table("converge").count() == 0


def test_retention_guards(spark):
    files = spark.createDataFrame([("kpi/dt=2024-01-01/hour=00/a.parquet", 5, 0), ("kpi/x.tmp", 5, 0)], "path string, bytes long, modified long")
    none = spark.createDataFrame([], "path string")
    with pytest.raises(ValueError):
        maintenance.orphan_files(files, none, 10**9, 60_000, allow=True)
    with pytest.raises(ValueError):
        maintenance.orphan_files(files, none, 10**9, 3_600_000)
    assert maintenance.orphan_files(files, none, 10**9, 3_600_000, allow=True).count() == 1
    assert [tuple(r) for r in maintenance.expired_partitions(files, 1_704_070_800_000).collect()] == [("2024-01-01", "00")]
    huge = spark.createDataFrame([("a", 2**62, 0), ("b", 2**62, 0)], "path string, bytes long, modified long")
    with pytest.raises(Exception, match="(?i)overflow"):
        maintenance.byte_budget(huge, 1).collect()


def test_json_sources(spark):
    lines = spark.createDataFrame([('{"stage_id":"s","rows_written":7}',), ("{broken",), ('{"subtask":1}',)], "value string")
    rows = readers.samples_from_json(lines).collect()
    assert [tuple(r) for r in rows] == [("s", -1, 0, 7, -1, 0, 0, "unknown")]
    log = spark.createDataFrame([("[summary] a | m | 1",), ("[summary] === a ===",), ("x",)], "value string")
    assert [tuple(r) for r in readers.log_metrics(log).collect()] == [("a", "m", "1")]


def test_plans(spark):
    from tidewell.plans.telemetry import _kpi as build

    text = build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp" in text


def test_upsert_goes_by_what_is_written_last(spark, tmp_path):
    rows = spark.createDataFrame([_kpi(1_704_067_200_000 + i * 86_400_000) for i in range(5)], KPI)
    root = str(tmp_path)
    sinks.write_results({"kpi": rows}, "upsert", root)
    changed = rows.where("window_start_ts < 1704240000000").withColumn("num_chr_events", F.lit(77).cast("long"))
    for _ in range(2):
        sinks.write_results({"kpi": changed}, "upsert", root)
        assert sorted(r.num_chr_events for r in spark.read.parquet(f"{root}/kpi").collect()) == [1, 1, 1, 77, 77]
    assert not [x for x in tmp_path.iterdir() if "staged" in x.name]
    twice = rows.limit(1).unionByName(rows.limit(1).withColumn("num_users", F.lit(9).cast("long")))
    with pytest.raises(ValueError, match="share their key"):
        sinks.write_results({"kpi": twice}, "upsert", root)
    like = rows.withColumns(sinks.day_and_hour("window_start_ts"))
    some = sinks.stored(spark, f"{root}/kpi", like, like.select("dt").limit(2).collect())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert some.count() == 2 and "PartitionFilters: [dt" in plan.replace("isnotnull(dt", "[dt") and "dt#" in plan


def test_tables_are_partitioned_and_written_by_name(spark):
    spark.sql("create database if not exists results")
    spark.sql("drop table if exists results.kpi")
    rows = spark.createDataFrame([_kpi(1_704_067_200_000), _kpi(1_704_074_400_000)], KPI)
    sinks.write_results({"kpi": rows.drop("num_users")}, "table", "results")
    sinks.write_results({"kpi": rows.select(*reversed(rows.columns))}, "table", "results")
    table = spark.table("results.kpi")
    assert sorted(((r.site_id, r.cell_id, r.num_users, r.hour) for r in table.collect()), key=str) == [("S", "C", 1, "00"), ("S", "C", 1, "02"), ("S", "C", None, "00"), ("S", "C", None, "02")]
    assert spark.sql("show partitions results.kpi").count() == 2
    sinks.reset_table(spark, "results.kpi")


def test_small_sinks(spark, tmp_path):
    anomalies = spark.createDataFrame([("a", 1_704_067_200_000), ("b", 1_704_074_400_000)], "anomaly_id string, event_ts long")
    sinks.write_results({"cell": anomalies}, "parquet", str(tmp_path))
    assert sorted(str(r.hour).zfill(2) for r in spark.read.parquet(f"{tmp_path}/cell").collect()) == ["00", "02"]
    kept = maintenance.keep_since(anomalies.withColumn("detection_ts", F.col("event_ts") + 5), "detection_ts", 1_704_074_400_005)
    assert [r.anomaly_id for r in kept.collect()] == ["b"]
    summary = spark.createDataFrame([("r,1", 'say "x"')], "run_id string, note string")
    sinks.write_summary(summary, f"{tmp_path}/s")
    assert spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/s/csv").first().run_id == "r,1" and spark.read.json(f"{tmp_path}/s/json").first().note == 'say "x"'
    sinks.write_samples(spark.createDataFrame([("r1", "s", 1), ("r2", "s", 2)], "run_id string, stage_id string, records int"), f"{tmp_path}/m")
    assert spark.read.text(f"{tmp_path}/m/run_id=r2").first().value == '{"run_id":"r2","stage_id":"s","records":2}'
    decisions = "cell_id string, shift int, routing_version long"
    sinks.write_routing(spark.createDataFrame([("c", 3, 1), ("d", 1, 1)], decisions), f"{tmp_path}/r")
    sinks.write_routing(spark.createDataFrame([("c", 5, 2)], decisions), f"{tmp_path}/r")
    assert sorted(tuple(r) for r in spark.read.csv(f"{tmp_path}/r/current").collect()) == [("c", "5", "2"), ("d", "1", "1")]
    assert spark.read.parquet(f"{tmp_path}/r/decisions").count() == 3


def test_more_rules(spark):
    row = spark.range(1).select(scalar.planar_km(F.lit(31.0), F.lit(121.0), F.lit(32.0), F.lit(121.0)).alias("lat"), scalar.planar_km(F.lit(31.0), F.lit(121.0), F.lit(31.0), F.lit(122.0)).alias("lon"), scalar.source_name(F.lit("source-pm")).alias("s"), scalar.source_name(F.lit("kpi-1m")).alias("n")).first()
    assert tuple(row) == (111.32, 85.0, "pm", "")
    with pytest.raises(Exception, match="no such child"):
        kpi.rollup(spark.createDataFrame([_kpi(0, kind="MIN_5")], KPI), R).collect()
    files = spark.createDataFrame([("a", 5, 0)], "path string, bytes long, modified long")
    assert maintenance.byte_budget(files, 5, strict=True).first().within
    with pytest.raises(Exception, match="budget"):
        maintenance.byte_budget(files, 4, strict=True).collect()
    readings = spark.createDataFrame([("v", "in_watermark", -5.0), ("v", "in_watermark", -2.0)], "vertex string, metric string, value double")
    assert metrics.subtask_fold(readings).first().value == -2.0


def test_streaks_of_a_hot_entity_are_cut(spark):
    """Of a long dense run only the rows up to the alarm matter; a sparse one is folded whole."""
    dense = [("CELL", "hot", "d", t, 0, True) for t in range(3000)]
    sparse = [("CELL", "cold", "d", t * 30, 0, True) for t in range(60)] + [("CELL", "cold", "d", 1800 + t, 0, True) for t in range(4)]
    df = spark.createDataFrame(dense + sparse, EVAL)
    got = {r.entity_id: r.event_ts for r in anomaly.streaks(df, 3, 40).collect()}
    assert got == {"hot": 2, "cold": _streak([(t, True) for *_, t, _, _ in sparse], 3, 40)[0]}


def _enriched(chr_, pm, cfg, cfg_ttl, pm_ttl):
    """The enrichment as a machine with a state for each cell, row by row."""
    rows = sorted([(c[1], 2, int(c[0]), c) for c in chr_] + [(p[4], 1, p[3], p) for p in pm] + [(c[2], 0, c[7], c) for c in cfg], key=lambda r: (r[3][3] if r[1] == 2 else r[3][1], *r[:3]))
    out, state = {}, {}
    for ts, kind, _, r in rows:
        s = state.setdefault(r[3] if kind == 2 else r[1], {"cfg": None, "touched": None, "pm": None})
        if kind == 1:
            s["pm"] = (ts, r[5])
            continue
        if s["touched"] is not None and ts - s["touched"] > cfg_ttl:
            s["cfg"] = None
        s["touched"] = ts
        if kind == 2:
            out[r[0]] = (s["cfg"], s["pm"][1] if s["pm"] and ts - s["pm"][0] <= pm_ttl else None)
        elif r[4]:
            s["cfg"] = None
        elif s["cfg"] is None or r[3] > s["cfg"]:
            s["cfg"] = r[3]
    return out


def test_enrichment_in_blocks(spark):
    """Blocks of any length give what a state machine gives, also with gaps, tombstones and ties at the edges of blocks."""
    from test_streaming import CFG, CHR, PM

    rng = random.Random(11)
    times = lambda n: [rng.choice([rng.randrange(0, 400), 100 * rng.randrange(0, 40)]) for _ in range(n)]
    cell = lambda: rng.choice("abc")
    chr_ = [(str(i), t, "u", cell(), "", "ATTACH", 0, -90.0, 1.0) for i, t in enumerate(times(250))]
    pm = [("", cell(), t, t + i, t, float(i), 1.0, 1, 0, 1, 0) for i, t in enumerate(times(60))]
    cfg = [("s", cell(), t, rng.randrange(6), rng.random() < 0.25, 1.0, 1.0, i) for i, t in enumerate(times(60))]
    tables = [spark.createDataFrame(rows, schema) for rows, schema in ((chr_, CHR), (pm, PM), (cfg, CFG))]
    rules = Rules(cfg_ttl_ms=150, pm_ttl_ms=60)
    want = _enriched(chr_, pm, cfg, 150, 60)
    for block in (7, 100, 150):
        got = enrich.enrich(*tables, rules, block).select("chr_id", "cfg.version", "pm.prb_usage_dl").collect()
        assert {r[0]: (r[1], r[2]) for r in got} == want
    with pytest.raises(ValueError, match="block"):
        enrich.enrich(*tables, rules, 151)
    assert enrich.enrich(*(t.limit(0) for t in tables), rules, 7).count() == 0


def test_handovers_of_no_cell(spark):
    rows = spark.createDataFrame([(str(i), i, None if i % 2 else "a", "HANDOVER", 1) for i in range(20)], "chr_id string, event_ts long, cell_id string, event_type string, result_code int")
    rules = Rules(burst_ms=5, handover_attempts=4)
    assert {(r.chr_id, r.attempts) for r in anomaly.handover_patterns(rows, rules).where("cell_id is null").collect()} == {(str(i), i // 2 + 1) for i in range(7, 20, 2)}


def _days(spark, path):
    """Rows of three hours: one wholly before the cutoff of 90 minutes, one through which it runs, one after it."""
    rows = [(i, i * 600_000, "2024-01-01", f"{i // 6:02d}") for i in range(18)] + [(99, None, "2024-01-01", "00")]
    spark.createDataFrame(rows, "id int, ts long, dt string, hour string").write.partitionBy("dt", "hour").parquet(path)


def test_retention_of_rows(spark, tmp_path):
    from tidewell.operators import retention

    path, keys = f"{tmp_path}/rows of a=b", ["dt", "hour"]
    _days(spark, path)
    cut = 9 * 600_000
    ids = lambda: sorted(r.id for r in retention.table_at(spark, path, keys).collect())
    want = {"00": (7, 6, "rewrite"), "01": (6, 3, "rewrite"), "02": (6, 0, "keep")}
    plan = lambda act: {r.hour: (r.n, r.expired, r.action) for r in retention.retain_rows(spark, path, "ts", cut, keys, act).collect()}
    untouched = os.listdir(f"{path}/dt=2024-01-01/hour=02")
    assert plan(False) == want and len(ids()) == 19
    assert plan(True) == want and ids() == [*range(9, 18), 99]
    assert os.listdir(f"{path}/dt=2024-01-01/hour=02") == untouched and os.listdir(tmp_path) == ["rows of a=b"]
    files = sorted(os.listdir(f"{path}/dt=2024-01-01/hour=01"))
    assert {a for _, _, a in plan(True).values()} == {"keep"} and ids() == [*range(9, 18), 99]
    assert sorted(os.listdir(f"{path}/dt=2024-01-01/hour=01")) == files
    # Without the row that has no time the first hour goes as a whole.
    later = {r.hour: r.action for r in retention.retain_rows(spark, path, "ts", 12 * 600_000, keys, True).collect()}
    assert later == {"00": "keep", "01": "drop", "02": "keep"} and sorted(os.listdir(f"{path}/dt=2024-01-01")) == ["hour=00", "hour=02"]
    assert ids() == [*range(12, 18), 99]


def test_retention_of_partitions(spark):
    from tidewell.operators import retention

    spark.sql("drop table if exists kept_hours")
    rows = spark.createDataFrame([(i, "2024-01-15", f"{i:02d}") for i in range(6)], "id int, dt string, hour string")
    rows.write.format("parquet").partitionBy("dt", "hour").saveAsTable("kept_hours")
    cut = 1_705_276_800_000 + 3 * 3_600_000
    due = [("2024-01-15", f"{h:02d}") for h in range(3)]
    assert sorted(map(tuple, retention.drop_partitions(spark, "kept_hours", cut).collect())) == due and spark.table("kept_hours").count() == 6
    assert sorted(map(tuple, retention.drop_partitions(spark, "kept_hours", cut, act=True).collect())) == due
    assert sorted(r.id for r in spark.table("kept_hours").collect()) == [3, 4, 5]
    assert retention.drop_partitions(spark, "kept_hours", cut, act=True).count() == 0
    spark.sql("drop table kept_hours")


def test_retention_of_files(spark, tmp_path):
    from tidewell.operators import maintenance, retention

    root, other = tmp_path / "files", tmp_path / "files-other"
    for folder in (root / "dt=1", other):
        folder.mkdir(parents=True)
    for name, age in (("dt=1/old a.parquet", 100), ("dt=1/new.parquet", 1), ("dt=1/part.inprogress.1", 50), ("dt=1/stuck.inprogress.2", 500)):
        (root / name).write_text(name)
        os.utime(root / name, (10_000 - age, 10_000 - age))
    (other / "old.parquet").write_text("x")
    os.utime(other / "old.parquet", (1, 1))
    uri = f"file:{root}"
    due = maintenance.stale_files(readers.listing(spark, uri), (10_000 - 10) * 1000, (10_000 - 200) * 1000)
    run = lambda files, n, act: {r.path.rsplit("/", 1)[1]: r.outcome for r in retention.delete_files(files, uri, f"{tmp_path}/log{n}", act).collect()}
    assert set(run(due, 0, False).values()) == {"planned"} and len(list((root / "dt=1").iterdir())) == 4
    planned = spark.createDataFrame(due.toArrow())
    outside = spark.createDataFrame([(f"file:{other}/old.parquet", 1, 1000), (f"{uri}/../files-other/old.parquet", 1, 1000), (f"{uri}/dt=1/new.parquet", 8, 5), (f"{uri}/none.parquet", 1, 5), (f"{uri}/dt=1", 1, 5)], planned.schema)
    got = retention.delete_files(planned.unionByName(outside), uri, f"{tmp_path}/log1", True)
    assert sorted((r.path[len(uri):], r.outcome) for r in got.collect() if r.path.startswith(uri + "/")) == [("/../files-other/old.parquet", "refused"), ("/dt=1", "refused"), ("/dt=1/new.parquet", "changed"), ("/dt=1/old a.parquet", "deleted"), ("/dt=1/stuck.inprogress.2", "deleted"), ("/none.parquet", "gone")]
    assert (other / "old.parquet").exists() and sorted(p.name for p in (root / "dt=1").iterdir()) == ["new.parquet", "part.inprogress.1"]
    assert set(run(planned, 2, True).values()) == {"gone"} and run(maintenance.stale_files(readers.listing(spark, uri), (10_000 - 10) * 1000, (10_000 - 200) * 1000), 3, True) == {}


def test_counters_of_one_window_end(spark):
    """Of the records with one window's end the one counts that the first event found, in whatever order rows come; of records with one time, too, the one with the greatest load."""
    from test_streaming import CFG, CHR, PM

    event = lambda i, ts: (str(i), ts, "u", "a", "", "ATTACH", 0, -90.0, 1.0)
    record = lambda end, ts, load, tput=1.0: ("", "a", 0, end, ts, load, tput, 1, 0, 1, 0)
    events = [event(i, ts) for i, ts in enumerate((15, 25, 35, 45, 55))]
    records = [record(100, 10, 7.0), record(100, 20, 3.0), record(100, 50, 9.0), *(record(200, 40, load, tput) for load, tput in ((4.0, 9.0), (8.0, 2.0), (8.0, 3.0), (6.0, 1.0)))]
    cfg = spark.createDataFrame([], CFG)
    for chr_rows, pm_rows in ((events, records), (events[::-1], records[::-1])):
        chr_, pm = (spark.createDataFrame(rows, schema).coalesce(1) for rows, schema in ((chr_rows, CHR), (pm_rows, PM)))
        for block in (1000, 7):
            enriched = enrich.enrich(chr_, pm, cfg, R, block)
            assert sorted((r.event_ts, r.pm.prb_usage_dl, r.pm.throughput_dl_mbps) for r in enriched.collect()) == [(15, 7.0, 1.0), (25, 3.0, 1.0), (35, 3.0, 1.0), (45, 8.0, 3.0), (55, 9.0, 1.0)]
            row = kpi.kpi_from_enriched(enriched, 1000, "K").first()
            assert (row.pm_windows, row.avg_prb_usage_dl, row.throughput_dl_mbps_avg) == (2, 7.5, 2.0)


def test_means_half_way(spark):
    """The last bits of a sum don't decide how a mean is rounded, here and in the SQL."""
    import duckdb

    from tidewell.plans import telemetry

    means = [3.9615624999999995, 3.9615625, 3.9615625000000003, -104.33393749999999, -104.3339375, 0.1234564999]
    want = [3.961563, 3.961563, 3.961563, -104.333938, -104.333938, 0.123456]
    assert [r[0] for r in telemetry.half_up(spark.createDataFrame([(m,) for m in means], "m double").coalesce(1)).collect()] == want
    assert [duckdb.sql(f"select {telemetry._half_up_sql(f'{m!r}::double')}").fetchall()[0][0] for m in means] == want
