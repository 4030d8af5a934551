"""Streams over files give the rows of the batch operators."""

import pytest
from pyspark.sql import functions as F

from tidewell.operators import anomaly, enrich, kpi
from tidewell.params import SPARSE as R
from tidewell.params import Rules
from tidewell.sources.adapters import view
from tidewell.sources.readers import file_stream
from tidewell.streaming import pipelines as st

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    st.state_settings(spark)
    return tmp_path_factory.mktemp("streams")


def _stream(spark, folder, name, df, files=1):
    path = f"{folder}/{name}"
    df.coalesce(files).write.mode("overwrite").parquet(path)
    return file_stream(spark, path, df.schema)


def test_kpis_and_rollups(spark, folder):
    rows = st.sides(view(spark, SF, "chr"), view(spark, SF, "pm"))
    end = F.timestamp_millis(F.lit(4_000_000_000_000))
    closing = rows.limit(1).withColumns({"event_time": end, "cell_id": F.lit("CLOSING")})
    stream = _stream(spark, folder, "sides", rows.unionByName(closing))
    st.run_once(st.kpis(stream, R).drop("w"), f"{folder}/kpi", f"{folder}/kpi-cp").stop()
    key = lambda r: (r.window_start_ts, r.cell_id)
    got = {key(r): (r.join_quality, r.num_chr_events, r.num_users, round(r.avg_rsrp, 6)) for r in spark.read.parquet(f"{folder}/kpi").collect()}
    want = {key(r): (r.join_quality, r.num_chr_events, r.num_users, round(r.avg_rsrp, 6)) for r in st.kpis(rows, R).drop("w").collect()}
    assert got == want and {q for q, *_ in want.values()} == {"JOINED", "CHR_ONLY", "PM_ONLY"}
    st.run_once(st.rollups(st.kpis(stream, R), R), f"{folder}/roll", f"{folder}/roll-cp").stop()
    rolled = {key(r): (r.num_chr_events, r.num_users) for r in spark.read.parquet(f"{folder}/roll").collect()}
    assert rolled == {key(r): (r.num_chr_events, r.num_users) for r in st.rollups(st.kpis(rows, R), R).collect()}


def test_user_streaks(spark, folder):
    rows = anomaly.user_evaluations(view(spark, SF, "chr"), R).select("entity_type", "entity_id", "dimension", "event_ts", "seq", "abnormal")
    stream = _stream(spark, folder, "eval", rows.orderBy("event_ts"))
    st.run_once(st.streaks(stream.drop("entity_type"), R.user_consecutive, R.user_window_ms, bounded=True), f"{folder}/streaks", f"{folder}/streaks-cp").stop()
    key = lambda r: (r.entity_id, r.dimension, r.event_ts, r.seq)
    want = {key(r) for r in anomaly.streaks(rows, R.user_consecutive, R.user_window_ms).collect()}
    assert want and {key(r) for r in spark.read.parquet(f"{folder}/streaks").collect()} == want


def test_enrichment(spark, folder):
    tables = {n: view(spark, SF, n) for n in ("chr", "pm", "cfg")}
    streams = {n: _stream(spark, folder, n, df) for n, df in tables.items()}
    st.run_once(st.enrich(streams["chr"], streams["pm"], streams["cfg"], R), f"{folder}/enriched", f"{folder}/enriched-cp").stop()
    got = {r.chr_id: (r.cfg_version, r.pm_prb_usage_dl) for r in spark.read.parquet(f"{folder}/enriched").collect()}
    batch = enrich.enrich(tables["chr"], tables["pm"], tables["cfg"], R).select("chr_id", F.col("cfg.version").alias("v"), F.col("pm.prb_usage_dl").alias("p"))
    assert got == {r.chr_id: (r.v, r.p) for r in batch.collect()}


def test_intervals():
    assert [st.trigger_seconds(x) for x in (None, 0, -1, 5)] == [30, 30, 30, 5]
    assert st.trigger_seconds(600, file_sink=True) == 180


def test_probes_and_side_output(spark, folder):
    from tidewell.streaming import probes

    seen = []
    listener = probes.Progress(seen.append)
    spark.streams.addListener(listener)
    rows = spark.createDataFrame([("a", 1, 5), ("b", 2, None)], "chr_id string, event_ts long, cfg_version long")
    stream = probes.observed(_stream(spark, folder, "late", rows), "enrich", "event_ts")
    q = stream.writeStream.foreachBatch(probes.split_batches(f"{folder}/main", f"{folder}/side")).option("checkpointLocation", f"{folder}/late-cp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(f"{folder}/main").count() == 2 and [r.chr_id for r in spark.read.parquet(f"{folder}/side").collect()] == ["b"]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(listener)
    assert any(s["stage_id"] == "enrich" and s["records"] == 2 and s["max_ts"] == 2 for s in seen)
    twice = spark.createDataFrame([("x", 1000), ("x", 1000), ("y", 2000)], "anomaly_id string, event_ts long")
    st.run_once(probes.once(_stream(spark, folder, "twice", twice)), f"{folder}/once", f"{folder}/once-cp").stop()
    assert spark.read.parquet(f"{folder}/once").count() == 2
    assert probes.detected(twice).where("detection_ts > 0").count() == 3
    write = probes.upsert_batches(f"{folder}/keyed", ("anomaly_id",), ["day"], "event_ts")
    for _ in range(2):
        write(twice.withColumn("day", F.lit("d")), 0)
    assert spark.read.parquet(f"{folder}/keyed").count() == 2


def test_recovers_partitions(spark, folder):
    from tidewell.streaming.probes import recover_partitions

    spark.range(2).withColumn("dt", F.lit("d1")).write.partitionBy("dt").parquet(f"{folder}/ext")
    spark.sql("drop table if exists ext")
    spark.sql(f"create table ext (id bigint, dt string) using parquet partitioned by (dt) location '{folder}/ext'")
    recover_partitions(spark, "ext")
    assert spark.table("ext").count() == 2


def test_late_rows_are_dropped(spark, folder):
    """Late rows are held against the watermark of the batch before; the fourth micro-batch brings a row of a window that the watermark has closed, and one that it hasn't."""
    rows = st.sides(view(spark, SF, "chr"), view(spark, SF, "pm")).where("side = 'chr'").limit(1)
    at = lambda s, cell: rows.withColumns({"event_time": F.timestamp_millis(F.lit(s * 1000)), "event_ts": F.lit(s * 1000).cast("long"), "cell_id": F.lit(cell)})
    path = f"{folder}/ordered"
    for batch in (at(10, "a").unionByName(at(20, "a")), at(200, "a"), at(201, "a"), at(30, "a").unionByName(at(195, "b")), at(100_000, "end")):
        batch.coalesce(1).write.mode("append").parquet(path)
        __import__("time").sleep(1.1)  # the file source goes by modification time
    from tidewell.params import Rules

    q = st.run_once(st.kpis(file_stream(spark, path, rows.schema), Rules()).drop("w"), f"{folder}/late-kpi", f"{folder}/late-kpi-cp")
    got = {(r.cell_id, r.window_start_ts): r.num_chr_events for r in spark.read.parquet(f"{folder}/late-kpi").collect()}
    assert got == {("a", 0): 2, ("a", 180_000): 2, ("b", 180_000): 1}
    assert sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]) == 1


def test_own_watermarks_of_both_sides(spark, folder):
    st.idle_sources(spark, block=False)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max"
    st.idle_sources(spark)
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    chr_, pm = (_stream(spark, folder, f"own-{n}", view(spark, SF, n)) for n in ("chr", "pm"))
    rows = st.kpis(st.sides(chr_, pm, st.DELAY), R, None).drop("w")
    st.run_once(rows, f"{folder}/own-kpi", f"{folder}/own-kpi-cp").stop()
    mark = min(view(spark, SF, "chr").agg(F.max("event_ts")).first()[0], view(spark, SF, "pm").agg(F.max("window_end_ts") - 1).first()[0]) - 12_000
    want = st.kpis(st.sides(view(spark, SF, "chr"), view(spark, SF, "pm")), R).where(F.col("window_end_ts") <= mark)
    assert spark.read.parquet(f"{folder}/own-kpi").count() == want.count() > 0


def test_streaks_have_a_time_limit():
    class Handle:
        def __init__(self):
            self.limits = {}

        def getValueState(self, name, schema, ttl=None):  # noqa: N802
            self.limits[name] = ttl

    handle = Handle()
    st.Streaks(3, 5, 7).init(handle)
    assert handle.limits == {"streak": 7}


def _in_turn(spark, path, batches, schema):
    """A stream with one micro-batch for each list of rows; the file source goes by modification time."""
    for i, rows in enumerate(batches):
        df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(path)
        if i + 1 < len(batches):
            __import__("time").sleep(1.1)
    return file_stream(spark, path, spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema)


CHR = "chr_id string, event_ts long, imsi string, cell_id string, site_id string, event_type string, result_code int, rsrp double, sinr double"
PM = "site_id string, cell_id string, window_start_ts long, window_end_ts long, event_ts long, prb_usage_dl double, throughput_dl_mbps double, active_users int, dropped_connections int, handover_success int, handover_failure int"
CFG = "site_id string, cell_id string, effective_ts long, version long, tombstone boolean, center_lat double, center_lon double, cfg_seq long"


def _event(s, cell, n=1):
    return (str(n), s * 1000, "u", cell, "", "ATTACH", 0, -90.0, 1.0)


def _counter(s, cell):
    return ("", cell, s * 1000 - 10_000, s * 1000, s * 1000 - 1, 50.0, 1.0, 1, 0, 1, 0)


def _state(spark, checkpoint, name):
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).count()


def test_enrichment_state_expires(spark, folder):
    """A row of another cell moves the watermark past both limits; the first cell's state is then really gone, the other's stays."""
    rules = Rules()
    hour = 3600
    chr_ = _in_turn(spark, f"{folder}/x-chr", [[_event(1000, "a")], [_event(1000 + 2 * hour, "b", 2)], [_event(1000 + 40 * hour, "b", 3)], [_event(1000 + 41 * hour, "b", 4)]], CHR)
    pm = _in_turn(spark, f"{folder}/x-pm", [[_counter(900, "a")]], PM)
    cfg = _in_turn(spark, f"{folder}/x-cfg", [[("s", "a", 800_000, 5, False, 1.0, 1.0, 1), ("s", "b", 800_000, 6, False, 1.0, 1.0, 2)]], CFG)
    rows = st.enrich(chr_, pm, cfg, rules)
    q = rows.writeStream.format("parquet").option("path", f"{folder}/x-out").option("checkpointLocation", f"{folder}/x-cp").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.chr_id: (r.cfg_version, r.pm_prb_usage_dl) for r in spark.read.parquet(f"{folder}/x-out").collect()}
    assert got == {"1": (5, 50.0), "2": (6, None), "3": (None, None), "4": (None, None)}
    assert _state(spark, f"{folder}/x-cp", "cfg") == 1 and _state(spark, f"{folder}/x-cp", "pm") == 0


def test_enrichment_state_stays_within_limits(spark, folder):
    """A gap shorter than the limits clears nothing, though the query is a bounded one."""
    chr_ = _in_turn(spark, f"{folder}/y-chr", [[_event(1000, "a")], [_event(1000 + 500, "a", 2)]], CHR)
    pm = _in_turn(spark, f"{folder}/y-pm", [[_counter(1000, "a")]], PM)
    cfg = _in_turn(spark, f"{folder}/y-cfg", [[("s", "a", 800_000, 5, False, 1.0, 1.0, 1)]], CFG)
    st.run_once(st.enrich(chr_, pm, cfg, Rules()), f"{folder}/y-out", f"{folder}/y-cp").stop()
    assert {(r.chr_id, r.cfg_version, r.pm_prb_usage_dl) for r in spark.read.parquet(f"{folder}/y-out").collect()} == {("1", 5, 50.0), ("2", 5, 50.0)}
    assert _state(spark, f"{folder}/y-cp", "cfg") == 1 and _state(spark, f"{folder}/y-cp", "pm") == 1


def test_joined_windows_come_early(spark, folder):
    """The watermark is 2 s behind the newest row. At 65 s the first minute's joined row is out, its one-sided row only once the wait of 10 s is over, too; nothing waits in the state then but the last minute's facts."""
    from tidewell.streaming import timers

    chr_ = _in_turn(spark, f"{folder}/e-chr", [[_event(10, "both"), _event(20, "chr")], [_event(65, "tick")], [_event(75, "tick")]], CHR)
    pm = _in_turn(spark, f"{folder}/e-pm", [[_counter(30, "both"), _counter(40, "pm")]], PM)
    seen = []

    def collect(batch, number):
        seen.append((number, sorted((r.cell_id, r.join_quality, r.num_chr_events, round(r.avg_prb_usage_dl)) for r in batch.collect())))

    q = timers.early_kpis(chr_, pm, Rules()).writeStream.foreachBatch(collect).option("checkpointLocation", f"{folder}/e-cp").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = [r for _, r in seen if r]
    assert rows == [[("both", "JOINED", 1, 50)], [("chr", "CHR_ONLY", 1, 0), ("pm", "PM_ONLY", 0, 50)]]
    assert _state(spark, f"{folder}/e-cp", "waiting") == 0


def test_configuration_of_kpis(spark, folder):
    """The highest version counts, a tombstone hides it, and older versions never come back."""
    from tidewell.streaming import timers

    changes = [("s1", "a", 0, 1, False, 31.2, 121.4, 1), ("s3", "a", 0, 3, False, 31.9, 121.4, 2), ("s2", "a", 0, 2, False, 31.2, 121.4, 3), ("s9", "a", 0, 3, False, 30.0, 120.0, 4), ("t1", "b", 0, 1, False, 31.2, 121.4, 5), ("t4", "b", 0, 4, True, 31.2, 121.4, 6), ("t2", "b", 0, 2, False, 31.2, 121.4, 7)]
    chr_ = _in_turn(spark, f"{folder}/v-chr", [[_event(10, c) for c in "abc"], [_event(100, "tick")]], CHR)
    pm = _in_turn(spark, f"{folder}/v-pm", [[_counter(30, c) for c in "abc"]], PM)
    cfg = _in_turn(spark, f"{folder}/v-cfg", [changes[:2], changes[2:]], CFG)
    rows = timers.early_kpis(chr_, pm, Rules(), cfg)
    st.run_once(rows, f"{folder}/v-out", f"{folder}/v-cp").stop()
    got = {r.cell_id: (r.site_id, r.grid_id) for r in spark.read.parquet(f"{folder}/v-out").collect()}
    batch = kpi.kpi_with_cfg(kpi.kpi(*(spark.read.parquet(f"{folder}/v-{n}") for n in ("chr", "pm")), Rules()), spark.createDataFrame(changes, CFG))
    want = {r.cell_id: (r.site_id, r.grid_id) for r in batch.where("cell_id != 'tick'").collect()}
    assert got == want and got["a"][0] == "s3" and got["b"] == got["c"] == ("", "")


PLACED = "chr_id string, event_ts long, cell_id string, site_id string, event_type string, result_code int, rsrp double, latitude double, longitude double"


def test_coverage_holes_across_batches(spark, folder):
    """The count goes on from batch to batch, the hole is told once, and nothing is left of buckets that are over."""
    from tidewell.streaming import timers

    rules = Rules(coverage_ms=60_000, coverage_count=3)
    at = lambda i, s, lat=31.2, rsrp=-120.0: (str(i), s * 1000, "c", "s", "DATA", 0, rsrp, lat, 121.4)
    batches = [[at(1, 5), at(2, 4), at(3, 6, rsrp=-80.0), at(4, 9, lat=40.0)], [at(6, 12), at(5, 10), at(7, 13)], [at(8, 20), at(9, 70)], [at(10, 500)], [at(11, 900)]]
    stream = _in_turn(spark, f"{folder}/h-in", batches, PLACED)
    st.run_once(timers.coverage_holes(stream, rules), f"{folder}/h-out", f"{folder}/h-cp").stop()
    got = [(r.window_start_ts, r.event_ts, r.seq) for r in spark.read.parquet(f"{folder}/h-out").collect()]
    assert got == [(0, 10_000, 5)]
    assert [r.entity_id for r in anomaly.coverage_holes(spark.read.parquet(f"{folder}/h-in"), rules).where("event_ts = 10000").collect()] == [r.grid_id for r in spark.read.parquet(f"{folder}/h-out").collect()]
    assert _state(spark, f"{folder}/h-cp", "count") == 1


def test_handover_patterns_across_batches(spark, folder):
    from tidewell.streaming import timers

    rules = Rules(handover_attempts=4)
    rows = [(str(i), i * 7000, "ab"[i % 2], "s", "HANDOVER" if i % 5 else "DATA", int(i % 3 == 0), -90.0, 1.0, 1.0) for i in range(120)]
    stream = _in_turn(spark, f"{folder}/o-in", [rows[:50], rows[50:51], rows[51:]], PLACED)
    st.run_once(timers.handover_patterns(stream, rules), f"{folder}/o-out", f"{folder}/o-cp").stop()
    key = lambda r: (r.cell_id, r.chr_id, r.event_ts, r.attempts, r.failures)
    want = {key(r) for r in anomaly.handover_patterns(spark.createDataFrame(rows, PLACED), rules).collect()}
    assert want and {key(r) for r in spark.read.parquet(f"{folder}/o-out").collect()} == want
    assert 0 < _state(spark, f"{folder}/o-cp", "buckets") <= 2 * rules.handover_buckets


def test_distinct_users_of_a_stream(spark, folder):
    rows = st.sides(view(spark, SF, "chr"), view(spark, SF, "pm"))
    rolled = st.rollups(st.kpis(rows, R, users=True), R).select("cell_id", "window_start_ts", "num_users", "distinct_users")
    exact = {(r.cell_id, r.window_start_ts): r.users for r in kpi.distinct_users(view(spark, SF, "chr"), R.rollup_ms).collect()}
    for r in rolled.collect():
        n = exact.get((r.cell_id, r.window_start_ts), 0)
        assert abs(r.distinct_users - n) <= 0.02 * n and r.num_users >= n


def test_distinct_users_of_many(spark):
    """Windows of thousands of users stay within 2 %, merged ones too."""
    n, rules = 3000, Rules(fact_ms=60_000, rollup_ms=300_000)
    users = spark.range(20 * 5 * n).selectExpr(f"concat('c', id div {5 * n}) as cell_id", f"id div {n} % 5 * 60000 + 1 as event_ts", "concat('46000', lpad(cast(id as string), 10, '0')) as imsi")
    chr_ = users.selectExpr("'1' as chr_id", "event_ts", "imsi", "cell_id", "'' as site_id", "'ATTACH' as event_type", "0 as result_code", "-90d as rsrp", "1d as sinr")
    rows = st.kpis(st.sides(chr_, spark.createDataFrame([], PM)), rules, users=True)
    assert all(abs(r.num_users - n) <= 3 for r in rows.select("num_users").collect())
    rolled = st.rollups(rows, rules).select("distinct_users").collect()
    assert len(rolled) == 20 and all(abs(r.distinct_users - 5 * n) <= 0.02 * 5 * n for r in rolled)


def test_sketches_of_a_stream(spark, folder):
    from tidewell.operators import metrics

    rows = [("s", t * 1000, 1000, 1000 + t) for t in range(300)]
    batches = [rows[:150], rows[150:], [("end", 10**7, 0, 0)], [("end", 10**7 + 1, 0, 0)]]
    stream = _in_turn(spark, f"{folder}/k-in", batches, "stage_id string, updated_at long, source_ts long, observed_ts long")
    sketches = metrics.latency_sketches(stream.withColumn("event_time", F.timestamp_millis("updated_at")).withWatermark("event_time", "1 second"), 60_000)
    st.run_once(sketches, f"{folder}/k-out", f"{folder}/k-cp").stop()
    got = metrics.merged_percentiles(spark.read.parquet(f"{folder}/k-out"), "stage_id").collect()
    assert [tuple(r) for r in got] == [("s", 300, 149, 284, 296, 299)]


def test_routes_change_while_the_stream_runs(spark, folder):
    """Two versions of a route and events between them; an older version changes nothing, a cell without a route has no shift."""
    from tidewell.operators import skew
    from tidewell.streaming import timers

    events = [("1", 5, "a"), ("2", 15, "a"), ("3", 15, "b")], [("4", 25, "a"), ("5", 26, "a")], [("6", 40, "a")]
    routes = [("a", 3, 1, 10), ("a", 5, 2, 20)], [("a", 9, 1, 30)], [("a", 6, 3, 35)]
    got_events = _in_turn(spark, f"{folder}/r-ev", events, "chr_id string, event_ts long, cell_id string")
    got_routes = _in_turn(spark, f"{folder}/r-rt", routes, "cell_id string, shift int, routing_version long, ts long")
    st.run_once(timers.routed(got_events, got_routes, 64, salts=3), f"{folder}/r-out", f"{folder}/r-cp").stop()
    got = {r.chr_id: (r.shift, r.vbucket) for r in spark.read.parquet(f"{folder}/r-out").collect()}
    assert {k: v[0] for k, v in got.items()} == {"1": 0, "2": 3, "3": 0, "4": 5, "5": 5, "6": 6}
    plain = skew.routed(spark.createDataFrame(events[0][1:2], "chr_id string, event_ts long, cell_id string"), spark.createDataFrame([("a", 3)], "cell_id string, shift int"), 64).first()
    assert got["2"][1] == plain.vbucket


def test_samples_of_a_running_stream(spark, folder):
    """A stream leaves samples by subtask and of its connector, which the queries over samples read."""
    from tidewell.operators import metrics
    from tidewell.streaming import probes

    log = probes.SampleLog()
    listener = probes.Progress(log)
    spark.streams.addListener(listener)
    batches = [[_event(10 + i, "ab"[i % 2], i) for i in range(20)], [_event(100 + i, "a", 50 + i) for i in range(7)]]
    stream = _in_turn(spark, f"{folder}/s-in", batches, CHR).withColumn("event_time", F.timestamp_millis("event_ts")).withWatermark("event_time", "1 second")
    table, out = f"{folder}/s-samples", f"{folder}/s-out"
    write = probes.sampled_batches(lambda b, n: b.write.mode("append").parquet(out), table, "run-1", "kpi-1m", "event_ts")
    q = stream.repartition(3).writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/s-cp").trigger(availableNow=True).start()
    q.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(listener)
    assert log.write(spark, table) >= 4 and log.write(spark, table) == 0
    samples = probes.read_samples(spark, table)
    own = samples.where("run_id = 'run-1'")
    assert own.agg(F.sum("records")).first()[0] == 27 == spark.read.parquet(out).count() and own.select("subtask").distinct().count() > 1
    rolled = {r.stage_id: r for r in metrics.stage_rollup(samples).collect()}
    assert rolled["kpi-1m"].p95_ms > 10**9 and set(rolled) == {"kpi-1m", "sink-connector-write", "sink-connector-commit"}
    found = {r.stage_id: r for r in metrics.connectors(samples).collect()}
    assert found["sink-connector-write"].samples >= 2 and found["sink-connector-write"].p95 > 0 and found["sink-connector-commit"].status == "healthy"
    assert samples.where("updated_at < 1600000000000").count() == 0 and samples.where("stage_id = 'sink-connector-write' and lag_ms > 0").count() >= 1


def test_stream_that_goes_on(spark, folder):
    """run_always() takes up files that come while it runs."""
    rows = view(spark, SF, "chr").select("chr_id").limit(3)
    stream = _stream(spark, folder, "on", rows)
    q = st.run_always(stream, f"{folder}/on-out", f"{folder}/on-cp", seconds=0.2)
    try:
        q.processAllAvailable()
        rows.write.mode("append").parquet(f"{folder}/on")
        q.processAllAvailable()
        assert spark.read.parquet(f"{folder}/on-out").count() == 6 and q.isActive
    finally:
        q.stop()


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 1000, 1001])
def test_rows_in_order_from_a_file(n):
    """Runs that don't fit come back from the file in order, with every value as it was."""
    import random

    from tidewell.streaming.order import in_order

    rng = random.Random(n)
    rows = [(rng.randrange(50), rng.choice("äb"), i, rng.random(), bool(i % 2)) for i in range(n)]
    assert list(in_order(iter(rows), held=100, block=7)) == sorted(rows)


def test_streaks_of_all_dimensions_share_a_key(spark, folder):
    """The streaks go on from batch to batch; there is one state an entity, none where every dimension was good last."""
    batches = [[(u, d, 10 * b + t, 0, (int(u) + b + t) % 4 > 0) for u in ("0", "1", "2") for d in "xyz" for t in range(9)] for b in range(3)]
    batches.append([("0", "x", 100, 0, False), ("3", "x", 100, 0, False)])
    schema = "entity_id string, dimension string, event_ts long, seq long, abnormal boolean"
    stream = _in_turn(spark, f"{folder}/sk-in", batches, schema)
    st.run_once(st.streaks(stream, 3, 5, bounded=True), f"{folder}/sk-out", f"{folder}/sk-cp").stop()
    want = anomaly.streaks(spark.createDataFrame(sum(batches, []), schema).withColumn("entity_type", F.lit("")), 3, 5)
    key = lambda r: (r.entity_id, r.dimension, r.event_ts, r.seq)
    assert sorted(map(key, spark.read.parquet(f"{folder}/sk-out").collect())) == sorted(map(key, want.collect())) != []
    assert _state(spark, f"{folder}/sk-cp", "streak") == 2  # user 2 ends well


def test_a_silent_dimension_is_forgotten():
    """The time limit goes by dimension, though the entity's other ones go on."""
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import TimerValues

    class State:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    processor = st.Streaks(2, 1000, 60)
    processor.state = State()

    def hits(now, *rows):
        frame = pd.DataFrame(rows, columns=["dimension", "event_ts", "seq", "abnormal"])
        return [(r.dimension, r.event_ts) for f in processor.handleInputRows(("u",), iter([frame]), TimerValues(now, 0)) for r in f.itertuples()]

    assert hits(0, ("x", 1, 0, True), ("y", 1, 0, True)) == []
    assert hits(50, ("y", 2, 0, True)) == [("y", 2)]
    assert hits(100, ("x", 3, 0, True), ("y", 3, 0, True)) == []
    assert hits(110, ("x", 4, 0, True), ("y", 4, 0, False)) == [("x", 4)]
    assert hits(120, ("x", 5, 0, False)) == [] and processor.state.value is None


def test_enrichment_of_a_busy_cell_holds_few_rows():
    """A cell's rows of a micro-batch are never held at once: the memory for 200,000 is that for the rows that are sorted at a time."""
    import tracemalloc

    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import TimerValues

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, set()

        def getValueState(self, name, schema, ttl=None):  # noqa: N802
            return self.states.setdefault(name, State())

        def registerTimer(self, at):  # noqa: N802
            self.timers.add(at)

        def deleteTimer(self, at):  # noqa: N802
            self.timers.remove(at)

    n, size, handle = 200_000, 10_000, Handle()
    processor = st.Enricher(10**9, 50)
    processor.init(handle)

    def frames():
        for k in range(0, n, size):
            # The order of time backwards, a counter every 100 rows, a configuration every 1,000.
            ts = range(n - k, n - k - size, -1)
            kind = [0 if t % 1000 == 0 else 1 if t % 100 == 0 else 2 for t in ts]
            yield pd.DataFrame({"cell_id": "c", "ts": ts, "ord": kind, "seq": ts, "known": [o < 2 for o in kind], "prb": [float(t) if o == 1 else 0.0 for t, o in zip(ts, kind, strict=True)], "version": [t if o == 0 else 0 for t, o in zip(ts, kind, strict=True)], "tombstone": False})

    tracemalloc.start()
    try:
        seen = at = 0
        for frame in processor.handleInputRows(("c",), frames(), TimerValues(-1, 0)):
            assert len(frame) <= size
            for r in frame.iloc[::997].itertuples(index=False):
                t, last = r.event_ts, r.event_ts // 100 * 100
                assert r.chr_id == str(t) and t > at
                assert (None if r.cfg_version is pd.NA else r.cfg_version) == (t // 1000 * 1000 or None)
                assert (None if r.pm_prb_usage_dl is pd.NA else r.pm_prb_usage_dl) == (float(last) if last % 1000 and t - last <= 50 else None)
            seen, at = seen + len(frame), int(frame.event_ts.iloc[-1])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == n - n // 100 and peak < 60 * 2**20
    assert handle.states["cfg"].value == (n, n) and handle.states["pm"].value == (n - 100.0, n - 100) and handle.timers == {n + 10**9 + 1, n - 100 + 51}


def test_enrichment_of_odd_rows(spark, folder):
    """Counters that tie count by load, a measure that is missing stays missing, and a configuration without a version counts for none."""
    chr_ = _in_turn(spark, f"{folder}/z-chr", [[_event(1000, "a", 2**60 + 1), _event(1001, "b", 2), _event(1002, "c", 3)]], CHR)
    counter = lambda cell, load: ("", cell, 0, 999_000, 999_000, load, 1.0, 1, 0, 1, 0)
    pm = _in_turn(spark, f"{folder}/z-pm", [[counter("a", 9.0), counter("a", 4.0), counter("a", None), counter("b", None)]], PM)
    cfg = _in_turn(spark, f"{folder}/z-cfg", [[("s", "a", 800_000, 2**60 + 3, None, 1.0, 1.0, 1), ("s", "b", 800_000, None, False, 1.0, 1.0, 2), ("s", "c", 800_000, 0, False, 1.0, 1.0, 3)]], CFG)
    st.run_once(st.enrich(chr_, pm, cfg, Rules()), f"{folder}/z-out", f"{folder}/z-cp").stop()
    got = {r.chr_id: (r.cell_id, r.event_ts, r.cfg_version, r.pm_prb_usage_dl) for r in spark.read.parquet(f"{folder}/z-out").collect()}
    assert got == {str(2**60 + 1): ("a", 1_000_000, 2**60 + 3, 9.0), "2": ("b", 1_001_000, None, None), "3": ("c", 1_002_000, 0, None)}


def test_handovers_and_routes_of_odd_rows(spark, folder):
    """A handover without a result counts as no failure, as in the batch; events without an id go through, and a route without a version counts for none."""
    from tidewell.streaming import timers

    rules = Rules(handover_attempts=2)
    rows = [(str(i), 1000 + i * 100, "a", "s", "HANDOVER", None if i % 3 == 0 else 1, -90.0, 1.0, 1.0) for i in range(9)]
    st.run_once(timers.handover_patterns(_in_turn(spark, f"{folder}/p-in", [rows], PLACED), rules), f"{folder}/p-out", f"{folder}/p-cp").stop()
    key = lambda r: (r.chr_id, r.attempts, r.failures)
    want = sorted(map(key, anomaly.handover_patterns(spark.createDataFrame(rows, PLACED), rules).collect()))
    assert want and sorted(map(key, spark.read.parquet(f"{folder}/p-out").collect())) == want
    events = _in_turn(spark, f"{folder}/w-ev", [[(None, 5, "a"), ("x", 5, "a"), (None, 5, "a")]], "chr_id string, event_ts long, cell_id string")
    routes = _in_turn(spark, f"{folder}/w-rt", [[("a", 3, 1, 1), ("a", 4, None, 2)]], "cell_id string, shift int, routing_version long, ts long")
    st.run_once(timers.routed(events, routes, 64, salts=1), f"{folder}/w-out", f"{folder}/w-cp").stop()
    assert sorted(((r.chr_id or "", r.shift) for r in spark.read.parquet(f"{folder}/w-out").collect())) == [("", 3), ("", 3), ("x", 3)]
