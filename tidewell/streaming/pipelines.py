"""The KPI, anomaly and enrichment paths as Structured Streaming queries.

KPIs aggregate the union of events and counters in one windowed aggregate, whose windows then chain into the
rollup; streaks and enrichment keep a small state for each key (timers.py has the KPI join by timers). Watermarks drop what comes late; the wait for the
other side of a window is part of the watermark's delay. In append mode the last windows stay open until the
watermark passes them, so closing() adds a row far in the future at the end of a finite input.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tidewell.functions.scalar import first_non_blank, ratio
from tidewell.operators.kpi import rollup_parts
from tidewell.params import DAY, Rules
from tidewell.streaming.order import in_order, in_parts, plain

#: Events may be OUT_OF_ORDER_S late; a window waits JOIN_WAIT_S more for the other side, so the watermark's delay is the sum.
OUT_OF_ORDER_S, JOIN_WAIT_S = 2, 10
DELAY = f"{OUT_OF_ORDER_S + JOIN_WAIT_S} seconds"
CHECKPOINT_S = 30
#: Sketches of users have 2^17 registers: a standard error of 0.29 %, so 2 % are seven of them, and 128 KB at most (a few bytes a user up to some 12,000).
USERS_LOG2 = 17


def idle_sources(spark: SparkSession, block: bool = True) -> None:
    """Whether a silent input holds back the common watermark (the default), or the busiest input alone moves it, so late rows of slower inputs may be dropped."""
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min" if block else "max")


def state_settings(spark: SparkSession) -> None:
    """Keep state in RocksDB with changelog checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def trigger_seconds(asked: float | None, file_sink: bool = False) -> float:
    """The checkpoint interval: CHECKPOINT_S unless a positive one is asked for; 180 s at most for file sinks."""
    seconds = asked if asked and asked > 0 else CHECKPOINT_S
    return min(seconds, 180) if file_sink else seconds


def sides(chr_: DataFrame, pm: DataFrame, delay: str | None = None) -> DataFrame:
    """Events and counters as one stream with event_time and side; counters count at their window's end less 1 ms.

    With a delay each side has its own watermark, and idle_sources() says how they go together. Configurations are
    no part of it: they are a changelog that kpi_with_cfg joins by version, so they never hold back the watermark.
    """
    late = lambda df: df.withWatermark("event_time", delay) if delay else df
    a = chr_.select(F.lit("chr").alias("side"), F.timestamp_millis("event_ts").alias("event_time"), "event_ts", "cell_id", "site_id", F.col("chr_id").cast("long").alias("seq"), "imsi", "event_type", "result_code", "rsrp", "sinr")
    b = pm.where("window_end_ts > 0 and window_end_ts > window_start_ts").select(F.lit("pm").alias("side"), F.timestamp_millis(F.col("window_end_ts") - 1).alias("event_time"), "event_ts", "cell_id", "site_id", F.col("window_end_ts").alias("seq"), "prb_usage_dl", "throughput_dl_mbps", "active_users", "dropped_connections", "handover_success", "handover_failure")
    return late(a).unionByName(late(b), allowMissingColumns=True)


def kpis(rows: DataFrame, rules: Rules, delay: str | None = DELAY, kind: str = "MIN_1", users: bool = False) -> DataFrame:
    """Windowed KPIs of sides(), batch or streaming: one row a cell and window with all measures of the batch KPIs, labelled by the sides that were there.

    Users are counted by a mergeable sketch (exact or one off for a few thousand, within 2 % beyond; USERS_LOG2), so
    the state of a window has a bound that doesn't grow with its users. Rows later than the delay are dropped. delay: None if the rows
    have watermarks already. users: keep the sketch as user_sketch, for rollups() to merge.
    """
    w = F.window("event_time", f"{rules.fact_ms} milliseconds")
    sketch = ([F.hll_sketch_agg("imsi", USERS_LOG2).alias("user_sketch")], ["user_sketch"]) if users else ([], [])
    return kpi_measures((rows.withWatermark("event_time", delay) if delay else rows).groupBy(w.alias("w"), "cell_id").agg(*kpi_sums(), *sketch[0]), kind, *sketch[1])


def kpi_sums() -> list[Column]:
    """Aggregates of sides() that KPIs are made of. Each counts one side only: over rows of the other it is null or 0."""
    is_chr, is_pm, attach = F.col("side") == "chr", F.col("side") == "pm", F.col("event_type") == "ATTACH"
    seen = lambda side: F.when(side & (F.col("event_ts") > 0), F.col("event_ts"))
    first = lambda side: F.min_by(F.when(side, F.col("site_id")), F.when(side, F.struct("event_time", "seq")))
    sums = {"rsrp_sum": "rsrp", "sinr_sum": "sinr", "prb_sum": "prb_usage_dl", "tput_sum": "throughput_dl_mbps", "drops": "dropped_connections", "ho_ok": "handover_success", "ho_bad": "handover_failure"}
    return [
        F.count(F.when(is_chr, 1)).alias("num_chr_events"), F.count(F.when(is_pm, 1)).alias("pm_n"), F.hll_sketch_estimate(F.hll_sketch_agg("imsi", USERS_LOG2)).alias("num_users"),
        first(is_chr).alias("chr_site"), first(is_pm).alias("pm_site"), F.count("rsrp").alias("rsrp_sample_count"), F.count("sinr").alias("sinr_sample_count"),
        F.count_if(is_chr & attach).alias("attach_attempts"), F.count_if(is_chr & attach & (F.col("result_code") == 0)).alias("attach_ok"), F.sum(F.greatest("active_users", F.when(is_pm, 0))).alias("active_sum"),
        *(F.sum(c).alias(n) for n, c in sums.items()),
        *(f(seen(side)).alias(f"{n}_{g}") for n, side in (("c", is_chr), ("p", is_pm)) for g, f in (("sum", F.sum), ("min", F.min), ("max", F.max), ("n", F.count)))]


def kpi_measures(out: DataFrame, kind: str, *more: str) -> DataFrame:
    """KPI rows from (w, cell_id, kpi_sums()); further columns come last."""
    quality = F.when(F.col("pm_n") == 0, "CHR_ONLY").when(F.col("num_chr_events") == 0, "PM_ONLY").otherwise("JOINED")
    over = lambda a, b: ratio(F.col(a), F.col(b))
    mean = F.expr("coalesce((coalesce(c_sum div nullif(c_n, 0) * c_n, 0) + coalesce(p_sum div nullif(p_n, 0) * p_n, 0)) div nullif(c_n + p_n, 0), 0)")
    return out.select(
        "w", F.unix_millis("w.start").alias("window_start_ts"), F.unix_millis("w.end").alias("window_end_ts"), F.lit(kind).alias("window_kind"), quality.alias("join_quality"), first_non_blank(F.col("chr_site"), F.col("pm_site")).alias("site_id"), "cell_id",
        "num_chr_events", "num_users", "rsrp_sample_count", "sinr_sample_count", "attach_attempts", over("rsrp_sum", "rsrp_sample_count").alias("avg_rsrp"), over("sinr_sum", "sinr_sample_count").alias("avg_sinr"),
        over("prb_sum", "pm_n").alias("avg_prb_usage_dl"), over("tput_sum", "pm_n").alias("throughput_dl_mbps_avg"), over("drops", "active_sum").alias("drop_rate"), ratio(F.col("ho_ok"), F.col("ho_ok") + F.col("ho_bad")).alias("ho_success_rate"), over("attach_ok", "attach_attempts").alias("attach_success_rate"),
        mean.alias("source_event_ts_avg"), F.coalesce(F.least("c_min", "p_min"), F.lit(0)).alias("source_event_ts_min"), F.coalesce(F.greatest("c_max", "p_max"), F.lit(0)).alias("source_event_ts_max"), (F.col("c_n") + F.col("p_n")).alias("source_event_count"), *more)


def rollups(rows: DataFrame, rules: Rules, kind: str = "MIN_5") -> DataFrame:
    """Rollup of kpis() into longer windows by the rules of the batch rollup, chained on the first windows' time.

    num_users is the sum over the windows, as in the batch; with the sketches of kpis(users=True) distinct_users says
    how many different users there were in the longer window, from sketches merged in state of fixed size.
    """
    children, _, parts = rollup_parts(rows, rules, kind)
    if "user_sketch" in rows.columns:
        parts = [*parts, F.hll_sketch_estimate(F.hll_union_agg("user_sketch")).alias("distinct_users")]
    out = children.groupBy(F.window("w", f"{rules.rollup_ms} milliseconds").alias("v"), "cell_id").agg(*parts)
    return out.withColumn("window_start_ts", F.unix_millis("v.start")).drop("v")


class Streaks(StatefulProcessor):
    """Streaks of bad evaluations of an entity; state: for each dimension the count, the time of the first bad one, whether the alarm went off.

    All dimensions of an entity share one key, because a key costs more than its rows do. A dimension's state goes when
    nothing has come for it for ttl_ms of the query's running time; its alarm is armed again then. A dimension whose
    last evaluation was good needs no state.
    """

    def __init__(self, needed: int, window_ms: int, ttl_ms: int | None):
        self.needed, self.window_ms, self.ttl_ms = needed, window_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("streak", "dimension ARRAY<STRING>, n ARRAY<INT>, first ARRAY<LONG>, active ARRAY<BOOLEAN>, touched ARRAY<LONG>", self.ttl_ms)

    def _hits(self, rows: Iterator[tuple], held: dict[str, tuple], now: int) -> Iterator[tuple]:
        """(dimension, ts, seq) of the alarms; afterwards held has the state of the dimensions that need one."""
        for dimension, mine in groupby(in_order(rows), key=itemgetter(0)):
            n, first, active, _ = held.pop(dimension, (0, 0, False, 0))
            for _, ts, seq, abnormal in mine:
                if not abnormal:
                    n, first, active = 0, 0, False
                    continue
                if n == 0 or ts - first > self.window_ms:
                    n, first = 1, ts
                else:
                    n += 1
                if n >= self.needed and not active:
                    active = True
                    yield dimension, ts, seq
            if n or active:
                held[dimension] = (min(n, 2**31 - 1), first, active, now)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, before = timerValues.getCurrentProcessingTimeInMs(), self.state.get()
        held = {d: tuple(more) for d, *more in zip(*before, strict=True)} if before else {}
        if self.ttl_ms is not None:
            held = {d: kept for d, kept in held.items() if now - kept[3] <= self.ttl_ms}
        for part in in_parts(self._hits(plain(rows, "dimension", "event_ts", "seq", "abnormal"), held, now)):
            yield pd.DataFrame([(key[0], *hit) for hit in part], columns=["entity_id", "dimension", "event_ts", "seq"])
        if held:
            self.state.update(([*held], *(list(c) for c in zip(*held.values(), strict=True))))
        elif before:
            self.state.clear()

    def close(self) -> None:
        pass


def _time_mode(bounded: bool) -> str:
    """Time limits of state need processing time, with which a query over what is there now never ends; so bounded queries keep their state, which ends with them."""
    return "none" if bounded else "processingTime"


def streaks(evaluations: DataFrame, needed: int, window_ms: int, bounded: bool = False) -> DataFrame:
    """Streaming twin of the batch streaks: (entity_id, dimension, event_ts, seq) at which a streak is complete. Across micro-batches the order is that of arrival."""
    return evaluations.select("entity_id", "dimension", "event_ts", "seq", "abnormal").groupBy("entity_id").transformWithStateInPandas(Streaks(needed, window_ms, None if bounded else max(window_ms, DAY)), "entity_id STRING, dimension STRING, event_ts LONG, seq LONG", "append", _time_mode(bounded))


class Enricher(StatefulProcessor):
    """Current configuration and latest counters of a cell, with time limits by event time.

    A configuration counts for cfg_ttl_ms after the cell's last event or configuration, counters for pm_ttl_ms. Once
    the watermark is past that no row can come that would still find them, and a timer clears the state.
    """

    def __init__(self, cfg_ttl_ms: int, pm_ttl_ms: int):
        self.cfg_ttl_ms, self.pm_ttl_ms = cfg_ttl_ms, pm_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cfg = handle.getValueState("cfg", "version LONG, touched LONG")
        self.pm = handle.getValueState("pm", "prb DOUBLE, at LONG")

    def _due(self) -> set[int]:
        """When the state that there is now may go."""
        ends = ((self.cfg, self.cfg_ttl_ms), (self.pm, self.pm_ttl_ms))
        return {state.get()[1] + ttl + 1 for state, ttl in ends if state.exists()}

    def _found(self, rows: Iterator[tuple], now: list) -> Iterator[tuple]:
        """(chr_id, ts, version, prb) of the events; now is [version, touched, prb, at] before and after."""
        version, touched, prb, at = now
        for ts, order, seq, known, load, change, tombstone in in_order(rows):
            if order == 1:
                prb, at = load if known else None, ts
                continue
            if touched is not None and ts - touched > self.cfg_ttl_ms:
                version = None
            touched = ts if touched is None else max(touched, ts)
            if order == 0:
                if tombstone:
                    version = None
                elif known and (version is None or change > version):
                    version = change
            else:
                live = at is not None and ts - at <= self.pm_ttl_ms
                yield str(seq), ts, version, prb if live else None
        now[:] = version, touched, prb, at

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self._due()
        now = [*(self.cfg.get() or (None, None)), *(self.pm.get() or (None, None))]
        # A cell's rows are never held at once, neither those that come in nor those that go out.
        for part in in_parts(self._found(plain(rows, "ts", "ord", "seq", "known", "prb", "version", "tombstone"), now)):
            ids, times, versions, loads = zip(*part, strict=True)
            yield pd.DataFrame({"cell_id": pd.Series([key[0]] * len(part), dtype=object), "chr_id": ids, "event_ts": times, "cfg_version": pd.array(versions, "Int64"), "pm_prb_usage_dl": pd.array(loads, "Float64")})
        version, touched, prb, at = now
        if touched is not None:
            self.cfg.update((version, touched))
        if at is not None:
            self.pm.update((prb, at))
        after = self._due()
        for due in before - after:
            self.handle.deleteTimer(due)
        for due in after - before:
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = expiredTimerInfo.getExpiryTimeInMs()
        for state, ttl in ((self.cfg, self.cfg_ttl_ms), (self.pm, self.pm_ttl_ms)):
            if state.exists() and state.get()[1] + ttl < now:
                state.clear()
        yield from ()

    def close(self) -> None:
        pass


def enrich(chr_: DataFrame, pm: DataFrame, cfg: DataFrame, rules: Rules, delay: str = "1 hour") -> DataFrame:
    """Streaming twin of the batch enrichment, over the union of the three streams keyed by cell.

    Rows go out in the micro-batch that brings them. Of counters with one time and window's end the greatest load counts.
    The delay says how late a row may come (later ones are dropped), and by how much state outlives its limit.
    """
    # No long and no boolean of a row is null, because pandas would make other numbers of the column.
    nothing = {"prb": F.lit(None).cast("double"), "version": F.lit(None).cast("long"), "tombstone": F.lit(False)}

    def row(df: DataFrame, ts: str, order: int, seq: str, **more: Column) -> DataFrame:
        prb, version, tombstone = (more.get(k, v) for k, v in nothing.items())
        return df.select("cell_id", F.col(ts).alias("ts"), F.timestamp_millis(ts).alias("event_time"), F.lit(order).alias("ord"), F.col(seq).cast("long").alias("seq"), F.coalesce(prb, version).isNotNull().alias("known"), F.coalesce(prb, F.lit(0.0)).alias("prb"), F.coalesce(version, F.lit(0)).alias("version"), F.coalesce(tombstone, F.lit(False)).alias("tombstone"))

    rows = row(chr_, "event_ts", 2, "chr_id").unionByName(row(pm, "event_ts", 1, "window_end_ts", prb=F.col("prb_usage_dl"))).unionByName(row(cfg, "effective_ts", 0, "cfg_seq", version=F.col("version").cast("long"), tombstone=F.col("tombstone")))
    return rows.withWatermark("event_time", delay).groupBy("cell_id").transformWithStateInPandas(Enricher(rules.cfg_ttl_ms, rules.pm_ttl_ms), "cell_id STRING, chr_id STRING, event_ts LONG, cfg_version LONG, pm_prb_usage_dl DOUBLE", "append", "EventTime")


def run_once(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a stream over all there is now into Parquet files at path, in as many micro-batches as the source's limits make, and wait for it."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_always(df: DataFrame, path: str, checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """Start a stream into Parquet files at path that looks for new rows every trigger_seconds()."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=f"{trigger_seconds(seconds, file_sink=True)} seconds").start()
