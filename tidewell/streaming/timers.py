"""Stateful streams with event-time timers: early joined KPI rows with versioned configuration, coverage holes, handover patterns and routing by version.

What is heavy (sums of windows, ratios, geohashes) is done by Spark before and after; the processors here only hold
what waits. All of them go by event time, so a query over what is there now comes to its end, and state leaves
when the watermark says that nothing can need it any more.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.functions.scalar import bucket_start, first_non_blank, geohash, shifted_bucket, virtual_bucket, weak_signal
from tidewell.params import Rules
from tidewell.streaming.order import in_order, in_parts, plain
from tidewell.streaming.pipelines import JOIN_WAIT_S, OUT_OF_ORDER_S, kpi_measures, kpi_sums, sides


class MinuteJoin(StatefulProcessor):
    """Joins the event fact and the counter fact of a cell's window.

    A joined row goes out with the second of the two facts; a fact that stays alone goes out when the watermark
    passes the window's end by wait_ms. Configurations keep the highest version seen, ties the first; a tombstone
    keeps its version too, so older ones never come back. A row has the configuration known when it goes out.
    """

    def __init__(self, fields: list[StructField], wait_ms: int):
        self.fields, self.wait_ms = fields, wait_ms
        self.schema = StructType([*StructType().add("cell_id", "string").add("window_end_ts", "long").add("cfg_site", "string").add("cfg_grid", "string").fields, *fields])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "window_end_ts LONG", StructType([StructField("side", StringType()), *self.fields]))
        self.cfg = handle.getValueState("cfg", "version LONG, tombstone BOOLEAN, cfg_site STRING, cfg_grid STRING")

    def _row(self, key: tuple, end: int, fact: tuple, other: tuple | None = None) -> Row:
        cfg = self.cfg.get() if self.cfg.exists() else None
        site, grid = (cfg[2], cfg[3]) if cfg and not cfg[1] else (None, None)
        if other:
            # Each sum is null or 0 on the side that has none of it.
            fact = tuple(b if a is None else a if b is None else max(a, b) for a, b in zip(fact, other, strict=True))
        return Row(*self.schema.fieldNames())(key[0], end, site, grid, *fact)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        # Configurations first, so that facts of the same micro-batch find them. A cell has two facts a window.
        for row in sorted(rows, key=lambda r: (r["side"] != "cfg", r["seq"])):
            if row["side"] == "cfg":
                if not self.cfg.exists() or row["version"] > self.cfg.get()[0]:
                    self.cfg.update((row["version"], row["tombstone"], row["cfg_site"], row["cfg_grid"]))
                continue
            end, fact = row["window_end_ts"], tuple(row[f.name] for f in self.fields)
            before = self.waiting.getValue((end,)) if self.waiting.containsKey((end,)) else None
            if before and before[0] != row["side"]:
                yield self._row(key, end, fact, tuple(before[1:]))
                self.waiting.removeKey((end,))
                self.handle.deleteTimer(end + self.wait_ms)
            else:
                self.waiting.updateValue((end,), (row["side"], *fact))
                self.handle.registerTimer(end + self.wait_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        end = expiredTimerInfo.getExpiryTimeInMs() - self.wait_ms
        if self.waiting.containsKey((end,)):
            yield self._row(key, end, tuple(self.waiting.getValue((end,))[1:]))
            self.waiting.removeKey((end,))

    def close(self) -> None:
        pass


def early_kpis(chr_: DataFrame, pm: DataFrame, rules: Rules, cfg: DataFrame | None = None, kind: str = "MIN_1") -> DataFrame:
    """KPI rows of streams: joined windows when the watermark, OUT_OF_ORDER_S behind the newest row, passes their end, one-sided ones JOIN_WAIT_S later.

    With a configuration changelog the rows have the grid and, where they have none, the site of the cell's
    configuration, as kpi_with_cfg() gives them. The changelog has no event time here: it is never late and never
    holds back the watermark. Facts are windowed aggregates, so a busy cell sends two rows a window into the join.
    """
    facts = sides(chr_, pm).withWatermark("event_time", f"{OUT_OF_ORDER_S} seconds").groupBy(F.window("event_time", f"{rules.fact_ms} milliseconds").alias("w"), "cell_id", "side").agg(*kpi_sums())
    fields = [StructField(f.name, f.dataType) for f in facts.schema.fields if f.name not in ("w", "cell_id", "side")]
    end = F.unix_millis("w.end")
    rows = facts.select("cell_id", "side", F.window_time("w").alias("event_time"), end.alias("window_end_ts"), end.alias("seq"), *(f.name for f in fields), F.lit(None).cast("long").alias("version"), F.lit(None).cast("boolean").alias("tombstone"), *(F.lit(None).cast("string").alias(c) for c in ("cfg_site", "cfg_grid")))
    if cfg is not None:
        changes = cfg.select("cell_id", F.lit("cfg").alias("side"), F.lit(None).cast("timestamp").alias("event_time"), F.col("cfg_seq").cast("long").alias("seq"), F.col("version").cast("long").alias("version"), "tombstone", F.col("site_id").alias("cfg_site"), geohash(F.col("center_lat"), F.col("center_lon")).alias("cfg_grid"))
        rows = rows.unionByName(changes, allowMissingColumns=True)
    processor = MinuteJoin(fields, JOIN_WAIT_S * 1000)
    joined = rows.groupBy("cell_id").transformWithState(processor, processor.schema, "append", "EventTime")
    window = F.struct(F.timestamp_millis(F.col("window_end_ts") - rules.fact_ms).alias("start"), F.timestamp_millis("window_end_ts").alias("end"))
    out = kpi_measures(joined.withColumn("w", window), kind, "cfg_site", "cfg_grid").drop("w")
    if cfg is None:
        return out.drop("cfg_site", "cfg_grid")
    return out.withColumns({"grid_id": F.coalesce("cfg_grid", F.lit("")), "site_id": first_non_blank(F.col("site_id"), F.col("cfg_site"))}).drop("cfg_site", "cfg_grid")


class Holes(StatefulProcessor):
    """Counts the weak-signal events of a grid cell's time bucket and tells the one that reaches the count, once.

    The state is a number; a timer drops it when no event of the bucket can come any more.
    """

    def __init__(self, needed: int, length_ms: int):
        self.needed, self.length_ms = needed, length_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        before = self.count.get()[0] if self.count.exists() else 0
        if not self.count.exists():
            self.handle.registerTimer(key[1] + self.length_ms)
        n, missing = 0, self.needed - before
        # Only the rows up to the one that reaches the count are ever held.
        first: list[tuple] = []
        for row in rows:
            n += 1
            if missing > 0:
                heapq.heappush(first, _Last((row["event_ts"], row["seq"], row["site_id"], row["cell_id"], row["latitude"], row["longitude"])))
                if len(first) > missing:
                    heapq.heappop(first)
        if 0 < missing <= n:
            yield Row("grid_id", "window_start_ts", "event_ts", "seq", "site_id", "cell_id", "latitude", "longitude")(*key, *first[0].row)
        self.count.update((before + n,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:  # noqa: N802, N803
        self.count.clear()
        yield from ()

    def close(self) -> None:
        pass


class _Last:
    """A row that a heap gives out first if it is the last in time."""

    def __init__(self, row: tuple):
        self.row = row

    def __lt__(self, other: _Last) -> bool:
        return self.row[:2] > other.row[:2]


def coverage_holes(chr_: DataFrame, rules: Rules, delay: str = f"{OUT_OF_ORDER_S} seconds") -> DataFrame:
    """Streaming twin of the batch coverage holes. Inside a micro-batch events count by time, across them as they come."""
    weak = chr_.where(weak_signal(F.col("rsrp"), rules.rsrp_min)).select(geohash(F.col("latitude"), F.col("longitude")).alias("grid_id"), bucket_start("event_ts", rules.coverage_ms).alias("window_start_ts"), F.timestamp_millis("event_ts").alias("event_time"), "event_ts", F.col("chr_id").cast("long").alias("seq"), "site_id", "cell_id", "latitude", "longitude")
    schema = "grid_id STRING, window_start_ts LONG, event_ts LONG, seq LONG, site_id STRING, cell_id STRING, latitude DOUBLE, longitude DOUBLE"
    return weak.withWatermark("event_time", delay).groupBy("grid_id", "window_start_ts").transformWithState(Holes(rules.coverage_count, rules.coverage_ms), schema, "append", "EventTime")


class Handovers(StatefulProcessor):
    """Attempts and failures of a cell's handovers in its latest buckets; tells each handover at which the failure rate is too high.

    A bucket's two numbers leave with a timer when the last bucket that looks back at it is over.
    """

    def __init__(self, rules: Rules):
        self.rules = rules

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getMapState("buckets", "bucket LONG", "attempts LONG, failures LONG")

    def _found(self, key: Any, rows: Iterator[tuple], held: dict[int, list], touched: set[int]) -> Iterator[tuple]:
        """The handovers that are told; held and touched have the buckets afterwards."""
        r = self.rules
        for ts, seq, failed in in_order(rows):
            bucket = ts // r.burst_ms
            mine = held.setdefault(bucket, [0, 0])
            mine[0] += 1
            mine[1] += failed
            touched.add(bucket)
            attempts, failures = (sum(held.get(b, (0, 0))[i] for b in range(bucket - r.handover_buckets + 1, bucket + 1)) for i in (0, 1))
            if attempts >= r.handover_attempts and failures / attempts > r.handover_rate:
                yield key[0], str(seq), ts, attempts, failures

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = {k[0]: list(v) for k, v in self.buckets.iterator()}
        touched: set[int] = set()
        for part in in_parts(self._found(key, plain(rows, "event_ts", "seq", "failed"), held, touched)):
            yield pd.DataFrame(part, columns=["cell_id", "chr_id", "event_ts", "attempts", "failures"])
        for bucket in touched:
            if not self.buckets.containsKey((bucket,)):
                self.handle.registerTimer(self._due(bucket))
            self.buckets.updateValue((bucket,), tuple(held[bucket]))

    def _due(self, bucket: int) -> int:
        return (bucket + self.rules.handover_buckets) * self.rules.burst_ms

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.buckets.removeKey((expiredTimerInfo.getExpiryTimeInMs() // self.rules.burst_ms - self.rules.handover_buckets,))
        yield from ()

    def close(self) -> None:
        pass


def handover_patterns(chr_: DataFrame, rules: Rules, delay: str = f"{OUT_OF_ORDER_S} seconds") -> DataFrame:
    """Streaming twin of the batch handover patterns. Inside a micro-batch handovers count by time, across them as they come."""
    rows = chr_.where("event_type = 'HANDOVER'").select("cell_id", "event_ts", F.timestamp_millis("event_ts").alias("event_time"), F.col("chr_id").cast("long").alias("seq"), F.coalesce((F.col("result_code") != 0).cast("int"), F.lit(0)).alias("failed"))
    return rows.withWatermark("event_time", delay).groupBy("cell_id").transformWithStateInPandas(Handovers(rules), "cell_id STRING, chr_id STRING, event_ts LONG, attempts LONG, failures LONG", "append", "EventTime")


class Routes(StatefulProcessor):
    """Gives each event the shift of the highest routing version that its cell had by then; the state is that version and its shift."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.route = handle.getValueState("route", "version LONG, shift INT")

    def _found(self, rows: Iterator[tuple], now: list) -> Iterator[tuple]:
        """(chr_id, ts, shift) of the events; now is [version, shift] before and after. A route counts from its own time on."""
        for ts, event, version, shift, named, chr_id in in_order(rows):
            if event:
                yield chr_id if named else None, ts, now[1]
            elif now[0] is None or version > now[0]:
                now[:] = version, shift

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now = list(self.route.get() or (None, 0))
        for part in in_parts(self._found(plain(rows, "ts", "event", "version", "shift", "named", "chr_id"), now)):
            yield pd.DataFrame([(key[0], *row) for row in part], columns=["cell_id", "chr_id", "event_ts", "shift"])
        if now[0] is not None:
            self.route.update(tuple(now))

    def close(self) -> None:
        pass


def routed(events: DataFrame, routing: DataFrame, n: int, salts: int = 8) -> DataFrame:
    """(cell_id, chr_id, event_ts, shift, vbucket): streaming twin of skew.routed() with a routing stream (cell_id, shift, routing_version, ts) that changes while it runs.

    A busy cell's events are dealt over `salts` keys, each of which gets every route of the cell; their order inside a
    cell doesn't matter here. Across micro-batches a route counts from its arrival, inside one from its time.
    """
    event = events.select("cell_id", F.pmod(F.xxhash64("chr_id"), F.lit(salts)).cast("int").alias("salt"), F.col("event_ts").alias("ts"), F.lit(True).alias("event"), F.col("chr_id").isNotNull().alias("named"), F.coalesce("chr_id", F.lit("")).alias("chr_id"), F.lit(0).cast("long").alias("version"), F.lit(0).alias("shift"))
    route = routing.where("routing_version is not null").select("cell_id", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "ts", F.lit(False).alias("event"), F.lit(False).alias("named"), F.lit("").alias("chr_id"), F.col("routing_version").cast("long").alias("version"), F.col("shift").cast("int").alias("shift"))
    found = event.unionByName(route).groupBy("cell_id", "salt").transformWithStateInPandas(Routes(), "cell_id STRING, chr_id STRING, event_ts LONG, shift INT", "append", "None")
    return found.withColumn("vbucket", shifted_bucket(virtual_bucket(F.col("cell_id"), n), F.col("shift"), n))
