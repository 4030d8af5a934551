"""Key skew: load by virtual bucket, imbalance between workers, and recommendations to re-map hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalar import bucket_start, shifted_bucket, virtual_bucket

OVERLOAD, IDLE, OVERLOAD_MS, TOP_BUCKETS, REBALANCE_MS = 1.5, 0.8, 60_000, 3, 300_000


def routed(events: DataFrame, routing: DataFrame, n: int) -> DataFrame:
    """Events with their virtual bucket, shifted as the routing table (cell_id, shift) says; no row there means no shift."""
    rows = events.join(routing, "cell_id", "left").withColumn("shift", F.coalesce("shift", F.lit(0)))
    return rows.withColumn("vbucket", shifted_bucket(virtual_bucket(F.col("cell_id"), n), F.col("shift"), n))


def bucket_load(events: DataFrame, n: int, slot_ms: int) -> DataFrame:
    """Events, and events a second, by time slot and virtual bucket; with the hottest key (ties: the greatest)."""
    keyed = events.withColumns({"vbucket": virtual_bucket(F.col("cell_id"), n), "slot_ts": bucket_start("event_ts", slot_ms)})
    by_key = keyed.groupBy("slot_ts", "vbucket", "cell_id").agg(F.count("*").alias("n"))
    return by_key.groupBy("slot_ts", "vbucket").agg(F.sum("n").alias("events"), (F.sum("n") / (slot_ms / 1000)).alias("eps"), F.max_by("cell_id", F.struct("n", "cell_id")).alias("hot_key"))


def merge_heartbeats(heartbeats: DataFrame, slot_ms: int) -> DataFrame:
    """One heartbeat a worker and slot: eps and the arrays of bucket loads summed, the hotspot of the hottest one (ties: the latest)."""
    rows = heartbeats.withColumn("slot_ts", bucket_start("ts", slot_ms))
    heads = rows.groupBy("worker", "slot_ts").agg(F.sum("eps").alias("eps"), F.max_by("hot_key", F.struct("eps", "ts", "hot_key")).alias("hot_key"))
    cells = rows.select("worker", "slot_ts", F.posexplode("loads").alias("pos", "load")).groupBy("worker", "slot_ts", "pos").agg(F.sum("load").alias("load"))
    loads = cells.groupBy("worker", "slot_ts").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "load"))), lambda x: x["load"]).alias("loads"))
    return heads.join(loads, ["worker", "slot_ts"], "left")


def imbalance(loads: DataFrame) -> DataFrame:
    """(worker, slot_ts, eps) with the slot's median, its max / median (1 for a median of 0) and whether the worker is overloaded."""
    slots = loads.groupBy("slot_ts").agg(F.median("eps").alias("median_eps"), F.max("eps").alias("max_eps"))
    ratio = F.when(F.col("median_eps") > 0, F.col("max_eps") / F.col("median_eps")).otherwise(1.0)
    return loads.join(slots, "slot_ts").withColumns({"imbalance": ratio, "overloaded": (F.col("median_eps") > 0) & (F.col("eps") > OVERLOAD * F.col("median_eps"))})


def overload_since(loads: DataFrame) -> DataFrame:
    """imbalance() with the time since when a worker has been overloaded without a break; null when it isn't."""
    w = Window.partitionBy("worker").orderBy("slot_ts")
    rows = imbalance(loads).withColumn("island", F.count_if(~F.col("overloaded")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    since = F.min(F.when(F.col("overloaded"), F.col("slot_ts"))).over(Window.partitionBy("worker", "island").orderBy("slot_ts").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("since", F.when(F.col("overloaded"), since)).drop("island")


def top_buckets(bucket_loads: DataFrame) -> DataFrame:
    """The TOP_BUCKETS most loaded buckets of each worker and slot (ties: the lowest number)."""
    w = Window.partitionBy("worker", "slot_ts").orderBy(F.desc("load"), "vbucket")
    return bucket_loads.where("load > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_BUCKETS)


def rebalance(loads: DataFrame, buckets: DataFrame, hotspots: DataFrame, n: int, workers: int, every_ms: int = REBALANCE_MS) -> DataFrame:
    """Which key of which overloaded worker should go to which idle worker and by which shift, at slots that start a period of every_ms.

    Workers overloaded for OVERLOAD_MS or longer give the hotspot that their heartbeat names (hotspots: worker,
    slot_ts, hot_key, hot_bucket), else their top buckets, in order; idle workers (at most IDLE of the median)
    take one each, in order, until they run out. The shift is the smallest that brings the key to the target, its
    bucket (of n) mod workers; it is an error if there is none.
    """
    state = overload_since(loads).where(F.col("slot_ts") % every_ms == 0)
    due = state.where((F.col("slot_ts") - F.col("since")) >= OVERLOAD_MS).select("worker", "slot_ts", "eps")
    named = due.join(hotspots.where("hot_key is not null and hot_bucket >= 0"), ["worker", "slot_ts"])
    own = buckets.select("worker", "slot_ts", F.col("vbucket").alias("hot_bucket"), "load")
    named = named.join(own, ["worker", "slot_ts", "hot_bucket"], "left").select("worker", "slot_ts", F.lit(1).alias("rank"), F.col("hot_key").alias("key"), F.col("hot_bucket").alias("vbucket"), F.coalesce("load", "eps").cast("double").alias("load"))
    other = due.drop("eps").join(named, ["worker", "slot_ts"], "left_anti").join(top_buckets(buckets), ["worker", "slot_ts"])
    give = named.unionByName(other.select("worker", "slot_ts", "rank", F.concat(F.lit("VB-"), "vbucket").alias("key"), "vbucket", F.col("load").cast("double").alias("load")))
    give = give.withColumn("ordinal", F.row_number().over(Window.partitionBy("slot_ts").orderBy("worker", "rank")))
    idle = state.where(F.col("eps") <= IDLE * F.col("median_eps")).select("slot_ts", F.col("worker").alias("target"))
    idle = idle.withColumn("ordinal", F.row_number().over(Window.partitionBy("slot_ts").orderBy("target")))
    rows = give.join(idle, ["slot_ts", "ordinal"])
    shift = F.array_position(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(shifted_bucket(virtual_bucket(F.col("key"), n), i, n), F.lit(workers)) == F.col("target")), True)
    shift = F.when(shift > 0, shift - 1).otherwise(F.raise_error(F.lit("no shift brings the key to its target")).cast("long"))
    return rows.select("slot_ts", "worker", "key", "vbucket", "load", "target", shift.cast("int").alias("shift"))


def slot_shift(keys: DataFrame, n: int, partitions: int) -> DataFrame:
    """The smallest xor shift that brings each key (key, target) to its target partition, bucket mod partitions."""
    tries = keys.select("key", "target", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shift"))
    lands = F.pmod(shifted_bucket(virtual_bucket(F.col("key"), n), F.col("shift"), n), F.lit(partitions)) == F.col("target")
    return tries.where(lands).groupBy("key", "target").agg(F.min("shift").alias("shift"))


def parse_heartbeats(lines: DataFrame) -> DataFrame:
    """worker, eps, ts, loads, hot_key and hot_bucket from CSV lines (column value): three fields, numbers, then site= and vb= if any."""
    parts = F.split("value", ",")
    at = F.array_position(F.transform(parts, lambda x: x.startswith("site=")), True)
    end = F.when(at > 0, at - 1).otherwise(F.size(parts)).cast("int")
    loads = F.transform(F.slice(parts, F.lit(4), F.greatest(end - 3, F.lit(0))), lambda x: x.cast("double"))
    return lines.select(parts[0].cast("int").alias("worker"), parts[1].cast("double").alias("eps"), parts[2].cast("long").alias("ts"), loads.alias("loads"), F.when(at > 0, F.regexp_extract("value", "site=([^,]*)", 1)).alias("hot_key"), F.when(F.col("value").rlike("vb=[0-9]"), F.regexp_extract("value", "vb=([0-9]+)", 1).cast("int")).alias("hot_bucket"))


def latest_routing(lines: DataFrame) -> DataFrame:
    """The highest version of each key from CSV lines (column value): key, shift, version."""
    rows = lines.select(F.from_csv("value", "cell_id STRING, shift INT, routing_version LONG").alias("r")).select("r.*").where("cell_id is not null")
    return rows.groupBy("cell_id").agg(F.max_by(F.struct("shift", "routing_version"), "routing_version").alias("r")).select("cell_id", "r.*")
