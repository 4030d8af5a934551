"""Rule evaluations and the detectors over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.scalar import anomaly_id, bucket_start, geohash
from tidewell.params import Rules


def _rule(dimension: str, bad: Column, kind: str, severity: str, metric: Column, threshold: Column, observed: Column) -> Column:
    return F.struct(F.lit(dimension).alias("dimension"), F.coalesce(bad, F.lit(False)).alias("abnormal"), F.lit(kind).alias("anomaly_type"), F.lit(severity).alias("severity"), metric.alias("metric"), threshold.cast("double").alias("threshold"), observed.cast("double").alias("observed"))


def cell_evaluations(kpis: DataFrame, rules: Rules) -> DataFrame:
    """Two evaluations (radio, service) of each one-window KPI row."""
    rsrp, sinr = F.col("rsrp_sample_count") > 0, F.col("sinr_sample_count") > 0
    bad_rsrp, bad_sinr = rsrp & (F.col("avg_rsrp") < rules.rsrp_min), sinr & (F.col("avg_sinr") < rules.sinr_min)
    by_rsrp = bad_rsrp | (~bad_sinr & rsrp)
    pick = lambda a, b: F.when(by_rsrp, a).otherwise(b)
    radio = _rule("radio", bad_rsrp | bad_sinr, "CELL_RADIO_BAD", "MEDIUM", pick(F.lit("avgRsrp"), F.lit("avgSinr")), pick(F.lit(rules.rsrp_min), F.lit(rules.sinr_min)), pick(F.col("avg_rsrp"), F.col("avg_sinr")))
    bad_attach = (F.col("attach_attempts") > 0) & (F.col("attach_success_rate") < rules.attach_success_min)
    bad_drop = F.col("drop_rate") > rules.drop_rate_max
    which = lambda a, d, n: F.when(bad_attach, a).when(bad_drop, d).otherwise(n)
    service = _rule("service", bad_attach | bad_drop, "CELL_SERVICE_BAD", "HIGH", which(F.lit("attachSuccessRate"), F.lit("dropRate"), F.lit("service")), which(F.lit(rules.attach_success_min), F.lit(rules.drop_rate_max), F.lit(0.0)), which(F.col("attach_success_rate"), F.col("drop_rate"), F.lit(0.0)))
    rows = kpis.where("window_kind = 'MIN_1'").select(F.lit("CELL").alias("entity_type"), F.col("cell_id").alias("entity_id"), F.col("window_end_ts").alias("event_ts"), F.lit(0).cast("long").alias("seq"), "window_start_ts", "window_end_ts", "site_id", "cell_id", "window_kind", F.explode(F.array(radio, service)).alias("e"))
    context = F.format_string('{"metric":"%s","threshold":%.6f,"observed":%.6f,"windowKind":"%s"}', "metric", "threshold", "observed", "window_kind")
    return rows.select("*", "e.*").drop("e").withColumn("context_json", context).drop("window_kind")


def user_evaluations(chr_: DataFrame, rules: Rules) -> DataFrame:
    """Up to five evaluations of each event of a user; a missing measure gives none, events without a user none at all."""
    failed = F.col("result_code") != 0
    access = F.col("event_type").isin("ATTACH", "SERVICE_REQUEST", "RRC_SETUP_FAIL")
    qoe = lambda name, column, bad, limit: F.when(F.col(column).isNotNull(), _rule(name, bad, "USER_QOE_BAD", "MEDIUM", F.lit(name), F.lit(limit), F.col(column)))
    fail = lambda name: _rule(name, failed, "USER_FAILURE", "HIGH", F.lit("resultCode"), F.lit(0.0), F.col("result_code"))
    all_ = F.array(
        F.when(access, fail("accessFailure")), F.when(F.col("event_type") == "HANDOVER", fail("handoverFailure")),
        qoe("rsrp", "rsrp", F.col("rsrp") < rules.rsrp_min, rules.rsrp_min), qoe("sinr", "sinr", F.col("sinr") < rules.sinr_min, rules.sinr_min),
        qoe("latencyMs", "latency_ms", F.col("latency_ms") > rules.latency_max, rules.latency_max))
    rows = chr_.where(F.length(F.trim("imsi")) > 0).select(F.lit("USER").alias("entity_type"), F.col("imsi").alias("entity_id"), "event_ts", F.col("chr_id").cast("long").alias("seq"), (F.col("event_ts") - rules.user_window_ms).alias("window_start_ts"), F.col("event_ts").alias("window_end_ts"), "site_id", "cell_id", "event_type", "result_code", F.explode(F.array_compact(all_)).alias("e"))
    context = F.format_string('{"metric":"%s","threshold":%.6f,"observed":%.6f,"eventType":"%s","resultCode":%d}', "metric", "threshold", "observed", "event_type", "result_code")
    return rows.select("*", "e.*").drop("e").withColumn("context_json", context).drop("event_type", "result_code")


def streaks(evaluations: DataFrame, needed: int, window_ms: int) -> DataFrame:
    """The evaluations at which a streak of `needed` bad ones is complete.

    Per entity and dimension in the order of time: a good evaluation ends the streak and arms the alarm again; a bad
    one continues it, or starts it anew if the streak's first bad one is over window_ms old, without arming the
    alarm. An armed alarm goes off once. A window first cuts the evaluations into runs of bad ones; the fold that
    follows has only a run's rows, each once with all that its alarm tells, and of those none after the first place where 2 * needed - 1
    rows lie within window_ms, because by then the alarm has gone off wherever its streak began. So the fold's rows
    are bounded by the run's length in time, not by how many events a hot entity has.
    """
    w = Window.partitionBy("entity_type", "entity_id", "dimension").orderBy("event_ts", "seq")
    runs = evaluations.withColumn("run", F.count_if(~F.col("abnormal")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where("abnormal")
    keys = ["entity_type", "entity_id", "dimension", "run"]
    inside = Window.partitionBy(*keys).orderBy("event_ts", "seq")
    sure = F.coalesce(F.col("event_ts") - F.lag("event_ts", 2 * needed - 2).over(inside) <= window_ms, F.lit(False)) if needed > 1 else F.lit(True)
    few = runs.withColumn("sure", sure).withColumn("decided", F.coalesce(F.count_if("sure").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) > 0).where("not decided")
    rest = [c for c in runs.columns if c not in (*keys, "event_ts", "seq", "abnormal")]
    folded = few.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("event_ts", "seq", *rest))).alias("rows"))
    kind = folded.schema["rows"].dataType.elementType
    start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("first"), F.lit(None).cast(kind).alias("hit"))

    def step(state: Column, row: Column) -> Column:
        fresh = (state["n"] == 0) | (row["event_ts"] - state["first"] > window_ms)
        n = F.when(fresh, 1).otherwise(state["n"] + 1)
        return F.struct(n.alias("n"), F.when(fresh, row["event_ts"]).otherwise(state["first"]).alias("first"), F.coalesce(state["hit"], F.when(n >= needed, row)).alias("hit"))

    hits = folded.select(*keys, F.aggregate("rows", start, step)["hit"].alias("hit")).where("hit is not null")
    order = [c for c in evaluations.columns if c != "abnormal"]
    return hits.select(*keys, "hit.*").select(*order)


def coverage_holes(chr_: DataFrame, rules: Rules) -> DataFrame:
    """The weak-signal event with which a geohash cell reaches the count in a time bucket."""
    weak = chr_.where(F.col("rsrp").isNotNull() & (F.col("rsrp") < rules.rsrp_min)).withColumn("grid_id", geohash(F.col("latitude"), F.col("longitude")))
    weak = weak.withColumn("window_start_ts", bucket_start("event_ts", rules.coverage_ms))
    w = Window.partitionBy("grid_id", "window_start_ts").orderBy("event_ts", F.col("chr_id").cast("long"))
    hit = weak.withColumn("n", F.row_number().over(w)).where(F.col("n") == rules.coverage_count)
    context = F.format_string('{"low_signal_count":%d,"window_ms":%d}', F.col("n"), F.lit(rules.coverage_ms))
    return hit.select(F.lit("GRID").alias("entity_type"), F.col("grid_id").alias("entity_id"), "event_ts", "window_start_ts", (F.col("window_start_ts") + rules.coverage_ms).alias("window_end_ts"), "site_id", "cell_id", F.lit("COVERAGE_HOLE").alias("anomaly_type"), F.lit("HIGH").alias("severity"), "latitude", "longitude", context.alias("context_json"))


def low_signal(chr_: DataFrame, rules: Rules) -> DataFrame:
    """Every event with both measures of which one is under its threshold."""
    return chr_.where((F.col("rsrp").isNotNull()) & F.col("sinr").isNotNull() & ((F.col("rsrp") < rules.rsrp_min) | (F.col("sinr") < rules.sinr_min)))


def attach_bursts(chr_: DataFrame, rules: Rules) -> DataFrame:
    """Every failed attach at or past the count in its cell and bucket."""
    failed = chr_.where((F.col("event_type") == "ATTACH") & (F.col("result_code") != 0))
    w = Window.partitionBy("cell_id", bucket_start("event_ts", rules.burst_ms)).orderBy("event_ts", F.col("chr_id").cast("long"))
    return failed.withColumn("failures", F.row_number().over(w)).where(F.col("failures") >= rules.burst_failures)


def handover_patterns(chr_: DataFrame, rules: Rules) -> DataFrame:
    """Handovers at which the failure rate over this bucket so far and the buckets before it is too high.

    The buckets before come from counts by cell and bucket, so a window holds a bucket's handovers at most.
    """
    rows = chr_.where("event_type = 'HANDOVER'").select("*", F.floor(F.col("event_ts") / rules.burst_ms).alias("bucket"), (F.col("result_code") != 0).cast("long").alias("failed"))
    earlier = Window.partitionBy("cell_id").orderBy("bucket").rangeBetween(-(rules.handover_buckets - 1), -1)
    rows_columns = rows.columns
    sums = rows.groupBy("cell_id", "bucket").agg(F.count("*").alias("n"), F.sum("failed").alias("bad"))
    sums = sums.select("cell_id", "bucket", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "bad")))
    inside = Window.partitionBy("cell_id", "bucket").orderBy("event_ts", F.col("chr_id").cast("long")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.alias("r").join(sums.alias("s"), F.col("r.cell_id").eqNullSafe(F.col("s.cell_id")) & (F.col("r.bucket") == F.col("s.bucket")))
    rows = rows.select("r.*", "n_before", "bad_before").select(*rows_columns, (F.count("*").over(inside) + F.col("n_before")).alias("attempts"), (F.sum("failed").over(inside) + F.col("bad_before")).alias("failures"))
    return rows.where((F.col("attempts") >= rules.handover_attempts) & (F.col("failures") / F.col("attempts") > rules.handover_rate)).drop("failed", "bucket")


def config_mismatch(enriched: DataFrame) -> DataFrame:
    """The first event of each cell that contradicts its configuration, with the fields that do."""
    differ = lambda name: F.when(F.col(name) != F.col(f"cfg.{name}"), name)
    rows = enriched.where("cfg is not null").withColumn("fields", F.array_join(F.array_compact(F.array(*map(differ, ("tac", "pci", "eci", "arfcn")))), ",")).where("fields != ''")
    first = F.min_by(F.struct(*rows.columns), F.struct("event_ts", F.col("chr_id").cast("long")))
    return rows.groupBy("cell_id").agg(first.alias("r")).select("r.*")


#: What all anomaly feeds share.
FEED = ("entity_type", "entity_id", "event_ts", "window_start_ts", "window_end_ts", "site_id", "cell_id", "anomaly_type", "severity", "context_json")


def feed(rules: Rules, *scopes: DataFrame) -> DataFrame:
    """One feed of all anomalies with their stable ids, which don't depend on when they were found."""
    rows = scopes[0].select(*FEED)
    for other in scopes[1:]:
        rows = rows.unionByName(other.select(*FEED))
    identity = anomaly_id(F.lower("entity_type"), F.col("event_ts"), F.col("entity_type"), F.col("entity_id"), F.col("anomaly_type"), F.lit(rules.version), context=F.col("context_json"))
    return rows.withColumn("anomaly_id", identity)
