"""Windowed facts of events and counters, their full join into KPIs, and the rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.scalar import bucket_start, first_non_blank, geohash, ratio
from tidewell.params import Rules


def valid_pm(pm: DataFrame) -> DataFrame:
    """pm with pm_event_ts (window end - 1 ms) and valid: end positive and after start."""
    valid = F.coalesce((F.col("window_end_ts") > 0) & (F.col("window_end_ts") > F.col("window_start_ts")), F.lit(False))
    return pm.withColumns({"pm_event_ts": F.when(valid, F.col("window_end_ts") - 1), "valid": valid})


def _source_stats(ts: str) -> dict:
    seen = F.when(F.col(ts) > 0, F.col(ts))
    n = F.count(seen)
    return {"ts_avg": F.expr(f"coalesce(sum(case when {ts} > 0 then {ts} end) div nullif(count(case when {ts} > 0 then 1 end), 0), 0)"), "ts_min": F.coalesce(F.min(seen), F.lit(0)), "ts_max": F.coalesce(F.max(seen), F.lit(0)), "ts_count": n}


def chr_facts(chr_: DataFrame, rules: Rules) -> DataFrame:
    """Event facts by cell and window; distinct users are exact, the site is that of the first event."""
    attach = F.col("event_type") == "ATTACH"
    return chr_.groupBy("cell_id", bucket_start("event_ts", rules.fact_ms).alias("minute_ts")).agg(
        F.min_by("site_id", F.struct("event_ts", F.col("chr_id").cast("long"))).alias("site_id"),
        F.count("*").alias("n"), F.count_distinct("imsi").alias("users"),
        F.sum("rsrp").alias("rsrp_sum"), F.count("rsrp").alias("rsrp_n"), F.sum("sinr").alias("sinr_sum"), F.count("sinr").alias("sinr_n"),
        F.count_if(attach).alias("attach_n"), F.count_if(attach & (F.col("result_code") == 0)).alias("attach_ok"),
        *(c.alias(f"chr_{n}") for n, c in _source_stats("event_ts").items()),
    )


def pm_facts(pm: DataFrame, rules: Rules) -> DataFrame:
    """Counter facts by cell and window of valid counters; negative active users count as none."""
    rows = valid_pm(pm).where("valid")
    return rows.groupBy("cell_id", bucket_start("pm_event_ts", rules.fact_ms).alias("minute_ts")).agg(
        F.min_by("site_id", F.struct("pm_event_ts", "event_ts")).alias("site_id"), F.count("*").alias("n"),
        F.sum("prb_usage_dl").alias("prb_sum"), F.sum("throughput_dl_mbps").alias("tput_sum"), F.sum(F.greatest("active_users", F.lit(0))).alias("active_sum"),
        F.sum("dropped_connections").alias("drops"), F.sum("handover_success").alias("ho_ok"), F.sum("handover_failure").alias("ho_bad"),
        *(c.alias(f"pm_{n}") for n, c in _source_stats("event_ts").items()),
    )


def kpi(chr_: DataFrame, pm: DataFrame, rules: Rules, kind: str = "MIN_1") -> DataFrame:
    """One row for each cell and window of either side, labelled JOINED, CHR_ONLY or PM_ONLY."""
    c, p = chr_facts(chr_, rules).alias("c"), pm_facts(pm, rules).alias("p")
    both = c.join(p, ["cell_id", "minute_ts"], "full_outer")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    n_c, n_p = zero("chr_ts_count"), zero("pm_ts_count")
    weighted = F.expr("coalesce((coalesce(chr_ts_avg * chr_ts_count, 0) + coalesce(pm_ts_avg * pm_ts_count, 0)) div nullif(coalesce(chr_ts_count, 0) + coalesce(pm_ts_count, 0), 0), 0)")
    return both.select(
        F.col("minute_ts").alias("window_start_ts"), (F.col("minute_ts") + rules.fact_ms).alias("window_end_ts"), F.lit(kind).alias("window_kind"),
        F.when(F.col("c.n").isNull(), "PM_ONLY").when(F.col("p.n").isNull(), "CHR_ONLY").otherwise("JOINED").alias("join_quality"),
        first_non_blank(F.col("c.site_id"), F.col("p.site_id")).alias("site_id"), "cell_id",
        zero("c.n").alias("num_chr_events"), zero("users").alias("num_users"), zero("rsrp_n").alias("rsrp_sample_count"), zero("sinr_n").alias("sinr_sample_count"), zero("attach_n").alias("attach_attempts"),
        ratio(F.col("rsrp_sum"), F.col("rsrp_n")).alias("avg_rsrp"), ratio(F.col("sinr_sum"), F.col("sinr_n")).alias("avg_sinr"),
        ratio(F.col("prb_sum"), F.col("p.n")).alias("avg_prb_usage_dl"), ratio(F.col("tput_sum"), F.col("p.n")).alias("throughput_dl_mbps_avg"),
        ratio(F.col("drops"), F.col("active_sum")).alias("drop_rate"), ratio(F.col("ho_ok"), F.col("ho_ok") + F.col("ho_bad")).alias("ho_success_rate"),
        ratio(F.col("attach_ok"), F.col("attach_n")).alias("attach_success_rate"),
        weighted.alias("source_event_ts_avg"), F.coalesce(F.least(F.when(n_c > 0, F.col("chr_ts_min")), F.when(n_p > 0, F.col("pm_ts_min"))), F.lit(0)).alias("source_event_ts_min"),
        F.greatest(zero("chr_ts_max"), zero("pm_ts_max")).alias("source_event_ts_max"), (n_c + n_p).alias("source_event_count"),
    )


def violation(rules: Rules) -> Column:
    """Why a rollup must not take a child: another kind than MIN_1, no positive length, or reaching over its parent; null if it may."""
    parent = bucket_start(F.col("window_end_ts") - 1, rules.rollup_ms)
    return F.when(F.col("window_kind") != "MIN_1", "kind").when(F.col("window_end_ts") <= F.col("window_start_ts"), "length").when((F.col("window_start_ts") < parent) | (F.col("window_end_ts") > parent + rules.rollup_ms), "outside")


def rollup_violations(children: DataFrame, rules: Rules) -> DataFrame:
    """Children that a rollup must not take, with the reason."""
    return children.withColumn("reason", violation(rules)).where("reason is not null")


def rollup_parts(children: DataFrame, rules: Rules, kind: str = "MIN_5") -> tuple[DataFrame, Column, list[Column]]:
    """Checked children with what the aggregates need, the start of their parent, and the aggregates; batch and stream group them each in their way. A bad child is an error."""
    has_pm = (F.col("join_quality") != "CHR_ONLY") | (F.col("avg_prb_usage_dl") != 0) | (F.col("throughput_dl_mbps_avg") != 0) | (F.col("drop_rate") != 0) | (F.col("ho_success_rate") != 0)
    bad = violation(rules)
    refuse = F.raise_error(F.concat(F.lit("a rollup takes no such child: "), bad)).cast("boolean")
    rows = children.withColumn("has_pm", F.when(bad.isNotNull(), refuse).otherwise(has_pm))
    mean = lambda x, n: ratio(F.sum(F.col(x) * F.col(n)), F.sum(n)).alias(x)
    over_pm = lambda x: ratio(F.sum(F.when(F.col("has_pm"), F.col(x))), F.count_if("has_pm")).alias(x)
    only = lambda q: F.bool_and(F.col("join_quality") == q)
    some_chr = F.bool_or((F.col("join_quality") != "PM_ONLY") | (F.col("num_chr_events") > 0))
    quality = F.when(only("JOINED"), "JOINED").when(only("CHR_ONLY"), "CHR_ONLY").when(only("PM_ONLY"), "PM_ONLY")
    quality = quality.when(some_chr & F.bool_or("has_pm"), "JOINED").when(some_chr, "CHR_ONLY").otherwise("PM_ONLY")

    def first(x: str) -> Column:
        there = F.trim(x) != ""
        return F.coalesce(F.min_by(F.when(there, F.col(x)), F.when(there, F.struct("window_start_ts", x))), F.lit("")).alias(x)

    ts = "source_event_ts"
    seen = F.col("source_event_count") > 0
    parts = [
        F.lit(kind).alias("window_kind"), quality.alias("join_quality"), first("site_id"), *([first("grid_id")] if "grid_id" in children.columns else []),
        *(F.sum(c).alias(c) for c in ("num_chr_events", "num_users", "rsrp_sample_count", "sinr_sample_count", "attach_attempts", "source_event_count")),
        mean("avg_rsrp", "rsrp_sample_count"), mean("avg_sinr", "sinr_sample_count"), mean("attach_success_rate", "attach_attempts"),
        *(over_pm(c) for c in ("avg_prb_usage_dl", "throughput_dl_mbps_avg", "drop_rate", "ho_success_rate")),
        F.expr(f"coalesce(sum({ts}_avg * source_event_count) div nullif(sum(source_event_count), 0), 0)").alias(f"{ts}_avg"),
        F.coalesce(F.min(F.when(seen, F.col(f"{ts}_min"))), F.lit(0)).alias(f"{ts}_min"), F.coalesce(F.max(F.when(seen, F.col(f"{ts}_max"))), F.lit(0)).alias(f"{ts}_max"),
    ]
    return rows, bucket_start(F.col("window_end_ts") - 1, rules.rollup_ms), parts


def rollup(children: DataFrame, rules: Rules, kind: str = "MIN_5") -> DataFrame:
    """Rollup of KPI rows: radio measures weighted by their samples, attach rate by attempts, counter measures as the mean over windows with counters; users are summed; the first site and grid (if there is one) that aren't blank. A child that rollup_violations() lists is an error."""
    rows, start, parts = rollup_parts(children, rules, kind)
    return rows.groupBy("cell_id", start.alias("window_start_ts")).agg(*parts)


def latest_cfg(cfg: DataFrame) -> DataFrame:
    """The configuration with the highest version of each cell (ties: the first); cells whose highest is a tombstone are absent, and older versions don't come back."""
    best = cfg.groupBy("cell_id").agg(F.max_by(F.struct(*cfg.columns), F.struct("version", -F.col("cfg_seq"))).alias("c"))
    return best.select("c.*").where(~F.col("tombstone"))


def kpi_with_cfg(rows: DataFrame, cfg: DataFrame) -> DataFrame:
    """KPI rows with the grid of the cell's latest configuration, and its site where the row has none."""
    named = latest_cfg(cfg).select("cell_id", F.col("site_id").alias("cfg_site"), geohash(F.col("center_lat"), F.col("center_lon")).alias("cfg_grid"))
    return rows.join(named, "cell_id", "left").withColumns({"grid_id": F.coalesce("cfg_grid", F.lit("")), "site_id": first_non_blank(F.col("site_id"), F.col("cfg_site"))}).drop("cfg_site", "cfg_grid")


def kpi_from_enriched(enriched: DataFrame, length: int, kind: str) -> DataFrame:
    """All KPI measures straight from enriched events for windows of any length and kind; each counter record counts once in a window: of those with one window's end, the record that the first event found."""
    rows = enriched.withColumn("window_start_ts", bucket_start("event_ts", length))
    keys = ["cell_id", "window_start_ts"]
    attach = F.col("event_type") == "ATTACH"
    at = F.struct("event_ts", F.col("chr_id").cast("long"))
    grid = geohash(F.col("cfg.center_lat"), F.col("cfg.center_lon"))
    stats = lambda ts: (F.sum(F.when(F.col(ts) > 0, F.col(ts))), F.min(F.when(F.col(ts) > 0, F.col(ts))), F.max(F.when(F.col(ts) > 0, F.col(ts))), F.count(F.when(F.col(ts) > 0, 1)))
    named = lambda side, ts: [c.alias(f"{side}_{n}") for c, n in zip(stats(ts), ("sum", "min", "max", "n"), strict=True)]
    own = rows.groupBy(*keys).agg(
        F.min_by("site_id", at).alias("site_id"), F.coalesce(F.min_by(grid, F.when(F.col("cfg").isNotNull(), at)), F.lit("")).alias("grid_id"), F.count("*").alias("num_chr_events"), F.count_distinct("imsi").alias("num_users"),
        F.count("rsrp").alias("rsrp_sample_count"), F.count("sinr").alias("sinr_sample_count"), F.count_if(attach).alias("attach_attempts"), ratio(F.sum("rsrp"), F.count("rsrp")).alias("avg_rsrp"), ratio(F.sum("sinr"), F.count("sinr")).alias("avg_sinr"),
        ratio(F.count_if(attach & (F.col("result_code") == 0)), F.count_if(attach)).alias("attach_success_rate"), *named("own", "event_ts"))
    counters = rows.where("pm is not null").groupBy(*keys, F.col("pm.window_end_ts").alias("pm_end")).agg(F.min_by("pm", at).alias("pm"))
    p = lambda x: F.col(f"pm.{x}")
    counters = counters.withColumn("pm_ts", p("event_ts"))
    ok, bad = F.sum(p("handover_success")), F.sum(p("handover_failure"))
    theirs = counters.groupBy(*keys).agg(
        F.count("*").alias("pm_windows"), F.avg(p("prb_usage_dl")).alias("avg_prb_usage_dl"), F.avg(p("throughput_dl_mbps")).alias("throughput_dl_mbps_avg"),
        ratio(F.sum(p("dropped_connections")), F.sum(F.greatest(p("active_users"), F.lit(0)))).alias("drop_rate"), ratio(ok, ok + bad).alias("ho_success_rate"), *named("pm", "pm_ts"))
    both = own.join(theirs, keys, "left").fillna(0, ["pm_windows", "avg_prb_usage_dl", "throughput_dl_mbps_avg", "drop_rate", "ho_success_rate", "own_sum", "pm_sum", "own_n", "pm_n"])
    return both.select(
        "window_start_ts", (F.col("window_start_ts") + length).alias("window_end_ts"), F.lit(kind).alias("window_kind"), F.lit("JOINED").alias("join_quality"), "site_id", "cell_id", "grid_id", "num_chr_events", "num_users",
        "rsrp_sample_count", "sinr_sample_count", "attach_attempts", "avg_rsrp", "avg_sinr", "avg_prb_usage_dl", "throughput_dl_mbps_avg", "drop_rate", "ho_success_rate", "attach_success_rate", "pm_windows",
        F.expr("coalesce((own_sum + pm_sum) div nullif(own_n + pm_n, 0), 0)").alias("source_event_ts_avg"), F.coalesce(F.least("own_min", "pm_min"), F.lit(0)).alias("source_event_ts_min"), F.coalesce(F.greatest("own_max", "pm_max"), F.lit(0)).alias("source_event_ts_max"), (F.col("own_n") + F.col("pm_n")).alias("source_event_count"))


def distinct_users(chr_: DataFrame, length: int) -> DataFrame:
    """Exact distinct users by cell and window beside the estimate of a mergeable sketch, and whether that is within 10 %."""
    out = chr_.groupBy("cell_id", bucket_start("event_ts", length).alias("window_start_ts")).agg(F.count_distinct("imsi").alias("users"), F.hll_sketch_estimate(F.hll_sketch_agg("imsi", 12)).alias("estimate"))
    return out.withColumn("close", F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.col("users") * 0.1, F.lit(1.0)))


def distinct_users_merged(chr_: DataFrame, fact_ms: int, rollup_ms: int) -> DataFrame:
    """Distinct users of long windows from the merged sketches of short ones."""
    sketches = chr_.groupBy("cell_id", bucket_start("event_ts", fact_ms).alias("t")).agg(F.hll_sketch_agg("imsi", 12).alias("s"))
    return sketches.groupBy("cell_id", bucket_start("t", rollup_ms).alias("window_start_ts")).agg(F.hll_sketch_estimate(F.hll_union_agg("s")).alias("estimate"))
