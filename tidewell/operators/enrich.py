"""As-of enrichment of events with the configuration and the counters of their cell.

The join goes in two levels, so that no task holds a cell's whole life: each block of time of a cell is folded to what
it leaves behind, those few rows are scanned in order, and what a block starts with then opens the window that resolves
the block's own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidewell.functions.scalar import bucket_start
from tidewell.params import Rules

_UNTIL, _BEFORE = (Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1)


def envelopes(chr_: DataFrame, pm: DataFrame, cfg: DataFrame) -> DataFrame:
    """All three streams as one of (kind, ts, cell_id, chr, pm, cfg); at equal times configurations come first, then counters."""
    return (
        chr_.select(F.lit("CHR").alias("kind"), F.col("event_ts").alias("ts"), "cell_id", F.lit(2).alias("ord"), F.col("chr_id").cast("long").alias("seq"), F.struct(*chr_.columns).alias("chr"))
        .unionByName(pm.select(F.lit("PM").alias("kind"), F.col("event_ts").alias("ts"), "cell_id", F.lit(1).alias("ord"), F.col("window_end_ts").alias("seq"), F.struct(*pm.columns).alias("pm")), allowMissingColumns=True)
        .unionByName(cfg.select(F.lit("CFG").alias("kind"), F.col("effective_ts").alias("ts"), "cell_id", F.lit(0).alias("ord"), F.col("cfg_seq").alias("seq"), F.struct(*cfg.columns).alias("cfg")), allowMissingColumns=True)
    )


def block_length(rules: Rules) -> int:
    """Length of a block: a day's worth of windows at a window an hour, and never longer than a configuration counts, so that a gap which ends it always lies between blocks."""
    return min(24 * rules.fact_ms, rules.cfg_ttl_ms)


def _latest(segment: Column, value: Column, w: WindowSpec) -> Column:
    """The greatest value since the last change of the segment's number, which only grows along the window; null if there is none."""
    best = F.max(F.when(value.isNotNull(), F.struct(segment.alias("n"), value.alias("v")))).over(w.rowsBetween(*_UNTIL))
    return F.when(best["n"] == segment, best["v"])


def _live(cfg: DataFrame) -> Column:
    """A configuration as it is compared: the highest version, of equal ones the first."""
    return F.struct(F.col("version").alias("v"), (-F.col("cfg_seq")).alias("s"), F.struct(*cfg.columns).alias("c"))


def openings(chr_: DataFrame, pm: DataFrame, cfg: DataFrame, rules: Rules, block_ms: int) -> DataFrame:
    """(cell_id, block, touched, carried, counters): for each block with rows, the cell's last event or configuration before it, the configuration that counted then, and the latest counters."""
    keys = ["cell_id", "block"]
    at = lambda df, ts: df.withColumn("block", bucket_start(ts, block_ms))
    touch = at(chr_.select("cell_id", F.col("event_ts").alias("t")).unionByName(cfg.select("cell_id", F.col("effective_ts").alias("t"))), "t")
    touch = touch.groupBy(*keys).agg(F.min("t").alias("first_touch"), F.max("t").alias("last_touch"))
    counters = at(pm, "event_ts").groupBy(*keys).agg(F.max_by(F.struct(F.col("event_ts").alias("ts"), F.struct(*pm.columns).alias("pm")), F.struct("event_ts", "window_end_ts", "prb_usage_dl", F.struct(*pm.columns))).alias("left_pm"))
    # Changes of a cell in a block; after a tombstone only later versions count.
    order = Window.partitionBy(*keys).orderBy("effective_ts", "cfg_seq")
    changes = at(cfg, "effective_ts").select(*keys, "effective_ts", "cfg_seq", F.when(F.col("tombstone"), F.lit(None)).otherwise(_live(cfg)).alias("live"), F.count_if("tombstone").over(order.rowsBetween(*_UNTIL)).alias("n"))
    changes = changes.groupBy(*keys, "n").agg(F.max("live").alias("best")).groupBy(*keys).agg(F.max_by("best", "n").alias("best"), (F.max("n") > 0).alias("ended"))
    folded = touch.unionByName(counters, allowMissingColumns=True).unionByName(changes, allowMissingColumns=True)
    folded = folded.groupBy(*keys).agg(*(F.any_value(c, True).alias(c) for c in ("first_touch", "last_touch", "left_pm", "best", "ended")))
    # One row a block of a cell.
    s = Window.partitionBy("cell_id").orderBy("block")
    touched = F.last("last_touch", ignorenulls=True).over(s.rowsBetween(*_BEFORE))
    folded = folded.withColumn("touched", touched)
    reset = F.coalesce(F.col("ended"), F.lit(False)) | F.coalesce(F.col("first_touch") - F.col("touched") > rules.cfg_ttl_ms, F.lit(False))
    folded = folded.withColumn("n", F.count_if(reset).over(s.rowsBetween(*_UNTIL)))
    folded = folded.withColumn("leaves", _latest(F.col("n"), F.col("best"), s))
    return folded.select(*keys, "touched", F.lag("leaves").over(s).alias("carried"), F.last("left_pm", ignorenulls=True).over(s.rowsBetween(*_BEFORE)).alias("counters"))


def enrich(chr_: DataFrame, pm: DataFrame, cfg: DataFrame, rules: Rules, block_ms: int | None = None) -> DataFrame:
    """Events with cfg (the cell's configuration then) and pm (its latest counters then); both null where there is none.

    The configuration is the highest version so far (ties: the first). A tombstone clears it and forgets the
    version, so an older one may come after; so does a time of cfg_ttl_ms in which the cell had neither event nor
    configuration. Counters count for pm_ttl_ms; of those with one time and window's end, the ones with the greatest load, then
    the greatest of the other columns in their order. Blocks of any length up to cfg_ttl_ms give the same rows.
    """
    block_ms = block_ms or block_length(rules)
    if block_ms > rules.cfg_ttl_ms:
        raise ValueError("a block must not be longer than a configuration counts")
    opening = openings(chr_, pm, cfg, rules, block_ms).select("*", F.lit("OPEN").alias("kind"), F.col("block").alias("ts"), F.lit(-1).alias("ord"), F.lit(0).cast("long").alias("seq"))
    rows = envelopes(chr_, pm, cfg).withColumn("block", bucket_start("ts", block_ms)).unionByName(opening, allowMissingColumns=True)
    w = Window.partitionBy("cell_id", "block").orderBy("ts", "ord", "seq", "pm.prb_usage_dl", "pm")
    kind, tombstone = F.col("kind"), F.coalesce(F.col("cfg.tombstone"), F.lit(False))
    touch = F.when(kind.isin("CHR", "CFG"), F.col("ts")).otherwise(F.col("touched"))
    before = F.last(touch, ignorenulls=True).over(w.rowsBetween(*_BEFORE))
    cleared = tombstone | F.coalesce(kind.isin("CHR", "CFG") & (F.col("ts") - before > rules.cfg_ttl_ms), F.lit(False))
    rows = rows.withColumn("cleared", cleared).withColumn("segment", F.count_if("cleared").over(w.rowsBetween(*_UNTIL)))
    change = F.struct(F.col("cfg.version").alias("v"), (-F.col("seq")).alias("s"), F.col("cfg").alias("c"))
    now = _latest(F.col("segment"), F.when((kind == "CFG") & ~tombstone, change).otherwise(F.col("carried")), w)
    latest = F.last(F.when(kind == "PM", F.struct("ts", "pm")).otherwise(F.col("counters")), ignorenulls=True).over(w.rowsBetween(*_UNTIL))
    rows = rows.withColumns({"_c": now, "_p": latest}).where("kind = 'CHR'")
    return rows.select("chr.*", F.col("_c.c").alias("cfg"), F.when(F.col("ts") - F.col("_p.ts") <= rules.pm_ttl_ms, F.col("_p.pm")).alias("pm"))


def split_late(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, and apart from them those without a configuration."""
    return enriched, enriched.where("cfg is null")
