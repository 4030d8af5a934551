"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order (md5 of id and text), gone through twice at most. A document's
virtual finish time is the source's cumulative words at its end divided by the source's target; all documents
are taken in the order of that time until the total budget is spent. Running sums come from sums by hash range.
Where the budget ends is found by sums over a grid of finish times, refined inside the cell that the end lies in
until the cell holds few documents, so no task holds a whole source and no window spans the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.scratch import Scratch, comparable, own, shuffled, unused

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix in relation to all words, and of a source's part in relation to the source.
SHARE, MOST = 1.5, 2
#: Hex digits that name a range of a source's shuffled order; cells of a grid of finish times; documents in a cell that isn't refined any more.
RANGE_DIGITS, GRID, FEW = 3, 4096, 20_000

_BEFORE = (Window.unboundedPreceding, -1)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, weigh WEIGHTS in turn and share SHARE of all words; no target is over MOST
    times its source's size, and what is cut off goes to the others by weight until none is above. Sorted by
    the weight at which a source is full, the first source that isn't full fixes the common level. The table has
    a row a source and is ordered in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    ranked = ranked.withColumns({"most": F.col("source_size") * MOST, "full_at": F.col("source_size") * MOST / F.col("weight")})
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_full = Window.orderBy("full_at", "rank")
    budget = F.sum("source_size").over(everything) * F.lit(SHARE)
    level = (budget - F.coalesce(F.sum("most").over(by_full.rowsBetween(*_BEFORE)), F.lit(0))) / F.sum("weight").over(by_full.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", level)
    common = F.min_by(F.when(F.col("level") <= F.col("full_at"), F.col("level")), F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank"))).over(everything)
    target = F.least(F.col("most").cast("double"), common * F.col("weight"))
    return ranked.select("source", "source_size", "rank", "weight", target.alias("target"))


def _end_of_budget(passes: DataFrame, budget: float) -> tuple[Column, bool] | None:
    """The place in the order (v, rank, h, row_key) where the budget ends: of the last pass taken (True) or of the first one not taken (False); None if all fit.

    The driver sees the sums of GRID cells in each round, then at most FEW passes (or those of one finish time).
    """
    low, high = passes.agg(F.min("v"), F.max("v")).first()
    if low is None:
        return None
    inside, held = passes, 0
    while True:
        width = high - low
        cell = F.least(F.floor((F.col("v") - low) / (width or 1.0) * GRID), F.lit(GRID - 1)).cast("int")
        cells = inside.groupBy(cell.alias("cell")).agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("cell").collect()  # GRID rows at most
        for found in cells:
            if held + found["words"] > budget:
                break
            held += found["words"]
        else:
            return None
        low, high = found["low"], found["high"]
        inside = passes.where(F.col("v").between(low, high))
        if found["n"] <= FEW or low == high:
            break
    rows = inside.groupBy("v", "rank", "h", "row_key").agg(F.sum("size").alias("words")).orderBy("v", "rank", "h", "row_key").collect()
    last = None
    for r in rows:
        if held + r["words"] > budget:
            break
        held, last = held + r["words"], r
    at = last or rows[0]
    return F.struct(*(F.lit(at[x]).cast(t).alias(x) for x, t in (("v", "double"), ("rank", "int"), ("h", "string"), ("row_key", "long")))), last is not None


def mix_sources(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How much of each document the mix takes.

    Returns for each row: doc_id, source, row_key (hash of id, source and text), size (words), source_size,
    target, times (0, 1 or 2 whole passes) and taken (size * times). A null text has no words; documents without
    words are taken never. Null is a source of its own. Rows equal in id, source and text stand in turn, so
    their times may differ. Other columns are ignored. The result doesn't depend on the partitioning. An empty df gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    h = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    base = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), F.xxhash64(id_col, source_col, text_col).alias("row_key"), h.alias("h"))
    base = scratch.save(base, "base")
    part = F.substring("h", 1, RANGE_DIGITS).alias("part")
    parts = base.groupBy("source", part).agg(F.sum("size").alias("held"))
    parts = parts.withColumn("below", F.coalesce(F.sum("held").over(Window.partitionBy("source").orderBy("part").rowsBetween(*_BEFORE)), F.lit(0)))
    aims = scratch.save(targets(base.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    inside = F.sum("size").over(Window.partitionBy("source", "part").orderBy("h", "row_key").rowsBetween(Window.unboundedPreceding, 0))
    rows = base.select("*", part).withColumn("inside", inside).alias("r")
    here = F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.part") == F.col("p.part"))
    rows = rows.join(parts.alias("p"), here).select("r.*", (F.col("below") + F.col("inside")).alias("end")).alias("r")
    rows = rows.join(aims.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select("r.*", "source_size", "target", "rank")
    finish = lambda words: F.when(F.col("target") > 0, words / F.col("target"))
    rows = scratch.save(rows.withColumns({"v1": finish(F.col("end")), "v2": finish(F.col("end") + F.col("source_size"))}), "rows")
    scratch.drop("base")

    passes = rows.where("size > 0").select("rank", "h", "row_key", "size", F.explode(F.array("v1", "v2")).alias("v"))
    end = _end_of_budget(passes, (aims.agg(F.sum("source_size")).first()[0] or 0) * SHARE)

    def taken(v: str) -> Column:
        if end is None:
            return F.col(v).isNotNull()
        at = F.struct(F.col(v).alias("v"), "rank", "h", "row_key")
        return at <= end[0] if end[1] else at < end[0]

    times = F.when(F.col("size") > 0, sum(F.coalesce(taken(v), F.lit(False)).cast("int") for v in ("v1", "v2"))).otherwise(0)
    return rows.withColumn("times", times).select("doc_id", "source", "row_key", "size", "source_size", "target", "times", (F.col("size") * F.col("times")).alias("taken"))


def apply_mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """df with each row as often as mix_sources takes it. Rows equal in id, source and text share their times evenly; of those, the first by a hash of all columns take what is left over. Columns may have any names."""
    scratch = Scratch(df.sparkSession, "mixing")
    key, times, more, turn, copy = (unused(df, f"_{x}") for x in ("key", "times", "more", "turn", "copy"))
    held = mix_sources(df, id_col, source_col, text_col).groupBy(F.col("row_key").alias(key)).agg(F.sum("times").alias("total"), F.count("*").alias("n")).where("total > 0")
    mix = scratch.save(held.select(key, F.expr("cast(total div n as int)").alias(times), (F.col("total") % F.col("n")).alias(more)), "mix")
    rows = df.withColumn(key, F.xxhash64(id_col, source_col, text_col))
    out = rows.join(shuffled(mix.where(F.col(more) == 0)), key)
    parted = mix.where(F.col(more) > 0)  # only where the budget ends within equal rows
    if not parted.isEmpty():
        order = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(comparable(df))))
        some = rows.join(parted, key).withColumn(turn, order).withColumn(times, F.col(times) + (F.col(turn) <= F.col(more)).cast("int"))
        out = out.unionByName(some.drop(turn))
    return out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(*own(df))
