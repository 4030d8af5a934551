"""Retention and storage checks. Functions plan; they delete nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FINISHED = (".parquet", ".orc", ".avro")
LEAST_AGE_MS = 3_600_000


def keep_since(df: DataFrame, column: str, cutoff: int) -> DataFrame:
    """Rows at or after the cutoff; for KPIs the window's end, for anomalies the event's or the detection's time."""
    return df.where(F.col(column) >= cutoff)


def partition_keys(files: DataFrame) -> DataFrame:
    """(path, ...) with the dt and hour named in the path, and key = 'dt-hour'; files outside partitions have none."""
    part = lambda name: F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
    return files.withColumns({"dt": part("dt"), "hour": part("hour")}).withColumn("key", F.when(F.col("dt") != "", F.concat_ws("-", "dt", "hour")))


def expired_partitions(files: DataFrame, cutoff: int) -> DataFrame:
    """Partitions (dt, hour) before the cutoff's hour."""
    line = F.date_format(F.timestamp_millis(F.lit(cutoff)), "yyyy-MM-dd-HH")
    return partition_keys(files).where(F.col("key") < line).select("dt", "hour").distinct()


def stale_files(files: DataFrame, finished_before: int, unfinished_before: int) -> DataFrame:
    """Files to delete by their time: finished ones, and unfinished ones (.inprogress) that nobody goes on with."""
    unfinished = F.col("path").contains(".inprogress")
    return files.where((~unfinished & (F.col("modified") < finished_before)) | (unfinished & (F.col("modified") < unfinished_before)))


def byte_budget(files: DataFrame, most: int, strict: bool = False) -> DataFrame:
    """One row: bytes of all files (an overflow raises), the budget, and whether they are within it; strict: more is an error."""
    if strict:
        above = F.raise_error(F.concat(F.lit("byte budget exceeded: "), F.col("bytes").cast("string"))).cast("boolean")
        return byte_budget(files, most).withColumn("within", F.when(F.col("within"), F.lit(True)).otherwise(above))
    return files.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).select("bytes", F.lit(most).cast("long").alias("budget"), (F.col("bytes") <= most).alias("within"))


def orphan_files(files: DataFrame, referenced: DataFrame, now: int, age_ms: int, allow: bool = False) -> DataFrame:
    """Finished files that no snapshot refers to and that are older than age_ms; only their paths are told.

    The age must be an hour or more, and the caller must say that orphans may be listed for deletion.
    """
    if age_ms < LEAST_AGE_MS:
        raise ValueError("orphans must be an hour old or more")
    if not allow:
        raise ValueError("listing orphans for deletion must be allowed explicitly")
    finished = F.lit(False)
    for ending in FINISHED:
        finished = finished | F.col("path").endswith(ending)
    safe = ~F.col("path").contains("/../")
    return files.where(finished & safe & (F.col("modified") < now - age_ms)).join(referenced, "path", "left_anti")


def inventory(files: DataFrame) -> DataFrame:
    """By table (the path's first folder): files, bytes, partition folders, the first and the last of them, and files in progress."""
    parts = F.split("path", "/")
    rows = files.select(F.regexp_extract("path", "^/?([^/]+)/", 1).alias("root"), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("folder"), "bytes", F.col("path").contains(".inprogress").alias("open"))
    folders = rows.groupBy("root", "folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.count_if("open").alias("open"))
    return folders.groupBy("root").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"), F.count("*").alias("folders"), F.min("folder").alias("first_folder"), F.max("folder").alias("last_folder"), F.sum("open").alias("in_progress"))


def compare(inventories: DataFrame, first: str, second: str) -> DataFrame:
    """One row for each figure of two tables' inventories (the same results in two formats, say): both values, their difference, and the second as a share of the first (null for none). A table that isn't there counts as empty."""
    names = ("files", "bytes", "folders", "in_progress")
    of = lambda root, c: F.coalesce(F.sum(F.when(F.col("root") == root, F.col(c))), F.lit(0)).cast("long")
    both = inventories.agg(F.array(*(F.struct(F.lit(c).alias("figure"), of(first, c).alias("first"), of(second, c).alias("second")) for c in names)).alias("f"))
    rows = both.select(F.explode("f").alias("f")).select("f.*")
    return rows.withColumns({"difference": F.col("second") - F.col("first"), "share": F.when(F.col("first") != 0, F.col("second") / F.col("first"))})


def profile(kpis: DataFrame) -> DataFrame:
    """By window kind: rows, first and last window, distinct sites, cells and grids."""
    return kpis.groupBy("window_kind").agg(F.count("*").alias("n"), F.min("window_start_ts").alias("first_ts"), F.max("window_end_ts").alias("last_ts"), F.count_distinct("site_id").alias("sites"), F.count_distinct("cell_id").alias("cells"), F.count_distinct(F.when(F.col("grid_id") != "", F.col("grid_id"))).alias("grids"))


def table_status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """A row for each table: rows, first and last time of its time column."""
    out = None
    for name, (df, ts) in tables.items():
        one = df.agg(F.count("*").alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).select(F.lit(name).alias("name"), "n", "first_ts", "last_ts")
        out = one if out is None else out.unionByName(one)
    return out


def topology_stats(topology: DataFrame) -> DataFrame:
    """One row: records, distinct sites and bands, and the bounding box (zeros when empty)."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return topology.agg(F.count("*").alias("records"), F.count_distinct("site_id").alias("sites"), F.count_distinct("frequency_band").alias("bands"), *(zero(f(c)).alias(f"{n}_{c}") for n, f in (("min", F.min), ("max", F.max)) for c in ("site_lat", "site_lon")))
