"""Retention that acts: rows, partitions and files are planned first, and go only if the caller says act=True.

Partitions that are wholly too old are dropped, and only those that the cutoff runs through are rewritten. Files are
deleted by the executors, each behind the same guards, with a row that tells what became of it. A second run finds
nothing left to do.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.maintenance import expired_partitions
from tidewell.sources import sinks

#: What became of a file: left alone as act was off, deleted, not there any more, changed since the plan, outside the root, or an error.
OUTCOMES = ("planned", "deleted", "gone", "changed", "refused", "failed")


def table_at(spark: SparkSession, path: str, partitions: list[str]) -> DataFrame:
    """The table at path with its partition columns as the strings in the paths, so that writing gives the same folders."""
    found = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([T.StructField(f.name, T.StringType() if f.name in partitions else f.dataType) for f in found])).parquet(path)


def partition_plan(table: DataFrame, column: str, cutoff: int, partitions: list[str]) -> DataFrame:
    """By partition: rows, rows before the cutoff (a null time never is), and what to do: keep, rewrite or drop."""
    old = F.coalesce(F.col(column) < cutoff, F.lit(False))
    out = table.groupBy(*partitions).agg(F.count("*").alias("n"), F.count_if(old).alias("expired"))
    return out.withColumn("action", F.when(F.col("expired") == 0, "keep").when(F.col("expired") < F.col("n"), "rewrite").otherwise("drop"))


def retain_rows(spark: SparkSession, path: str, column: str, cutoff: int, partitions: list[str], act: bool = False) -> DataFrame:
    """Delete the rows before the cutoff from the partitioned Parquet table at path; the plan by partition tells what was (or would be) done.

    Rewritten partitions are staged beside the table and then replaced by dynamic overwrite; wholly expired ones lose
    their folder. Between two acts a reader sees each partition either as before or as after. Writers of the same
    partitions must wait, as for upserts.
    """
    table = table_at(spark, path, partitions)
    plan = partition_plan(table, column, cutoff, partitions)
    if not act:
        return plan
    staged = f"{path.rstrip('/')}-retained-{uuid.uuid4().hex[:12]}"
    try:
        # The plan is kept as it was: the table changes under it.
        plan = sinks._saved(plan, f"{staged}/plan", [])
        done = spark.createDataFrame(plan.toArrow())  # one row a partition
        same = F.lit(True)
        for c in partitions:
            same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}"))
        kept = table.alias("t").join(done.where("action = 'rewrite'").alias("p"), same, "left_semi").where(f"not coalesce({column} < {cutoff}, false)")
        result = sinks._saved(kept, f"{staged}/kept", [])
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
        for row in done.where("action = 'drop'").select(*partitions).collect():
            sinks._delete(spark, "/".join([path.rstrip("/"), *(f"{c}={_folder(spark, row[c])}" for c in partitions)]))
    finally:
        sinks._delete(spark, staged)
    return done


def _folder(spark: SparkSession, value: str | None) -> str:
    """A partition value as it stands in a path."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def drop_partitions(spark: SparkSession, table: str, cutoff: int, act: bool = False) -> DataFrame:
    """(dt, hour) of a catalog table's partitions before the cutoff's hour; they are dropped if act is on. The data of external tables stays where it is."""
    shown = spark.sql(f"SHOW PARTITIONS {table}").select(F.concat(F.lit("/"), "partition", F.lit("/")).alias("path"))
    due = expired_partitions(shown, cutoff)
    if not act:
        return due
    rows = [tuple(r) for r in due.collect()]  # one row a partition
    for dt, hour in rows:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (dt = '{dt}', hour = '{hour}')")
    return spark.createDataFrame(rows, "dt string, hour string")


def _local(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _remove(path: str, modified: int, root: str) -> tuple[str, str]:
    if not path.startswith(root) or ".." in path.split("/"):
        return "refused", "not below the root"
    try:
        system, name = _local(path)
        info = system.get_file_info(name)
        if info.type == pafs.FileType.NotFound:
            return "gone", ""
        if info.type != pafs.FileType.File:
            return "refused", "not a file"
        if info.mtime_ns // 1_000_000 != modified:
            return "changed", ""
        system.delete_file(name)
    except (OSError, ValueError, pa.ArrowException) as e:
        return "failed", str(e)
    sidecar = posixpath.join(posixpath.dirname(name), f".{posixpath.basename(name)}.crc")
    if isinstance(system, pafs.LocalFileSystem) and os.path.exists(sidecar):
        os.remove(sidecar)
    return "deleted", ""


def delete_files(files: DataFrame, root: str, log: str, act: bool = False) -> DataFrame:
    """(path, bytes, outcome, error) for each of the files (path, bytes, modified), written to `log` once.

    A file goes only if it lies below root, without a step upwards, and hasn't changed since it was listed. A task that
    runs again finds its files gone, which is an outcome and no error.
    """
    below = root.rstrip("/") + "/"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch["path"].to_pylist()
            outcome = [_remove(p, m, below) if act else ("planned", "") for p, m in zip(paths, batch["modified"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["path"], batch["bytes"], *(pa.array(x, pa.string()) for x in ([o for o, _ in outcome], [e for _, e in outcome]))], ["path", "bytes", "outcome", "error"])

    rows = files.select("path", F.col("bytes").cast("long").alias("bytes"), F.col("modified").cast("long").alias("modified")).dropDuplicates(["path"])
    return sinks._saved(rows.mapInArrow(run, "path string, bytes long, outcome string, error string"), log, [])
