"""Shared intermediate tables, small Arrow batches and unused column names for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents handled at once in a task; Spark itself bounds the Arrow batch that they come in by bytes.
BATCH_ROWS = 1000
#: Estimated bytes up to which a side of a join may be broadcast.
SMALL = 256 << 10


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session gets one of its own (tests); on a cluster that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidewell-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def slices(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows, so that what a function holds for a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own(df: DataFrame) -> list[Column]:
    """df's columns, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def least_rows(df: DataFrame, key: Column, most: int) -> DataFrame:
    """The `most` rows of df with the least 64-bit keys, one row of each key; all keys if there are fewer.

    The number of rows is exact whatever df's size, and a key that holds a third of the rows counts once.
    """
    name = unused(df, "_key")
    best = df.select(key.alias(name)).distinct().orderBy(name).limit(most).agg(F.max(name)).first()[0]
    rows = df.withColumn(name, key)
    return rows.where(F.col(name) <= best if best is not None else F.lit(False)).dropDuplicates([name]).drop(name)


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that shuffles both sides, unless df is estimated at SMALL bytes at most.

    Spark sends a side through the driver if its files are small; but some bytes of a file may be many rows, and of rows that
    explode() or mapInArrow() multiply it knows only the files they come from.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.hint("merge") if size > SMALL else df


def comparable(df: DataFrame) -> Column:
    """All columns of df as one that can be compared and hashed: a struct, or its JSON where df has maps."""
    row = F.struct(*own(df))
    return F.to_json(row) if '"type":"map"' in df.schema.json() else row


class Scratch:
    """Tables of one operator run, written below shared_dir so that a lost executor costs no lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df, then give it back as a plain Parquet scan."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads; those that the returned DataFrame reads stay until the folder is cleared."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
