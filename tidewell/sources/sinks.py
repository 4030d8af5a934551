"""Sinks: partitioned tables, keyed upserts, side outputs and the dispatcher over them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KPI_KEY, ANOMALY_KEY = ("window_start_ts", "window_kind", "cell_id"), ("anomaly_id",)
SINKS = ("parquet", "table", "upsert", "kafka", "none")
#: Partitions that one upsert may touch (a day each for results).
MOST_PARTITIONS = 1000


def day_and_hour(ts: str) -> dict[str, Column]:
    """UTC partition columns dt and hour of an epoch-ms column."""
    at = F.timestamp_millis(F.col(ts))
    return {"dt": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")}


def write_kpis(df: DataFrame, path: str, mode: str = "append") -> None:
    """KPI rows as Parquet partitioned by window kind, day and hour of the window's start."""
    df.withColumns(day_and_hour("window_start_ts")).write.mode(mode).partitionBy("window_kind", "dt", "hour").parquet(path)


def write_anomalies(df: DataFrame, path: str, mode: str = "append") -> None:
    """Anomalies as Parquet partitioned by day and hour of the event."""
    df.withColumns(day_and_hour("event_ts")).write.mode(mode).partitionBy("dt", "hour").parquet(path)


def upsert(df: DataFrame, path: str, key: tuple[str, ...], partitions: list[str], order: str | None = None) -> None:
    """Write rows so that the table at path has the row written last of each key.

    Rows of df go before stored ones; among themselves the latest by `order` stays, and rows that tie but differ are an
    error. Only the partitions that df touches are listed, read and replaced: their values (MOST_PARTITIONS at most)
    become a static filter. The merged partitions are written beside the table first, because a partition can't be
    read while it is overwritten; rows whose key moves between partitions are the caller's to avoid. Repeating a call
    changes nothing. Two writers of the same partition at once need a lock of the caller's: the later one wins whole.
    """
    spark = df.sparkSession
    staged = f"{path}-staged-{uuid.uuid4().hex[:12]}"
    rank, new = "_rank", "_new"
    try:
        fresh = _saved(df.distinct(), f"{staged}/new", [])
        ties = fresh.groupBy(*key, *([order] if order else [])).count().where("count > 1")
        if not ties.isEmpty():
            raise ValueError(f"rows of one batch share their key {key} and can't be ordered")
        touched = fresh.select(*partitions).distinct().limit(MOST_PARTITIONS + 1).collect()
        if len(touched) > MOST_PARTITIONS:
            raise ValueError(f"a batch may touch {MOST_PARTITIONS} partitions at most")
        merged = fresh.withColumn(new, F.lit(1))
        if touched and _exists(spark, path):
            merged = merged.unionByName(stored(spark, path, df, touched).withColumn(new, F.lit(0)), allowMissingColumns=True)
        by = [F.desc(new), *([F.desc(order)] if order else [])]
        latest = merged.withColumn(rank, F.row_number().over(Window.partitionBy(*key).orderBy(*by))).where(F.col(rank) == 1).drop(rank, new)
        result = _saved(latest, f"{staged}/merged", partitions)
        result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    finally:
        _delete(spark, staged)


def _saved(df: DataFrame, path: str, partitions: list[str]) -> DataFrame:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, path: str, like: DataFrame, touched: list[Row]) -> DataFrame:
    """The rows of the table at path in the given partitions, whose columns have the types that they have in `like`."""
    types = {f.name: f.dataType for f in like.schema}
    names = touched[0].__fields__
    schema = T.StructType([T.StructField(f.name, types[f.name] if f.name in names else f.dataType) for f in spark.read.parquet(path).schema])
    wanted = F.lit(False)
    for row in touched:
        one = F.lit(True)
        for name in names:
            one = one & F.col(name).eqNullSafe(F.lit(row[name]))
        wanted = wanted | one
    if len(names) == 1 and all(row[0] is not None for row in touched):
        wanted = F.col(names[0]).isin([row[0] for row in touched])
    return spark.read.schema(schema).parquet(path).where(wanted)


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def ensure_table(spark: SparkSession, name: str, df: DataFrame, properties: dict[str, str] | None = None, partitions: list[str] | None = None) -> None:
    """Create the table with df's columns, partitioned by `partitions`, if it isn't there, add columns that it lacks, and set its properties."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], df.schema).write.format("parquet").partitionBy(*(partitions or [])).saveAsTable(name)
    have = {f.name for f in spark.table(name).schema}
    missing = [f for f in df.schema if f.name not in have]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in missing)})")
    if properties:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{k!r} = {v!r}' for k, v in properties.items())})")


def append_by_name(df: DataFrame, name: str) -> None:
    """Append rows to a table by column name; columns that df lacks are null."""
    fields = df.sparkSession.table(name).schema
    have = set(df.columns)
    rows = df.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
    rows.write.mode("append").option("partitionOverwriteMode", "dynamic").insertInto(name)


def reset_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def to_kafka(df: DataFrame, key: str, avro_schema: str | None = None) -> DataFrame:
    """key and value (JSON, or Avro if a schema is given) as the Kafka sink takes them; send with .write.format("kafka"). (Avro and sending need the connector packages.)"""
    row = F.struct(*df.columns)
    if avro_schema is None:
        value = F.to_json(row)
    else:
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(row, avro_schema)
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def sink_of(name: str | None) -> str:
    """The sink of that name; parquet for names that aren't known."""
    return name.lower() if name and name.lower() in SINKS else "parquet"


def write_results(outputs: dict[str, DataFrame], sink: str | None, root: str, order: str | None = None) -> None:
    """Write all outputs (kpi, kpi_rollup, cell, user, grid) to one sink.

    order: the column by which an upsert takes the later of two rows of one key (an arrival number, say); outputs
    without it must not have two different rows of a key.
    """
    kind = sink_of(sink)
    for name, df in outputs.items():
        is_kpi = name.startswith("kpi")
        if kind == "none":
            df.write.format("noop").mode("overwrite").save()
        elif kind == "kafka":
            to_kafka(df, "cell_id" if is_kpi else "anomaly_id").write.format("kafka").option("topic", name).option("kafka.bootstrap.servers", root).save()
        elif kind == "table":
            dated = df.withColumns(day_and_hour("window_start_ts" if is_kpi else "event_ts"))
            ensure_table(df.sparkSession, f"{root}.{name}", dated, partitions=["window_kind", "dt", "hour"] if is_kpi else ["dt", "hour"])
            append_by_name(dated, f"{root}.{name}")
        elif kind == "upsert":
            dated = df.withColumns(day_and_hour("window_start_ts" if is_kpi else "event_ts"))
            upsert(dated, f"{root}/{name}", KPI_KEY if is_kpi else ANOMALY_KEY, ["dt"], order if order in df.columns else None)
        else:
            (write_kpis if is_kpi else write_anomalies)(df, f"{root}/{name}")


def write_summary(df: DataFrame, path: str) -> None:
    """A small result table (a row a run) as one CSV with a header and one JSON file."""
    one = df.coalesce(1)
    one.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    one.write.mode("overwrite").json(f"{path}/json")


def write_samples(samples: DataFrame, path: str) -> None:
    """Metric samples as JSON lines by run."""
    samples.select("run_id", F.to_json(F.struct(*samples.columns)).alias("value")).write.mode("append").partitionBy("run_id").text(path)


def write_routing(decisions: DataFrame, path: str) -> None:
    """Append routing decisions to a table, and replace the CSV of the latest row of each key in that table."""
    decisions.write.mode("append").parquet(f"{path}/decisions")
    every = decisions.sparkSession.read.schema(decisions.schema).parquet(f"{path}/decisions")
    every.groupBy("cell_id").agg(F.max_by(F.struct("shift", "routing_version"), "routing_version").alias("r")).select("cell_id", "r.*").write.mode("overwrite").csv(f"{path}/current")
