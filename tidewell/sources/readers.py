"""Sources: event streams and tables, JSON metric samples, run logs and metadata, and file listings.

Kafka and Avro readers need Spark's connector packages on the class path; their file-based twins read the same
rows from Parquet and are what the tests run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_SCHEMA = "stage_id STRING, subtask LONG, updated_at LONG, records LONG, rows_written LONG, p95_ms LONG, lag_ms LONG, errors LONG, status STRING"


def kafka_stream(spark: SparkSession, servers: str, topic: str, avro_schema: str, from_start: bool = False) -> DataFrame:
    """A Kafka topic of Avro values; a bad record fails the query. Changelogs are read from the start, events from now on. (Needs the connector packages.)"""
    from pyspark.sql.avro.functions import from_avro

    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest" if from_start else "latest").load()
    return raw.select(from_avro("value", avro_schema, {"mode": "FAILFAST"}).alias("v"), F.col("timestamp").alias("record_time")).select("v.*", "record_time")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def topic_counts(rows: DataFrame) -> DataFrame:
    """Records of each topic and partition, from (topic, partition, offset)."""
    return rows.groupBy("topic", "partition").agg((F.max("offset") - F.min("offset") + 1).alias("records"))


def latest_topology(records: DataFrame) -> DataFrame:
    """The last record of each cell by version."""
    return records.groupBy("cell_id").agg(F.max_by(F.struct(*(c for c in records.columns if c != "cell_id")), "version").alias("r")).select("cell_id", "r.*")


def cells_by_site(topology: DataFrame) -> DataFrame:
    return topology.groupBy("site_id").agg(F.array_sort(F.collect_set("cell_id")).alias("cells"))


def samples_from_json(lines: DataFrame) -> DataFrame:
    """Metric samples from JSON (column value) with defaults for missing fields; malformed lines are left out."""
    rows = lines.select(F.from_json("value", f"{SAMPLE_SCHEMA}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*").where("_corrupt is null and stage_id is not null")
    n = lambda x, d: F.coalesce(x, F.lit(d)).alias(x)
    records = F.when(F.coalesce("records", F.lit(0)) == 0, F.coalesce("rows_written", F.lit(0))).otherwise(F.col("records"))
    status = F.when(F.trim(F.coalesce("status", F.lit(""))) != "", F.col("status")).otherwise("unknown")
    return rows.select("stage_id", n("subtask", -1), n("updated_at", 0), records.alias("records"), n("p95_ms", -1), n("lag_ms", 0), n("errors", 0), status.alias("status"))


def jsonl_quality(lines: DataFrame, most: int) -> DataFrame:
    """One row about JSON lines (number, value): valid and invalid ones among the first `most` that aren't blank, and whether there were more."""
    rows = lines.where(F.trim("value") != "")
    head = rows.orderBy("number").limit(most)
    valid = F.from_json("value", "stage_id STRING", {"mode": "PERMISSIVE"})["stage_id"].isNotNull()
    total = rows.agg(F.count("*").alias("all_lines"))
    return head.agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid")).join(F.broadcast(total)).select("valid", "invalid", (F.col("all_lines") > most).alias("truncated"))


def log_metrics(lines: DataFrame) -> DataFrame:
    """(section, metric, value) from lines `[summary] section | metric | value`; header lines (===) and others are left out."""
    part = lambda k: F.trim(F.regexp_extract("value", r"^\[summary\]\s*([^|]*)\|([^|]*)\|(.*)$", k))
    return lines.where(F.col("value").startswith("[summary]") & ~F.col("value").contains("===")).select(part(1).alias("section"), part(2).alias("metric"), part(3).alias("value")).where("metric != ''")


def run_metadata(files: DataFrame) -> DataFrame:
    """(path, value) with a run's JSON: its id (else the folder's name), sink and status (else unknown)."""
    meta = F.from_json("value", "runId STRING, sink STRING, status STRING, startedAt LONG")
    folder = F.element_at(F.split("path", "/"), -2)
    text = lambda x, d: F.coalesce(F.when(F.trim(meta[x]) != "", meta[x]), d)
    return files.select(text("runId", folder).alias("run_id"), text("sink", F.lit("unknown")).alias("sink"), text("status", F.lit("unknown")).alias("status"), meta["startedAt"].alias("started_at"))


def run_list(runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Runs, newest first, those without a start last, with their headline: the status metric, else the first KPI metric; null without both.

    metrics are (run_id, section, ord, metric, value) rows of a run's log.
    """
    kpi = F.col("section") == "kpi"
    status = F.max(F.when(F.col("metric") == "status", F.col("value")))
    heads = metrics.groupBy("run_id").agg(F.coalesce(status, F.min_by(F.when(kpi, F.concat_ws(" ", "metric", "value")), F.when(kpi, F.col("ord")))).alias("headline"))
    return runs.join(heads, "run_id", "left").orderBy(F.desc_nulls_last("started_at"), "run_id")


def source_metrics_pivot(rows: DataFrame) -> DataFrame:
    """(run_id, source, events) as one row a run with a column for each source; a missing source has 0."""
    return rows.groupBy("run_id").pivot("source", ["chr", "pm", "cfg"]).agg(F.sum("events")).fillna(0, ["chr", "pm", "cfg"])


def kind_views(spark: SparkSession, kpis: DataFrame) -> None:
    """Views kpi_1m and kpi_5m over a KPI table."""
    kpis.where("window_kind = 'MIN_1'").createOrReplaceTempView("kpi_1m")
    kpis.where("window_kind = 'MIN_5'").createOrReplaceTempView("kpi_5m")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files below path: path, bytes, modified (epoch ms); contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.unix_millis("modificationTime").alias("modified"))
