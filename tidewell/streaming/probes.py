"""Probes of running streams, side outputs and idempotent delivery."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewell.sources import sinks


def observed(df: DataFrame, stage: str, ts: str) -> DataFrame:
    """df with counters of the rows that pass: how many, and the least and greatest epoch-ms time."""
    return df.observe(stage, F.count("*").alias("records"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


class Progress(StreamingQueryListener):
    """Turns each batch's progress into metric samples with the fields of the other samples, and hands them to `emit`.

    One for each observed stage, one for the connector's write and one for its commit. lag_ms is now less the
    watermark; times are epoch ms.
    """

    def __init__(self, emit: Callable[[dict], None]):
        self.emit = emit

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        p = event.progress
        took = {k: int(v) for k, v in dict(p.durationMs or {}).items()}
        now = epoch_ms(p.timestamp)
        mark = epoch_ms((p.eventTime or {}).get("watermark"))
        base = sample(run_id=str(p.runId), sample_id=p.batchId, updated_at=now, lag_ms=max(0, now - mark) if mark else 0)
        for stage, row in dict(p.observedMetrics or {}).items():
            self.emit({**base, "stage_id": stage, **row.asDict()})
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators or [])
        write, commit = took.get("addBatch", 0), took.get("walCommit", 0) + took.get("commitOffsets", 0)
        self.emit({**base, "stage_id": "sink-connector-write", "records": p.numInputRows, "duration_ms": write, "p95_ms": write, "dlq": dropped})
        self.emit({**base, "stage_id": "sink-connector-commit", "records": p.numInputRows, "duration_ms": commit, "p95_ms": commit})

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        pass


#: Fields of a metric sample with what stands for nothing.
SAMPLE = {"run_id": "", "sample_id": 0, "stage_id": "", "window": "", "subtask": -1, "updated_at": 0, "eps": 0.0, "records": 0, "bytes": 0, "errors": 0, "failures": 0, "dlq": 0, "p95_ms": -1, "lag_ms": 0, "duration_ms": 0, "status": "healthy", "error_text": ""}
SAMPLE_TYPES = "run_id string, sample_id long, stage_id string, window string, subtask int, updated_at long, eps double, records long, bytes long, errors long, failures long, dlq long, p95_ms long, lag_ms long, duration_ms long, status string, error_text string"


def sample(**fields) -> dict:  # noqa: ANN003
    return {**SAMPLE, **fields}


def epoch_ms(text: str | None) -> int:
    """An ISO time as Spark's progress has it; 0 for none."""
    return round(datetime.fromisoformat(text).timestamp() * 1000) if text else 0


class SampleLog:
    """Keeps the samples of listeners until write() appends them to a sample table; a listener starts no Spark job itself."""

    def __init__(self):
        self.rows: list[dict] = []

    def __call__(self, row: dict) -> None:
        self.rows.append(row)

    def write(self, spark: SparkSession, path: str) -> int:
        rows, self.rows = self.rows, []
        if rows:
            sinks.write_samples(spark.createDataFrame([tuple(sample(**{k: v for k, v in r.items() if k in SAMPLE})[k] for k in SAMPLE) for r in rows], SAMPLE_TYPES), path)
        return len(rows)


def sampled_batches(write: Callable[[DataFrame, int], None], path: str, run_id: str, stage: str, ts: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: `write`, and besides a sample for each subtask (the task that has the rows) with its records and the p95 of their age, appended to the sample table at path."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            write(batch, number)
            now = F.unix_millis(F.current_timestamp())
            rows = batch.select(F.spark_partition_id().alias("subtask"), F.greatest(now - F.col(ts), F.lit(0)).alias("age"))
            found = rows.groupBy("subtask").agg(F.count("*").alias("records"), F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint("age"), F.lit(0.95).cast("double")).alias("p95_ms"), F.max("age").alias("lag_ms"))
            fields = {**SAMPLE, "run_id": run_id, "stage_id": stage, "sample_id": number}
            types = dict(x.split(" ") for x in SAMPLE_TYPES.split(", "))
            columns = [F.col(k) if k in found.columns else now.alias(k) if k == "updated_at" else F.lit(v).cast(types[k]).alias(k) for k, v in fields.items()]
            sinks.write_samples(found.select(*columns), path)
        finally:
            batch.unpersist()

    return run


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """All samples of a sample table, as the queries over samples take them."""
    return spark.read.text(path).select(F.from_json("value", SAMPLE_TYPES).alias("s")).select("s.*")


def detected(anomalies: DataFrame) -> DataFrame:
    """Anomalies with the time of their detection, which is no part of their id."""
    return anomalies.withColumn("detection_ts", F.unix_millis(F.current_timestamp()))


def once(anomalies: DataFrame, delay: str = "1 hour") -> DataFrame:
    """A stream of anomalies without repeats of an id within the delay."""
    return anomalies.withColumn("event_time", F.timestamp_millis("event_ts")).withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["anomaly_id"]).drop("event_time")


def upsert_batches(path: str, key: tuple[str, ...], partitions: list[str], order: str | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch is upserted by key, so a batch delivered again changes nothing."""
    return lambda batch, _: sinks.upsert(batch, path, key, partitions, order)


def split_batches(main: str, late: str | None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch on enriched events: all rows go to `main`, those without a configuration also to `late` (None: switched off). The batch is computed once."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{main}/batch={number}")
            if late:
                batch.where("cfg_version is null").write.mode("overwrite").parquet(f"{late}/batch={number}")
        finally:
            batch.unpersist()

    return write


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Let the catalog find partitions that were written to a partitioned table's folder."""
    spark.catalog.recoverPartitions(table)
