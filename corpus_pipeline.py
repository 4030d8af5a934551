"""The corpus pipeline: documents in, shuffled shards of a clean and balanced corpus out.

Counted as part of tidewell.llm. Each stage takes (spark, docs, sf_dir), where docs has the columns of documents,
and returns a DataFrame that run() writes to the shared folder and reads again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import decontaminate, language, mixing, near_dup, sharding
from tidewell.llm.scratch import Scratch

SHARDS = 24


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the language identifier finds to be in none of the languages it has learned."""
    return language.keep_identified(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return near_dup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix of sources does."""
    return mixing.apply_mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.shard_rows(docs, SHARDS)


STAGES = [
    ("language_id", keep_languages),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; every stage but the last is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language identification, signatures and the trained tables behind them can't be written in SQL; the tests hold run() against a plain Python version.
ORACLE_SQL = None
