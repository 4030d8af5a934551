"""Registered queries of the corpus operators: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidewell.llm import bpe, decontaminate, divergence, interactions, language, media, mixing, near_dup, pii, sharding, spans, toxicity, urls
from tidewell.llm.oracles import ORACLES


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in each document."""
    return pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose row counts differ by one at most."""
    rows = sharding.shard_rows(_table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a benchmark item and a document that contains three quarters of its shingles or more."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "doc_id", "n_item", "n_shared", "containment")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's near-duplicate group."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose repeated spans, what they lose and what is left."""
    found = spans.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "removed", "removed_chars", "text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for each document, learned from the labels that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id")).select("doc_id", F.col("toxic").alias("label"))
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    scored = toxicity.score(docs, toxicity.fit(keyed.join(labels, "doc_id"), "key"))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language for each document, learned from the documents that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, language.fit_on_documents(docs))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on each page's URL."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.fit(urls.labelled(spark))).select("page_id", "host", "path", "rule", "verdict", "probability")


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document stored as an image, read back and described."""
    return media.store_and_describe(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return interactions.audit(docs.select("doc_id", "text", "lang"), labels)


def op12_bpe(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Digests of each document's token ids and of the text that they decode to; tokenizer is the path of a tokenizer.json."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    tables = bpe.Tokenizer.load(tokenizer)
    rows = bpe.encode_rows(_table(spark, sf_dir, "documents").select("doc_id", "text"), tables)
    decoded = F.sha2(bpe.decode(tables, F.col("ids")), 256)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language diverge, and by which terms."""
    return divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_shards, op3_contaminated, op4_near_duplicates, op5_repeated_spans, op6_toxicity, op7_language, op8_mix, op9_urls, op10_media, op11_interactions, op12_bpe, op13_divergence, pipeline)}


def oracle_sql() -> dict[str, str]:
    return ORACLES
