"""Benchmark decontamination: size-partitioned MinHash containment search with exact confirmation.

Benchmark items are partitioned by the power of two below their number of shingles. An item of q shingles has as
sketch its m = q - ceil(t * q) + 1 smallest hashes (a bottom-m MinHash). A document that contains a part t of the
item misses m - 1 of its shingles at most, so it has one of the sketch: the search loses nothing. In each
partition a document is searched with the part of its own hashes that lies below the partition's largest sketch
value, and only if it is long enough to contain a part t of the partition's smallest item. What hits becomes a
candidate pair, and pairs are confirmed by exact containment of the full shingle sets.

Words are runs of letters, digits and non-ASCII characters with A-Z lower-cased, so punctuation around or
between words doesn't hide a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import bitmaps, shingles
from tidewell.llm.scratch import Scratch, own, slices, unused

#: Part of an item's shingles, in hundredths, that a document must contain; tasks over which the documents that hit one sketch value are dealt.
PERCENT, SALTS = 75, 16


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _tagged(hashes: np.ndarray, partition: int) -> np.ndarray:
    return shingles.mix(hashes + shingles.mix(np.array([partition + 1], np.uint64)))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out: list[tuple] = []
        for item, found in zip(batch["item_id"].to_pylist(), shingles.shingle_sets(_texts(batch["text"]), separators=shingles.PUNCTUATION), strict=True):
            q = len(found)
            if q:
                least = found[: q + 1 - -(-PERCENT * q // 100)]
                partition = q.bit_length() - 1
                out.append((item, partition, q, int(least[-1] >> np.uint64(1)), found.view(np.int64).tolist(), _tagged(least, partition).view(np.int64).tolist()))
        columns = list(zip(*out, strict=True)) or [()] * 6
        types = [batch["item_id"].type, pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item_id", "partition", "q", "top", "found", "keys"])


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs of a benchmark item and a document that contains at least 75 % of the item's distinct five-word shingles.

    Returns item_id, doc_id, row_key (hash of the document's id and text), n_item (the item's shingles), n_shared
    and containment; a pair once, however often either is repeated. Items of one to four words are one shingle,
    which only a document of just these words has; items and documents without words, or null, are in no pair.
    Other columns are ignored. An empty table on either side gives an empty result.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "decontaminate")
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    items = scratch.save(items.mapInArrow(_sketch, "item_id long, partition int, q long, top long, found array<long>, keys array<long>"), "items")
    # A row for each power of two that occurs as an item's size: 64 at most.
    partitions = [(r["partition"], r["least"], r["top"]) for r in items.groupBy("partition").agg(F.min("q").alias("least"), F.max("top").alias("top")).collect()]
    sketched = bitmaps.build(items.select(F.explode("keys").alias("k")), F.col("k"))
    known = bitmaps.build(items.select(F.explode("found").alias("k")), F.col("k"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            row, keys, shared = [], [], []
            texts = _texts(batch["text"])
            base = 0
            for part in shingles.groups(texts):
                hashes, counts = shingles.shingle_hashes(*shingles.word_hashes(texts[part], shingles.PUNCTUATION))
                owner = np.repeat(np.arange(len(counts)), counts)
                hit_owner, hit_key = [], []
                for partition, least, top in partitions:
                    fits = (hashes >> np.uint64(1) <= np.uint64(top)) & (100 * counts >= PERCENT * least)[owner]
                    tagged = _tagged(hashes[fits], partition)
                    hit = bitmaps.hits(sketched, tagged)
                    hit_owner.append(owner[fits][hit])
                    hit_key.append(tagged[hit])
                hit_owner = np.concatenate([np.zeros(0, np.int64), *hit_owner])
                hit_key = np.concatenate([np.zeros(0, np.uint64), *hit_key])
                ends = np.cumsum(counts)
                for i in np.unique(hit_owner):
                    own = np.unique(hashes[ends[i] - counts[i] : ends[i]])
                    row.append(base + int(i))
                    keys.append(np.unique(hit_key[hit_owner == i]).view(np.int64).tolist())
                    shared.append(own[bitmaps.hits(known, own)].view(np.int64).tolist())
                base += len(counts)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(at), batch["row_key"].take(at), pa.array(keys, pa.list_(pa.int64())), pa.array(shared, pa.list_(pa.int64()))], ["doc_id", "row_key", "keys", "shared"])

    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    hits = scratch.save(docs.mapInArrow(search, "doc_id long, row_key long, keys array<long>, shared array<long>"), "hits")
    # A passage that very many documents hold is one key: its documents are dealt over SALTS tasks, its items go to each.
    sketch = items.select("item_id", F.explode("keys").alias("key")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hits.select("row_key", F.pmod(F.xxhash64("row_key"), F.lit(SALTS)).cast("int").alias("salt"), F.explode("keys").alias("key"))
    pairs = salted.join(sketch, ["key", "salt"]).select("row_key", "item_id").distinct()
    full = pairs.join(hits.drop("keys"), "row_key").join(items.select("item_id", "q", "found"), "item_id")
    n = F.size(F.array_intersect("shared", "found")).cast("long")
    full = full.select("item_id", "doc_id", "row_key", F.col("q").alias("n_item"), n.alias("n_shared")).where(F.col("n_shared") * 100 >= F.col("n_item") * PERCENT)
    return full.distinct().withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the documents that contaminated() pairs with an item. Repeated rows go or stay together; null and empty texts stay; df's columns may have any names."""
    key = unused(df, "_key")
    found = contaminated(df, benchmark, id_col, text_col).select(F.col("row_key").alias(key)).distinct()
    found = Scratch(df.sparkSession, "decontaminate").save(found, "found")
    return df.withColumn(key, F.xxhash64(id_col, text_col)).join(found, key, "left_anti").select(*own(df))
