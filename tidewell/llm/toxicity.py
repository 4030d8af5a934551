"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct character n-grams of 5 to 7 characters of the lower-cased text (anything but
letters is one separator), hashed to 2**21 buckets. Spark counts in how many toxic and other labelled documents
each bucket occurs; the log of the ratio of the smoothed shares scales the feature, a document's scaled features
are brought to the length LENGTH, and a logistic regression is fitted on those of the FEATURES buckets that tell
the classes apart best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm import chars
from tidewell.llm.scratch import Scratch, least_rows, slices

ORDERS = (5, 6, 7)
BUCKET_BITS = 21
#: Labelled documents that the fit uses at most (those with the least hashes of id and text); features kept, and their least log ratio; smoothing; length of a document's features; penalty.
SAMPLE, FEATURES, LEAST_RATIO, ALPHA, LENGTH, PENALTY = 12_000, 20_000, 1.0, 0.5, 5.0, 0.1


def _features(texts: list[str], slot: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text index, feature) pairs, each pair once; slot maps buckets to features, -1 to none.

    A long text comes in chunks: its last codes go on into the next one, so no n-gram is lost, and its features are
    gathered (there are no more of them than buckets) until the text ends.
    """
    tail, last, gathered = np.zeros(0, np.uint32), -1, np.zeros(0, np.int64)
    for found, owner, torn in chars.pieces(texts):
        if torn:
            found, owner = found[:-1], owner[:-1]
        if len(tail) and owner[0] == last:
            found, owner = np.concatenate([tail, found]), np.concatenate([np.full(len(tail), last), owner])
        pairs = [gathered]
        for n in ORDERS:
            if len(found) < n:
                continue
            at = (chars.ngrams(found, n) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            own = owner[: len(at)]
            inside = own == owner[n - 1 :]
            if slot is not None:
                at = slot[at]
                inside &= at >= 0
            pairs.append((own[inside] << 24) | at[inside])
        both = np.unique(np.concatenate(pairs))
        last, tail = owner[-1], found[-min(len(found), max(ORDERS) - 1) :][owner[-min(len(found), max(ORDERS) - 1) :] == owner[-1]]
        open_ = both >> 24 == last
        gathered, done = both[open_], both[~open_]
        yield done >> 24, done & 0xFFFFFF
    yield gathered >> 24, gathered & 0xFFFFFF


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by bucket and label in each batch."""
    for batch in slices(batches):
        label = batch["label"].to_numpy().astype(np.int64)
        found = [(f << 1) | label[own] for own, f in _features(chars.texts_of(batch["text"]))]
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(keys & 1), pa.array(n)], ["bucket", "label", "n"])


@dataclass
class Model:
    """slot: feature of each bucket or -1; ratio and weight: of each feature; bias."""

    slot: np.ndarray
    ratio: np.ndarray
    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        total, squares = np.zeros(len(texts)), np.zeros(len(texts))
        for own, f in _features(texts, self.slot):
            total += np.bincount(own, self.weight[f] * self.ratio[f], len(texts))
            squares += np.bincount(own, self.ratio[f] ** 2, len(texts))
        z = LENGTH * total / np.sqrt(np.maximum(squares, 1e-12)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-penalised logistic regression by Nesterov's accelerated gradient."""
    n = len(labels)
    norms = np.bincount(rows, values**2, n)
    rate = 1 / (0.25 * (norms.mean() * 4 + 1) + PENALTY / n)
    w, b = np.zeros(width), 0.0
    vw, vb = w.copy(), b
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(rows, values * vw.astype(np.float32)[columns], n) + vb, -35, 35)))
        g = (p - labels) / n
        new_w = vw - rate * (np.bincount(columns, values * g.astype(np.float32)[rows], width) + PENALTY / n * vw)
        new_b = vb - rate * g.sum()
        m = k / (k + 3)
        vw, vb, w, b = new_w + m * (new_w - w), new_b + m * (new_b - b), new_w, new_b
    return w, b


def fit(labelled: DataFrame, key: str | None = None) -> Model:
    """A model from (doc_id, text, label); label is 0 or 1, other rows are left out. Without rows of both labels every score is the smoothed share of label 1.

    It learns from the SAMPLE rows with the least keys, rows of one key once. The key is the column of that name, or a
    hash of id and text: a caller who joins labels to texts computes it before, so that the choice needs no texts.
    """
    rows = labelled.where(F.col("label").isin(0, 1) & F.col("text").isNotNull())
    rows = least_rows(rows, F.col(key) if key else F.xxhash64("doc_id", "text"), SAMPLE)
    rows = Scratch(labelled.sparkSession, "toxicity").save(rows.select("text", F.col("label").cast("long").alias("label")), "labelled")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    slot = np.full(1 << BUCKET_BITS, -1, np.int64)
    if len(sizes) < 2:
        share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
        return Model(slot, np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    counts = rows.mapInArrow(_count, "bucket long, label long, n long").groupBy("bucket").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("q"))
    share = lambda c, k: (F.col(c) + ALPHA) / (sizes[k] + 2 * ALPHA)
    ratio = F.log(share("p", 1) / share("q", 0))
    apart = F.abs((share("p", 1) - share("q", 0)) * ratio)
    best = counts.where((F.col("p") + F.col("q") > 2) & (F.abs(ratio) >= LEAST_RATIO)).select("bucket", ratio.alias("ratio"), apart.alias("apart")).orderBy(F.desc("apart"), "bucket").limit(FEATURES).toArrow()
    slot[best["bucket"].to_numpy()] = np.arange(len(best))
    ratios = best["ratio"].to_numpy()

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: list[list[int]] = [[] for _ in range(batch.num_rows)]
            for own, f in _features(chars.texts_of(batch["text"]), slot):
                for i in np.unique(own):
                    found[i] += f[own == i].tolist()
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array([sorted(x) for x in found], pa.list_(pa.int32()))], ["label", "features"])

    # SAMPLE documents at most, as numbers of kept features.
    sample = rows.mapInArrow(active, "label long, features array<int>").toArrow()
    labels = sample["label"].to_numpy().astype(float)
    features = sample["features"].combine_chunks()
    columns = np.asarray(features.flatten(), np.int32)
    owners = np.repeat(np.arange(len(labels), dtype=np.int32), np.diff(np.asarray(features.offsets)))
    values = ratios[columns]
    values *= LENGTH / np.sqrt(np.maximum(np.bincount(owners, values**2, len(labels)), 1e-12))[owners]
    w, b = _logistic(owners, columns, values.astype(np.float32), labels, len(best))
    return Model(slot.astype(np.int32), ratios, w, float(b))


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row, repeated ones too; null and empty texts get the score of no features, texts of any length are scored whole.

    Other columns are ignored whatever their names. An empty df gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.scores(chars.texts_of(batch["text"])), pa.float64())], ["doc_id", "score"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
