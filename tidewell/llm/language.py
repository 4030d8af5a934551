"""Language identification with word-first backoff.

A text's words are its runs of letters, lower-cased. A word known from training scores by its log frequency in
each language. An unseen word falls back to character n-grams of the padded word, the longest order first: the
first order of which any n-gram is known scores it by the mean log frequency of its known n-grams. The sums over
a text's words, tempered for long texts, give a posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import chars
from tidewell.llm.scratch import Scratch, least_rows, slices

ORDERS = (4, 3, 2, 1)
#: Training documents at most (those with the least hashes of id and text); known words and n-grams of each order kept by language.
SAMPLE, KNOWN = 20_000, 20_000
#: Words after which more words don't sharpen the posterior.
TEMPER = 20
#: What a text needs to be taken for one in a known language: its posterior, and the log odds for that by its known words. Of a text in a known language about half of the words are known, of one in another language one in twenty.
LEAST_SCORE, LEAST_ODDS, KNOWN_SHARES = 0.4, -2.0, (0.5, 0.05)
UNDETERMINED = "und"


def _padded_grams(found: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the word, n-gram hash) for each n-gram of each word with a GAP on either side."""
    lead = np.concatenate([[chars.GAP], found]).astype(np.uint32)  # padded word i is lead[starts[i] : ends[i] + 2]
    hashes = chars.ngrams(lead, n)
    many = np.maximum(ends - starts + 2 - n + 1, 0)
    word = np.repeat(np.arange(len(starts)), many)
    offset = np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)
    return word, hashes[starts[word] + offset]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, key, n): words (kind 0) and n-grams (kind n) by language, summed up by chunk so that little is held at a time."""
    for batch in slices(batches):
        langs = batch["lang"].to_pylist()
        for lang in dict.fromkeys(langs):
            for found, _ in chars.chunks([t or "" for t, x in zip(batch["text"].to_pylist(), langs, strict=True) if x == lang]):
                starts, ends, hashes = chars.words(found)
                keys, first, n = np.unique(hashes, return_index=True, return_counts=True)
                for kind in (0, *ORDERS):
                    held, many = keys, n
                    if kind:
                        word, grams = _padded_grams(found, starts[first], ends[first], kind)
                        held, at = np.unique(grams, return_inverse=True)
                        many = np.bincount(at, n[word], len(held)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), pa.array(np.full(len(held), kind, np.int32)), pa.array(held.view(np.int64)), pa.array(many, pa.int64())], ["lang", "kind", "key", "n"])


@dataclass
class Model:
    """langs; by kind the sorted keys and, for each key, log frequencies by language (the last row holds those of nothing known: zero)."""

    langs: list[str]
    keys: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]

    def _find(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        keys = self.keys[kind]
        if not len(keys):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return np.where(keys[at] == hashes, at, len(keys))

    def _word_scores(self, found: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = self._find(0, hashes)
        out = self.logs[0][at]
        left = np.flatnonzero(at == len(self.keys[0]))
        for order in ORDERS:
            if not len(left):
                break
            word, grams = _padded_grams(found, starts[left], ends[left], order)
            at = self._find(order, grams)
            known = at < len(self.keys[order])
            n = np.bincount(word[known], minlength=len(left))
            for k in range(len(self.langs)):
                total = np.bincount(word[known], self.logs[order][at[known], k], len(left))
                out[left, k] = np.where(n > 0, total / np.maximum(n, 1), out[left, k])
            left = left[n == 0]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text."""
        return self.judge(texts)[:2]

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, posterior, number of words and of known words of each text."""
        total, n, known = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts)), np.zeros(len(texts))
        for found, owner in chars.chunks(texts):
            starts, ends, hashes = chars.words(found)
            if not len(starts):
                continue
            keys, first, at = np.unique(hashes, return_index=True, return_inverse=True)
            scores = self._word_scores(found, starts[first], ends[first], keys)[at]
            own = owner[starts]
            lo = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[lo]] += np.add.reduceat(scores, lo, axis=0)
            n += np.bincount(own, minlength=len(texts))
            known += np.bincount(own, (self._find(0, keys) < len(self.keys[0]))[at], len(texts))
        names = np.array([*self.langs, UNDETERMINED], object)
        best = np.full(len(texts), len(self.langs))
        score = np.zeros(len(texts))
        if self.langs:
            tempered = total * (np.minimum(n, TEMPER) / np.maximum(n, 1))[:, None]
            share = np.exp(tempered - tempered.max(1, keepdims=True))
            share /= share.sum(1, keepdims=True)
            best = np.where(n > 0, share.argmax(1), best)
            score = np.where(n > 0, share.max(1), 0.0)
        return names[best].tolist(), score, n, known


def fit(labelled: DataFrame) -> Model:
    """A model from (doc_id, text, lang); rows with a null text or lang are left out. Without rows it identifies nothing.

    It learns from the SAMPLE rows with the least hashes of id and text, rows equal in both once.
    """
    rows = least_rows(labelled.where("lang is not null and text is not null"), F.xxhash64("doc_id", "text"), SAMPLE)
    scratch = Scratch(labelled.sparkSession, "language")
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    counts = scratch.save(counts, "counts")
    totals = {(r["lang"], r["kind"]): r["n"] for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    kept = counts.where("kind != 0 or n > 1").withColumn("rank", rank).where(F.col("rank") <= KNOWN).select("kind", "key").distinct()
    # KNOWN keys of five kinds by language at most.
    table = counts.join(kept, ["kind", "key"]).toArrow().to_pandas()
    scratch.drop("counts")
    langs = sorted({lang for lang, _ in totals})
    keys, logs = {}, {}
    for kind in (0, *ORDERS):
        part = table[table["kind"] == kind]
        keys[kind] = np.unique(part["key"].to_numpy(np.int64).view(np.uint64))
        n_by = np.zeros((len(keys[kind]) + 1, len(langs)))
        for k, lang in enumerate(langs):
            own = part[part["lang"] == lang]
            n_by[np.searchsorted(keys[kind], own["key"].to_numpy(np.int64).view(np.uint64)), k] = own["n"]
        all_ = np.array([totals.get((lang, kind), 0) for lang in langs], float)
        logs[kind] = np.log((n_by + 0.5) / (all_ + 0.5 * len(n_by)))
        logs[kind][-1] = 0
    return Model(langs, keys, logs)


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit_on_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """fit() on the rows that aren't held out."""
    return fit(df.where(~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")))


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row; `und` and 0 for null texts and texts without a letter.

    Every row has its row in the result, repeated or not; ids may be null; texts of any length are read whole; other
    columns are ignored whatever their names. An empty df gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, scores = model.predict(chars.texts_of(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def lettered(texts: list[str]) -> list[bool]:
    """Whether each text has a letter."""
    out = np.zeros(len(texts), bool)
    for found, owner in chars.chunks(texts):
        out[owner[chars.words(found)[0]]] = True
    return out.tolist()


def accepted(model: Model, texts: list[str], wanted: tuple[str, ...] | None = None) -> np.ndarray:
    """Whether each text is in one of the wanted languages (None: any that the model knows), by the prediction and its evidence.

    The posterior only says which known language fits best, so a text in none of them needs another sign. Each word is
    evidence by whether it is known from training, as KNOWN_SHARES says; a text goes once the odds against it are over
    exp(-LEAST_ODDS). So a few unknown words alone don't speak against a short text, and of a long one about a fifth
    must be known; the rule is the same for texts of any length.
    """
    langs, score, n, known = model.judge(texts)
    fits = np.array([x != UNDETERMINED and (wanted is None or x in wanted) for x in langs], bool)
    own, other = KNOWN_SHARES
    odds = known * np.log(own / other) + (n - known) * np.log((1 - own) / (1 - other))
    return fits & (score >= LEAST_SCORE) & (odds >= LEAST_ODDS)


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", wanted: tuple[str, ...] | None = None) -> DataFrame:
    """df without the rows whose text is in none of the wanted languages (None: all those learned), as accepted() says.

    Null texts, texts without a letter and texts in a language that isn't known go. Where no row has a language to
    learn from, every text with a letter stays: nothing speaks against it. Repeated rows stay or go together; an
    empty df gives an empty result; df's columns may have any names.
    """
    model = fit_on_documents(df, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = chars.texts_of(batch["text"])
            yield batch.filter(pa.array(accepted(model, texts, wanted).tolist() if model.langs else lettered(texts), pa.bool_()))

    # Arrow functions take no names with dots, so the columns have plain ones there.
    plain = df.toDF(*("text" if c.lower() == text_col.lower() else f"c{i}" for i, c in enumerate(df.columns)))
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)
