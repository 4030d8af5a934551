"""Substring deduplication over sliding spans of consecutive sentences.

Sentences end at a line break or after . ! ? before white space. From every sentence on, the shortest run of at least
RUN consecutive sentences with LEAST_WORDS words is hashed (words only: A-Z lower-cased, punctuation left out). A hash
that occurs more than once is a repeated span; it stays where it stands first (least id, then position), and the
sentences that it covers elsewhere are removed.

Passages also get pasted into the middle of sentences, and some have no sentence ends, so that they hold less than RUN
whole sentences. Passages of PASSAGE words or more are therefore found by words besides: of every WINDOW consecutive
runs of GRAM words the one with the least hash is chosen (winnowing), so any GRAM + WINDOW - 1 = PASSAGE words hold a
chosen run wherever they stand. From a repeated one, the range grows word by word to either side as long as the
LEAST_WORDS words from the new one inward stand somewhere earlier too; it is removed if it has PASSAGE words then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import bitmaps, shingles
from tidewell.llm.scratch import Scratch, slices

RUN, LEAST_WORDS = 3, 12
GRAM, WINDOW = 24, 28
PASSAGE = GRAM + WINDOW - 1
#: In a passage of PASSAGE words or more, the first chosen run starts less than WINDOW words from its start, and so on to its end.
REACH = WINDOW - 1
#: The bitmap of repeated hashes has 2**26 bits (8 MB).
BITS = 26

_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True


class _Words:
    """The words of some texts: hash, index of the text, first byte in it, and the byte where the next word starts or the text ends."""

    def __init__(self, texts: list[bytes]):
        self.hashes, counts = shingles.word_hashes(texts, shingles.PUNCTUATION)
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        word = ~shingles.PUNCTUATION[data]
        starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
        stop = np.zeros(len(data), bool)
        stop[:-1] = _STOPS[data[:-1]] & shingles.SPACES[data[1:]]
        stop |= data == 10
        self.owner = np.repeat(np.arange(len(texts)), counts)
        #: Whether a sentence ends between a word and the next one.
        self.stops = np.diff(np.cumsum(stop)[starts]) > 0
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        text_starts = (text_ends - [len(t) + 1 for t in texts])[self.owner]
        self.starts = starts - text_starts
        self.until = np.minimum(np.append(starts, len(data))[1:], text_ends[self.owner] - 1) - text_starts
        up, self._down = shingles._powers(len(self.hashes) + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * up[: len(self.hashes)])])

    def digest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the words from lo to before hi."""
        return shingles.mix((self._sums[hi] - self._sums[lo]) * self._down[lo] + (hi - lo).astype(np.uint64))

    def windows(self) -> np.ndarray:
        """Where LEAST_WORDS words of one text start."""
        n = max(len(self.owner) - LEAST_WORDS + 1, 0)
        return np.flatnonzero(self.owner[:n] == self.owner[LEAST_WORDS - 1 :][:n])


def _sentences(w: _Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the runs of sentences."""
    cut = w.stops | (np.diff(w.owner) > 0)
    at = np.flatnonzero(np.concatenate([[True], cut])) if len(w.hashes) else np.zeros(0, np.int64)
    edges = np.append(at, len(w.hashes))
    hi = np.maximum(np.searchsorted(edges, at + LEAST_WORDS), np.arange(len(at)) + RUN)
    fits = hi <= len(at)
    lo, hi = at[fits], edges[hi[fits]]
    fits = w.owner[lo] == w.owner[hi - 1]
    return lo[fits], hi[fits]


def _slide(least_or_most: np.ufunc, x: np.ndarray, n: int) -> np.ndarray:
    """The least or greatest of every n consecutive values."""
    size = len(x) - n + 1
    k = 1
    while 2 * k <= n:
        x = least_or_most(x[:-k], x[k:])
        k *= 2
    return least_or_most(x[:size], x[n - k :][:size])


def _winnowed(w: _Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the chosen runs of GRAM words."""
    size = len(w.hashes) - GRAM - WINDOW + 2
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(w.hashes) - GRAM + 1)
    grams = w.digest(at, at + GRAM)
    least = np.where(w.owner[:size] == w.owner[-size:], _slide(np.minimum, grams, WINDOW), np.uint64(0))
    edge = np.zeros(WINDOW - 1, np.uint64)
    lo = np.flatnonzero((grams == _slide(np.maximum, np.concatenate([edge, least, edge]), WINDOW)) & (grams > 0))
    return lo, lo + GRAM


def runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text index, hash, start byte, end byte, by words) of each run by which repeats are found, for some texts at a time; an end is where the next word starts or the text ends."""
    base = 0
    for part in shingles.groups(texts):
        w = _Words(texts[part])
        found = [(lo, hi, np.full(len(lo), words)) for words, (lo, hi) in enumerate((_sentences(w), _winnowed(w)))]
        lo, hi, words = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((words, hi, lo))
        lo, hi, words = lo[order], hi[order], words[order].astype(bool)
        # The two kinds of runs must not meet: a hash of words is told apart by its lowest bit.
        hashes = (w.digest(lo, hi) << np.uint64(1)) | words.astype(np.uint64)
        yield w.owner[lo] + base, hashes, w.starts[lo], w.until[hi - 1], words
        base += len(texts[part])


def spans(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text index, hash, start byte, end byte) of every LEAST_WORDS consecutive words: the steps by which a repeat grows, of which every run is made up."""
    base = 0
    for part in shingles.groups(texts):
        w = _Words(texts[part])
        lo = w.windows()
        yield w.owner[lo] + base, w.digest(lo, lo + LEAST_WORDS), w.starts[lo], w.until[lo + LEAST_WORDS - 1]
        base += len(texts[part])


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _again(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which runs have the hash of an earlier run of their text."""
    order = np.lexsort((hashes, owner))
    out = np.zeros(len(hashes), bool)
    out[order[1:]] = (np.diff(owner[order]) == 0) & (hashes[order[1:]] == hashes[order[:-1]])
    return out


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's distinct hashes; many: it has the hash more than once."""
    for batch in slices(batches):
        for owner, hashes, *_ in runs(_texts(batch["text"])):
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            same = (np.diff(owner) == 0) & (np.diff(hashes) == 0)
            first = np.concatenate([[True], ~same])[: len(hashes)]
            many = np.concatenate([same, [False]])[: len(hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), batch["doc_id"].take(pa.array(owner[first])), pa.array(many[first])], ["hash", "doc_id", "many"])


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], end))
        else:
            merged.append((start, end))
    return merged


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The steps from each range that was found by words to either side: hash, the range's edge, how many words off, and the byte up to which the step leads; again: the text has the hash earlier."""
    names = ["hash", "row", "edge", "off", "upto", "again"]
    for batch in slices(batches):
        every = batch["ranges"].to_pylist()
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        for i, text in enumerate(_texts(batch["text"])):
            merged = _merged([(r["start"], r["end"]) for r in every[i] if r["words"]])
            if not merged:
                continue
            w = _Words([text])
            at = w.windows()
            hashes = w.digest(at, at + LEAST_WORDS)
            again = _again(np.zeros(len(at), np.int64), hashes)
            start, end = np.array(merged).T
            lo, hi = np.searchsorted(w.starts, start), np.searchsorted(w.starts, end)
            before, after = np.append(0, hi[:-1]), np.append(lo[1:], len(w.starts))
            off = np.arange(1, REACH + 1)
            # Rows are ranges, columns are how many words off.
            left, right = off <= np.minimum(REACH, lo - before)[:, None], off <= np.minimum(REACH, after - hi)[:, None]
            to_left, to_right = (lo[:, None] - off)[left], (hi[:, None] + off)[right]
            step = np.concatenate([to_left, to_right - LEAST_WORDS])
            rows = [hashes[step].view(np.int64), np.full(len(step), i), np.concatenate([np.repeat(start, left.sum(1)), np.repeat(end, right.sum(1))]), np.concatenate([np.broadcast_to(-off, left.shape)[left], np.broadcast_to(off, right.shape)[right]]), np.concatenate([w.starts[to_left], w.until[to_right - 1]]), again[step]]
            for held, column in zip(found, rows, strict=True):
                held.append(column)
        out = dict(zip(names, map(np.concatenate, found), strict=True))
        at = pa.array(out["row"].astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(out["hash"]), batch["doc_id"].take(at), batch["row_key"].take(at), pa.array(out["edge"]), pa.array(out["off"]), pa.array(out["upto"]), pa.array(out["again"].astype(bool))], ["hash", "doc_id", "row_key", "edge", "off", "upto", "again"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Let the ranges found by words grow, and remove those that are long enough and all ranges of sentences; the ranges removed, merged, in code points."""
    for batch in slices(batches):
        rows = []
        for doc_id, key, text, ranges, steps in zip(batch["doc_id"].to_pylist(), batch["row_key"].to_pylist(), _texts(batch["text"]), batch["ranges"].to_pylist(), batch["steps"].to_pylist(), strict=True):
            known = {(r["edge"], r["off"]): r["upto"] for r in steps or ()}
            found = [(r["start"], r["end"]) for r in ranges if not r["words"]]
            grown = []
            for edges in _merged([(r["start"], r["end"]) for r in ranges if r["words"]]):
                reached = list(edges)
                for side, off in ((0, -1), (1, 1)):
                    n = 1
                    while (edges[side], off * n) in known:
                        reached[side] = known[edges[side], off * n]
                        n += 1
                grown.append(tuple(reached))
            starts = _Words([text]).starts if grown else None
            found += [(s, e) for s, e in _merged(grown) if np.searchsorted(starts, e) - np.searchsorted(starts, s) >= PASSAGE]
            merged = _merged(found)
            if not merged:
                continue
            before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            points = [(int(before[s]), int(before[e])) for s, e in merged]
            kept, at = [], 0
            for s, e in merged:
                kept.append(text[at:s])
                at = e
            rows.append((doc_id, key, ",".join(f"{s}:{e}" for s, e in points), sum(e - s for s, e in points), b"".join([*kept, text[at:]]).decode(errors="replace")))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)], ["doc_id", "row_key", "removed", "removed_chars", "text"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents from which repeated spans are removed, and only those.

    Returns doc_id, row_key (hash of id and text), removed (start:end of the removed ranges in code points, end
    exclusive, comma-joined), removed_chars and text (what is left). Null, empty and short texts have no spans.
    Rows that share an id count as one document, so a span stays in all of them; rows without an id yield to
    others and not to each other, but do lose what they repeat themselves. A repeated row comes out once. Texts of
    any length are worked through whole; other columns are ignored whatever their names. An empty df gives an empty
    result. The ranges of one document are gathered in one row, as its text is.
    """
    scratch = Scratch(df.sparkSession, "spans")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    counts = docs.select("doc_id", "text").mapInArrow(_hashes, "hash long, doc_id long, many boolean")
    repeated = counts.groupBy("hash").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.max("many").alias("many")).where("n > 1 or many")
    repeated = scratch.save(repeated.select("hash", "first_id"), "repeated")
    wanted = bitmaps.build(repeated, F.col("hash"), BITS)

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for owner, hashes, start, end, words in runs(_texts(batch["text"])):
                hit = bitmaps.hits(wanted, hashes)
                owner, hashes, start, end, words = owner[hit], hashes[hit], start[hit], end[hit], words[hit]
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch["doc_id"].take(at), batch["row_key"].take(at), pa.array(start), pa.array(end), pa.array(words), pa.array(_again(owner, hashes))], ["hash", "doc_id", "row_key", "start", "end", "words", "again"])

    found = docs.mapInArrow(occurrences, "hash long, doc_id long, row_key long, start long, end long, words boolean, again boolean").join(repeated, "hash")
    is_later = F.col("again") | (~F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull())
    later = found.where(is_later)
    ranges = later.groupBy("row_key").agg(F.collect_set(F.struct("start", "end", "words")).alias("ranges"))
    ranges = scratch.save(ranges, "ranges")
    touched = bitmaps.build(ranges, F.col("row_key"))

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmaps.hits(touched, batch["row_key"].to_numpy().view(np.uint64))))

    texts = docs.mapInArrow(changed, "doc_id long, row_key long, text string").join(ranges, "row_key").dropDuplicates(["row_key"])
    texts = scratch.save(texts.select("doc_id", "row_key", "text", "ranges"), "texts")
    steps = scratch.save(texts.mapInArrow(_steps, "hash long, doc_id long, row_key long, edge long, off long, upto long, again boolean"), "steps")
    stepped = bitmaps.build(steps, F.col("hash"), BITS)

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for owner, hashes, _, _ in spans(_texts(batch["text"])):
                hit = bitmaps.hits(stepped, hashes)
                owner, hashes = owner[hit], hashes[hit]
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch["doc_id"].take(pa.array(owner))], ["hash", "doc_id"])

    firsts = docs.select("doc_id", "text").mapInArrow(standing, "hash long, doc_id long").groupBy("hash").agg(F.min("doc_id").alias("first_id"))
    steps = steps.join(firsts, "hash").where(is_later).groupBy("row_key").agg(F.collect_set(F.struct("edge", "off", "upto")).alias("steps"))
    return texts.join(steps, "row_key", "left").select("doc_id", "row_key", "text", "ranges", "steps").mapInArrow(_cut, "doc_id long, row_key long, removed string, removed_chars long, text string")
