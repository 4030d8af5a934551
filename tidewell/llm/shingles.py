"""Vectorised word and shingle hashing over batches of UTF-8 texts.

A word is a run of bytes other than space and 09-0D, with A-Z lower-cased. A document's shingles are its runs
of five words; with one to four words, the whole sequence is the only shingle; without words there is none.
Words hash by a prefix sum of byte * P**position (mod 2**64) times P**-start, so a word has the same hash
wherever it stands, and no Python loop runs over words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes of text hashed at once; a word longer than that is hashed alone.
SEGMENT = 1 << 18

#: Tables of the bytes that stand between words: white space, or every ASCII character but letters and digits.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
#: Multipliers of a shingle's words and of the length of a short text.
_PLACES = np.array([0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xDB4F0B9175AE2165, 0xBBE0563303A4615F], np.uint64)
_SHORT = np.uint64(0xA0F2EC75A1FE1575)
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["up"]) < n:
        n = max(n, 2 * SEGMENT)
        for name, base in (("up", _P), ("down", _P_INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about SEGMENT bytes that end at white space."""
    at = 0
    while len(text) - at > SEGMENT:
        m = _SPACE.search(text, at + SEGMENT)
        if not m:
            break
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


def _hash_group(pieces: list[bytes], separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)
    up, down = _powers(len(data) + 1)
    space = separators[data]
    edge = np.diff(space.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(data) and space[0]:
        ends = ends[ends > 0]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LOWER[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum([len(p) + 1 for p in pieces])
    return hashes, np.diff(np.searchsorted(starts, bounds), prepend=0)


def word_hashes(texts: list[bytes], separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    found, counts = [], np.zeros(len(texts), np.int64)
    group: list[bytes] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        if group:
            hashes, n = _hash_group(group, separators)
            found.append(hashes)
            np.add.at(counts, owner, n)
            group.clear()
            owner.clear()

    for i, text in enumerate(texts):
        for piece in _pieces(text) if len(text) > SEGMENT else (text,):
            if held + len(piece) > SEGMENT:
                flush()
                held = 0
            group.append(piece)
            owner.append(i)
            held += len(piece) + 1
    flush()
    return np.concatenate(found) if found else np.zeros(0, np.uint64), counts


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (repeats included) of all texts in order, and their number by text."""
    ends = np.repeat(np.cumsum(counts), counts)
    at = np.arange(len(hashes))
    first = np.zeros(len(hashes), bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    starts = np.flatnonzero((at + words <= ends) | (first & (at + words > ends)))
    left = ends[starts] - starts
    total = np.where(left < words, left.astype(np.uint64) * _SHORT, np.uint64(0))
    for j in range(words):
        there = np.minimum(starts + j, max(len(hashes) - 1, 0))
        total += np.where(j < left, hashes[there], np.uint64(0)) * _PLACES[j]
    return mix(total), np.where(counts > 0, np.maximum(counts - words + 1, 1), 0)


def groups(texts: list[bytes], most: int = SEGMENT) -> Iterator[slice]:
    """Slices of consecutive texts of at most `most` bytes together, or of one longer text."""
    lo, held = 0, 0
    for i, text in enumerate(texts):
        if i > lo and held + len(text) > most:
            yield slice(lo, i)
            lo, held = i, 0
        held += len(text)
    if lo < len(texts):
        yield slice(lo, len(texts))


def shingle_sets(texts: list[bytes], words: int = WORDS, separators: np.ndarray = SPACES) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for part in groups(texts):
        all_, counts = shingle_hashes(*word_hashes(texts[part], separators), words)
        ends = np.cumsum(counts)
        for lo, hi in zip(ends - counts, ends, strict=True):
            yield np.unique(all_[lo:hi])
