"""Vectorised letters, words of letters and character n-grams over batches of texts.

Texts are lower-cased and seen as code points; every character that isn't a letter becomes one separator code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidewell.llm.shingles import _powers, mix

#: Characters handled at once.
SEGMENT = 1 << 18
#: The code that stands for anything but a letter.
GAP = np.uint32(1)

_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _tables:
        _tables["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _tables["letters"]


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, with GAP for all but letters."""
    found = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[found], found, GAP)


def chunks(texts: list[str], most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """pieces() without the mark."""
    for found, owner, _ in pieces(texts, most):
        yield found, owner


def pieces(texts: list[str], most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(codes, owner, torn) of consecutive texts, about `most` (SEGMENT) characters at a time; owner is the text's index.

    Each text ends with a GAP. A longer text comes in several chunks, which are the text's own codes when put one
    after another: it is cut at a blank or a line break, which the GAP at the chunk's end stands for. Only where it
    has none in `most` characters is it cut inside a run; the chunk is torn then, and its last GAP isn't the text's.
    """
    most = most or SEGMENT
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        out = np.concatenate(held), np.repeat(np.array(owner), [len(x) for x in held])
        held.clear()
        owner.clear()
        return out

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end, after, torn = min(len(text), at + most), min(len(text), at + most), False
            if end < len(text):
                cut = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
                torn = cut < 0
                end, after = (end, end) if torn else (cut, cut + 1)
            if size and size + end - at > most:
                yield *flush(), False
                size = 0
            held.append(np.append(codes(text[at:end]), GAP))
            owner.append(i)
            size += end - at + 1
            at = after
            if at < len(text):  # what follows is the same text's
                yield *flush(), torn
                size = 0
    if held:
        yield *flush(), False


def words(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words (runs of letters) of codes that end with a GAP."""
    letter = found != GAP
    edge = np.diff(letter.view(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(found) + 1)
    sums = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(found.astype(np.uint64) * up[: len(found)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])


def ngrams(found: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each code but the last n - 1."""
    out = np.zeros(max(0, len(found) - n + 1), np.uint64)
    for j in range(n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + found[j : len(found) - n + 1 + j]
    return mix(out + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFF))


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]
