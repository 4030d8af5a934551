"""Rows of one key in order, in memory of a fixed size: what doesn't fit waits sorted in a file of the task's own."""

from __future__ import annotations

import heapq
import marshal
import os
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from typing import Any

#: Rows that are held at a time, and rows read back at a time of each sorted run.
HELD, BLOCK = 50_000, 1_000


def _folder() -> str | None:
    """The executor's first local folder, which Spark removes; the system's if it names none."""
    first = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return first if first and os.path.isdir(first) else None


def in_order(rows: Iterable[tuple], held: int = HELD, block: int = BLOCK) -> Iterator[tuple]:
    """Tuples of plain values in their natural order; up to `held` are sorted at a time, and the sorted runs are merged from a file by blocks."""
    rows = iter(rows)
    last = sorted(islice(rows, held))
    more = next(rows, None)
    if more is None:
        yield from last
        return
    with tempfile.TemporaryFile(dir=_folder()) as file:
        runs = []
        while last:
            ends = [file.tell()]
            for i in range(0, len(last), block):
                file.write(marshal.dumps(last[i:i + block]))
                ends.append(file.tell())
            runs.append(ends)
            last = sorted(islice(rows if more is None else chain([more], rows), held))
            more = None

        def read(ends: list[int]) -> Iterator[tuple]:
            for start, end in zip(ends, ends[1:], strict=False):
                file.seek(start)
                yield from marshal.loads(file.read(end - start))

        yield from heapq.merge(*map(read, runs))


def plain(frames: Iterable[Any], *columns: str) -> Iterator[tuple]:
    """The columns of pandas frames as tuples of Python values."""
    for frame in frames:
        yield from zip(*(frame[c].tolist() for c in columns), strict=True)


def in_parts(rows: Iterable[tuple], size: int = 10_000) -> Iterator[list[tuple]]:
    """Lists of at most `size` rows, so that what goes out isn't gathered."""
    rows = iter(rows)
    while part := list(islice(rows, size)):
        yield part
