"""Byte-level BPE encoding and decoding by forced boundaries.

A token that spans the place between two bytes holds that pair of bytes. So where a pair is in no token of the
vocabulary, no merge can cross: the place is a certain cut. A text is first cut into the pieces of the tokenizer's
pattern, each piece at all its certain cuts; the fragments are encoded one by one and their ids joined, which gives
the ids of the whole. Texts are encoded where they lie: nothing is shuffled, and a task holds the vocabulary, a cache
of bounded size and one Arrow batch.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from tidewell.llm.scratch import own

ADDED = ("n_tokens", "ids")
#: Pieces whose ids a task remembers, and the longest that it does; a full cache starts anew.
CACHED, CACHED_CHARS = 400_000, 64
#: Fragments of up to so many bytes are merged in a plain list, longer ones by a heap, with the same result; NONE is the rank of no merge.
SHORT, NONE = 256, 1 << 31
#: Characters whose pieces are listed at once; longer texts are cut before a blank that follows something else.
WINDOW = 1 << 20

#: Fixed value: the pattern of byte-level pre-tokenizers; S, L and N stand for blanks, letters and numbers inside of classes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^SLN]+|[S]+(?![^S])|[S]+"
#: The plain form of the pattern knows the characters below.
PLAIN = 0x10000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable Latin-1 characters for themselves, all others, in order, for the characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranges(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    out: list[list[int]] = []
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


@cache
def piece_patterns() -> tuple[str, str]:
    """The pattern with the tokenizers library's classes of characters: for texts of characters below PLAIN, whose classes are looked up faster, and for all.

    Python, `regex` and the library know different versions of Unicode. What Python's, the oldest, has is the same in
    all; about each letter and number that only `regex` knows, the library is asked.
    """
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    newer = {"L": (regex.compile(r"\p{L}"), "a"), "N": (regex.compile(r"\p{N}"), "1")}
    blank = regex.compile(r"\s")
    points: dict[str, list[int]] = {"S": [p for p in range(0x110000) if blank.match(chr(p))], "L": [], "N": []}
    for p in range(0x110000):
        c = chr(p)
        kind = unicodedata.category(c)
        if kind[0] in "LN":
            points[kind[0]].append(p)
        elif kind == "Cn":
            for k, (known, before) in newer.items():
                if known.match(c) and len(split(before + c)) == 1:
                    points[k].append(p)

    def form(limit: int) -> str:
        classes = {k: _ranges([p for p in found if p < limit]) for k, found in points.items()}
        return re.sub(r"(?<=[\[^])[SLN]+(?=\])", lambda m: "".join(map(classes.__getitem__, m[0])), PATTERN)

    return form(PLAIN), form(0x110000)


@dataclass(frozen=True)
class Tokenizer:
    """Tables of a byte-level BPE tokenizer: the rank of each merge by its pair of ids (the first times 2**32 and the second), the id that each merge makes, each id's bytes, the id of each byte, strings that are tokens as a whole, whether a pair of bytes is in any token, and the patterns of pieces."""

    merges: dict[int, int]
    made: list[int]
    tokens: list[bytes]
    of_byte: list[int]
    whole: dict[str, int]
    inside: bytes
    patterns: tuple[str, str]

    @classmethod
    def load(cls, path: str) -> Tokenizer:
        """From a tokenizer.json of the library; an error for settings that this module doesn't know."""
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
        if model["type"] != "BPE" or any(odd) or file["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
            raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
        vocab, letters = dict(model["vocab"]), byte_letters()
        whole = {t["content"]: t["id"] for t in file["added_tokens"]}
        tokens = [b""] * (1 + max([*vocab.values(), *whole.values()]))
        for token, i in (vocab | whole).items():
            tokens[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in reversed(list(enumerate(pairs)))}
        inside = bytearray(1 << 16)
        for token in vocab:
            b = bytes(letters[c] for c in token)
            for x, y in pairwise(b):
                inside[x << 8 | y] = 1
        of_byte = [0] * 256
        for letter, byte in letters.items():
            of_byte[byte] = vocab[letter]
        return cls(merges, [vocab[a + b] for a, b in pairs], tokens, of_byte, whole, bytes(inside), piece_patterns())

    def fragments(self, piece: bytes) -> Iterator[bytes]:
        """The piece cut at every pair of bytes that is in no token."""
        start, inside = 0, self.inside
        for cut in [i for i, (x, y) in enumerate(pairwise(piece), 1) if not inside[x << 8 | y]]:
            yield piece[start:cut]
            start = cut
        yield piece[start:]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: always the merge of the least rank, the leftmost of equal ones, until none is left."""
        ids = [self.of_byte[b] for b in fragment]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        find = self.merges.get
        ranks = [find(a << 32 | b, NONE) for a, b in pairwise(ids)]
        while (least := min(ranks, default=NONE)) < NONE:
            i = ranks.index(least)
            ids[i] = new = self.made[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] << 32 | new, NONE)
            if i < len(ranks):
                ranks[i] = find(new << 32 | ids[i + 1], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of merges and links between neighbours, in n log n."""
        n, find = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, a, b) for i, (a, b) in enumerate(pairwise(ids)) if (rank := find(a << 32 | b, NONE)) < NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y < n and (rank := find(ids[x] << 32 | ids[y], NONE)) < NONE:
                    heapq.heappush(heap, (rank, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def windows(self, text: str) -> Iterator[str]:
        """The text in parts of about WINDOW characters, cut before a blank after something else, where a piece always begins; a run without such a place stays whole."""
        at = 0
        while len(text) - at > WINDOW:
            cut = text.find(" ", at + WINDOW)
            while cut > 0 and text[cut - 1].isspace():
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encoder(self) -> _Encoder:
        return _Encoder(self)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; ids of no token give nothing, bytes that are no UTF-8 the replacement character."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and int(numbers.max()) >= len(self.tokens):
            numbers = numbers[numbers < len(self.tokens)]
        return b"".join(map(self.tokens.__getitem__, numbers.tolist())).decode("utf-8", "replace")


class _Encoder(dict):
    """Packed ids by piece, computed at the first use of a piece."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.t = tokenizer
        self.plain, self.full = map(re.compile, tokenizer.patterns)
        self.beyond = re.compile(f"[{chr(PLAIN)}-{chr(0x10FFFF)}]").search
        self.whole = re.compile("(" + "|".join(map(re.escape, sorted(tokenizer.whole, key=len, reverse=True))) + ")").split if tokenizer.whole else None

    def __missing__(self, piece: str) -> bytes:
        ids: list[int] = []
        for fragment in self.t.fragments(piece.encode()):
            ids += self.t.merge(fragment)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The text's ids, four little-endian bytes each."""
        out: list[bytes] = []
        for i, part in enumerate(self.whole(text) if self.whole else [text]):
            if i % 2:
                out.append(struct.pack("<I", self.t.whole[part]))
            else:
                pieces = (self.plain if part.isascii() or not self.beyond(part) else self.full).findall
                out += (b"".join(map(self.__getitem__, pieces(w))) for w in self.t.windows(part) if w)
        return b"".join(out)


def encode(tokenizer: Tokenizer, text: Column) -> Column:
    """Ids of a text as binary, four little-endian bytes each; null and empty texts have no ids. Texts of any length are encoded whole."""

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = tokenizer.encoder()
        for batch in batches:
            yield pa.array([encoder.encode(t.as_py() or "") for t in batch], pa.binary())

    return ids(text)


def decode(tokenizer: Tokenizer, ids: Column) -> Column:
    """The text of packed ids; null gives the empty text."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([tokenizer.decode(i.as_py() or b"") for i in batch], pa.string())

    return text(ids)


def encode_rows(df: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> DataFrame:
    """df with ids (binary, four little-endian bytes each) and n_tokens.

    A null text counts as the empty one and has no ids. Rows that repeat are encoded each, in any order. Columns of df
    named as in ADDED are replaced, all others stay whatever their names. An empty df gives an empty result.
    """
    kept = own(df.drop(*ADDED))
    rows = df.select(*kept, encode(tokenizer, F.col(text_col)).alias("ids"))
    return rows.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
