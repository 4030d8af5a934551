"""Vectorised kernels against plain Python."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import chars, shingles

TEXTS = ["", " ", "a", "a b c d", "A b C d e", "a\x0bb\x0cc\rd\ne f", "x" * 5000, "été Über ñandú", "word " * 4000, "\u2003a\u00a0b c", "a b c d e a b c d e"]


def _words(t):
    return t.encode().lower().split()


def _set(t):
    w = _words(t)
    return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def test_words_and_shingles():
    hashes, counts = shingles.word_hashes([t.encode() for t in TEXTS])
    assert counts.tolist() == [len(_words(t)) for t in TEXTS]
    seen: dict = {}
    for w, h in zip([w for t in TEXTS for w in _words(t)], hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert [len(s) for s in shingles.shingle_sets([t.encode() for t in TEXTS])] == [len(_set(t)) for t in TEXTS]


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(3000)).encode()
    whole = shingles.word_hashes([text, b"tail"])[0]
    monkeypatch.setattr(shingles, "SEGMENT", 100)
    cut = shingles.word_hashes([text, b"tail"])[0]
    assert (whole == cut).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB cé.\n\t1", max_size=40), max_size=8))
def test_sets_agree(texts):
    sets = list(shingles.shingle_sets([t.encode() for t in texts]))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(_set(a) & _set(b))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aB é1.\n", max_size=30), max_size=6))
def test_letter_words(texts):
    got = [0] * len(texts)
    for found, owner in chars.chunks(texts, 16):
        starts, ends, _ = chars.words(found)
        for s, e in zip(starts, ends, strict=True):
            got[owner[s]] += e - s
    assert got == [sum(c.isalpha() for c in t.lower()) for t in texts]
