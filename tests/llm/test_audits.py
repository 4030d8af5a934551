"""Filter interactions, BPE and source divergence against plain Python and the tokenizers library."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import bpe, divergence, interactions, queries

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n long, mask string, ids string, N_Tokens int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "m", "i", 2) for r in rows], DOCS)


def _audit(rows, labels):
    """The contract of the filter audit, document by document."""
    first, good, toxic = {}, {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    out = Counter()
    parts = {lang or "" for _, _, lang, _ in rows}
    for i, text, lang, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)), "E": i is not None and i > first[text]}
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (lang or "", "".join(order), step)
                now = fails[f] and not gone
                for name, hit in (("kept", not gone and not fails[f]), ("removed", now), ("redundant", fails[f] and gone), ("unique_fails", fails[f] and sum(fails.values()) == 1), ("good_lost", now and i in good), ("toxic_lost", now and i in toxic)):
                    out[*key, name] += hit
                out[lang or "", f, "shapley"] += now
                gone = gone or fails[f]
    return {(p, "".join(o), s): (*(out[p, "".join(o), s, n] for n in interactions.COUNTS), out[p, o[s - 1], "shapley"]) for p in parts for o in permutations("ABCDE") for s in range(1, 6)}


def test_interactions(spark):
    rng = random.Random(5)
    kinds = ["SHOUTING TEXT", "plain words " * 80, " ".join(f"w{i}" for i in range(120)), "costs $5 | " + "word " * 99, "", None, "\x0b\t \n", "É" * 3 + " x" * 200]
    rows = [(rng.choice([None, *range(60)]), rng.choice(kinds), rng.choice(["en", "de", None, ""]), "s") for _ in range(150)]
    rows += [(7, "same", "en", "s")] * 3 + [(9, "same", "de", "s"), (7, "same", "fr", "s"), (None, "same", "en", "s")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 60, 2), 7, 7, None, 999]]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = interactions.audit(_frame(spark, rows).repartition(5), marks)
    found = {(r.part, r.filter_order, r.step): (*(r[c] for c in interactions.COUNTS), r.shapley) for r in got.collect()}
    assert found == _audit(rows, labels) and got.columns == ["part", "filter_order", "step", *interactions.COUNTS, "shapley"]
    assert interactions.audit(_frame(spark, rows).limit(0), marks).count() == 0
    unlabelled = interactions.audit(_frame(spark, rows), marks.limit(0))
    assert unlabelled.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_fold_of_other_filters(spark):
    """The fold takes any letters and cells."""
    cells = spark.createDataFrame([("p", "", 4, 1, 0), ("p", "X", 2, 0, 1), ("p", "XY", 3, 3, 3)], "part string, mask string, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in interactions.interactions(cells, "XY").collect()}
    assert got == {("XY", 1): (4, 5, 0, 2, 3, 4, 7), ("XY", 2): (4, 0, 3, 0, 0, 0, 3), ("YX", 1): (6, 3, 0, 0, 3, 3, 3), ("YX", 2): (4, 2, 3, 2, 0, 1, 7)}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def tables():
    return bpe.Tokenizer.load(VOCABULARY)


def _texts(n, seed):
    """Random texts of blanks, contractions, special strings and characters from all over Unicode, unassigned ones too."""
    rng = random.Random(seed)
    parts = [chr(c) for c in (*range(256), 0x85, 0xA0, 0x2028, 0x3000, 0x558, 0x3FC3B, 0x1C89, 0x4E2D, 0x1F600, 0x660, 0xFEFF, 0x200B, 0x10FFFF)] + ["<|endoftext|>", "<|endoftext", "'s", "'LL", "  ", "\n\n", " \n", "tion", " the"] * 6
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def _packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_equals_library(tables, library, monkeypatch):
    encoder = tables.encoder()
    texts = [*_texts(4000, 1), "a" * 50_000, "x1" * 5000, "\n" * 3000, "word " * 20_000, "中文" * 3000]
    want = [_packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode(t) for t in texts] == want
    assert [tables.decode(i) for i in want] == texts
    # Other bounds change the way and not the result: long fragments, short windows, a cache that never lasts.
    monkeypatch.setattr(bpe, "SHORT", 2)
    monkeypatch.setattr(bpe, "WINDOW", 5)
    monkeypatch.setattr(bpe, "CACHED", 3)
    assert [tables.encoder().encode(t) for t in texts[:2000]] == want[:2000]


def test_bpe_decodes_any_ids(tables, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 20))]
        assert tables.decode(_packed(ids)) == library.decode(ids, skip_special_tokens=False)
    assert tables.decode(_packed([70_000])) == ""


def test_forced_cuts_are_in_no_token(tables):
    token_pairs = {p for t in tables.tokens for p in zip(t, t[1:], strict=False)}
    for piece in (b" rock'n'roll2024", "Zürich中".encode(), b"qqzzxxjj"):
        parts = list(tables.fragments(piece))
        assert b"".join(parts) == piece
        assert all((a[-1], b[0]) not in token_pairs for a, b in zip(parts, parts[1:], strict=False))
    assert len(list(tables.fragments(b"qqzzxxjj"))) > 1


def test_bpe_query(spark, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op12_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(_packed(ids)).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_bpe_rows(spark, tables):
    rows = [(1, "hello world", "en", "s"), (1, "hello world", "en", "s"), (None, None, None, None), (2, "", "en", None), (3, "<|endoftext|>", "x", "y")]
    out = bpe.encode_rows(_frame(spark, rows), tables)
    assert out.columns == ["doc_id", "text", "lang", "source", "n", "mask", "ids", "n_tokens"]
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.ids)) for r in out.collect()) == [(0, 0, b""), (1, 2, _packed([31373, 995])), (1, 2, _packed([31373, 995])), (2, 0, b""), (3, 1, _packed([50256]))]
    assert bpe.encode_rows(_frame(spark, rows).limit(0), tables).count() == 0


def _divergence(rows, least=10):
    """The contract of the divergence audit in whole numbers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))) for _, text, lang, source in rows]
    have, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        have[lang].update(set(words))
        for key in (lang, (lang, source)):
            count[key].update(words)
    out = set()
    groups = {(lang, source) for lang, source, _ in docs}
    for lang, source in groups:
        kept = [t for t, n in have[lang].items() if n >= least]

        def p(key, kept=kept):
            bottom = sum(count[key][t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[key][t] + 2) // bottom for t in kept}

        f = lambda a, b: (a - b) ** 2 // (a + b)
        mine, whole = p((lang, source)), p(lang)
        pairs = [(-sum(f(mine[t], q[t]) for t in kept), s.encode()) for g, s in groups if g == lang and s != source for q in [p((lang, s))]]
        top = [(-f(mine[t], whole[t]), t.encode()) for t in kept if count[lang, source][t] and mine[t] > whole[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(top)[:10])):
            out |= {(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)}
    return out


def _found(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("held", [divergence.HELD, 5])
def test_divergence(spark, monkeypatch, held):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "WINDOW", 11)
    rng = random.Random(3)
    words = ["The", "the", "été", "ÉTÉ", "x1y", "don't", "😀a", "中文", "Zz", "rare", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))), rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "b", "b", None, "é"])) for i in range(200)]
    rows += [(1, None, "en", "empty"), (None, "", "fr", "a"), (None, "few", "fr", "b"), (2, "12 34", "en", "digits"), *[(5, "same same tie", "en", "b")] * 12]
    got = _found(divergence.audit(_frame(spark, rows).repartition(3)))
    assert got == _divergence(rows)
    assert {x[2] for x in got} == {"pair", "term"} and ("fr", "a", "pair", "b", 0, 1) in got
    assert divergence.audit(_frame(spark, rows).limit(0)).count() == 0


def test_divergence_of_large_counts(spark):
    """Products beyond the range of long stay exact."""
    rows = spark.createDataFrame([(7 * 10**12, 10**13, 3)], "n long, total long, v long")
    want = 1 + 10**9 * (7 * 10**12 + 2) // (10**13 + 6)
    assert rows.select(divergence.probability(F.col("n"), F.col("total"), F.col("v"))).first()[0] == want
