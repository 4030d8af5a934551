"""Near-duplicate groups and repeated spans against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import components, near_dup, scratch, spans

SCHEMA = "doc_id long, text string, node int, comp string"


def _set(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def _components(rows):
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: _set(t) for i, t in rows.items()}
    for i in rows:
        for j in rows:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: find(i) for i in rows}


def _corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    rows, n = {}, 0
    passage = [word() for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice((6, 30, 120)))]
        if rng.random() < 0.5:
            base += passage
        for k in range(rng.choice((1, 3, 12))):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25)) if k else 0):
                copy[rng.randrange(len(copy))] = word()
            rows[n] = " ".join(copy)
            n += 1
    rows |= {n: None, n + 1: "", n + 2: " \n", n + 3: "One two", n + 4: "one  TWO", n + 5: "one two three"}
    return rows


def test_components_equal_brute_force(spark):
    rows = _corpus()
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows.items()], SCHEMA)
    got = {r.doc_id: r for r in near_dup.near_duplicates(df).collect()}
    want = _components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(_set(t)) for i, t in rows.items()}
    assert all(r.kept == (r.component_id == i) for i, r in got.items())
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(want.values())


@pytest.mark.parametrize("block,cluster", [(4, 50_000), (4, 0)])
def test_open_buckets_in_blocks(spark, monkeypatch, block, cluster):
    """A chain of small edits: stars alone don't join it, blocks do, by cluster and by bucket."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = {}
    for i in range(40):
        rows[i] = " ".join(words)
        words[rng.randrange(80)] = f"v{i}"
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "CLUSTER", cluster)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()}
    assert got == _components(rows)


def _plans(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found, out = spark._jsparkSession.sharedState().statusStore().executionsList().iterator(), {}
    while found.hasNext():
        x = found.next()
        out[x.executionId()] = x.physicalPlanDescription()
    return out


def test_no_join_passes_through_the_driver(spark, monkeypatch):
    """Tables that Spark would broadcast: all steps run, by cluster and by bucket, with and without hot buckets."""
    monkeypatch.setattr(scratch, "SMALL", -1, raising=False)
    rng = random.Random(9)
    rows, words = _corpus(), [f"w{rng.randrange(10**6)}" for _ in range(80)]
    for i in range(1000, 1040):  # a chain of small edits, for the blocks
        rows[i] = " ".join(words)
        words[rng.randrange(80)] = f"v{i}"
    df = spark.createDataFrame([*rows.items(), (1000, rows[1000])], "doc_id long, text string")
    want = _components(rows)
    for hot, cluster in ((near_dup.HOT, 50_000), (1, 0)):
        monkeypatch.setattr(near_dup, "HOT", hot)
        monkeypatch.setattr(components, "HOT", hot)
        monkeypatch.setattr(near_dup, "CLUSTER", cluster)
        before = max(_plans(spark), default=-1)
        assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == want
        assert {r.doc_id for r in near_dup.keep_one(df).collect()} == set(want.values())
        plans = [x for i, x in _plans(spark).items() if i > before]
        assert not [x for x in plans if "Broadcast" in x]
        assert sum("SortMergeJoin" in x for x in plans) > 20 and any("open-links" in x for x in plans)


def test_repeated_rows_null_ids_and_empty(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "z y x w v u")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, 1, None), (None, None, None)], key=str)
    assert sorted(str(r.doc_id) for r in near_dup.keep_one(df).collect()) == ["1", "None", "None"]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_signature_distance_guarantee():
    """Any two signatures within 2 * CHUNKS - 1 errors share a key."""
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dup.SYMBOLS, dtype=np.uint16)
        b = a.copy()
        at = rng.choice(near_dup.SYMBOLS, 2 * near_dup.CHUNKS - 1, replace=False)
        b[at] ^= 1
        keys = near_dup.chunk_keys(np.stack([a, b]))
        assert set(keys[0].tolist()) & set(keys[1].tolist())


def test_spans_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(3, 12))).capitalize() + ". "
    passage = "".join(sentence() for _ in range(9))
    texts = {i: "".join(sentence() for _ in range(6)) for i in range(8)}
    texts[3] = texts[3][:40] + " " + passage + texts[3][40:]
    texts[6] = passage.upper() + "É " + texts[6]
    texts |= {8: None, 9: "", 10: "é" * 50, 11: texts[0]}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, hash string")
    got = {r.doc_id: r for r in spans.remove_repeats(df).collect()}
    seen: set = set()
    for i, t in texts.items():
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for _, hashes, start, end in spans.spans([raw]):
            for h, s, e in zip(hashes.tolist(), start, end, strict=True):
                if h in seen:
                    gone[s:e] = b"\x01" * (e - s)
                seen.add(h)
        left = bytes(c for c, g in zip(raw, gone, strict=True) if not g).decode()
        assert (i in got) == (left != (t or "")), i
        if i in got:
            assert got[i].text == left and got[i].removed_chars == len(t) - len(left)
            assert sum(int(e) - int(s) for s, e in (x.split(":") for x in got[i].removed.split(","))) == got[i].removed_chars
    assert set(got) == {6, 11}
    assert len(got[6].text) < len(texts[6]) - len(passage) * 0.8
    assert spans.remove_repeats(df.limit(0)).count() == 0
    assert spans.remove_repeats(df.withColumn("doc_id", F.lit(None).cast("long"))).count() == 0


def test_spans_of_passages_planted_mid_sentence(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnop"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(3000)})
    # Passages without a sentence end.
    passages = [[rng.choice(words) for _ in range(51 + i % 10)] for i in range(40)]
    docs = []
    for i in range(80):
        around = [[rng.choice(words) for _ in range(rng.randint(3, 40))] for _ in range(2)]
        docs.append([*around[0], *passages[i % 40], *around[1]])
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.text.split() for r in spans.remove_repeats(df).collect()}
    seen: set = set()
    for i, d in enumerate(docs):
        gone = set()
        for j in range(len(d) - spans.LEAST_WORDS + 1):
            window = tuple(d[j : j + spans.LEAST_WORDS])
            if window in seen:
                gone.update(range(j, j + spans.LEAST_WORDS))
            seen.add(window)
        assert got.get(i, d) == [w for j, w in enumerate(d) if j not in gone], i
        assert len(gone) >= len(passages[i % 40]) if i >= 40 else not gone


def test_keep_one_goes_by_rows(spark):
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    a, b, c, d, e, f = (text() for _ in range(6))
    near = lambda t: t + " more"
    rows = [
        (1, a, "x"), (7, near(a), "x"), (7, b, "x"), (7, c, "x"),  # one id: a copy and two clean rows
        (None, d, "x"), (None, near(d), "x"), (None, d, "y"), (None, near(b), "x"),  # copies without ids
        (9, e, "z"), (9, e, "y"), (None, e, "x"), (None, f, "x"), (None, None, "x"), (None, " ", "x"),
    ]
    for _ in range(2):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = sorted(((r.doc_id, r.text, r.source) for r in near_dup.keep_one(df).collect()), key=repr)
        one_of_d = [r for r in got if r[1] in (d, near(d))]
        assert len(one_of_d) == 1 and one_of_d[0] in ((None, d, "x"), (None, near(d), "x"))
        assert [r for r in got if r not in one_of_d] == sorted([(1, a, "x"), (7, b, "x"), (7, c, "x"), (9, e, "y"), (None, near(b), "x"), (None, e, "x"), (None, f, "x"), (None, None, "x"), (None, " ", "x")], key=repr)
