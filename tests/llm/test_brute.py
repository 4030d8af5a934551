"""Operators and the whole pipeline against plain Python (brute.py)."""

import math
import os
import random
import re
import struct
import sys
import zlib
from collections import Counter

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from tidewell.llm import chars, decontaminate, language, media, mixing, near_dup, pii, sharding, spans, toxicity, urls  # noqa: E402

SF = "/root/testdata/sf0.001"


def _held(i, n, k):
    return zlib.crc32(str(i).encode()) % n == k


def _words(rng, n, alphabet="abcdefghijkl"):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_spans_by_sentences_and_words(spark):
    rng = random.Random(21)
    sentence = lambda n=0: " ".join(_words(rng, n or rng.randint(4, 11))).capitalize() + rng.choice([". ", "! ", ".\n", "\n"])
    own = lambda n: "".join(sentence() for _ in range(n))
    one, two, three, many = sentence(16), own(2), own(3), own(9)
    long = " ".join(_words(rng, 60))
    texts = {}
    for i in range(0, 40, 2):
        shared = (one, two, three, many, long)[i // 2 % 5]
        texts[i], texts[i + 1] = own(4) + shared + own(3), own(2) + "so it is that " + shared.strip() + " and on. " + own(3)
    texts |= {50: None, 51: "", 52: "no end", 53: own(5) * 2, 54: texts[2], 55: "é" * 60}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, hash string")
    got = {r.doc_id: r.text for r in spans.remove_repeats(df).collect()}
    want = brute.spans_removed(texts)
    assert got == want and 53 in want and 54 in want
    left = lambda s, i: s.strip() in re.sub(r"\s+", " ", got.get(i, texts[i]))
    norm = lambda s: re.sub(r"\s+", " ", s)
    assert all(left(norm(one), i) for i in range(0, 40, 10)) and all(i not in got for i in range(1, 40, 10))
    assert all(many.split()[20] not in got[i].split() for i in range(16, 40, 10) if i > 6)


def test_pii_discovers_every_kind(spark):
    rng = random.Random(4)
    seeds = {
        "email": (lambda k: f"user{k}@mail.example.com", "write me at mail", "jane (AT) host (DOT) org"),
        "ip": (lambda k: f"10.0.{k}.7", "logged in from address", "10-20-30-40"),
        "card": (lambda k: "4111 1111 1111 1111" if not k else "4012888888881881" if k == 1 else "5555 5555 5555 4444" if k == 2 else "378282246310005" + "0" * 2, "paid by card", "4111.1111.1111.1112"),
        "phone": (lambda k: f"+1 (555) 555-01{k:02d}", "please call number", "(555) 555-0123"),
        "key": (lambda k: f"{rng.getrandbits(160):040x}", "the secret token", "Zx9" + "Kq7_" * 60),
    }
    rows, at = [], 0
    for kind, (make, before, unseen) in seeds.items():
        for k in range(8 if kind != "card" else 3):
            rows.append((at, f"line {at} {before} {make(k)} thanks", None))
            at += 1
        rows.append((1000 + len(rows), f"other text {before} {unseen} thanks", kind))
    rows += [(5000 + k, f"the version {k} is {unseen} ok", None) for k, (_, _, unseen) in enumerate(seeds.values())]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.find_pii(df).collect()}
    for i, text, kind in rows:
        if kind:
            start = text.index(seeds[kind][2])
            assert out[i].spans == f"{kind}:{start}:{start + len(seeds[kind][2])}" and (out[i].n_added, out[i].n_spans) == (1, 1), (kind, out[i])
        if i >= 5000:
            assert out[i].n_added == 0
    # Long keys with one beginning are instances of their own, and the patterns' trust is that of plain Python.
    edges = [(f"p{rng.randrange(6)}", rng.choice(pii.KINDS), f"i{rng.randrange(25)}", rng.random() < 0.4) for _ in range(300)]
    edges = [(p, k, i, s) for (p, k, i), s in {e[:3]: e[3] for e in edges}.items()]
    got = pii.trusted_patterns(spark.createDataFrame(edges, "pattern string, kind string, instance string, seed boolean"), pii.Scratch(spark, "test"))
    want = brute.trust(edges)
    assert want and {(r.pattern, r.kind): round(r.trust, 9) for r in got.collect()} == {x: round(t, 9) for x, t in want.items()}
    near = ["a1" * 110 + "x", "a1" * 110 + "y"]
    batch = spark.createDataFrame([(1, f"key is {near[0]} end"), (2, f"key is {near[1]} end")], "row_key long, text string")
    assert len({r.instance for r in batch.mapInArrow(pii._scan, "row_key long, kind string, start long, end long, seed boolean, base boolean, instance string, patterns array<string>").collect()}) == 2


def test_toxicity_scores(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = docs.join(labels.where(~toxicity.held_out("doc_id")), "doc_id").select("doc_id", "text", F.col("toxic").alias("label"))
    model = toxicity.fit(train)
    texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()] + ["", "Ünï cödé!", "x"]

    def grams(text):
        shown = "".join(c if c.isalpha() else "\x01" for c in text.lower()) + "\x01"
        return {shown[i : i + n] for n in toxicity.ORDERS for i in range(len(shown) - n + 1)}

    def score(text):
        import numpy as np

        found = {int(chars.ngrams(np.array([ord(c) for c in g], np.uint32), len(g))[0] >> np.uint64(64 - toxicity.BUCKET_BITS)) for g in (grams(text) if text else ())}
        kept = {int(model.slot[b]) for b in found} - {-1}
        length = math.sqrt(sum(model.ratio[f] ** 2 for f in kept))
        z = toxicity.LENGTH * sum(model.weight[f] * model.ratio[f] for f in kept) / length + model.bias if kept else model.bias
        return 1 / (1 + math.exp(-z))

    want = [score(t) for t in texts]
    assert max(abs(a - b) for a, b in zip(model.scores(texts), want, strict=True)) < 1e-9
    for most in (7, 64, 1000):  # texts of many chunks score as whole ones
        monkeypatch.setattr(chars, "SEGMENT", most)
        assert max(abs(a - b) for a, b in zip(model.scores(texts), want, strict=True)) < 1e-9
    rows = [(i, t, "clash") for i, t in enumerate(texts)] * 2
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score string"), model)
    assert got.count() == len(rows) and toxicity.score(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    return docs, rows, language.fit_on_documents(docs), brute.Language([(r.text, r.lang) for r in rows if r.lang and r.text is not None and not _held(r.doc_id, 3, 1)])


POLISH = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem i sumieniem"


def test_language_predictions(spark, languages, monkeypatch):
    docs, rows, model, plain = languages
    texts = [r.text or "" for r in rows] + ["", "12 .. 3", "the", POLISH, "a" * 40]
    want = [plain.judge(t) for t in texts]
    langs, scores, n, known = model.judge(texts)
    assert langs == [w[0] for w in want] and max(abs(s - w[1]) for s, w in zip(scores, want, strict=True)) < 1e-9
    assert n.tolist() == [w[2] for w in want] and known.tolist() == [w[3] for w in want]
    monkeypatch.setattr(chars, "SEGMENT", 300)
    again = model.judge(texts)
    assert again[0] == langs and max(abs(again[1] - scores)) < 1e-9 and again[2].tolist() == n.tolist()
    assert language.identify(docs.limit(0), model).count() == 0


def test_language_stage_goes_by_the_model(spark, languages):
    docs, rows, _, plain = languages
    odd = [(9001, POLISH, None, "s", 1), (9002, "Все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом", "en", "s", 1), (9003, "xqzt jkwv pppq zzkw vbnm qwrt plkj hgfd zxcv bnmm qqqq", "en", "s", 1), (9004, "", "en", "s", 1), (None, None, None, None, None)]
    odd = [r for r in odd if r[0] is None or _held(r[0], 3, 1) or r[0] in (9001,)] + [(9000 + 1 + 3 * k, odd[2][1], None, "s", 1) for k in range(2)]
    df = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = language.keep_identified(df)
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted(r.doc_id for r in rows if plain.accepts(r.text)) and len(ids) == len(rows) and kept.columns == docs.columns
    only = {r.doc_id for r in language.keep_identified(df, wanted=("de",)).collect()}
    assert only == {r.doc_id for r in rows if plain.judge(r.text)[0] == "de" and plain.accepts(r.text)} and 0 < len(only) < len(rows)
    assert language.keep_identified(df.limit(0)).count() == 0


def test_url_scores(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    model = urls.fit(urls.labelled(spark))
    weights, bias, hashing = model.stages[1].coefficients.toArray(), model.stages[1].intercept, HashingTF(numFeatures=urls.WIDTH)
    got = {r.page_id: r for r in urls.judge(pages, model).collect()}

    def plain(url):
        host, path = "", ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host) :])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(t), t, v) for v, t in urls.RULES for h, _, p in [t.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule, says = max(fits)[1:] if fits else (None, None)
        grams = {f"{k}{x[i : i + n]}" for k, part in enumerate((host, path)) for x in [f"^{part}$"] for n in urls.ORDERS for i in range(len(x) - n + 1)}
        p = 1 / (1 + math.exp(-bias - sum(weights[b] for b in {hashing.indexOf(g) for g in grams})))
        return host, path, rule, says or ("block" if p >= 0.5 else "allow"), p

    for r in pages.collect():
        host, path, rule, verdict, p = plain(r.url)
        mine = got[r.page_id]
        assert (mine.host, mine.path, mine.rule, mine.verdict) == (host, path, rule, verdict) and abs(mine.probability - p) < 1e-9


def test_media_features(spark):
    texts = ["", "é" * 300, "plain " * 500, "x" * 576, "\n"]
    out = {r.doc_id: r for r in media.store_and_describe(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        raw = t.encode()
        p = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        rows = [p[k : k + 576] for k in range(0, len(p), 576)]
        n, total, squares = len(p), sum(p), sum(x * x for x in p)
        eighths = Counter(x // 32 for x in p)
        assert out[i].feature == f"576x{len(rows)};{total * 1000 // n};{(squares * n - total * total) * 1000 // (n * n)};" + ",".join(str(eighths[k]) for k in range(8))
        chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 576, len(rows), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r for r in rows), 6)) + chunk(b"IEND", b"")
        assert out[i].media_bytes == len(png) and out[i].media_sha256 == __import__("hashlib").sha256(png).hexdigest()


def test_archives_stay_small(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(40)], "doc_id long, text string").coalesce(1)
    folder = f"file://{tmp_path}/a"
    media.write_archives(df, folder, most=1000)
    assert len((tmp_path / "a" / "_archives").read_text().splitlines()) > 3
    assert sorted(r.doc_id for r in media.read_archives(spark, folder).collect()) == list(range(40))


CLASHES = ["_key", "_range", "_rank", "_below", "_at", "_times", "_more", "_turn", "_copy", "_row", "key", "th", "node", "says", "grams", "features", "rawPrediction", "prediction", "a.b", "rank", "h", "n", "row_number_"]


def test_clashing_columns_stay(spark):
    text = " ".join(_words(random.Random(1), 40))
    values = {c: f"v-{c}" for c in CLASHES}
    rows = [(1, text, "s", *values.values()), (1, text, "s", *values.values()), (2, text + " more", "s", *values.values()), (3, None, None, *values.values()), (None, "other words", "t", *values.values())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)).withColumn("lang", F.lit("en"))
    bench = spark.createDataFrame([(1, " ".join(_words(random.Random(2), 30)), "x")], "item_id long, text string, _key string")
    for out in (sharding.shard_rows(df, 3), mixing.apply_mix(df), decontaminate.drop_contaminated(df, bench), near_dup.keep_one(df), language.keep_identified(df)):
        got = out.collect()
        assert got and set(df.columns) <= set(out.columns) and all(r[c] == f"v-{c}" for r in got for c in CLASHES)
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b.org/c").alias("url"), *(F.col(f"`{c}`") for c in CLASHES))
    got = urls.judge(pages, urls.fit(urls.labelled(spark))).collect()
    assert len(got) == 5 and all(r[c] == f"v-{c}" for r in got for c in CLASHES)
    for f in (near_dup.near_duplicates, mixing.mix_sources, pii.find_pii, spans.remove_repeats, media.store_and_describe):
        assert f(df).count() is not None and f(df.limit(0)).count() == 0
    for f in (near_dup.keep_one, mixing.apply_mix, language.keep_identified):
        assert f(df.limit(0)).count() == 0


def test_hot_buckets_and_fine_grids(spark, monkeypatch):
    """Small bounds send everything through the ways of large groups; the results stay."""
    rng = random.Random(8)
    texts, words = {}, _words(rng, 70)
    for i in range(60):
        texts[i] = " ".join(words)
        if i % 7 == 6:
            words = _words(rng, 70)
        else:
            words[rng.randrange(70)] = f"e{i}"
    df = spark.createDataFrame([(i, t, f"s{i % 4}") for i, t in texts.items()], "doc_id long, text string, source string")
    want = brute.components(texts)
    monkeypatch.setattr(near_dup, "HOT", 1)
    monkeypatch.setattr(near_dup, "SALTS", 3)
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()} == want
    times = brute.mixed([(i, f"s{i % 4}", t) for i, t in texts.items()])
    for grid, few in ((4096, 20_000), (2, 1), (3, 5)):
        monkeypatch.setattr(mixing, "GRID", grid)
        monkeypatch.setattr(mixing, "FEW", few)
        assert +Counter({r.doc_id: r.times for r in mixing.mix_sources(df).collect()}) == +times


def test_pipeline_equals_plain_python(spark, languages):
    docs, rows, _, plain = languages
    at = [(r.doc_id, r.source, r.text) for r in rows if plain.accepts(r.text)]
    comp = brute.components({i: t for i, _, t in at})
    at = [r for r in at if comp[r[0]] == r[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute.contaminated([(i, t) for i, _, t in at], items)
    at = [r for r in at if r[0] not in found]
    times = brute.mixed(at)
    at = [r for r in at for _ in range(times[r[0]])]
    want = Counter(brute.placed([(i, t) for i, _, t in at], corpus_pipeline.SHARDS))
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.shard, r.slot) for r in got.collect()) == want and found and len(rows) > len(comp) - 1
    assert set(docs.columns) < set(got.columns)


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tidewell.llm import scratch

    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = conf = Context()  # noqa: N815

    with pytest.raises(ValueError, match="checkpoint"):
        scratch.shared_dir(Session())


def test_repeated_rows_with_maps(spark):
    """Rows that can't be compared as they are still give one row of a group, and their shares of a mix."""
    text = " ".join(_words(random.Random(3), 40))
    rows = [(1, text, "s", {"k": i}) for i in range(3)] + [(2, text, "s", {"k": 9}), (3, "other words here", "t", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string, int>")
    assert sorted((r.doc_id, r.more) for r in near_dup.keep_one(df).collect()) == [(1, {"k": 0}), (3, None)]
    got = mixing.apply_mix(df).collect()
    assert sum(len(r.text.split()) for r in got) == pytest.approx(1.5 * sum(len(t.split()) for _, t, *_ in rows), rel=0.25)
