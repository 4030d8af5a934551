"""Personal data, toxicity, languages, URLs and the pipeline."""

import hashlib
import re

import corpus_pipeline
from pyspark.sql import functions as F

from tidewell.llm import language, pii, toxicity, urls

BIG = "/root/testdata/sf0.01"
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def _base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(digits) <= 19 and _luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


ODD = ["", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255", "a@b.c@d.e x@@y.z .@a-.b é@b.c", "+1 (111) 222-3333+44 20 7946 0958", "4111 1111 1111 1111 4111-1111-1111-1111-11", "@" * 500 + "a@b.c", "9" * 3000, "a" * 3000 + "@", "x@y."]


def test_base_spans():
    for text in ODD:
        assert [f"{k}:{s}:{e}" for k, s, e in pii.base_spans(text)] == _base(text), text[:40]


def test_contexts_find_unseen(spark):
    seen = [f'note {i} the secret token = "{hashlib.md5(str(i).encode()).hexdigest()}" here' for i in range(8)]
    unseen = 'odd secret token = "Zx9-Kq77Lm_42Rt8Vw1Pn" end'
    plain = [f"build Qw7-{i}-abcdefghijklmnopqr ok" for i in range(4)]
    rows = [*enumerate(seen), (100, unseen), *((200 + i, p) for i, p in enumerate(plain)), (300, None), (301, ""), *((400 + i, t) for i, t in enumerate(ODD))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string")
    out = {r.doc_id: r for r in pii.find_pii(df).collect()}
    start = unseen.index("Zx9")
    assert out[100].spans == f"key:{start}:{start + len('Zx9-Kq77Lm_42Rt8Vw1Pn')}"
    assert all(out[200 + i].spans == "" for i in range(4)) and len(out) == len(rows)
    for i, t in rows:
        want = _base(t or "")
        assert out[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(filter(None, out[i].spans.split(",")))
    assert pii.find_pii(df.limit(0)).count() == 0


def test_toxicity(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train = docs.join(labels.where(~toxicity.held_out("doc_id")), "doc_id").select("doc_id", "text", F.col("toxic").alias("label"))
    model = toxicity.fit(train)
    rows = toxicity.score(docs, model).join(labels.where(toxicity.held_out("doc_id")), "doc_id").collect()
    hit = [r.score >= 0.3 for r in rows]
    recall = sum(h and r.toxic for h, r in zip(hit, rows, strict=True)) / sum(r.toxic for r in rows)
    false = sum(h and not r.toxic for h, r in zip(hit, rows, strict=True)) / sum(not r.toxic for r in rows)
    assert recall > 0.85 and false < 0.02
    odd = toxicity.score(spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id long, text string"), model).collect()
    assert len(odd) == 3 and all(0 <= r.score <= 1 for r in odd)
    long = " ".join(["plain words here"] * 60_000)
    assert len(model.scores([long, long + " you stupid idiot", ""])) == 3
    none = toxicity.fit(train.limit(0))
    assert none.scores(["a"])[0] == 0.5


def test_rows_stay_where_no_language_is_learned(spark):
    rows = [(1, "a clean text", None), (2, None, None), (3, "", None), (4, "12 .. 34", None), (5, "é", None), (None, "x 1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in language.keep_identified(df).collect()} == {1, 5, None}


def test_language(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = language.fit_on_documents(docs)
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out("doc_id")).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    odd = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 .. 34", "en"), (4, "the thing is", None), (4, "the thing is", None)], "doc_id long, text string, lang string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(odd, model).collect()]
    assert [g[:2] for g in got[:3]] == [(1, "und"), (2, "und"), (3, "und")] and len(got) == 5 and all(0 <= s <= 1 for *_, s in got)
    assert [r.doc_id for r in language.keep_identified(docs.select("doc_id", "text", "lang").unionByName(odd)).where("doc_id < 0 or text is null or text in ('', '12 .. 34')").collect()] == []
    empty = language.fit(docs.select("doc_id", "text", "lang").limit(0))
    assert empty.predict(["words", ""])[0] == ["und", "und"]


def test_urls(spark):
    pages = [(1, "https://a.EXAMPLE.org/es/1?x"), (2, "http://example.org/en/12"), (3, "https://x.com/de/1"), (4, None), (5, "no scheme"), (6, "https://www.spam-farm.example.net/en/9"), (7, "http://notexample.org/es/"), (8, "x://h"), (9, "https://blog.therea.example.net/en/7"), (9, "https://blog.therea.example.net/en/7")]
    df = spark.createDataFrame([(i, u, "x") for i, u in pages], "page_id long, url string, rule string")
    model = urls.fit(urls.labelled(spark))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(df, model).collect()}
    assert got[1] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[2][2:] == ("example.org/en/1", "block")
    assert got[3][2:] == ("com/de/", "block") and got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None)
    assert got[6][2:] == (None, "block") and got[7][2:] == ("org/", "allow") and got[8][:2] == ("h", "") and got[9][3] == "allow"
    assert urls.judge(df, model).count() == 10 and urls.judge(df.limit(0), model).count() == 0
    plan = urls.judge(df, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline(spark):
    """Each stage against plain rules on its own input."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    junk = spark.createDataFrame([(10_000, "12 34 ..", None, "src0", 8), (10_001, None, "en", "src1", 0)], docs.schema)
    at = docs.unionByName(junk)
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in at.collect()}
        out = stage(spark, at, "/root/testdata/sf0.001")
        after = [r.doc_id for r in out.collect()]
        if name == "language_id":
            assert before - set(after) == {10_000, 10_001}
        if name == "near_dedup":
            assert len(after) == len(set(after)) < len(before)
        if name == "sharding":
            assert sorted(after) == sorted(r.doc_id for r in at.collect()) and {"shard", "slot"} <= set(out.columns)
        else:
            assert out.columns == docs.columns and set(after) <= before
        at = spark.createDataFrame(out.toPandas(), out.schema)
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_samples_are_bounded(spark):
    """The sample has exactly as many rows as it should, whatever the ids: all null, all one, or one row that repeats."""
    from tidewell.llm.scratch import least_rows

    key = F.xxhash64("doc_id", "text")
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    one = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    assert least_rows(rows, key, 50).count() == 50 and least_rows(rows, key, 5000).count() == 3000
    assert least_rows(rows.withColumn("doc_id", F.lit(1).cast("long")), key, 50).count() == 50
    assert least_rows(one, key, 50).count() == 1 and least_rows(one.unionByName(rows), key, 3001).count() == 3001
    assert least_rows(rows.limit(0), key, 50).count() == 0
    again = {r.text for r in least_rows(rows.repartition(7), key, 50).collect()}
    assert again == {r.text for r in rows.orderBy(key).limit(50).collect()}


def test_short_foreign_texts(spark):
    """Sentences of eight words in a language that isn't known go; short ones in a known language stay."""
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    model = language.fit_on_documents(docs)
    foreign = ["Wczoraj wieczorem pojechaliśmy do babci na obiad świąteczny", "Dziś rano kupiłem świeże bułki oraz żółty ser", "Наступила весна и птицы снова запели в саду"]
    assert not language.accepted(model, foreign).any()
    known = [" ".join(r.text.split()[:8]) for r in docs.where("text is not null and length(text) > 400").limit(200).collect()]
    assert language.accepted(model, known).mean() >= 0.98
