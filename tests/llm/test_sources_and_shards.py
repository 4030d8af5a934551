"""Sharding, mixing, decontamination and media."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, media, mixing, sharding

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, _rank int"


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 24, 100, 1001])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 3)).collect()] if n else []
    assert sorted(got) == list(range(n)) and (n < 24 or got != list(range(n)))


def test_shards(spark):
    rows = [(i, "é" * (i % 5), "s", i) for i in range(50)] + [(None, None, None, 1), (3, "", "s", 2), (3, "", "s", 2)]
    df = spark.createDataFrame(rows, DOCS)
    out = sharding.shard_rows(df, 24).collect()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.size == len((r.text or "").encode()) + 8 and r.text_crc32 == zlib.crc32((r.text or "").encode())
    assert len(out) == 53 and all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.shard_rows(df.repartition(7), 24).collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in out if r.doc_id != 3) == Counter((r.doc_id, r.shard, r.slot) for r in again if r.doc_id != 3)
    assert sharding.shard_rows(df.limit(0), 24).count() == 0


def _targets(sizes, share=1.5, most=2, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), list(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > most * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            free.remove(s)
    return out


def test_mix(spark):
    rows = [(i, "w " * (i % 17 + 1), ("a", "b", "c", None, "e")[i % 5 if i > 90 else 0], 0) for i in range(200)] + [(500, None, "z", 0), (501, "", "a", 0)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix_sources(df).collect()
    sizes = Counter()
    for r in out:
        assert r.size == len((dict((a, b) for a, b, *_ in rows)[r.doc_id] or "").split())
        sizes[r.source] += r.size
    want = _targets(sizes)
    taken = Counter()
    for r in out:
        taken[r.source] += r.taken
        assert abs(r.target - want[r.source]) < 1e-6 and r.taken in (0, r.size, 2 * r.size) and r.source_size == sizes[r.source]
    assert all(abs(taken[s] - want[s]) <= 40 for s in sizes) and sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = mixing.mix_sources(df.repartition(9)).collect()
    assert {r.doc_id: r.taken for r in out} == {r.doc_id: r.taken for r in again}
    assert mixing.apply_mix(df).count() == sum(r.times for r in out)
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_mix_of_many_repeated_rows(spark):
    rows = [(None, "w w w", "a", 0)] * 90 + [(i, "w w", "b", 0) for i in range(60)] + [(7, "v v v v", None, 0)] * 40
    df = spark.createDataFrame(rows, DOCS)
    out = mixing.mix_sources(df).collect()
    took, have, got = Counter(), Counter(), Counter()
    for r in out:
        took[r.doc_id, r.source] += r.times
        have[r.doc_id, r.source] += 1
    assert any(took[k] % have[k] for k in have)
    for r in mixing.apply_mix(df).collect():
        got[r.doc_id, r.source] += 1
    assert got == +took and all(got[k] <= 2 * have[k] for k in have)


def test_contamination_equals_brute_force(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    docs = [(1, "x y z. " + item.upper().replace(" ", ", ") + "! q", "s", 0), (2, "p q " + item[: len(item) // 2] + " r s", "s", 0), (3, None, "s", 0), (4, "", "s", 0), (5, "few words", "s", 0), (6, "a few words", "s", 0), (7, "w " * 300 + item, "s", 0), (7, "w " * 300 + item, "s", 0)]
    bench = [(10, item), (11, "few words"), (12, None), (13, "")]
    df, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id long, text string")
    words = lambda t: re.findall("[A-Za-z0-9]+", (t or "").lower())
    grams = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())(words(t))
    want = {(i, d[0]) for i, t in bench for d in docs if grams(t) and 100 * len(grams(t) & grams(d[1])) >= 75 * len(grams(t))}
    found = decontaminate.contaminated(df, b)
    assert sorted((r.item_id, r.doc_id) for r in found.collect()) == sorted(want) == [(10, 1), (10, 7), (11, 5)]
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(df, b).collect()) == [2, 3, 4, 6]
    assert decontaminate.contaminated(df.limit(0), b).count() == 0 and decontaminate.contaminated(df, b.limit(0)).count() == 0


def test_media_round_trip(spark, tmp_path):
    docs = [(1, "é" * 300), (2, None), (3, ""), (None, "x" * 576), (1, "é" * 300), (-4, "y" * 577)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = media.store_and_describe(df).collect()
    want = Counter()
    for i, t in docs:
        raw = (t or "").encode()
        p = media.payload_of(raw)
        assert len(p) % 576 == 0 and p
        want[i, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])] += 1
    assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in out) == want
    assert media.store_and_describe(df.limit(0)).count() == 0
    folder = f"file://{tmp_path}/a"
    media.write_archives(df, folder)
    rows = media.read_archives(spark, folder, split=200).collect()  # ranges shorter than members
    assert len(rows) == 6 and all(hashlib.sha256(r.media).hexdigest() in {x.media_sha256 for x in out} for r in rows)


def test_media_member_is_read_again(tmp_path, monkeypatch):
    import zipfile

    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        for i in range(3):
            z.writestr(f"{i}_{i}.png", media.encode_png(media.payload_of(b"abc" * i)))
    (tmp_path / "_archives").write_text(f"{(tmp_path / 'p.zip').stat().st_size} p.zip\n")
    reader = media.MediaReader(f"file://{tmp_path}")
    real, failures = zipfile.ZipFile.read, Counter()

    def flaky(self, info, *a):
        failures[info.filename] += 1
        if info.filename == "1_1.png" and failures[info.filename] < 3:
            raise zipfile.BadZipFile("bad checksum")
        return real(self, info, *a)

    monkeypatch.setattr(zipfile.ZipFile, "read", flaky)
    rows = [r for b in reader.read(reader.partitions()[0]) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [0, 1, 2] and failures["0_0.png"] == 1 and failures["1_1.png"] == 3
    monkeypatch.setattr(media, "RETRIES", 2)
    failures.clear()
    with pytest.raises(zipfile.BadZipFile):
        list(reader.read(reader.partitions()[0]))
