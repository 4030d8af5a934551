"""Connected components against a plain union-find."""

import random

from tidewell.llm import components as module
from tidewell.llm.components import components
from tidewell.llm.scratch import Scratch


def _plain(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    some = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(150)]
    star, ring, chain = [(1000, k) for k in range(1001, 1100)], [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)], [(i, i + 1) for i in range(3000, 3060)]
    for edges in ([], [(4, 4)], [(9, -3), (9, -3), (-3, 9)], some + star + ring + chain):
        rows = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"), "c").collect()
        got = {r.node: r.comp for r in rows}
        assert got == _plain(edges) and len(rows) == len(got)


def test_parents_of_many_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT", 3)
    monkeypatch.setattr(module, "SALTS", 4)
    rng = random.Random(5)
    fans = [(hub, hub + k) for hub in range(10_000, 20_000, 1000) for k in range(1, 60)] + [(hub, hub + 1000) for hub in range(10_000, 19_000, 1000)]
    rng.shuffle(fans)
    rows = components(spark.createDataFrame(fans, "a long, b long").repartition(7), Scratch(spark, "test"), "c").collect()
    assert {r.node: r.comp for r in rows} == _plain(fans) and len(rows) == len({x for e in fans for x in e})
