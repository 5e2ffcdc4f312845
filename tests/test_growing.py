import random

import pytest

from loamwork.operators import growing
from loamwork.operators.components import connected_components


def plain(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_batches_gives_the_components_of_the_whole(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(7, 7), (500, 500), (None, 3), (4, None), (5, 6), (5, 6)]
    rng.shuffle(links)
    labels = spark.createDataFrame([], "node long, component long")
    cut = [0, 20, 21, 70, len(links)]
    for a, b in zip(cut, cut[1:], strict=False):
        before = labels
        labels = spark.createDataFrame(growing.add_links(labels, spark.createDataFrame(links[a:b], "a long, b long")).collect(), "node long, component long")
        assert {r["node"]: r["component"] for r in labels.collect()} == plain(links[:b])
        old = {tuple(r) for r in before.collect()}
        assert {tuple(r) for r in growing.touched(before, labels).collect()} == {tuple(r) for r in labels.collect()} - old
    every = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {n: c for n, c in plain(links).items() if n in every} == every


def test_new_links_only_touch_their_components(spark):
    labels = spark.range(0, 1000).selectExpr("id AS node", "id - id % 10 AS component")
    after = growing.add_links(labels, spark.createDataFrame([(13, 27), (1005, 999)], "a long, b long"))
    changed = {tuple(r) for r in growing.touched(labels, after).collect()}
    assert changed == {(n, 10) for n in range(20, 30)} | {(1005, 990)} and after.count() == 1001
