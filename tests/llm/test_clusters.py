import collections
import glob
import os
import random
from hashlib import sha256

import duckdb
import numpy as np
import pytest

from loamwork.llm import elkan

DATA = "/root/testdata/sf0.001"


def plain(rows, k, rounds, dim):
    """(vec_id, cluster, distance) by all distances in every round, and the final centroids."""
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [list(v) for _, v in first]
    if not centroids:
        return [], []
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for c, own in groups.items():
            centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], centroids


def rows_of(seed, n, dim, coarse):
    rng = random.Random(seed)
    return [(i, [rng.randint(-coarse, coarse) / 256 + (3 * (i % 5) / 256) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("seed,coarse,k", [(1, 2, 7), (2, 300, 12), (3, 1, 20), (4, 5000, 3)])
def test_equals_all_distances(spark, seed, coarse, k):
    rows = rows_of(seed, 150, 3, coarse)
    found = elkan.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), k=k, rounds=5, dim=3)
    expected, centroids = plain(rows, k, 5, 3)
    assert sorted(map(tuple, found.assigned.collect())) == sorted(expected)
    assert found.centroids.tolist() == centroids


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [*rows_of(5, 30, 2, 2), (3, [0.0, 0.0]), (3, [0.0, 0.0]), (None, [0.5, 0.5]), (40, None), (41, []), (42, [1.0]), (43, [1.0, nan]), (44, [inf, 0.0]), (45, [None, 1.0]), (46, [1.0, 2.0, 3.0])]
    data = [(*r, "clash", 9) for r in rows]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, cluster string, id int").repartition(2)
    found = elkan.clusters(df, k=40, dim=2)
    expected, centroids = plain(rows, 40, 5, 2)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()), key=str) == sorted(expected, key=str)
    assert len(centroids) == 32 and found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert elkan.clusters(df.limit(0), dim=2).count() == 0
    far = elkan.clusters(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>"), k=1, dim=2).collect()
    assert {r["vec_id"]: r["cluster"] for r in far} == {1: 0, 2: 0, 3: 0}


def test_bounds_spare_distances():
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (20, 16))
    v = (centres[rng.integers(0, 20, 4000)] + rng.integers(-50, 50, (4000, 16))).astype(np.int64)
    start = centres + rng.integers(-20, 20, centres.shape)
    first = elkan.Bounds(start, None)
    state = first.assign(v, np.zeros(len(v), np.int64), elkan._root_up(elkan.squared(v, start[0])), np.zeros((len(v), 20), np.float32))
    moved = start + rng.integers(-3, 3, start.shape)
    cluster, upper, lower, computed = elkan.Bounds(moved, start).assign(v, *state[:3])
    every = np.stack([elkan.squared(v, c) for c in moved], axis=1)
    assert (cluster == every.argmin(axis=1)).all()
    assert (upper >= np.sqrt(every[np.arange(len(v)), cluster])).all() and (lower <= np.sqrt(every)).all()
    assert computed < 0.05 * every.size


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_query_equals_sql(spark):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = elkan.op12_elkan_clusters(spark, DATA)
    expected = con.sql(elkan.ORACLES["op12_elkan_clusters"])
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall()) and found.columns == expected.columns
