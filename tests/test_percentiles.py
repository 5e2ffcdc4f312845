import random
import statistics
from collections import defaultdict
from math import floor

import pytest

from loamwork.operators import metrics, percentiles


def data(seed, n):
    rng = random.Random(seed)
    kinds = [lambda: rng.random(), lambda: rng.choice([1.5, 2.5]), lambda: 10 ** rng.uniform(-200, 200) * rng.choice([-1, 1]), lambda: 7.0, lambda: float(rng.randrange(5) or 10**9)]
    return [(["a", "b", "c", None, "e"][k], rng.randrange(2), None if rng.random() < 0.05 else kinds[k]()) for _ in range(n) for k in [rng.randrange(5)]] + [("only nulls", 0, None), ("one", 0, 3.0)]


@pytest.mark.parametrize("grid,small", [(32, 40), (512, 4096)])
def test_ranks_equal_sorting(spark, monkeypatch, grid, small):
    monkeypatch.setattr(percentiles, "GRID", grid)
    monkeypatch.setattr(percentiles, "SMALL", small)
    rows = data(grid, 1500)
    groups = defaultdict(list)
    for model, subset, v in rows:
        if v is not None:
            groups[model, subset].append(v)
    df = spark.createDataFrame(rows, "model string, subset int, latency double").repartition(3)
    found = {(r["model"], r["subset"]): (r["median"], r["p95"], r["first"], r["last"]) for r in percentiles.nearest_rank(df, ["model", "subset"], "latency", {"median": 0.5, "p95": 0.95, "first": 0.0, "last": 1.0}).collect()}
    expected = {g: tuple(sorted(v)[min(len(v) - 1, floor(len(v) * q))] for q in (0.5, 0.95, 0.0, 1.0)) for g, v in groups.items()}
    assert found == expected
    middle = {(r["model"], r["subset"]): r["m"] for r in percentiles.medians(df, ["model", "subset"], "latency", "m").collect()}
    assert middle == {g: pytest.approx(statistics.median(v)) for g, v in groups.items()}
    assert percentiles.medians(df.limit(0), ["model"], "latency", "m").count() == 0


def test_a_wrong_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "GRID", 40)
    monkeypatch.setattr(percentiles, "ACCURACY", 20)
    monkeypatch.setattr(percentiles, "SMALL", 200)
    df = spark.range(3000).selectExpr("'x' as model", "double(pmod(id * 7919, 3001)) as latency").repartition(4)
    values = sorted(pmod * 1.0 for pmod in ((i * 7919) % 3001 for i in range(3000)))
    assert metrics.latency(df).first()[1:] == (values[1500], values[2850])


def test_scores_of_providers(spark):
    rows = [("m", True, True, 1.0), ("m", False, True, 2.0), (None, True, False, 4.0), ("n", True, True, None)]
    found = {r["model"]: tuple(r)[1:] for r in metrics.provider_scores(spark.createDataFrame(rows, "model string, hit boolean, json_valid boolean, latency double")).collect()}
    assert found == {"m": (0.5, 1.0, 1.5, 2), None: (1.0, 0.0, 4.0, 1), "n": (1.0, 1.0, None, 1)}
