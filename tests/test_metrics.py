import math
import random

import pytest
from pyspark.sql import functions as F

from loamwork.operators import decision, metrics, quota


def test_softmax_and_confidence(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([0.0, 0.0, 0.0],), ([1000.0, 0.0, 0.0],)], "s array<double>").withColumn("p", metrics.softmax(F.col("s")))
    rows = df.select("p", metrics.confidence(F.col("p")).alias("c"), metrics.entropy(F.col("p")).alias("e")).collect()
    assert all(math.isclose(sum(r["p"]), 1.0) for r in rows)
    assert math.isclose(rows[1]["c"], 0.0, abs_tol=1e-12) and rows[2]["c"] == 1.0 and math.isclose(rows[1]["e"], math.log(3))


def test_bins_are_open_below(spark):
    rows = spark.createDataFrame([(0.0, 1), (0.1, 1), (0.30000000000000004, 0), (0.3, 0), (1.0, 1)], "confidence double, hit int")
    assert {r["bin"]: r["n"] for r in metrics.reliability(rows).collect()} == {0: 1, 2: 2, 9: 1}


def test_auc_and_precision_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 1), rng.randint(0, 40) / 40) for _ in range(300)]
    df = spark.createDataFrame(rows, "y int, p double")
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(auc)
    ap = last = 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        tp = sum(p >= t for p in pos)
        ap += (tp / len(pos) - last) * tp / (tp + sum(p >= t for p in neg))
        last = tp / len(pos)
    assert metrics.average_precision(df).first()[0] == pytest.approx(ap)
    assert metrics.roc_auc(df.where("y = 1")).first()[0] is None


def test_macro_average_has_classes_without_rows(spark):
    pairs = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "y int, predicted int")
    found = {r["label"]: (r["f1"], r["support"]) for r in metrics.class_metrics(pairs, [0, 1, 2]).collect()}
    assert found[2] == (0.0, 0) and found[0] == (pytest.approx(2 / 3), 2)


def test_nan_is_left_out(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (0, [float("nan"), 0.5])], "y int, p array<double>")
    assert metrics.probability_scores(rows).first().asDict() == {"brier": 0.0, "mean_top1": 1.0, "mean_margin": 1.0, "n": 1}


def test_temperature_is_near_the_optimum(spark):
    rng = random.Random(1)
    rows = [(i % 3, [3.0 * (k == (i % 3 if rng.random() < 0.7 else rng.randrange(3))) for k in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, scores array<double>")
    best = metrics.fit_temperature(df)
    losses = {r["temperature"]: r["nll"] for r in metrics.negative_log_likelihood(df, [best * 0.8, best, best * 1.25]).collect()}
    assert min(losses, key=losses.get) == best


def test_questions(spark):
    questions = spark.createDataFrame([("q1", "noul", "?", {"true": "is a grant", "false": "is not"}), ("q2", "choice", "?", {"a": "one", "b": "two", "c": "three"}), ("q3", "noul", "?", {"true": "x"}), ("q4", "choice", "?", {"a": "x"}), ("q5", "other", "?", {})], "question_id string, kind string, instructions string, criteria map<string,string>")
    checked = {r["question_id"]: r["error"] for r in decision.validate_questions(questions).collect()}
    assert checked["q1"] is None and checked["q2"] is None and all(checked[q] for q in ("q3", "q4", "q5"))

    def scorer(batches):
        for pdf in batches:
            yield pdf.drop(columns="prompt").assign(score=[-float(len(p)) for p in pdf["prompt"]])

    states = spark.createDataFrame([(1, "some state"), (2, "another state " * 20)], "state_id long, state string")
    asked = questions.where("question_id IN ('q1', 'q2')")
    both = {(r["state_id"], r["question_id"]): r for r in decision.answer(decision.score(decision.expand(states, asked), scorer)).collect()}
    alone = decision.answer(decision.score(decision.expand(states.where("state_id = 1"), asked.where("question_id = 'q2'")), scorer)).first()
    assert len(both) == 4 and both[1, "q2"] == alone
    assert both[1, "q2"]["choice"] == "a" and both[1, "q1"]["noul"] < 0.5 and both[1, "q1"]["choice"] is None


def test_budget(spark):
    ledger = spark.createDataFrame([(1, f"2024-01-02 {h:02}:00:00", h % 4 > 0, 10) for h in range(24)] + [(2, "2024-01-01 00:00:00", True, 5)], "slot long, ts string, ok boolean, tokens long").withColumn("ts", F.to_timestamp("ts"))
    state = {r["slot"]: r for r in quota.budget_state(ledger, "2024-01-02 23:00:00", rpd=18, rpm=2).collect()}
    assert state[1]["in_day"] == 18 and state[1]["daily_dry"] and not state[1]["budget_left"]
    assert state[2]["in_day"] == 0 and state[2]["budget_left"]
    spread = quota.migrate_counts(spark.createDataFrame([(3, 4)], "slot long, n long"), "2024-01-02 12:00:00")
    assert [str(r["ts"]) for r in spread.orderBy("ts").collect()] == ["2024-01-02 03:00:00", "2024-01-02 06:00:00", "2024-01-02 09:00:00", "2024-01-02 12:00:00"]
