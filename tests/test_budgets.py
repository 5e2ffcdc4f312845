import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from loamwork.operators import quota
from loamwork.streaming import budgets

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "slot string, ts timestamp, ok boolean, tokens long, available_after timestamp"


def stamp(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).isoformat()


def feed(folder, number, rows):
    with open(os.path.join(folder, f"{number}.json"), "w", encoding="utf-8") as f:
        f.writelines(json.dumps({"slot": s, "ts": stamp(m), "ok": ok, "tokens": 1, "available_after": None if after is None else stamp(after)}) + "\n" for s, m, ok, after in rows)


def replay(spark, tmp_path, batches, rpd=3, rpm=2):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.mkdir(source)
    for number, rows in enumerate(batches):
        feed(source, number, rows)
        query = budgets.budgets(spark.readStream.schema(SCHEMA).json(source), rpd, rpm).writeStream.option("checkpointLocation", state).option("path", out).format("parquet").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.parquet(out), spark.read.schema(SCHEMA).json(source), state


def test_replay_equals_the_windows_of_a_ledger(spark, tmp_path):
    batches = [[(s, 7 * i + k * 300 + (s == "b"), (i + k) % 3 > 0, None) for i in range(40) for s in "ab"] for k in range(0, 14, 2)]
    found, ledger, _ = replay(spark, tmp_path, [sorted(b, key=lambda r: r[1]) for b in batches])
    day = quota.rolling_day(ledger).select("slot", "ts", F.col("in_day").alias("d"))
    minute = quota.per_minute(ledger)
    both = found.join(day, ["slot", "ts"])
    assert found.count() == ledger.count() == both.count() and both.where("in_day <> d").count() == 0
    last = found.groupBy("slot", F.date_trunc("minute", "ts").alias("minute")).agg(F.max("in_minute").alias("m")).join(minute, ["slot", "minute"])
    assert last.where("m <> requests").count() == 0
    assert found.where("daily_dry <> (in_day >= 3) OR budget_left <> (in_day < 3 AND in_minute < 2)").count() == 0


def test_refusals_end_and_silent_slots_have_no_state(spark, tmp_path):
    batches = [[("a", 0, True, None), ("a", 1, False, 100), ("a", 50, True, None), ("b", 2, True, None)], [("b", 101, True, None), ("a", 120, True, None)], [("c", 3000, True, None)], [("c", 3100, True, None)]]
    found, _, state = replay(spark, tmp_path, batches, rpd=10, rpm=9)
    rows = {(r["slot"], int((r["ts"] - T0).total_seconds() // 60)): (r["in_day"], r["blocked"], r["budget_left"]) for r in found.collect()}
    assert rows["a", 1] == (1, True, False) and rows["a", 50] == (2, True, False) and rows["a", 120] == (3, False, True)
    assert rows["b", 101] == (2, False, True)
    held = spark.read.format("statestore").option("stateVarName", "stamps").load(state)
    assert {r["key"]["slot"] for r in held.select("key").distinct().collect()} == {"c"}
    paused = spark.read.format("statestore").option("stateVarName", "available_after").load(state)
    assert paused.count() == 0


@pytest.mark.parametrize("rows", [[], [("a", 5, True, None)] * 4])
def test_repeated_and_missing_requests(spark, tmp_path, rows):
    found, _, _ = replay(spark, tmp_path, [rows or [("z", 0, False, None)]], rpd=3, rpm=2)
    assert [r["in_day"] for r in found.orderBy("in_day").collect()] == ([1, 2, 3, 4] if rows else [0])
