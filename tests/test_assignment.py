from collections import Counter
from math import ceil

import pytest

from loamwork.operators import assignment

SLOTS = "slot string, place int, role string, rpd double, rpm double, margin double, in_day long, disabled boolean"


def plain(requests, slots, minutes):
    """One request after the other takes the first place that is free."""
    found = {}
    sent, day = Counter(), {s[0]: s[6] or 0 for s in slots}
    usable = sorted((s for s in slots if not s[7]), key=lambda s: s[1])
    for i, role in sorted(requests):
        found[i] = next(((s[0], m) for m in range(minutes) for s in usable if s[2] == role and sent[s[0], m] < ceil(s[4] * s[5]) and day[s[0]] < ceil(s[3] * s[5])), (None, None))
        if found[i][0]:
            sent[found[i]] += 1
            day[found[i][0]] += 1
    return found


@pytest.mark.parametrize("partitions,n,bucket", [(1, 300, 64), (7, 300, 3), (3, 40, 64)])
def test_no_slot_exceeds_its_budget(spark, monkeypatch, partitions, n, bucket):
    monkeypatch.setattr(assignment, "BUCKET", bucket)
    slots = [("a", 0, "primary", 60.0, 4.0, 0.85, 3, None), ("b", 1, "primary", 9.0, 20.0, 0.5, None, False), ("c", 2, "verifier", 1000.0, 3.0, 1.0, 0, False), ("d", 3, "primary", 50.0, 5.0, 1.0, 0, True), ("e", 4, "primary", 5.0, 1.0, 1.0, 9, False), ("f", 5, "primary", 3.0, 0.2, 0.85, 0, False)]
    requests = [(i * 37 % 1009, "verifier" if i % 3 == 0 else "primary") for i in range(n)] + [(5000, "nobody")]
    df = spark.createDataFrame([(*r, "x") for r in requests], "id long, role string, minute0 string").repartition(partitions)
    found = assignment.assign(df, spark.createDataFrame(slots, SLOTS), ["id"], 30).collect()
    assert len(found) == len(requests) and {r["id"]: (r["slot"], r["minute"]) for r in found} == plain(requests, slots, 30)
    per_minute, per_day = Counter((r["slot"], r["minute"]) for r in found if r["slot"]), Counter(r["slot"] for r in found if r["slot"])
    limit = {s[0]: s for s in slots}
    assert all(k <= ceil(limit[s][4] * limit[s][5]) for (s, _), k in per_minute.items()) and all(k + (limit[s][6] or 0) <= ceil(limit[s][3] * limit[s][5]) for s, k in per_day.items())
    assert any(r["slot"] is None for r in found)


def test_numbers_of_an_order(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1009 AS id", "id % 3 AS k").repartition(5)
    found = {(r["k"], r["id"]): r["number"] for r in assignment.numbered(df, ["k", "id"]).collect()}
    assert found == {key: n for n, key in enumerate(sorted(found))} and assignment.numbered(df.limit(0), ["k", "id"]).count() == 0
