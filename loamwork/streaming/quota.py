"""The ledger's windows over a stream of requests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY = 86_400_000_000


def per_minute(ledger: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Requests of each slot and calendar minute; requests later than `late` are not counted."""
    windowed = ledger.withWatermark("ts", late).groupBy("slot", F.window("ts", "1 minute")).agg(F.count("*").alias("requests"))
    return windowed.select("slot", F.col("window.start").alias("minute"), "requests")


def per_day(ledger: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(slot, day, successful, tokens) of each calendar day: totals that start anew at midnight."""
    windowed = ledger.withWatermark("ts", late).groupBy("slot", F.window("ts", "1 day"))
    totals = windowed.agg(F.count_if("ok").alias("successful"), F.sum(F.when(F.col("ok"), F.col("tokens")).otherwise(0)).alias("tokens"))
    return totals.select("slot", F.to_date("window.start").alias("day"), "successful", "tokens")


def rolling_day(ledger: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(slot, ts, in_day) of each request: successes in the 24 hours up to it, in the order of arrival.

    State is the stamps of a slot's last day, so it is bounded by the slot's budget. A slot that has been
    silent for a day, by the watermark, has no state.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        stamps = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values("at", kind="stable")
        out = []
        for at, ok in zip(rows["at"], rows["ok"], strict=True):
            if ok:
                stamps.append(int(at))
            out.append(sum(at - DAY <= s <= at for s in stamps))
        last = int(rows["at"].max())
        state.update(([s for s in stamps if s >= last - DAY],))
        state.setTimeoutTimestamp(max((last + DAY) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame({"slot": key[0], "ts": pd.to_datetime(rows["at"], unit="us").to_numpy(), "in_day": out})

    timed = ledger.withWatermark("ts", late).select("slot", "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "ok")
    return timed.groupBy("slot").applyInPandasWithState(step, "slot long, ts timestamp, in_day long", "stamps array<long>", "append", GroupStateTimeout.EventTimeTimeout)
