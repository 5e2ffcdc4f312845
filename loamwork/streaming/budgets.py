"""Providers' budgets kept in state: a slot's last day, and the moment until which it is left alone.

The stamps of a slot's successes are a list in state, a refusal's end is a value. Timers in event time
clear what has lost its meaning: a refusal at its end, and all of a slot a day after its last success.
State needs the RocksDB provider, which `configure` sets for a session.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

DAY = 86_400_000_000
BUDGET = "slot string, ts timestamp, in_day long, in_minute long, blocked boolean, daily_dry boolean, budget_left boolean"


def configure(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Budget(StatefulProcessor):
    """What a slot may still do after each of its requests, by daily and minute limits of `rpd` and `rpm`."""

    def __init__(self, rpd: float, rpm: float):
        self.rpd, self.rpm = rpd, rpm

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stamps = handle.getListState("stamps", "at long")
        self.minute = handle.getListState("minute", "at long")
        self.until = handle.getValueState("available_after", "until long")

    def _wake(self, stamps: list[int], until: int | None) -> None:
        """One timer for the end of a refusal and one for the end of the last success's day."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        for at in {*([until] if until else []), *([max(stamps) + DAY] if stamps else [])}:
            self.handle.registerTimer(at // 1000 + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        stamps = [x[0] for x in self.stamps.get()]
        minute = [x[0] for x in self.minute.get()]
        until = self.until.get()[0] if self.until.exists() else None
        batch = pd.concat(list(rows)).sort_values("at", kind="stable")
        out = []
        for at, ok, after in zip(batch["at"].tolist(), batch["ok"].tolist(), batch["after"].tolist(), strict=True):
            minute.append(at)
            if ok:
                stamps.append(at)
            elif after == after and after is not None:
                until = max(until or 0, int(after))
            in_day, in_minute = sum(at - DAY <= s <= at for s in stamps), sum(s // 60_000_000 == at // 60_000_000 for s in minute)
            blocked, dry = until is not None and at < until, in_day >= self.rpd
            out.append((key[0], pd.Timestamp(at, unit="us"), in_day, in_minute, blocked, dry or blocked, not (dry or blocked) and in_minute < self.rpm))
        # a row can still come that is as old as the watermark
        oldest = min(int(batch["at"].max()), timerValues.getCurrentWatermarkInMs() * 1000 or int(batch["at"].min()))
        stamps, minute = [s for s in stamps if s >= oldest - DAY], [s for s in minute if s // 60_000_000 >= oldest // 60_000_000]
        until = until if until is not None and until > oldest else None
        self._write(stamps, minute, until)
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in BUDGET.split(", ")])

    def _write(self, stamps: list[int], minute: list[int], until: int | None) -> None:
        for state, values in ((self.stamps, stamps), (self.minute, minute)):
            state.put([(v,) for v in values]) if values else state.clear()
        self.until.update((until,)) if until is not None else self.until.clear()
        self._wake(stamps, until)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs() * 1000
        stamps = [x[0] for x in self.stamps.get() if x[0] >= now - DAY]
        until = self.until.get()[0] if self.until.exists() else None
        minute = [x[0] for x in self.minute.get() if x[0] // 60_000_000 >= now // 60_000_000]
        self._write(stamps, minute, until if until is not None and until > now else None)
        return iter(())

    def close(self) -> None:
        pass


def budgets(ledger: DataFrame, rpd: float, rpm: float, late: str = "10 minutes") -> DataFrame:
    """A slot's budget after each request of a stream (slot, ts, ok, available_after).

    Successes of the last 24 hours count for the day, all requests of the calendar minute for the minute.
    A failed request may name the moment up to which its slot is left alone. Requests that come together
    are taken in the order of their times; those later than the watermark are not taken.
    """
    configure(ledger.sparkSession)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    timed = ledger.withWatermark("ts", late).select("slot", "ts", micros("ts").alias("at"), "ok", micros("available_after").alias("after"))
    return timed.groupBy("slot").transformWithStateInPandas(Budget(rpd, rpm), outputStructType=BUDGET, outputMode="append", timeMode="EventTime")
