"""Usage of providers: rolling daily budgets, calendar minutes and totals over a ledger.

The ledger has slot, ts, ok and tokens. A day's budget counts successes of the last 24 hours, a
minute's counts every reserved request of the calendar minute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_day(ledger: DataFrame) -> DataFrame:
    """`ledger` with in_day: successes of the slot in the 24 hours up to and with the row."""
    day = Window.partitionBy("slot").orderBy(F.unix_micros(F.col("ts").cast("timestamp"))).rangeBetween(-86_400_000_000, 0)
    return ledger.withColumn("in_day", F.sum(F.col("ok").cast("long")).over(day))


def per_minute(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("slot", F.date_trunc("minute", "ts").alias("minute")).agg(F.count("*").alias("requests"))


def totals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("slot").agg(F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed"), F.sum(F.when(F.col("ok"), F.col("tokens")).otherwise(0)).alias("tokens"))


def budget_state(ledger: DataFrame, now: str, rpd: int, rpm: int, margin: float = 1.0) -> DataFrame:
    """(slot, in_day, in_minute, daily_dry, budget_left) at a moment."""
    at = F.to_timestamp(F.lit(now))
    recent = ledger.where((F.col("ts") <= at) & (F.col("ts") >= at - F.expr("INTERVAL 24 HOURS")))
    used = recent.groupBy("slot").agg(F.count_if("ok").alias("in_day"), F.count_if(F.date_trunc("minute", "ts") == F.date_trunc("minute", at)).alias("in_minute"))
    full = ledger.select("slot").distinct().join(used, "slot", "left").fillna(0, ["in_day", "in_minute"])
    dry = F.col("in_day") >= rpd * margin
    return full.withColumn("daily_dry", dry).withColumn("budget_left", ~dry & (F.col("in_minute") < rpm * margin))


def candidates(state: DataFrame, providers: DataFrame, roles: list[str]) -> DataFrame:
    """Enabled providers of these roles with daily budget, in the order of their configuration."""
    return providers.where(F.col("role").isin(roles) & ~F.coalesce("disabled", F.lit(False))).join(state.where("NOT daily_dry"), "slot", "left_semi").orderBy("place")


def migrate_counts(counters: DataFrame, now: str) -> DataFrame:
    """Stamps for ledgers that kept only a count: its requests spread evenly over the last twelve hours."""
    at = F.unix_micros(F.to_timestamp(F.lit(now)))
    step = F.floor(F.lit(12 * 3_600_000_000) / F.col("n")).cast("long")
    each = counters.where("n > 0").select("slot", step.alias("step"), F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("i"))
    return each.select("slot", F.timestamp_micros(at - F.col("i") * F.col("step")).alias("ts"), F.lit(True).alias("ok"), F.lit(0).alias("tokens"))
