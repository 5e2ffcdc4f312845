"""Requests dealt to providers' slots, so that no slot exceeds its minute or its day.

A slot's places in a minute are known before any request is sent. In the order of minutes and, within
one, of the configuration, running totals of these places are ranges of request numbers; a request takes
the place whose range its number lies in. This is one plan over all requests, whatever their partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamwork.runtime import cut

MINUTES = 24 * 60
#: Request numbers that meet the ranges they may lie in by one key.
BUCKET = 64


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """`rows` with their place in an order, from 0, without a task that has all of them.

    Partitions are ranges of the order; what comes before one is a sum over at most as many rows as there
    are partitions. `order` must tell all rows apart.
    """
    ranged = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_before", "_place")


def places(slots: DataFrame, minutes: int = MINUTES) -> DataFrame:
    """(role, slot, minute, first, last): the request numbers of a role that a slot takes in a minute.

    `slots` has slot, place, role, rpd, rpm, margin, in_day (successes of the last 24 hours) and disabled.
    Minutes count from now; a day's share is not refilled within them, so that it is kept whatever the
    ages of its successes are.
    """
    minutely = F.greatest(F.ceil(F.col("rpm") * F.col("margin")), F.lit(0)).cast("long")
    daily = F.greatest(F.ceil(F.col("rpd") * F.col("margin")) - F.coalesce("in_day", F.lit(0)), F.lit(0)).cast("long")
    usable = slots.where(~F.coalesce("disabled", F.lit(False))).select("slot", "place", "role", minutely.alias("m"), daily.alias("d")).where("m > 0 AND d > 0")
    busy = F.least(F.ceil(F.col("d") / F.col("m")), F.lit(minutes)).cast("int")
    each = usable.withColumn("minute", F.explode(F.sequence(F.lit(0), busy - 1))).withColumn("n", F.least("m", F.col("d") - F.col("m") * F.col("minute")))
    order = Window.partitionBy("role").orderBy("minute", "place", "slot").rowsBetween(Window.unboundedPreceding, 0)
    total = each.withColumn("last", F.sum("n").over(order) - 1)
    return total.select("role", "slot", "minute", (F.col("last") - F.col("n") + 1).alias("first"), "last")


def assign(requests: DataFrame, slots: DataFrame, order: list[str], minutes: int = MINUTES) -> DataFrame:
    """`requests` (with role) with slot and minute; null where all places of the role are taken.

    Requests take places in the order of `order`, which must tell them apart. The ranges are as many as
    minutes and slots make, and are cut at multiples of BUCKET, so that numbers and ranges meet by an
    equality.
    """
    ranked = numbered(requests, ["role", *order], "_number")
    first = ranked.groupBy("role").agg(F.min("_number").alias("_first"))
    own = ranked.join(first, "role").withColumn("_number", F.col("_number") - F.col("_first")).withColumn("_bucket", F.floor(F.col("_number") / BUCKET)).drop("_first")
    ranges = places(slots, minutes).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("first") / BUCKET), F.floor(F.col("last") / BUCKET))))
    a, b = own.alias("a"), ranges.alias("b")
    within = (F.col("a.role") == F.col("b.role")) & (F.col("a._bucket") == F.col("b._bucket")) & F.col("a._number").between(F.col("b.first"), F.col("b.last"))
    return a.join(b, within, "left").select(*[F.col(f"a.{c}") for c in requests.columns], F.col("b.slot").alias("slot"), F.col("b.minute").alias("minute"))
