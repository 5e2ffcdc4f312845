"""Exact percentiles of many groups at once, without a group's values in one task.

A group's value at a rank is closed in by quantile sketches, which are small and merge before a shuffle:
each round takes a grid of approximate quantiles of the values that are left, keeps the step that the
rank lies in with one more on either side, and counts exactly what lies below and inside. Some hundredth
of the values is left each time. When a bounded number is left, or only equal ones, the rank is read off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.runtime import cut

#: Steps of the grid; the sketch's error must stay well below one of them.
GRID = 512
ACCURACY = 10_000
#: Values of a group that may meet in one task.
SMALL = 4096


def at_ranks(rows: DataFrame, by: Sequence[str], column: str, ranks: dict[str, Column]) -> DataFrame:
    """(by..., names of `ranks`): each group's value at each rank, which is a column over its number of values `n`.

    Ranks count from 0 in ascending order and are held to n - 1. Null values are left out; a group with
    none but nulls has no row. Null keys are a group like any other.
    """
    values = rows.where(F.col(column).isNotNull()).select(F.struct(*[F.col(c) for c in by]).alias("g"), F.col(column).cast("double").alias("v"))
    sizes = values.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.greatest(F.lit(0), F.least(r, F.col("n") - 1)).cast("long").alias("r")) for name, r in ranks.items()])
    state = cut(sizes.select("g", F.inline(asked), "n", "lo", "hi"))
    wide = (F.col("lo") < F.col("hi")) & (F.col("n") > SMALL)
    while not (open_ := state.where(wide)).isEmpty():
        state = cut(state.where(~wide).unionByName(_narrower(values, open_)))
    known = state.where("lo = hi").select("g", "name", F.col("lo").alias("v"))
    read = _left(values, state.where("lo < hi")).groupBy("g", "name", "r").agg(F.sort_array(F.collect_list("v")).alias("sorted"))
    every = known.unionByName(read.select("g", "name", F.get("sorted", F.col("r").cast("int")).alias("v")))
    wanted = [F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in ranks]
    return every.groupBy("g").agg(*wanted).select("g.*", *ranks)


def _left(values: DataFrame, state: DataFrame) -> DataFrame:
    return values.join(state, "g").where(F.col("v").between(F.col("lo"), F.col("hi")))


def _narrower(values: DataFrame, state: DataFrame) -> DataFrame:
    grid = F.percentile_approx("v", [k / GRID for k in range(GRID + 1)], ACCURACY)
    gridded = _left(values, state).groupBy("g", "name", "r", "n", "lo", "hi").agg(grid.alias("grid"))
    step = F.floor(F.col("r") * GRID / F.col("n")).cast("int")
    low = F.when(step < 2, F.col("lo")).otherwise(F.get("grid", step - 1))
    high = F.when(step + 2 >= GRID, F.col("hi")).otherwise(F.get("grid", step + 2))
    closer = gridded.select("g", "name", "r", "lo", "hi", low.alias("low"), high.alias("high"))
    # a grid that closes nothing in is replaced by the middle, or by the least value where nothing lies between
    middle = F.col("lo") / 2 + F.col("hi") / 2
    useless = (F.col("low") <= F.col("lo")) & (F.col("high") >= F.col("hi"))
    closer = closer.withColumn("high", F.when(useless, F.when(middle < F.col("hi"), F.greatest(middle, "lo")).otherwise(F.col("lo"))).otherwise(F.col("high")))
    # whatever the sketch's error was, the counts say in which of the three parts the rank lies
    part = F.when(F.col("v") < F.col("low"), 0).when(F.col("v") <= F.col("high"), 1).otherwise(2)
    counted = _left(values, closer).groupBy("g", "name", "r", part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    parts = counted.groupBy("g", "name", "r").agg(F.array_sort(F.collect_list(F.struct("part", "n", "lo", "hi"))).alias("parts"))
    before = F.aggregate(F.slice("parts", 1, F.col("i")), F.lit(0).cast("long"), lambda n, p: n + p["n"])
    each = parts.select("*", F.posexplode("parts").alias("i", "p")).withColumn("before", before)
    held = each.where((F.col("r") >= F.col("before")) & (F.col("r") < F.col("before") + F.col("p.n")))
    return held.select("g", "name", (F.col("r") - F.col("before")).alias("r"), "p.n", "p.lo", "p.hi")


def medians(rows: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    """(by..., name): the median, which is the mean of the two middle values where their number is even."""
    n = F.col("n")
    both = at_ranks(rows, by, column, {"_low": F.floor((n - 1) / 2), "_high": F.ceil((n - 1) / 2)})
    return both.select(*by, ((F.col("_low") + F.col("_high")) / 2).alias(name))


def nearest_rank(rows: DataFrame, by: Sequence[str], column: str, quantiles: dict[str, float]) -> DataFrame:
    """(by..., names of `quantiles`): the values at floor(n q)."""
    return at_ranks(rows, by, column, {name: F.floor(F.col("n") * F.lit(q)) for name, q in quantiles.items()})
