"""One row, or the first few, of each key: the best, the latest, the first, the last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, key: str | list[str], *order: Column, n: int = 1) -> DataFrame:
    """The first `n` rows of each key in this order; the order should have no ties."""
    keys = [key] if isinstance(key, str) else key
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_n") <= n).drop("_n")


def latest(df: DataFrame, key: str, stamps: list[str], seq: str = "seq") -> DataFrame:
    """The row with the greatest stamp, compared as text; the first of equals.

    A row's stamp is its first of `stamps` that is neither null nor empty, else the empty string.
    """
    stamp = F.coalesce(*[F.nullif(F.col(s), F.lit("")) for s in stamps], F.lit(""))
    return top(df, key, stamp.desc(), F.col(seq).asc())


def best_annotation(df: DataFrame, seq: str = "seq") -> DataFrame:
    """The entry of highest rank of each record; the first of equals."""
    return top(df, "record_id", entry_rank().desc(), F.col(seq).asc())


def last(df: DataFrame, key: str = "record_id", seq: str = "seq") -> DataFrame:
    return top(df, key, F.col(seq).desc())


def first(df: DataFrame, key: str = "record_id", seq: str = "seq") -> DataFrame:
    return top(df, key, F.col(seq).asc())


def last_in_first_order(df: DataFrame, key: str = "record_id", seq: str = "seq") -> DataFrame:
    """The last entry of each key, with `position` by the key's first appearance."""
    whole = Window.partitionBy(key)
    kept = top(df.withColumn("_first", F.min(seq).over(whole)), key, F.col(seq).desc())
    return kept.withColumnRenamed("_first", "position")


def entry_rank() -> Column:
    """3 reviewed, 2 completed, 1 with a label, 0 otherwise."""
    reviewed = F.coalesce(F.col("review_status"), F.lit("")) != ""
    return F.when(reviewed, 3).when(F.col("status") == "completed", 2).when(F.col("parsed_annotation").isNotNull(), 1).otherwise(0)
