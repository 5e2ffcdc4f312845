"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the operators' word patterns have it; the same set that bytes.split() uses.
BLANK = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_hash(name: str = "text") -> Column:
    """Tells texts that share a doc_id apart; null counts as empty."""
    return F.xxhash64(text_or_empty(name))


def unused(df: DataFrame, name: str) -> str:
    """`name`, with a number after it if `df` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    return next(c for c in (name, *(f"{name}{i}" for i in range(len(taken) + 1))) if c.lower() not in taken)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch in UTF-8; null counts as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Split batches so that a slice has about `limit` bytes of text, or one row if that is longer."""
    for batch in batches:
        column = batch.column(name)
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(f, schema)
