"""Records that arrive as files: new ones only, written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamwork.operators.curation import normalize
from loamwork.sources.files import append_once


def arriving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def unseen(records: DataFrame, event_time: str | None = None, within: str = "30 days") -> DataFrame:
    """The first row of each record id: of all time, or of a bounded time where there is a column for it."""
    if event_time is None:
        return records.dropDuplicates(["record_id"])
    return records.withWatermark(event_time, within).dropDuplicatesWithinWatermark(["record_id"])


def write_normalized(records: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Normalize each micro-batch and append it under its number; a batch that is repeated replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        append_once(normalize(batch.withColumn("seq", F.monotonically_increasing_id())).drop("seq"), path, str(number))

    writer = records.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
