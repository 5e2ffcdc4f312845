"""Session construction and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine, with a checkpoint folder of its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _folder(spark)
    return spark


def _folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only where all runs on one machine may it be unset; a temporary one is set then."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="loamwork-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the cluster's checkpoint folder and return it without its lineage; partitions and their order stay."""
    _folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same by a Parquet table, which is smaller and read by column, but may be cut into other partitions."""
    path = f"{_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
