"""Readers and writers of JSON lines, splits, manifests and reports. Paths may lie in any store that Spark reads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.operators.pick import last


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a missing path is an empty table. Blank lines are skipped, and lines split at "\\n" only."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("lineSep", "\n").json(path)


def read_raw(spark: SparkSession, root: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Records of raw/<source>/<batch>.jsonl with the source from the folder's name, and the lines that are no JSON."""
    lines = spark.read.text(f"{root}/*/*.jsonl", lineSep="\n").where("trim(value) <> ''")
    parsed = lines.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("_source"), "value", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    good = parsed.where("r._corrupt IS NULL").select("_source", "r.*").drop("_corrupt", "source_id").withColumnRenamed("_source", "source_id")
    return good, parsed.where("r._corrupt IS NOT NULL").select(F.col("_source").alias("source_id"), "value")


def read_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_split(spark: SparkSession, root: str, capability: str, version: str, split: str) -> DataFrame:
    path = f"{root}/{capability}/{version}"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path).where(F.col("split") == split)


def by_id(df: DataFrame, key: str = "record_id", seq: str = "seq") -> DataFrame:
    """One row an id; of repeated ids the last."""
    return last(df, key, seq)


def new_records(found: DataFrame, known: DataFrame) -> DataFrame:
    """Records of this run that are neither known nor repeated in it."""
    return found.dropDuplicates(["record_id"]).join(known.select("record_id"), "record_id", "left_anti")


def append_batch(records: DataFrame, root: str) -> None:
    records.write.mode("append").partitionBy("source_id").json(root)


def digest(df: DataFrame) -> dict:
    """Row count and a hash that does not depend on the order of rows; as it is a sum, rows that repeat one another count."""
    hashes = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    row = df.agg(F.count("*").alias("n"), F.sum(hashes.cast("decimal(38,0)")).alias("x")).first()
    return {"rows": row["n"], "sum64": f"{int(row['x'] or 0) % (1 << 64):016x}"}


def write_frozen(df: DataFrame, path: str, manifest: dict, partition_by: str | None = None, mirror: str | None = None) -> dict:
    """Write a version once: an existing manifest, even of an unfinished writer, refuses the second.

    The manifest is written last, so that a version without one is incomplete. A `mirror` gets the same
    files and then the same manifest, after the version itself is whole.
    """
    spark = df.sparkSession
    if exists(spark, f"{path}.manifest"):
        raise FileExistsError(f"{path} is frozen; use a new version")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    whole = manifest | digest(spark.read.parquet(path))
    line = spark.createDataFrame([(json.dumps(whole, sort_keys=True),)], "value string").coalesce(1)
    line.write.mode("errorifexists").text(f"{path}.manifest")
    if mirror is not None:
        copy = spark.read.parquet(path).write.mode("overwrite")
        (copy.partitionBy(partition_by) if partition_by else copy).parquet(mirror)
        if {k: v for k, v in digest(spark.read.parquet(mirror)).items() if v != whole[k]}:
            raise OSError(f"{mirror} does not hold what {path} holds")
        line.write.mode("overwrite").text(f"{mirror}.manifest")
    return whole


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}.manifest").first()["value"])


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of each file under a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def append_once(df: DataFrame, path: str, batch: str) -> None:
    """Append rows under a batch name; repeating the batch replaces its rows, so that a retry adds nothing."""
    marked = df.withColumn("batch", F.lit(batch))
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def markdown(df: DataFrame, title: str, limit: int = 1000) -> str:
    """A small aggregate as a report; the limit keeps a mistake from filling the driver."""
    head = df.columns
    rows = [f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in df.limit(limit).collect()]
    return "\n".join([f"# {title}", "", f"| {' | '.join(head)} |", f"|{'---|' * len(head)}", *rows]) + "\n"
