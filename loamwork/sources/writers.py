"""A batch of records that appears whole or not at all.

The format record_batch writes one file a task beside the table and returns what the file holds. Only
when all tasks have succeeded are their files moved into the batch's folder, and the manifest is written
last; a batch without one does not exist. Files of attempts that failed, or that ran twice, are deleted.

    writers.write_batch(records, root, "source_a", "20260101T000000Z")
    writers.read_batches(spark, root)
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

_HASH = "_row_hash"


def row_hash(df: DataFrame) -> DataFrame:
    """`df` with a hash of each row over its columns in order of name."""
    return df.withColumn(_HASH, F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]))


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    where = re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(where) if "://" in where else (fs.LocalFileSystem(), where)


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: a staged file, its rows, the sum of their hashes and the file's own hash."""

    name: str
    rows: int
    total: int
    sha256: str


@dataclass
class BatchWriter(DataSourceArrowWriter):
    root: str
    source: str
    batch: str
    facts: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.folder = f"{self.root}/source_id={self.source}/batch={self.batch}"
        self.staged = f"{self.root}/_staged/{self.source}/{self.batch}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, staged = _opened(self.staged)
        system.create_dir(staged, recursive=True)
        name, rows, total, writer = f"part-{uuid.uuid4().hex}.parquet", 0, 0, None
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            hashes = pc.cast(table.column(_HASH), pa.decimal128(38, 0))
            total += int(pc.sum(hashes).as_py() or 0)
            rows += len(table)
            table = table.drop_columns([_HASH])
            writer = writer or pq.ParquetWriter(f"{staged}/{name}", table.schema, filesystem=system)
            writer.write_table(table)
        if writer is None:
            return Written("", 0, 0, "")
        writer.close()
        digest = sha256()
        with system.open_input_stream(f"{staged}/{name}") as f:
            while block := f.read(1 << 20):
                digest.update(block)
        return Written(name, rows, total % (1 << 64), digest.hexdigest())

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _opened(self.folder)
        _, staged = _opened(self.staged)
        files = sorted((m for m in messages if m is not None and m.name), key=lambda m: m.sha256)
        if system.get_file_info(f"{folder}/_manifest.json").type != fs.FileType.NotFound:
            self.abort(messages)
            return  # the batch is there: a repeated commit adds nothing
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)  # left by a commit that did not reach its manifest
        system.create_dir(folder, recursive=True)
        for m in files:
            system.move(f"{staged}/{m.name}", f"{folder}/{m.name}")
        whole = {
            "source_id": self.source, "batch": self.batch, "rows": sum(m.rows for m in files), "sum64": f"{sum(m.total for m in files) % (1 << 64):016x}",
            "batch_sha256": sha256("".join(m.sha256 for m in files).encode()).hexdigest() if files else None, "files": [{"name": m.name, "rows": m.rows, "sha256": m.sha256} for m in files],
        } | self.facts
        with system.open_output_stream(f"{folder}/_manifest.json") as f:
            f.write(json.dumps(whole, sort_keys=True).encode())
        system.delete_dir(staged) if system.get_file_info(staged).type != fs.FileType.NotFound else None

    def abort(self, messages: list[Written | None]) -> None:
        system, staged = _opened(self.staged)
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.delete_dir(staged)


class RecordBatch(DataSource):
    """Options: path, source, batch, and facts (JSON that the manifest shall have as well)."""

    @classmethod
    def name(cls) -> str:
        return "record_batch"

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options["path"], self.options["source"], self.options["batch"], json.loads(self.options.get("facts", "{}")))


def write_batch(records: DataFrame, root: str, source: str, batch: str, **facts: object) -> dict:
    """Write a batch of one source once and return its manifest; a batch that is there already stays as it is."""
    spark = records.sparkSession
    spark.dataSource.register(RecordBatch)
    writer = row_hash(records.drop("source_id")).write.format("record_batch").mode("append")
    writer.option("source", source).option("batch", batch).option("facts", json.dumps(facts)).save(root)
    return read_manifests(spark, root)[source, batch]


def read_manifests(spark: SparkSession, root: str) -> dict[tuple[str, str], dict]:
    """The manifests of all whole batches, by source and batch; there are as many as batches."""
    system, where = _opened(root)
    found = {}
    for info in system.get_file_info(fs.FileSelector(where, recursive=True, allow_not_found=True)):
        if info.base_name == "_manifest.json":
            with system.open_input_stream(info.path) as f:
                one = json.loads(f.read())
            found[one["source_id"], one["batch"]] = one
    return found


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """The records of all whole batches, with source_id and batch. What an unfinished commit has left is not read."""
    whole = [f"{root}/source_id={s}/batch={b}/{f['name']}" for (s, b), m in sorted(read_manifests(spark, root).items()) for f in m["files"]]
    if not whole:
        raise FileNotFoundError(f"no whole batch in {root}")
    return spark.read.option("basePath", root).parquet(*whole)
