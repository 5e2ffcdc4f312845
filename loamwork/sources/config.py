"""Small files that a driver reads: YAML, environment, registries, versions, logs."""

from __future__ import annotations

import json
import os
import platform
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork import schemas
from loamwork.sources.files import exists


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]


def read_yaml(spark: SparkSession, path: str) -> object:
    """A YAML document; without the yaml package only JSON, which is YAML too."""
    document = read_text(spark, path)
    try:
        import yaml
    except ImportError:
        return json.loads("\n".join(x for x in document.split("\n") if not x.startswith("#")))
    return yaml.safe_load(document)


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """A source list with its order in `pos`."""
    rows = read_yaml(spark, path)
    return spark.createDataFrame([(i, r["name"], list(r.get("scope", [])), r["postings_page"].strip(), (r.get("api_endpoint") or "").strip()) for i, r in enumerate(rows)], schemas.SOURCE)


def taxonomy(spark: SparkSession) -> DataFrame:
    """(category, place, aliases): a dozen rows."""
    rows = [(c, i, sorted(a for a, to in C.ALIASES.items() if to == c)) for i, c in enumerate(C.CATEGORIES)]
    return spark.createDataFrame(rows, "category string, place int, aliases array<string>")


def set_environment(document: str, target: dict[str, str] | None = None) -> None:
    """KEY=value lines; what is set already stays."""
    target = os.environ if target is None else target
    for line in document.splitlines():
        key, found, value = line.strip().partition("=")
        if found and key and not key.startswith("#"):
            target.setdefault(key.strip(), value.strip().strip("'\""))


def run_manifest(**facts: object) -> dict:
    """What a run should be able to say of itself later."""
    return {"created_at": datetime.now(UTC).isoformat(), "python": platform.python_version(), "machine": platform.machine(), "cpus": os.cpu_count()} | facts


PACKAGES = ("pyspark", "pyarrow", "pandas", "numpy", "torch", "transformers", "trl", "peft")


def capture_run(capability: str, seed: int = 42, run_id: str | None = None, commit: str | None = None, datasets: dict[str, str] | None = None, **config: object) -> dict:
    """A run's manifest: its id, seed and configuration, the packages and hardware it ran on, and the hashes of what it read.

    Packages that are not installed are left out. A device is named only where one is there.
    """
    from importlib.metadata import PackageNotFoundError, version

    now = datetime.now(UTC)
    found = {}
    for name in PACKAGES:
        try:
            found[name] = version(name)
        except PackageNotFoundError:
            continue
    hardware = {"platform": platform.platform(), "device": "cpu"}
    if "torch" in found:
        import torch

        if torch.cuda.is_available():
            hardware |= {"device": "cuda", "gpu": torch.cuda.get_device_name(0), "cuda": torch.version.cuda}
    return run_manifest(run_id=run_id or f"{capability}_{now:%Y%m%d_%H%M%S}", capability=capability, seed=seed, packages=found, hardware=hardware, git_commit=commit, datasets=datasets or {}, config=config)


def register_model(spark: SparkSession, root: str, capability: str, version: str, run_id: str, dataset_version: str, git_commit: str | None = None, taxonomy: str | None = None, **extra: object) -> dict:
    """Write the metadata of a model's version once, where versions() finds it."""
    entry = {"capability": capability, "version": version, "run_id": run_id, "dataset_version": dataset_version, "git_commit": git_commit, "taxonomy": taxonomy, "registered_at": datetime.now(UTC).isoformat()} | extra
    spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{root}/{capability}/{version}.manifest")
    return entry


def save_usage(ledger: DataFrame, path: str) -> None:
    """Providers' usage: one row a slot with the stamps of its successes and requests, as a legacy state file has them.

    A slot's stamps are those of its last day, which its budget bounds.
    """
    stamp = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    state = ledger.groupBy("slot").agg(
        F.array_sort(F.collect_list(F.when(F.col("ok"), stamp))).alias("request_stamps"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("tokens"))), F.lit(0)).alias("tokens_24h"), F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed"),
    )
    save_snapshot(state, path)


def load_usage(spark: SparkSession, path: str, now: str) -> DataFrame:
    """(slot, ts, ok, tokens) of a saved state; slots that kept only a count get stamps spread over the last twelve hours."""
    from loamwork.operators.quota import migrate_counts

    saved = load_snapshot(spark, path, "slot string, request_stamps array<double>, tokens_24h bigint, requests_today bigint")
    stamped = saved.where("request_stamps IS NOT NULL").select("slot", F.posexplode("request_stamps").alias("i", "at"), "tokens_24h")
    # a day's tokens are known as a sum only: the first stamp carries it
    kept = stamped.select("slot", F.timestamp_micros(F.round(F.col("at") * 1e6).cast("long")).alias("ts"), F.lit(True).alias("ok"), F.when(F.col("i") == 0, F.coalesce("tokens_24h", F.lit(0))).otherwise(0).cast("long").alias("tokens"))
    counted = migrate_counts(saved.where("request_stamps IS NULL").select("slot", F.coalesce("requests_today", F.lit(0)).alias("n")), now)
    return kept.unionByName(counted.withColumn("tokens", F.col("tokens").cast("long")))


def log_run(spark: SparkSession, path: str, entry: dict) -> None:
    spark.createDataFrame([(json.dumps(entry, sort_keys=True),)], "value string").coalesce(1).write.mode("append").text(path)


def write_registry(spark: SparkSession, path: str, sources: list[dict]) -> None:
    """A registry in YAML's JSON form under a comment that says where it comes from."""
    lines = ["# Source registry, written by a program: change the source list and build it again.", *json.dumps(sources, ensure_ascii=False, indent=1).split("\n")]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray("\n".join([*lines, ""]).encode()))
    finally:
        stream.close()


def save_snapshot(df: DataFrame, path: str) -> None:
    """Replace a small table, such as providers' usage or an inventory, with its columns in order of name.

    The new version is whole beside the old one before it takes its place; load_snapshot() finds
    whichever is left by a run that ends in between.
    """
    df.select(sorted(df.columns)).coalesce(1).write.mode("overwrite").json(f"{path}.new")
    system, at = _file_system(df.sparkSession, path)
    if system.exists(at(path)):
        system.delete(at(f"{path}.old"), True)
        system.rename(at(path), at(f"{path}.old"))
    system.rename(at(f"{path}.new"), at(path))
    system.delete(at(f"{path}.old"), True)


def load_snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    system, at = _file_system(spark, path)
    whole = next((p for p in (path, f"{path}.new", f"{path}.old") if system.exists(at(f"{p}/_SUCCESS"))), path)
    return spark.read.schema(schema).json(whole)


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names under `root` whose version has been written to its end."""
    if not exists(spark, root):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(s.getPath().getName().removesuffix(".manifest") for s in found if s.getPath().getName().endswith(".manifest"))


def newest_records(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All batches of a raw folder, with the time of the file that a record came from."""
    return spark.read.schema(schema).json(f"{root}/*").withColumn("batch_time", F.col("_metadata.file_modification_time"))
