import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loamwork.functions import text
from loamwork.operators import quota
from loamwork.sources import config, files, writers


def records(spark, n=50):
    return spark.range(n).selectExpr("concat('r', id % 40) AS record_id", "id % 3 AS k", "array(id) AS a", "'s' AS source_id").repartition(4)


def names(root):
    return sorted(os.path.join(d, f)[len(root) + 1 :] for d, _, found in os.walk(root) for f in found)


def test_a_batch_is_written_once_with_its_digest(spark, tmp_path):
    root, df = str(tmp_path / "raw"), records(spark)
    manifest = writers.write_batch(df, root, "s", "b1", records_seen=60)
    whole = writers.read_batches(spark, root)
    recount = files.digest(whole.drop("source_id", "batch"))
    assert manifest["rows"] == 50 and manifest["records_seen"] == 60 and {k: manifest[k] for k in recount} == recount
    assert len(manifest["batch_sha256"]) == 64 and sum(f["rows"] for f in manifest["files"]) == 50
    assert Counter(map(str, whole.select("record_id", "k", "a").collect())) == Counter(map(str, df.select("record_id", "k", "a").collect()))
    before = names(root)
    assert writers.write_batch(df, root, "s", "b1") == manifest and names(root) == before
    writers.write_batch(df.limit(0), root, "t", "b1")
    writers.write_batch(df.limit(3), root, "s", "b2")
    assert writers.read_batches(spark, root).count() == 53 and writers.read_manifests(spark, root)["t", "b1"]["rows"] == 0


def test_a_failed_batch_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "raw")
    writers.write_batch(records(spark), root, "s", "b1")
    before = names(root)
    broken = records(spark).withColumn("k", F.when(F.col("record_id") == "r7", F.raise_error(F.lit("broken row"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="broken row"):
        writers.write_batch(broken, root, "s", "b2")
    assert names(root) == before and writers.read_batches(spark, root).count() == 50


def test_a_task_that_runs_twice_counts_once(spark, tmp_path):
    import pyarrow as pa

    root = str(tmp_path / "raw")
    batch = pa.RecordBatch.from_pylist([{"record_id": "a", writers._HASH: -5}, {"record_id": "b", writers._HASH: 7}])
    writer = writers.BatchWriter(root, "s", "b")
    first, again = writer.write(iter([batch])), writer.write(iter([batch]))
    assert first.name != again.name and first.sha256 == again.sha256
    writer.commit([again, None])
    manifest = writers.read_manifests(spark, root)["s", "b"]
    assert (manifest["rows"], manifest["sum64"]) == (2, f"{2:016x}") and len(names(root)) == 2
    # a commit that ended before its manifest is done again, one that reached it is not
    os.remove(os.path.join(root, "source_id=s/batch=b/_manifest.json"))
    assert writers.read_manifests(spark, root) == {}
    third = writer.write(iter([batch]))
    writer.commit([third])
    writer.commit([third])
    assert len(names(root)) == 2 and writers.read_batches(spark, root).count() == 2


def test_equal_rows_count_in_a_digest(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "x string") for xs in (["p", "p", "q"], ["r", "r", "q"]))
    assert files.digest(a) != files.digest(b) and files.digest(a) == files.digest(a.orderBy(F.desc("x")))


def test_mirrors_models_runs_and_usage(spark, tmp_path):
    df = spark.range(6).withColumn("split", F.when(F.col("id") < 4, "train").otherwise("test"))
    path, mirror = str(tmp_path / "d" / "v1"), str(tmp_path / "m" / "v1")
    manifest = files.write_frozen(df, path, {"version": "v1"}, "split", mirror)
    assert files.read_manifest(spark, mirror) == manifest and files.digest(spark.read.parquet(mirror)) == {k: manifest[k] for k in ("rows", "sum64")}
    entry = config.register_model(spark, str(tmp_path / "models"), "classify", "v2", "run1", "v1", taxonomy="t", note=1)
    assert config.versions(spark, str(tmp_path / "models" / "classify")) == ["v2"] and files.read_manifest(spark, str(tmp_path / "models" / "classify" / "v2")) == entry
    with pytest.raises(Exception, match="(?i)exist"):
        config.register_model(spark, str(tmp_path / "models"), "classify", "v2", "run2", "v1")
    run = config.capture_run("classify", 7, rate=0.1)
    assert run["run_id"].startswith("classify_") and run["seed"] == 7 and "pyspark" in run["packages"] and run["hardware"]["device"] in ("cpu", "cuda") and run["config"] == {"rate": 0.1} and json.dumps(run)
    ledger = spark.createDataFrame([("a", "2026-01-01 10:00:00.25", True, 5), ("a", "2026-01-01 11:00:00", True, 6), ("a", "2026-01-01 11:30:00", False, 0)], "slot string, ts string, ok boolean, tokens long").withColumn("ts", F.to_timestamp("ts"))
    config.save_usage(ledger, str(tmp_path / "usage"))
    loaded = config.load_usage(spark, str(tmp_path / "usage"), "2026-01-01 12:00:00")
    assert loaded.select("slot", "ts").subtract(ledger.where("ok").select("slot", "ts")).count() == 0 and quota.totals(loaded).first()[1:] == (2, 0, 11)
    spark.createDataFrame([("old", 4)], "slot string, requests_today long").coalesce(1).write.json(str(tmp_path / "legacy"))
    spread = [r["ts"].isoformat() for r in config.load_usage(spark, str(tmp_path / "legacy"), "2026-01-01 12:00:00").orderBy("ts").collect()]
    assert spread == ["2026-01-01T03:00:00", "2026-01-01T06:00:00", "2026-01-01T09:00:00", "2026-01-01T12:00:00"]


def test_prompt_of_the_service(spark):
    shown = spark.range(1).select(text.service_prompt(F.lit("Grant for X")).alias("p")).first()["p"]
    assert shown.startswith("Summarize the following") and "IMPORTANT / PREFERRED / SUMMARY" in shown and shown.endswith("OPPORTUNITY POSTING:\nGrant for X")
