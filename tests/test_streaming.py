from pyspark.sql import functions as F

from loamwork.operators import quota
from loamwork.streaming import ingest
from loamwork.streaming import quota as streamed


def test_rolling_day_equals_batch(spark, tmp_path):
    rows = [(i % 3, f"2024-01-0{1 + i // 24} {i % 24:02}:15:00", i % 5 > 0, 1) for i in range(72)]
    ledger = spark.createDataFrame(rows, "slot long, ts string, ok boolean, tokens long").withColumn("ts", F.to_timestamp("ts"))
    ledger.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ledger.schema).parquet(str(tmp_path / "in"))
    query = streamed.rolling_day(stream).writeStream.format("memory").queryName("rolling").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    expected = {(r["slot"], r["ts"]): r["in_day"] for r in quota.rolling_day(ledger).collect()}
    assert {(r["slot"], r["ts"]): r["in_day"] for r in spark.table("rolling").collect()} == expected


def test_days_start_anew_and_silent_slots_lose_their_state(spark, tmp_path):
    schema = "slot long, ts timestamp, ok boolean, tokens long"
    for n, day in enumerate((1, 1, 5, 5)):
        rows = [(n % 2, f"2024-01-0{day} {h:02}:00:00", h % 2 == 0, 3) for h in range(n, 24, 3)]
        spark.createDataFrame(rows, "slot long, ts string, ok boolean, tokens long").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    ledger = spark.read.parquet(str(tmp_path / "in"))
    for name, made in (("days", streamed.per_day(stream(), "30 days")), ("silent", streamed.rolling_day(stream(), "30 days"))):
        made.writeStream.format("memory").queryName(name).outputMode("append" if name == "silent" else "update").trigger(availableNow=True).start().awaitTermination(180)
    last = {(r["slot"], str(r["day"])): (r["successful"], r["tokens"]) for r in spark.sql("SELECT slot, day, max(successful) AS successful, max(tokens) AS tokens FROM days GROUP BY ALL").collect()}
    assert last == {(r["slot"], r["day"]): (r["s"], r["t"]) for r in ledger.groupBy("slot", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count_if("ok").alias("s"), F.sum(F.when(F.col("ok"), 3).otherwise(0)).alias("t")).collect()}
    assert {(r["slot"], r["ts"]): r["in_day"] for r in spark.table("silent").collect()} == {(r["slot"], r["ts"]): r["in_day"] for r in quota.rolling_day(ledger).collect()}


def test_ingest_is_repeatable(spark, tmp_path):
    text = "the students of this programme will apply for a deadline " * 6
    rows = [("r1", "s", "t", text), ("r1", "s", "t", text), ("r2", "s", "t", "short")]
    spark.createDataFrame(rows, "record_id string, source_id string, title string, clean_text string").write.json(str(tmp_path / "in"))
    for _ in range(2):
        arriving = ingest.unseen(ingest.arriving(spark, str(tmp_path / "in"), "record_id string, source_id string, title string, clean_text string"))
        ingest.write_normalized(arriving, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert [r["record_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["r1"]
