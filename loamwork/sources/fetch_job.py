"""Fetching as a job over a table of requests: hosts are dealt to tasks, answers go into the cache table.

A host's requests meet in one task, which keeps its pauses and refusals (see sources.fetching); a task
goes on with its other hosts while one is waited for. What the cache has is not sent again. How a
request is sent, what time it is and how to wait are given from outside; they are made once a task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork import schemas
from loamwork.sources import connectors, fetching
from loamwork.sources.files import exists

_COLUMNS = [c.split(" ")[0] for c in schemas.RESPONSE.split(", ")]
FETCHED = schemas.RESPONSE + ", outcome string"


@dataclass
class Means:
    """What a task fetches with. `send` gets a URL and gives a fetching.Response."""

    send: Callable[[str], fetching.Response]
    clock: Callable[[], float]
    wait: Callable[[float], None]
    allowed: Callable[[str], bool] = lambda url: True


def host_of(url: str) -> Column:
    return F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def with_keys(requests: DataFrame) -> DataFrame:
    """Requests (source_id, url, page) with the key that their responses are cached under."""
    return requests.withColumn("key", F.sha1(F.concat("url", F.lit(json.dumps({})))))


def fetch(requests: DataFrame, cache: DataFrame, means: Callable[[], Means], hosts_at_once: int = 64) -> DataFrame:
    """The responses of the requests that `cache` lacks, with outcome: done, failed, refused or disallowed.

    Of equal URLs one is sent. Hosts are dealt to `hosts_at_once` tasks at most, each host to one; a
    task's requests stand in the order of their sources and pages. A response without a status was not
    sent, or was lost. Rows without a URL are left out.
    """
    keyed = with_keys(requests.where("url IS NOT NULL").select("source_id", "url", "page"))
    one = keyed.groupBy("key").agg(F.min(F.struct("source_id", "page", "url")).alias("r")).select("key", "r.*")
    missing = one.join(cache.select("key"), "key", "left_anti").withColumn("host", host_of("url"))
    dealt = missing.repartition(hosts_at_once, "host").sortWithinPartitions("source_id", "page", "url")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        if rows.empty:
            return
        own = means()
        by_url = {r["url"]: r for r in rows.to_dict("records")}
        for url, response, outcome in fetching.fetch(list(by_url), own.send, own.allowed, own.clock, own.wait):
            r = by_url[url]
            status, body = (response.status, response.text) if response else (None, None)
            yield pd.DataFrame([(r["key"], r["source_id"], url, r["page"], status, None, None, body, outcome)], columns=[*_COLUMNS, "outcome"]).astype({"status": "Int32", "total_pages": "Int32"})

    return dealt.drop("host").mapInPandas(run, FETCHED)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.RESPONSE)
    return spark.read.schema(f"{schemas.RESPONSE}, run string").parquet(path).drop("run")


def fetch_into(requests: DataFrame, path: str, run: str, means: Callable[[], Means], hosts_at_once: int = 64) -> DataFrame:
    """Send what the cache at `path` lacks, add the answers to it under the name of this run, and return the outcomes' counts.

    Answers with a status below 400, and those that will not change when they are asked for again (404,
    410), are cached; others are asked for in the next run. A run that is repeated replaces its answers.
    """
    spark = requests.sparkSession
    fetched = fetch(requests, read_cache(spark, path), means, hosts_at_once)
    # written before it is looked at: a plan that ran twice would send its requests twice
    fetched.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{path}.outcomes")
    own = spark.read.parquet(f"{path}.outcomes").where(F.col("run") == run)
    lasting = own.where("status < 400 OR status IN (404, 410)").select(*_COLUMNS, F.col("run").cast("string").alias("run"))
    lasting.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return own.groupBy("outcome").agg(F.count("*").alias("n"))


def responses_for(requests: DataFrame, path: str) -> DataFrame:
    """The requests with what the cache has for them, in the form that collectors read."""
    keyed = with_keys(requests)
    return connectors.lookup(keyed, read_cache(requests.sparkSession, path))
