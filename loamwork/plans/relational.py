"""Set operations, joins and top-k over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.operators import pick


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_region_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: _table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    # nation and region are fixed tables of a few dozen rows
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sold = lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return sold.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.count("*").alias("n"))


def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind"))
    b = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"))
    return a.unionByName(b).groupBy("nation", "kind").agg(F.count("*").alias("n"))


def q_common_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    return a.intersect(_table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation")))


def q_unsold_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    big = _table(spark, sf_dir, "lineitem").where("l_quantity >= 49").select("l_partkey")
    return parts.join(big, F.col("p_partkey") == F.col("l_partkey"), "left_anti").groupBy("p_brand").agg(F.count("*").alias("n"))


def q_customers_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").where("o_totalprice > 200000").select("o_custkey")
    return _table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").groupBy("c_mktsegment").agg(F.count("*").alias("n"))


def q_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return a.exceptAll(_table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))).groupBy("nation").agg(F.count("*").alias("n"))


def q_top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick.top(_table(spark, sf_dir, "orders"), "o_orderpriority", F.desc("o_totalprice"), F.col("o_orderkey"), n=5).select("o_orderpriority", "o_orderkey", "o_totalprice")


def q_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reproducible sample: the 25 documents whose ids have the least hashes."""
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha1(F.concat(F.lit("sample:"), F.col("doc_id").cast("string"))).alias("h")).orderBy("h").limit(25).select("doc_id")


QUERIES = {f.__name__: f for f in (q_region_revenue, q_union_sources, q_common_nations, q_unsold_parts, q_customers_with_orders, q_difference, q_top_orders, q_hash_sample)}

ORACLES = {
    "q_region_revenue": "SELECT r_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "q_union_sources": "SELECT nation, kind, count(*) AS n FROM (SELECT c_nationkey AS nation, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier) GROUP BY 1, 2",
    "q_common_nations": "SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier",
    "q_unsold_parts": "SELECT p_brand, count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49) GROUP BY 1",
    "q_customers_with_orders": "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) GROUP BY 1",
    "q_difference": "SELECT nation, count(*) AS n FROM (SELECT c_nationkey AS nation FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier) GROUP BY 1",
    "q_top_orders": "SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 5",
    "q_hash_sample": "SELECT doc_id FROM documents ORDER BY sha1('sample:' || CAST(doc_id AS VARCHAR)) LIMIT 25",
}
