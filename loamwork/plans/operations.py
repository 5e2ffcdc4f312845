"""Queries over budgets, payloads and responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.functions import arrow
from loamwork.operators import assignment, payloads
from loamwork.plans import decisions

#: Minutes for which requests are dealt.
HORIZON = 240


def q_slot_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as requests of two roles, dealt to suppliers as slots within their budgets."""
    key = F.col("s_suppkey")
    slots = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        key.alias("slot"), key.alias("place"), F.when(key % 3 == 0, "verifier").otherwise("primary").alias("role"), (20 + key * 37 % 400).cast("double").alias("rpd"), (1 + key % 5).cast("double").alias("rpm"),
        F.lit(0.85).alias("margin"), (key % 7).alias("in_day"), (key % 10 == 9).alias("disabled"),
    )
    requests = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 0, "verifier").otherwise("primary").alias("role"))
    none = F.lit(-1)  # a request that no slot takes
    return assignment.assign(requests, slots, ["o_orderkey"], HORIZON).select("o_orderkey", "role", F.coalesce("slot", none).alias("slot"), F.coalesce("minute", none).cast("long").alias("minute"))


def q_api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a probe would have found: a customer's orders as a list, an object, or no JSON at all."""
    order = F.struct("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("string").alias("price"))
    k = F.col("o_custkey")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").agg(F.to_json(F.collect_list(order)).alias("list"), F.max("o_orderkey").alias("last"))
    body = F.when(k % 5 == 0, F.concat(F.lit("<html>"), "list")).when(k % 5 == 1, F.concat(F.lit('{"posts":'), "list", F.lit("}"))).when(k % 5 == 2, F.lit(" [] ")).otherwise(F.col("list"))
    url = F.when(k % 11 == 0, F.lit(None)).when(k % 2 == 0, "https://a.org/wp-json/wp/v2/posts").otherwise("https://a.org/api")
    status = F.when(k % 13 == 0, F.lit(None)).when(k % 17 == 0, 403).otherwise(200)
    found = rows.select("o_custkey", payloads.api_payload(body, url, status).alias("p"))
    return found.select("o_custkey", "p.kind", F.coalesce(F.col("p.has_posts").cast("string"), F.lit("")).alias("has_posts"), F.coalesce(F.col("p.items").cast("long"), F.lit(-1)).alias("items"), F.coalesce(F.array_join("p.sample_fields", ","), F.lit("-")).alias("sample_fields"))


def q_response_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decisions' answers as they are sent back, and read again."""
    read = payloads.read_response(payloads.with_response(decisions.answers(spark, sf_dir)).select("state_id", "question_id", "response"))
    return read.select("state_id", "question_id", "shape", *[F.round(c, 6).alias(c) for c in ("noul", "chosen", "entropy")], "choice")


def q_summary_varied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries against references that go on after them by a different number of words, and some without a word of them."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role = 'assistant'")
    k = F.length("text") % 7
    reference = F.when(k == 6, "qq qq").otherwise(F.concat("text", F.lit(" "), F.repeat(F.lit("qq "), k)))
    return c.select("conv_id", "turn", F.round(arrow.rouge_l(F.col("text"), reference), 6).alias("rouge_l"))


QUERIES = {f.__name__: f for f in (q_slot_plan, q_api_payloads, q_response_variant, q_summary_varied)}

ORACLES = {
    "q_slot_plan": f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'verifier' ELSE 'primary' END AS role FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY o_orderkey) - 1 AS k FROM r),
s AS (SELECT s_suppkey AS slot, CASE WHEN s_suppkey % 3 = 0 THEN 'verifier' ELSE 'primary' END AS role, CAST(ceil((1 + s_suppkey % 5) * CAST(0.85 AS DOUBLE)) AS BIGINT) AS m, CAST(ceil((20 + s_suppkey * 37 % 400) * CAST(0.85 AS DOUBLE)) AS BIGINT) - s_suppkey % 7 AS d FROM supplier WHERE s_suppkey % 10 <> 9),
e AS (SELECT *, least(m, d - m * minute) AS n FROM s, range({HORIZON}) AS g(minute) WHERE d - m * minute > 0), t AS (SELECT *, sum(n) OVER (PARTITION BY role ORDER BY minute, slot ROWS UNBOUNDED PRECEDING) - 1 AS last FROM e)
SELECT o_orderkey, k.role, coalesce(slot, -1) AS slot, coalesce(minute, -1) AS minute FROM k LEFT JOIN t ON k.role = t.role AND k >= last - n + 1 AND k <= last""",
    "q_api_payloads": """WITH c AS (SELECT o_custkey, count(*) AS n, o_custkey % 11 <> 0 AND o_custkey % 2 = 0 AS wp, CASE o_custkey % 5 WHEN 0 THEN 'html' WHEN 1 THEN 'object' ELSE 'list' END AS shape FROM orders GROUP BY ALL),
k AS (SELECT *, CASE WHEN o_custkey % 11 = 0 THEN 'none' WHEN o_custkey % 13 = 0 THEN 'error' WHEN o_custkey % 17 = 0 THEN 'refused' WHEN shape = 'html' THEN 'html' WHEN wp THEN 'wp_rest' WHEN shape = 'list' THEN 'json_list' ELSE 'json_object' END AS kind FROM c)
SELECT o_custkey, kind, CASE WHEN kind = 'wp_rest' AND shape = 'list' THEN CAST(o_custkey % 5 <> 2 AS VARCHAR) ELSE '' END AS has_posts, CASE WHEN kind = 'json_list' THEN CASE WHEN o_custkey % 5 = 2 THEN 0 ELSE n END ELSE -1 END AS items,
  CASE WHEN kind = 'wp_rest' AND shape = 'list' THEN CASE WHEN o_custkey % 5 = 2 THEN '' ELSE 'o_orderkey,o_orderstatus,price' END ELSE '-' END AS sample_fields FROM k""",
    "q_summary_varied": """WITH w AS (SELECT conv_id, turn, length(text) % 7 AS k, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS n FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, round(CASE WHEN k = 6 OR n = 0 THEN 0.0 ELSE CAST(2 * n AS DOUBLE) / (2 * n + k) END, 6) AS rouge_l FROM w""",
    "q_response_variant": f"""WITH {decisions.ANSWERED} SELECT state_id, question_id, kind AS shape, round(CASE WHEN kind = 'noul' THEN p[1] END, 6) AS noul, round(CASE WHEN kind = 'choice' THEN r[1] END, 6) AS chosen,
  round(-list_sum(list_transform(p, lambda x: x * ln(x))), 6) AS entropy, CASE WHEN kind = 'choice' THEN o[list_position(p, r[1])] END AS choice FROM r""",
}
