"""Queries over embeddings, labels, pages and conversations: metrics, decisions, probes, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow, text
from loamwork.operators import decision, inventory, metrics
from loamwork.plans.corpus import records

DIMS = 10


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, scores, p): the first ten dimensions of a vector as scores of the ten labels."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    scores = F.transform(F.slice("embedding", 1, DIMS), lambda x: F.round(x.cast("double") * 10, 4))
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("y"), scores.alias("scores")).withColumn("p", metrics.softmax(F.col("scores")))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    best, top = metrics.top1(F.col("p"))
    return scored(spark, sf_dir).select("id", "y", best.alias("predicted"), top.alias("confidence")).withColumn("hit", F.col("y") == F.col("predicted"))


def binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, y, p): quality against a pseudo-probability of three decimals."""
    h = F.conv(F.substring(F.sha1(F.concat(F.lit("p:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("y"), ((h % 701 + F.col("quality") * 300) / 1000).alias("p"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_softmax_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    best, top = metrics.top1(p)
    return _rounded(scored(spark, sf_dir).select("id", best.alias("choice"), top.alias("top"), metrics.margin(p).alias("margin"), metrics.entropy(p).alias("entropy"), metrics.confidence(p).alias("confidence")))


def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(predicted(spark, sf_dir))


def q_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.class_metrics(predicted(spark, sf_dir), list(range(12))))


def q_macro_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = predicted(spark, sf_dir)
    return _rounded(metrics.class_metrics(pairs, list(range(12))).agg(F.avg("f1").alias("macro_f1")).crossJoin(F.broadcast(metrics.accuracy(pairs))))


def q_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.reliability(predicted(spark, sf_dir)))


def q_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.calibration_error(predicted(spark, sf_dir)))


def q_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.probability_scores(scored(spark, sf_dir)))


def q_temperature_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.negative_log_likelihood(scored(spark, sf_dir), [0.25, 0.5, 1.0, 2.0, 4.0, 8.0]))


def q_binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.binary_scores(binary(spark, sf_dir)))


def q_binary_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binary(spark, sf_dir).withColumnsRenamed({"p": "confidence", "y": "hit"})
    return _rounded(metrics.calibration_error(rows, digits=3))


def q_threshold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.threshold_table(binary(spark, sf_dir)))


def q_roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.roc_auc(binary(spark, sf_dir)))


def q_pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.average_precision(binary(spark, sf_dir)))


def q_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision.gate(binary(spark, sf_dir), "p").groupBy("error").agg(F.count("*").alias("n"))


def q_provider_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = e.select(F.col("event_type").alias("model"), (F.col("event_id") % 3 == 0).alias("hit"), (F.col("event_id") % 5 > 0).alias("json_valid"), F.col("value").alias("latency"))
    return _rounded(metrics.provider_scores(rows))


def q_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("record_id", F.round(arrow.rouge_l(F.col("title"), F.col("clean_text")), 6).alias("rouge_l"))


def q_summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role = 'assistant'")
    # the summary stands whole in a reference of twice its length, so that SQL knows the score; q_rouge_l_short has others
    scores = metrics.summary_scores(c.select(F.col("text").alias("summary"), F.concat_ws("\n", "text", "text").alias("reference")))
    return _rounded(scores).withColumns({c: F.col(c).cast("long") for c in ("word_count_p50", "word_count_max")})


def q_html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", arrow.html_to_text("html").alias("text"))


def q_domain_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", text.domain_of(F.col("url")).alias("domain"))


def q_page_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    probed = inventory.page_probe(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return probed.select("page_id", *[F.col(c).cast("long").alias(c) for c in ("html_bytes", "article_tags", "links")], "looks_like_wordpress", "server_rendered_guess", F.array_join("spa_markers", ",").alias("spa_markers"))


def q_recommended_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    probes = inventory.page_probe(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(
        "html_bytes", F.when(i % 5 == 0, "wp_rest").when(i % 7 == 0, "json_list").otherwise("html").alias("api_kind"), F.when(i % 3 == 0, "x/feed").alias("rss_url"),
        F.when(i % 2 == 0, 200).otherwise(404).alias("page_status"), (i % 11 == 0).alias("page_refused"), F.when(i % 13 == 0, False).alias("robots_allowed"),
    )
    return inventory.method_counts(probes.withColumn("recommended_method", inventory.recommended_method()))


def q_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    line = F.concat(F.upper("role"), F.lit(": "), text.strip(F.col("text")))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("x")))), lambda s: s["x"]), "\n")
    return c.groupBy("conv_id").agg(F.sha1(whole).alias("rendered_sha1"), F.count("*").alias("turns"))


_S = f"""s AS (SELECT vec_id AS id, label AS y, list_transform(embedding[1:{DIMS}], lambda x: round(CAST(x AS DOUBLE) * 10, 4)) AS scores FROM embeddings),
z AS (SELECT *, list_transform(scores, lambda x: exp(x - list_max(scores))) AS e FROM s), pr AS (SELECT id, y, scores, list_transform(e, lambda x: x / list_sum(e)) AS p FROM z),
pd AS (SELECT *, list_position(p, list_max(p)) - 1 AS predicted, list_max(p) AS confidence, list_sort(p, 'DESC') AS r FROM pr) """
_B = "b AS (SELECT doc_id, quality AS y, (CAST(('0x' || substr(sha1('p:' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 701 + quality * 300) / 1000 AS p FROM labels) "


def _bins(p: str) -> str:
    return "CASE " + " ".join(f"WHEN {p} > CAST({metrics.EDGES[k]!r} AS DOUBLE) AND {p} <= CAST({metrics.EDGES[k + 1]!r} AS DOUBLE) THEN {k}" for k in range(10)) + " END"


_REL = f"rel AS (SELECT {_bins('confidence')} AS bin, avg(confidence) AS confidence, avg(CASE WHEN y = predicted THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM pd WHERE confidence > 0 GROUP BY 1) "
_CM = """c AS (SELECT unnest(range(12)) AS label), t AS (SELECT y AS label, count(*) AS support, count(*) FILTER (y = predicted) AS tp FROM pd GROUP BY 1), q AS (SELECT predicted AS label, count(*) AS said FROM pd GROUP BY 1),
m AS (SELECT CAST(c.label AS INTEGER) AS label, coalesce(tp / said, 0.0) AS prec, coalesce(tp / support, 0.0) AS rec, coalesce(support, 0) AS support FROM c LEFT JOIN t USING (label) LEFT JOIN q USING (label)),
cm AS (SELECT label, prec AS precision, rec AS recall, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1, support FROM m) """
_CUM = "d AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM b GROUP BY 1), k AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM d) "
_W = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_TAG = "len(regexp_extract_all(html, '(?i)<{}[\\s>]'))"
_SPA = "list_filter([" + ", ".join(f"CASE WHEN contains(html, '{m}') THEN '{m}' END" for m in C.SPA_MARKERS) + "], lambda x: x IS NOT NULL)"

QUERIES = {f.__name__: f for f in (
    q_softmax_choice, q_confusion, q_class_metrics, q_macro_f1, q_reliability, q_ece, q_brier, q_temperature_grid, q_binary_metrics, q_binary_ece, q_threshold_table, q_roc_auc, q_pr_auc,
    q_gate, q_provider_scores, q_rouge_l, q_summary_stats, q_html_to_text, q_domain_of, q_page_probe, q_recommended_method, q_chat_render,
)}

ORACLES = {
    "q_softmax_choice": f"WITH {_S} SELECT id, predicted AS choice, round(confidence, 6) AS top, round(r[1] - r[2], 6) AS margin, round(-list_sum(list_transform(p, lambda x: x * ln(x))), 6) AS entropy, round((10 * confidence - 1) / 9, 6) AS confidence FROM pd",
    "q_confusion": f"WITH {_S} SELECT y, predicted, count(*) AS n FROM pd GROUP BY 1, 2",
    "q_class_metrics": f"WITH {_S}, {_CM} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cm",
    "q_macro_f1": f"WITH {_S}, {_CM} SELECT round(avg(f1), 6) AS macro_f1, (SELECT round(avg(CASE WHEN y = predicted THEN 1.0 ELSE 0.0 END), 6) FROM pd) AS accuracy, (SELECT count(*) FROM pd) AS n FROM cm",
    "q_reliability": f"WITH {_S}, {_REL} SELECT bin, round(confidence, 6) AS confidence, round(accuracy, 6) AS accuracy, n FROM rel",
    "q_ece": f"WITH {_S}, {_REL} SELECT round(sum(n / (SELECT count(*) FROM pd) * abs(confidence - accuracy)), 6) AS ece FROM rel",
    "q_brier": f"WITH {_S} SELECT round(avg(list_sum(list_transform(p, lambda x, i: (x - CASE WHEN i = y + 1 THEN 1.0 ELSE 0.0 END) ** 2))), 6) AS brier, round(avg(confidence), 6) AS mean_top1, round(avg(r[1] - r[2]), 6) AS mean_margin, count(*) AS n FROM pd",
    "q_temperature_grid": f"WITH {_S}, g AS (SELECT unnest([0.25, 0.5, 1.0, 2.0, 4.0, 8.0]::DOUBLE[]) AS temperature) SELECT temperature, round(avg(list_max(scores) / temperature + ln(list_sum(list_transform(scores, lambda x: exp((x - list_max(scores)) / temperature)))) - scores[y + 1] / temperature), 6) AS nll FROM s, g GROUP BY 1",
    "q_binary_metrics": f"WITH {_B} SELECT round(avg((p - y) ** 2), 6) AS brier, round(avg(abs(p - y)), 6) AS mean_absolute_error, round(avg(CASE WHEN abs(p - 0.5::DOUBLE) < 0.02::DOUBLE THEN 1.0 ELSE 0.0 END), 6) AS no_separation_rate, count(*) AS n FROM b",
    "q_binary_ece": f"WITH {_B}, g AS (SELECT {_bins('p')} AS bin, round(avg(p), 3) AS c, round(avg(y), 3) AS a, count(*) AS n FROM b WHERE p > 0 GROUP BY 1) SELECT round(sum(n / (SELECT count(*) FROM b) * abs(c - a)), 6) AS ece FROM g",
    "q_threshold_table": f"WITH {_B}, g AS (SELECT unnest([0.3, 0.4, 0.5, 0.6, 0.7]::DOUBLE[]) AS threshold), c AS (SELECT threshold, count(*) FILTER (p >= threshold AND y = 1) AS tp, count(*) FILTER (p >= threshold) AS pp, count(*) FILTER (y = 1) AS np FROM b, g GROUP BY 1), m AS (SELECT threshold, coalesce(tp / nullif(pp, 0), 0.0) AS prec, coalesce(tp / nullif(np, 0), 0.0) AS rec FROM c) SELECT threshold, round(prec, 6) AS precision, round(rec, 6) AS recall, round(coalesce(2 * prec * rec / nullif(prec + rec, 0), 0.0), 6) AS f1 FROM m",
    "q_roc_auc": f"WITH {_B}, {_CUM} SELECT round(sum(neg * (tp - pos) + neg * pos * 0.5) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM k",
    "q_pr_auc": f"WITH {_B}, {_CUM} SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS pr_auc FROM k",
    "q_gate": f"WITH {_B} SELECT CASE WHEN p < 0.5 THEN 'not_an_opportunity' END AS error, count(*) AS n FROM b GROUP BY 1",
    "q_provider_scores": "SELECT event_type AS model, round(avg(CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(CASE WHEN event_id % 5 > 0 THEN 1.0 ELSE 0.0 END), 6) AS json_valid_rate, round(median(value), 6) AS median_latency, count(*) AS n FROM events GROUP BY 1",
    "q_summary_stats": f"WITH a AS (SELECT text, len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS w, ({' + '.join(f'CAST(contains(upper(text), {x!r}) AS INTEGER)' for x in C.SUMMARY_SECTIONS)}) AS k FROM conversations WHERE role = 'assistant') SELECT count(*) AS n, round(avg(CASE WHEN w BETWEEN 1 AND 150 THEN 1.0 ELSE 0.0 END), 6) AS word_limit_compliance, round(avg(CASE WHEN {_W} = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_rate, round(avg(CASE WHEN {_W} = '' THEN 0.0 ELSE least(1.0, k / 3) * CASE WHEN contains(text, '-') THEN 1.0 ELSE 0.5 END END), 6) AS section_format_mean, round(avg(CASE WHEN w > 0 THEN 2.0 / 3 ELSE 0.0 END), 6) AS rouge_l_mean, list(w ORDER BY w)[count(*) // 2 + 1] AS word_count_p50, max(w) AS word_count_max FROM a",
    "q_domain_of": "SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS domain FROM pages",
    "q_page_probe": f"SELECT page_id, strlen(html) AS html_bytes, {_TAG.format('article')} AS article_tags, {_TAG.format('a')} AS links, regexp_matches(html, '{C.WORDPRESS}') AS looks_like_wordpress, length(html) > 15000 AND {_TAG.format('a')} > 20 AND len({_SPA}) = 0 AS server_rendered_guess, array_to_string({_SPA}, ',') AS spa_markers FROM pages",
    "q_recommended_method": "SELECT CASE WHEN page_id % 11 = 0 OR page_id % 13 = 0 THEN 'blocked_document' WHEN page_id % 5 = 0 THEN 'wp_rest' WHEN page_id % 7 = 0 THEN 'api_json' WHEN page_id % 3 = 0 THEN 'rss' WHEN page_id % 2 = 0 AND strlen(html) > 10000 THEN 'html' ELSE 'needs_manual_review' END AS recommended_method, count(*) AS n FROM pages GROUP BY 1",
    "q_chat_render": f"SELECT conv_id, sha1(string_agg(upper(role) || ': ' || {_W}, chr(10) ORDER BY turn)) AS rendered_sha1, count(*) AS turns FROM conversations GROUP BY 1",
}
