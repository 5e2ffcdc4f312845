"""Queries over labels, events and documents as annotations, verdicts and provider ledgers.

Pseudo-annotations and verdicts are derived from hashes of ids, in the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow
from loamwork.operators import labels, pick, quota
from loamwork.plans.corpus import records

FOUR = ["scholarships", "fellowships", "internships", "workshops"]


def _digit(salt: str, n: int) -> Column:
    return F.conv(F.substring(F.sha1(F.concat(F.lit(f"{salt}:"), F.col("record_id"))), 1, 8), 16, 10).cast("long") % n


def _choice(salt: str, options: list) -> Column:
    return F.get(F.array(*map(F.lit, options)), _digit(salt, len(options)).cast("int"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("record_id"), "quality", "toxic")
    return known.select(
        "seq", "record_id", _choice("label", FOUR).alias("label"), _choice("review", ["", "", "", "approved", "corrected", "reject"]).alias("review_status"),
        F.when(F.col("quality") == 1, "completed").otherwise("needs_review").alias("status"), F.when(_digit("parsed", 20) > 0, F.lit("{}")).alias("parsed_annotation"),
        (F.col("toxic") == 1).alias("needs_human_review"), F.lit("valid").alias("validation_status"), F.lit("").alias("reviewed_at"), F.lit("").alias("verified_at"), F.lit("").alias("teacher_timestamp"),
        F.slice(F.array(*[F.lit(f"flag_{i}") for i in range(4)]), 1, _digit("flags", 5).cast("int")).alias("review_flags"),
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = annotations(spark, sf_dir).select("seq", "record_id", "label")
    out = None
    for k, name in enumerate(["verify_bulk", "verify"]):
        one = base.where(_digit(name, 3) > 0).select(
            "seq", "record_id", F.lit(name).alias("verifier"), F.lit(k).alias("priority"), F.when(_digit(f"{name}:same", 2) == 0, F.col("label")).otherwise(_choice("other", FOUR)).alias("verifier_label"),
            F.when(_digit(f"{name}:ok", 10) > 0, "valid").otherwise("invalid").alias("verifier_validation"), F.lit("").alias("verified_at"), F.col("label"),
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn("agreement", F.when(F.col("verifier_validation") == "valid", F.col("verifier_label") == F.col("label")))


def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.consensus(records(spark, sf_dir), annotations(spark, sf_dir), verdicts(spark, sf_dir).drop("label"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", F.col("user_id").alias("slot"), "ts", (F.col("event_type") != "error").alias("ok"), F.floor("value").cast("long").alias("tokens"))


def q_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay(spark, sf_dir)


def q_consensus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay(spark, sf_dir).groupBy(labels.consensus_outcome(F.col("basis")).alias("outcome")).agg(F.count("*").alias("n"), F.count_if("to_verify").alias("to_verify"))


def q_agreement_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = verdicts(spark, sf_dir).where("agreement = false")
    return v.groupBy("label", "verifier_label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label", "verifier_label").limit(10)


def q_agreement_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark, sf_dir).groupBy("verifier").agg(F.round(F.avg(F.col("agreement").cast("double")), 6).alias("rate"), F.count("agreement").alias("n"))


def q_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = annotations(spark, sf_dir).join(verdicts(spark, sf_dir).where("verifier = 'verify_bulk' AND verifier_validation = 'valid'").select("record_id", "agreement"), "record_id", "left")
    return known.withColumn("tier", labels.quality_tier(F.col("agreement"))).groupBy("tier").agg(F.count("*").alias("n"))


def q_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.review_queue(annotations(spark, sf_dir)).select("record_id", F.col("place").cast("long").alias("place"))


def q_review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.coalesce(F.nullif("review_status", F.lit("")), F.lit("pending"))
    return annotations(spark, sf_dir).groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def q_verify_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.verify_targets(annotations(spark, sf_dir), 5).select("record_id", "label")


def q_bulk_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.bulk_targets(annotations(spark, sf_dir), records(spark, sf_dir), verdicts(spark, sf_dir), overlay(spark, sf_dir))
    return found.select("record_id")


def q_second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.second_pass_targets(annotations(spark, sf_dir)).select("record_id")


def q_noul_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).withColumn("deadline", F.when(F.col("seq") % 3 == 0, F.lit("30 November")))
    return labels.noul_items(r, annotations(spark, sf_dir)).select("item_id", "family", "target", "case")


def q_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).withColumn("group_id", F.col("seq")).drop("seq")
    built = labels.build_dataset(r, annotations(spark, sf_dir), "classify", overlay(spark, sf_dir))
    return built.groupBy("split", "tier", "target").agg(F.count("*").alias("n"))


def q_best_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("record_id"), F.when(F.col("event_type") == "purchase", "approved").alias("review_status"),
        F.when(F.col("event_type") == "signup", "completed").otherwise("needs_review").alias("status"), F.when(F.col("event_type") != "error", F.lit("{}")).alias("parsed_annotation"),
    )
    return pick.best_annotation(log).select("record_id", "seq", pick.entry_rank().alias("rank"))


def q_latest_by_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    log = events(spark, sf_dir).select(F.col("event_id").alias("seq"), "user_id", F.when(F.col("event_type") == "click", day).alias("reviewed_at"), F.when(F.col("event_type") != "view", day).otherwise("").alias("verified_at"))
    return pick.latest(log, "user_id", ["reviewed_at", "verified_at"]).select("user_id", "seq")


def q_first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events(spark, sf_dir).select(F.col("event_id").alias("seq"), "user_id", "event_type")
    ends = pick.first(log.where("event_type = 'signup'"), "user_id").select("user_id", F.col("seq").alias("first_signup"))
    return pick.last_in_first_order(log, "user_id").select("user_id", F.col("seq").alias("last"), "position").join(ends, "user_id", "left")


def q_rolling_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.rolling_day(ledger(spark, sf_dir)).select("event_id", "in_day")


def q_minute_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.per_minute(ledger(spark, sf_dir)).groupBy("requests").agg(F.count("*").alias("n"))


def q_usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.totals(ledger(spark, sf_dir))


def q_budget_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota.budget_state(ledger(spark, sf_dir), "2024-01-03 00:00:00", rpd=6, rpm=1)


def q_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("Answer: "), "props", F.when(F.col("event_id") % 7 == 0, " and {}").otherwise(""))
    k = F.coalesce(F.get_json_object(arrow.strict_json(raw), "$.k").cast("long"), F.lit(-1))
    return events(spark, sf_dir).select("event_id", k.alias("k")).groupBy("k").agg(F.count("*").alias("n"))


def _h(salt: str, n: int) -> str:
    return f"CAST(('0x' || substr(sha1('{salt}:' || record_id), 1, 8)) AS BIGINT) % {n}"


def _pick(salt: str, options: list[str]) -> str:
    return f"[{', '.join(repr(o) for o in options)}][{_h(salt, len(options))} + 1]"


_BASE = f"""ann AS (SELECT seq, record_id, {_pick('label', FOUR)} AS label, {_pick('review', ['', '', '', 'approved', 'corrected', 'reject'])} AS review_status,
  CASE WHEN quality = 1 THEN 'completed' ELSE 'needs_review' END AS status, {_h('parsed', 20)} > 0 AS parsed, toxic = 1 AS needs_human_review, {_h('flags', 5)} AS n_flags
  FROM (SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS record_id, quality, toxic FROM labels)),
ver AS (""" + " UNION ALL ".join(
    f"SELECT record_id, label, '{v}' AS verifier, {k} AS priority, CASE WHEN {_h(v + ':same', 2)} = 0 THEN label ELSE {_pick('other', FOUR)} END AS verifier_label, {_h(v + ':ok', 10)} > 0 AS ok FROM ann WHERE {_h(v, 3)} > 0"
    for k, v in enumerate(["verify_bulk", "verify"])
) + """), votes AS (SELECT record_id, string_agg(verifier, '+' ORDER BY priority) AS names, count(*) AS n, count(*) FILTER (verifier_label <> label) AS n_dis,
  min(verifier_label) FILTER (verifier_label <> label) AS lo, max(verifier_label) FILTER (verifier_label <> label) AS hi FROM ver WHERE ok GROUP BY 1),
con AS (SELECT a.record_id, CASE WHEN review_status = 'reject' THEN NULL WHEN review_status = '' AND n_dis = 2 AND lo = hi THEN lo ELSE label END AS final_label,
  CASE WHEN review_status <> '' THEN 'human_' || review_status WHEN n IS NULL THEN 'teacher_unverified' WHEN n_dis = 0 THEN 'confirmed_' || names
    WHEN n_dis = 2 AND lo = hi THEN 'consensus_2of3_' || lo WHEN n >= 2 THEN 'split_verdicts' ELSE 'single_disagreement_' || names END AS basis,
  review_status = '' AND coalesce(n_dis, 0) > 0 AS needs_human_review, review_status = '' AND (n IS NULL OR (n = 1 AND n_dis = 1)) AS to_verify
  FROM ann a JOIN documents d ON a.seq = d.doc_id LEFT JOIN votes v USING (record_id)) """
_LAB = "WITH " + _BASE
_LED = "WITH led AS (SELECT event_id, user_id AS slot, ts, event_type <> 'error' AS ok, CAST(floor(value) AS BIGINT) AS tokens FROM events) "

QUERIES = {f.__name__: f for f in (
    q_consensus, q_consensus_stats, q_agreement_pairs, q_agreement_rate, q_tier_counts, q_review_queue, q_review_counts, q_verify_targets, q_bulk_targets, q_second_pass, q_noul_items, q_dataset,
    q_best_annotation, q_latest_by_stamp, q_first_and_last, q_rolling_24h, q_minute_window, q_usage_totals, q_budget_state, q_json_props,
)}

_NEIGHBOUR = "CASE label " + " ".join(f"WHEN '{c}' THEN CASE WHEN CAST(('0x' || substr(sha1('noul:' || record_id), 16, 1)) AS BIGINT) % 2 = 1 THEN '{b}' ELSE '{a}' END" for c, (a, b) in C.NOUL_NEIGHBOURS.items()) + " END"
_FAMILIES = ", ".join(f"'{c}'" for c in C.NOUL_NEIGHBOURS)
ORACLES = {
    "q_consensus": _LAB + "SELECT * FROM con",
    "q_consensus_stats": _LAB + "SELECT CASE WHEN basis = 'human_reject' THEN 'gold_rejected' WHEN basis LIKE 'human%' THEN 'gold_human' WHEN basis = 'teacher_unverified' THEN 'unverified_silver' WHEN basis LIKE 'confirmed%' THEN 'confirmed' WHEN basis LIKE 'consensus%' THEN 'overruled_2of3' WHEN basis = 'split_verdicts' THEN 'split_needs_human' ELSE 'single_disagreement' END AS outcome, count(*) AS n, count(*) FILTER (to_verify) AS to_verify FROM con GROUP BY 1",
    "q_agreement_pairs": _LAB + "SELECT label, verifier_label, count(*) AS n FROM ver WHERE ok AND label <> verifier_label GROUP BY 1, 2 ORDER BY n DESC, label, verifier_label LIMIT 10",
    "q_agreement_rate": _LAB + "SELECT verifier, round(avg(CASE WHEN ok THEN CASE WHEN label = verifier_label THEN 1.0 ELSE 0.0 END END), 6) AS rate, count(*) FILTER (ok) AS n FROM ver GROUP BY 1",
    "q_tier_counts": _LAB + "SELECT CASE WHEN NOT parsed THEN 'quarantine' WHEN review_status IN ('approved', 'corrected') THEN 'gold' WHEN v.verifier_label <> a.label THEN 'quarantine' WHEN needs_human_review THEN 'quarantine' ELSE 'silver' END AS tier, count(*) AS n FROM ann a LEFT JOIN (SELECT * FROM ver WHERE verifier = 'verify_bulk' AND ok) v ON a.record_id = v.record_id GROUP BY 1",
    "q_review_queue": _LAB + "SELECT record_id, row_number() OVER (ORDER BY CASE review_status WHEN 'reject' THEN 0 WHEN 'corrected' THEN 3 WHEN 'approved' THEN 4 ELSE 1 END, least(n_flags, 4) DESC, seq) AS place FROM ann",
    "q_review_counts": _LAB + "SELECT CASE WHEN review_status = '' THEN 'pending' ELSE review_status END AS status, count(*) AS n FROM ann GROUP BY 1",
    "q_verify_targets": _LAB + "SELECT record_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY seq) AS k FROM ann WHERE status = 'completed' AND NOT needs_human_review) WHERE k <= 5",
    "q_bulk_targets": _LAB + "SELECT record_id FROM ann WHERE record_id NOT IN (SELECT record_id FROM ver WHERE ok) AND record_id NOT IN (SELECT record_id FROM con WHERE basis LIKE 'confirmed%' OR basis LIKE 'human%') AND seq IN (SELECT doc_id FROM documents)",
    "q_second_pass": _LAB + "SELECT record_id FROM ann WHERE needs_human_review AND review_status = ''",
    "q_noul_items": _LAB + f", el AS (SELECT record_id, seq, label, {_NEIGHBOUR} AS other FROM ann WHERE status = 'completed' AND NOT needs_human_review AND label IN ({_FAMILIES}) AND seq IN (SELECT doc_id FROM documents)), it AS (SELECT record_id, 'category_' || label AS family, true AS target, 'positive' AS \"case\" FROM el UNION ALL SELECT record_id, 'category_' || other, false, 'negative' FROM el WHERE other IN ({_FAMILIES}) UNION ALL SELECT record_id, 'deadline_stated', seq % 3 = 0, CASE WHEN seq % 3 = 0 THEN 'qualified' ELSE 'negative' END FROM el WHERE other IN ({_FAMILIES})) SELECT record_id || ':' || family || ':' || CAST(target AS VARCHAR) AS item_id, family, target, \"case\" FROM it",
    "q_dataset": _LAB + f""", tiered AS (SELECT a.record_id, a.seq AS group_id, d.source AS source_id, coalesce(c.final_label, a.label) AS target,
  CASE WHEN NOT a.parsed THEN 'quarantine' WHEN CASE WHEN c.basis = 'human_corrected' THEN 'corrected' WHEN c.basis = 'human_approved' THEN 'approved' WHEN c.basis = 'human_reject' THEN 'reject' ELSE a.review_status END IN ('approved', 'corrected') THEN 'gold' WHEN a.needs_human_review OR c.needs_human_review THEN 'quarantine' ELSE 'silver' END AS tier
  FROM ann a JOIN documents d ON a.seq = d.doc_id LEFT JOIN con c USING (record_id)),
tr AS (SELECT * FROM tiered WHERE tier <> 'quarantine'), held AS (SELECT DISTINCT source_id FROM tr WHERE CAST(('0x' || substr(sha1('classify:unseen:42:' || source_id), 1, 16)) AS UBIGINT) % 1000 < 150),
pool AS (SELECT *, row_number() OVER (ORDER BY substr(sha1('classify:split:42:' || CAST(group_id AS VARCHAR)), 1, 16)) - 1 AS spot, count(*) OVER () AS total FROM tr WHERE source_id NOT IN (SELECT source_id FROM held)),
placed AS (SELECT tier, target, CASE WHEN spot < floor(total * 0.8) THEN 'train' WHEN spot < floor(total * 0.9) THEN 'validation' ELSE 'test' END AS split FROM pool UNION ALL SELECT tier, target, 'unseen_sources_test' FROM tr WHERE source_id IN (SELECT source_id FROM held))
SELECT split, tier, target, count(*) AS n FROM placed GROUP BY 1, 2, 3""",
    "q_best_annotation": "SELECT record_id, seq, rank FROM (SELECT user_id AS record_id, event_id AS seq, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank DESC, event_id) AS k FROM (SELECT *, CASE event_type WHEN 'purchase' THEN 3 WHEN 'signup' THEN 2 WHEN 'error' THEN 0 ELSE 1 END AS rank FROM events)) WHERE k = 1",
    "q_latest_by_stamp": "SELECT user_id, event_id AS seq FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'view' THEN '' ELSE strftime(ts, '%Y-%m-%d') END DESC, event_id) AS k FROM events) WHERE k = 1",
    "q_first_and_last": "SELECT user_id, max(event_id) AS last, min(event_id) AS position, min(event_id) FILTER (event_type = 'signup') AS first_signup FROM events GROUP BY 1",
    "q_rolling_24h": _LED + "SELECT event_id, CAST(sum(CAST(ok AS BIGINT)) OVER (PARTITION BY slot ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) AS in_day FROM led",
    "q_minute_window": _LED + "SELECT requests, count(*) AS n FROM (SELECT count(*) AS requests FROM led GROUP BY slot, date_trunc('minute', ts)) GROUP BY 1",
    "q_usage_totals": _LED + "SELECT slot, count(*) FILTER (ok) AS successful, count(*) FILTER (NOT ok) AS failed, CAST(sum(CASE WHEN ok THEN tokens ELSE 0 END) AS BIGINT) AS tokens FROM led GROUP BY 1",
    "q_budget_state": _LED + ", u AS (SELECT slot, count(*) FILTER (ok AND ts <= TIMESTAMP '2024-01-03' AND ts >= TIMESTAMP '2024-01-02') AS in_day, count(*) FILTER (date_trunc('minute', ts) = TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-03') AS in_minute FROM led GROUP BY 1) SELECT slot, in_day, in_minute, in_day >= 6 AS daily_dry, in_day < 6 AND in_minute < 1 AS budget_left FROM u",
    "q_json_props": "SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) ELSE -1 END AS k, count(*) AS n FROM events GROUP BY 1",
}
