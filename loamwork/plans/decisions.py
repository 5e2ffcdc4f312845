"""Queries that run decisions end to end, and the bookkeeping of runs, reviews, inventories and providers.

Inputs are derived from ids, in the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.functions import arrow
from loamwork.operators import curation, decision, inventory, labels, metrics, quota
from loamwork.plans import labelling
from loamwork.plans.corpus import records
from loamwork.plans.scores import DIMS, scored


def _of(place: Column, *options: str | None) -> Column:
    return F.get(F.array(*[F.lit(o).cast("string") for o in options]), place.cast("int"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two questions about each part: expanded, scored by a stand-in for a model and answered."""
    states = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("state_id"), F.col("p_name").alias("state"))
    criteria = lambda **c: F.create_map(*[F.lit(x) for kv in c.items() for x in kv])
    one = spark.range(1)
    questions = one.select(F.lit("posting").alias("question_id"), F.lit("noul").alias("kind"), F.lit("Is it a posting?").alias("instructions"), criteria(true="it is one", false="it is none at all").alias("criteria")).unionByName(
        one.select(F.lit("colour").alias("question_id"), F.lit("choice").alias("kind"), F.lit("Which?").alias("instructions"), criteria(red="red", blue="a blue thing", green="greenish").alias("criteria"))
    )
    asked = decision.validate_questions(questions).where("error IS NULL").drop("error")

    def scorer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop(columns="prompt").assign(score=batch["prompt"].str.len() * 7 % 13 / 4.0)

    return decision.answer(decision.score(decision.expand(states.where(decision.state_error(F.col("state")).isNull()), asked), scorer))


def q_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers to two questions about each part, gated."""
    gated = decision.gate(answers(spark, sf_dir), "noul")
    return _rounded(gated.select("state_id", "question_id", "noul", "choice", "top_probability", "margin", "entropy", "confidence", "error"))


def q_state_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.groupBy(decision.state_error(F.col("text")).alias("error")).agg(F.count("*").alias("n"))


def q_question_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    keys = F.when(i % 5 == 1, F.array(F.lit("true"), F.lit("false"))).when(i % 5 == 2, F.array(F.lit("a"))).when(i % 5 == 3, F.array(F.lit("a"), F.lit("b"))).when(i % 5 == 4, F.array(F.lit("true"), F.lit("x")))
    asked = labelling.events(spark, sf_dir).select(_of(i % 4, "noul", "choice", "other", "noul").alias("kind"), F.map_from_arrays(keys, keys).alias("criteria"))
    return decision.validate_questions(asked).groupBy("error").agg(F.count("*").alias("n"))


def q_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = quota.budget_state(labelling.ledger(spark, sf_dir), "2024-01-03 00:00:00", rpd=6, rpm=1)
    slot = F.col("slot")
    providers = labelling.ledger(spark, sf_dir).select("slot").distinct().select("slot", F.when(slot % 3 == 0, "verifier").otherwise("primary").alias("role"), (slot % 7 == 0).alias("disabled"), slot.alias("place"))
    return quota.candidates(state, providers, ["primary"]).select("slot")


def q_registry_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_name")
    right = left.where("s_suppkey % 10 <> 0").withColumn("s_name", F.when(F.col("s_suppkey") % 9 == 0, F.lower("s_name")).otherwise(F.col("s_name")))
    return inventory.drift(left, right)


def q_answer_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    body = F.concat(
        F.lit('{"primary_category": "'), _of(i % 5, "phd", "grants", "nonsense", "", "awards"), F.lit('", "classification_ambiguity": 0.'), (i % 10).cast("string"),
        F.lit(', "secondary_plausible_categories": ['), F.when(i % 3 == 0, '"grants"').otherwise(""), F.lit("]}"),
    )
    raw = F.when(i % 11 == 0, "no answer").when(i % 13 == 0, F.concat(body, F.lit(" {"), body)).otherwise(F.concat(F.lit("Answer: "), body))
    parsed = labelling.events(spark, sf_dir).select(labels.parse_answer(raw).alias("a"))
    return parsed.groupBy(labels.validate("classify", F.col("a")).alias("status")).agg(F.count("*").alias("n"))


def q_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    part = lambda by, n: F.floor(i / by) % n
    asked = labelling.events(spark, sf_dir).select(
        "event_id", _of(i % 3, "valid", "ambiguous", "invalid").alias("v1"), _of(part(3, 4), None, "valid", "ambiguous", "invalid").alias("v2"), _of(part(12, 3), None, "valid", "invalid").alias("v3"),
        _of(part(36, 2), "a", "b").alias("l1"), _of(part(72, 3), "a", "b", "c").alias("l2"), _of(part(216, 3), "a", "b", "c").alias("l3"),
    )
    return labels.route(asked).select("event_id", "label", "validation_status", "needs_human_review")


def q_revalidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    entries = labelling.events(spark, sf_dir).select(
        "event_id", F.when(i % 2 == 0, "needs_review").otherwise("completed").alias("status"), F.when(i % 13 != 0, F.trim(F.repeat(F.lit("word "), (i % 400).cast("int")))).alias("summary"),
        F.lit("ambiguous").alias("validation_status"), (i % 2 == 0).alias("needs_human_review"), F.when(i % 5 != 0, F.array(F.lit("x"))).alias("review_flags"),
    )
    return labels.revalidate(entries).select("event_id", "status", "validation_status", "needs_human_review", F.array_join("review_flags", ",").alias("flags"))


def q_review_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = labelling.annotations(spark, sf_dir)
    seq = F.col("seq")
    edits = entries.where(seq % 3 == 0).select("record_id", _of(seq % 2, "approved", "reject").alias("action"), F.when(seq % 4 == 0, "fellowships").alias("edited_label"))
    return labels.merge_review(entries, edits).select("record_id", "label", "review_status", F.array_join("human_edited_fields", ",").alias("edited"))


def q_dataset_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir).withColumn("group_id", F.col("seq")).drop("seq")
    bulk = labelling.verdicts(spark, sf_dir).where("verifier = 'verify_bulk'")
    return labels.build_dataset(r, labelling.annotations(spark, sf_dir), "classify", verdicts=bulk).groupBy("split", "tier", "target").agg(F.count("*").alias("n"))


def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.provenance(records(spark, sf_dir), "classify", "p1", "s1").select("record_id", "input_hash", "task", "prompt_version", "schema_version", "taxonomy_version")


def q_run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq = F.col("seq")
    flags = F.when(seq % 4 == 0, F.array(F.lit("opinions_disagree"))).when(seq % 5 == 0, F.array(F.lit("recovered_by_second_opinion")))
    entries = labelling.annotations(spark, sf_dir).withColumn("review_flags", flags).withColumn("status", F.when(seq % 7 == 0, "rate_limited").when(seq % 11 == 0, "lost").otherwise(F.col("status")))
    return labels.run_statistics(records(spark, sf_dir), entries.where(seq % 6 != 0), entries.where(seq % 6 == 0))


def q_noul_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.noul_counts(labelling.q_noul_items(spark, sf_dir))


def q_inventory_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    registered = s.select(F.col("s_suppkey").cast("string").alias("source_id"), F.when(F.col("s_suppkey") % 2 == 0, "https://a.org/wp-json/wp/v2").otherwise("").alias("api_endpoint"))
    probes = s.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").cast("string").alias("source_id"), F.lit("rss").alias("recommended_method"))
    known = inventory.known_methods(registered, probes)
    return inventory.targets(known, methods=["rss", "wp_rest"]).unionByName(inventory.targets(known, source="1")).select("source_id", "recommended_method")


def q_terms_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.term_counts_by_source(spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_brand").alias("source_id"), F.explode(F.split("p_name", " ")).alias("term")))


def q_top_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(curation.top_source(records(spark, sf_dir)))


def q_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latency(labelling.events(spark, sf_dir).select(F.col("event_type").alias("model"), F.col("value").alias("latency")))


def q_shootout(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    rows = labelling.events(spark, sf_dir).select(F.col("event_type").alias("model"), F.when(i % 4 == 0, "human").otherwise("silver").alias("subset"), (i % 3 == 0).alias("hit"), (i % 5 > 0).alias("json_valid"), F.col("value").alias("latency"))
    return _rounded(metrics.provider_scores(rows, ("model", "subset")))


def q_rouge_l_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    joined = p
    for k in (1, 2, 5):
        joined = joined.join(p.select((F.col("p_partkey") - k).alias("p_partkey"), F.col("p_name").alias(f"n{k}")), "p_partkey")
    return _rounded(joined.select("p_partkey", arrow.rouge_l(F.concat_ws(" ", "p_name", "n1", "n2"), F.concat_ws(" ", "n2", "n5", "p_name")).alias("rouge_l")))


def q_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of four fifths of the vectors are replaced by the best score's, so that there is a temperature between the bounds."""
    best = (F.array_position("scores", F.array_max("scores")) - 1).cast("long")
    rows = scored(spark, sf_dir).withColumn("y", F.when(F.col("id") % 5 > 0, best).otherwise(F.col("y").cast("long")))
    return spark.createDataFrame([(round(metrics.fit_temperature(rows), 3),)], "temperature double")


QUERIES = {f.__name__: f for f in (
    q_decisions, q_state_errors, q_question_errors, q_candidates, q_registry_drift, q_answer_validation, q_routing, q_revalidated, q_review_merge, q_dataset_verified, q_provenance, q_run_statistics,
    q_noul_counts, q_inventory_methods, q_terms_by_source, q_top_source, q_latency, q_shootout, q_rouge_l_short, q_temperature,
)}


def _list(options: list[str | None], place: str) -> str:
    return f"[{', '.join('NULL' if o is None else repr(o) for o in options)}][{place} + 1]"


def _score(rest: int) -> str:
    """The stand-in's score of a prompt that is `rest` longer than its state."""
    return f"((length(p_name) + {rest}) * 7 % 13) / 4.0"


def _question(name: str, kind: str, instructions: str, options: dict[str, str]) -> str:
    scores = ", ".join(_score(28 + len(instructions) + len(c)) for c in options.values())
    return f"SELECT p_partkey AS state_id, '{name}' AS question_id, '{kind}' AS kind, [{scores}] AS s, {list(options)} AS o FROM part"


_ASKED = _question("posting", "noul", "Is it a posting?", {"true": "it is one", "false": "it is none at all"}) + " UNION ALL " + _question("colour", "choice", "Which?", {"red": "red", "blue": "a blue thing", "green": "greenish"})


def _temperature_sql(low: float = 0.05, high: float = 10.0, rounds: int = 5, points: int = 17) -> str:
    scores = f"SELECT CASE WHEN vec_id % 5 > 0 THEN list_position(s, list_max(s)) - 1 ELSE label END AS y, s FROM (SELECT *, list_transform(embedding[1:{DIMS}], lambda x: round(CAST(x AS DOUBLE) * 10, 4)) AS s FROM embeddings)"
    steps = [f"rows_ AS ({scores})", f"b0 AS (SELECT CAST({low} AS DOUBLE) AS low, CAST({high} AS DOUBLE) AS high, CAST(0 AS DOUBLE) AS best)"]
    for k in range(rounds):
        steps += [
            f"g{k} AS (SELECT low * pow(high / low, CAST(i AS DOUBLE) / {points - 1}) AS t FROM b{k}, (SELECT unnest(range({points})) AS i))",
            f"z{k} AS (SELECT t, y, list_transform(s, lambda x: x / t) AS z FROM rows_, g{k})",
            f"n{k} AS (SELECT t, avg(list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[y + 1]) AS nll FROM z{k} GROUP BY 1)",
            f"w{k} AS (SELECT t FROM n{k} ORDER BY nll, t LIMIT 1)",
            f"b{k + 1} AS (SELECT greatest(low, t / pow(high / low, CAST(1 AS DOUBLE) / {points - 1})) AS low, least(high, t * pow(high / low, CAST(1 AS DOUBLE) / {points - 1})) AS high, t AS best FROM b{k}, w{k})",
        ]
    return "WITH " + ", ".join(steps) + f" SELECT round(best, 3) AS temperature FROM b{rounds}"


_D = "[CAST(floor(n * CAST({} AS DOUBLE)) AS BIGINT) + 1]"
_FLIPS = "(event_id % 2 = 0 AND event_id % 13 <> 0 AND event_id % 400 <= 250)"
#: Answers r with probabilities p, their order r and the options o.
ANSWERED = f"""a AS ({_ASKED}), e AS (SELECT *, list_transform(s, lambda x: exp(x - list_max(s))) AS e FROM a), p AS (SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e), r AS (SELECT *, list_sort(p, 'DESC') AS r FROM p)"""
ORACLES = {
    "q_decisions": f"""WITH a AS ({_ASKED}), e AS (SELECT *, list_transform(s, lambda x: exp(x - list_max(s))) AS e FROM a), p AS (SELECT *, list_transform(e, lambda x: x / list_sum(e)) AS p FROM e), r AS (SELECT *, list_sort(p, 'DESC') AS r FROM p)
SELECT state_id, question_id, round(CASE WHEN kind = 'noul' THEN p[1] END, 6) AS noul, CASE WHEN kind = 'choice' THEN o[list_position(p, r[1])] END AS choice, round(r[1], 6) AS top_probability, round(r[1] - r[2], 6) AS margin,
round(-list_sum(list_transform(p, lambda x: x * ln(x))), 6) AS entropy, round((len(p) * r[1] - 1) / (len(p) - 1), 6) AS confidence, CASE WHEN kind = 'noul' AND p[1] < 0.5 THEN 'not_an_opportunity' END AS error FROM r""",
    "q_state_errors": "SELECT CASE WHEN length(coalesce(text, '')) < 1 THEN 'state is empty' WHEN length(text) > 60000 THEN 'state is too long' END AS error, count(*) AS n FROM documents GROUP BY 1",
    "q_question_errors": "SELECT CASE WHEN event_id % 4 = 2 THEN 'unknown question type' WHEN event_id % 5 = 0 THEN 'criteria are missing' WHEN event_id % 4 <> 1 AND event_id % 5 <> 1 THEN 'noul needs true and false' WHEN event_id % 4 = 1 AND event_id % 5 = 2 THEN 'choice needs two criteria' END AS error, count(*) AS n FROM events GROUP BY 1",
    "q_candidates": "SELECT user_id AS slot FROM events GROUP BY 1 HAVING user_id % 3 <> 0 AND user_id % 7 <> 0 AND count(*) FILTER (event_type <> 'error' AND ts <= TIMESTAMP '2024-01-03' AND ts >= TIMESTAMP '2024-01-02') < 6",
    "q_registry_drift": "WITH l AS (SELECT s_suppkey, s_name FROM supplier), r AS (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN lower(s_name) ELSE s_name END AS s_name FROM supplier WHERE s_suppkey % 10 <> 0) SELECT *, 'left' AS side FROM (FROM l EXCEPT ALL FROM r) UNION ALL SELECT *, 'right' FROM (FROM r EXCEPT ALL FROM l)",
    "q_answer_validation": "SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 5 IN (2, 3) THEN 'invalid' WHEN event_id % 10 >= 6 OR (event_id % 3 = 0 AND event_id % 10 >= 4) THEN 'ambiguous' ELSE 'valid' END AS status, count(*) AS n FROM events GROUP BY 1",
    "q_routing": f"""WITH a AS (SELECT event_id, {_list(['valid', 'ambiguous', 'invalid'], 'event_id % 3')} AS v1, {_list([None, 'valid', 'ambiguous', 'invalid'], 'event_id // 3 % 4')} AS v2, {_list([None, 'valid', 'invalid'], 'event_id // 12 % 3')} AS v3,
{_list(['a', 'b'], 'event_id // 36 % 2')} AS l1, {_list(['a', 'b', 'c'], 'event_id // 72 % 3')} AS l2, {_list(['a', 'b', 'c'], 'event_id // 216 % 3')} AS l3 FROM events),
b AS (SELECT *, v1 = 'invalid' AND coalesce(v2 IN ('valid', 'ambiguous'), false) AS rec, v1 = 'ambiguous' AND coalesce(v2 = 'valid', false) AS cmp FROM a), c AS (SELECT *, cmp AND l1 = l2 AS agr, cmp AND l1 <> l2 AND coalesce(v3 = 'valid', false) AS adj FROM b)
SELECT event_id, CASE WHEN adj THEN l3 WHEN rec THEN l2 ELSE l1 END AS label, CASE WHEN rec THEN v2 ELSE v1 END AS validation_status, (CASE WHEN rec THEN v2 ELSE v1 END <> 'valid' AND NOT agr) OR adj AS needs_human_review FROM c""",
    "q_revalidated": f"SELECT event_id, CASE WHEN {_FLIPS} OR event_id % 2 = 1 THEN 'completed' ELSE 'needs_review' END AS status, CASE WHEN {_FLIPS} THEN 'valid' ELSE 'ambiguous' END AS validation_status, event_id % 2 = 0 AND NOT {_FLIPS} AS needs_human_review, CASE WHEN {_FLIPS} THEN CASE WHEN event_id % 5 <> 0 THEN 'x,' ELSE '' END || 'revalidated_flex_250w' WHEN event_id % 5 <> 0 THEN 'x' END AS flags FROM events",
    "q_review_merge": labelling._LAB + """, m AS (SELECT *, seq % 3 = 0 AS e, seq % 3 = 0 AND seq % 4 = 0 AND label <> 'fellowships' AS ch FROM ann)
SELECT record_id, CASE WHEN e AND seq % 4 = 0 THEN 'fellowships' ELSE label END AS label, CASE WHEN e AND seq % 2 = 0 AND ch THEN 'corrected' WHEN e THEN CASE WHEN seq % 2 = 0 THEN 'approved' ELSE 'reject' END ELSE review_status END AS review_status, CASE WHEN ch THEN 'primary_category' ELSE '' END AS edited FROM m""",
    "q_dataset_verified": labelling._LAB + """, tiered AS (SELECT a.record_id, a.seq AS group_id, d.source AS source_id, a.label AS target, CASE WHEN NOT parsed THEN 'quarantine' WHEN review_status IN ('approved', 'corrected') THEN 'gold' WHEN v.verifier_label <> a.label THEN 'quarantine' WHEN needs_human_review THEN 'quarantine' ELSE 'silver' END AS tier
  FROM ann a JOIN documents d ON a.seq = d.doc_id LEFT JOIN (SELECT record_id, verifier_label FROM ver WHERE verifier = 'verify_bulk' AND ok) v USING (record_id)),
tr AS (SELECT * FROM tiered WHERE tier <> 'quarantine'), held AS (SELECT DISTINCT source_id FROM tr WHERE CAST(('0x' || substr(sha1('classify:unseen:42:' || source_id), 1, 16)) AS UBIGINT) % 1000 < 150),
pool AS (SELECT *, row_number() OVER (ORDER BY substr(sha1('classify:split:42:' || CAST(group_id AS VARCHAR)), 1, 16)) - 1 AS spot, count(*) OVER () AS total FROM tr WHERE source_id NOT IN (SELECT source_id FROM held)),
placed AS (SELECT tier, target, CASE WHEN spot < floor(total * 0.8) THEN 'train' WHEN spot < floor(total * 0.9) THEN 'validation' ELSE 'test' END AS split FROM pool UNION ALL SELECT tier, target, 'unseen_sources_test' FROM tr WHERE source_id IN (SELECT source_id FROM held))
SELECT split, tier, target, count(*) AS n FROM placed GROUP BY 1, 2, 3""",
    "q_provenance": "SELECT CAST(doc_id AS VARCHAR) AS record_id, sha256(split_part(coalesce(text, ''), chr(10), 1) || chr(10) || coalesce(text, '')) AS input_hash, 'classify' AS task, 'p1' AS prompt_version, 's1' AS schema_version, 'taxonomy_v1' AS taxonomy_version FROM documents",
    "q_run_statistics": labelling._LAB + ", e AS (SELECT *, CASE WHEN seq % 7 = 0 THEN 'rate_limited' WHEN seq % 11 = 0 THEN 'lost' ELSE status END AS st FROM ann WHERE seq % 6 <> 0) SELECT count(*) FILTER (st = 'completed') AS completed, count(*) FILTER (st = 'rate_limited') AS rate_limited, count(*) FILTER (st = 'needs_review') AS needs_review, count(*) FILTER (st = 'lost') AS errors, count(*) FILTER (seq % 4 = 0) AS disagreements, count(*) FILTER (seq % 4 <> 0 AND seq % 5 = 0) AS second_opinions, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT seq FROM ann WHERE seq % 6 = 0)) AS skipped FROM e",
    "q_noul_counts": f"SELECT family, target, count(*) AS n FROM ({labelling.ORACLES['q_noul_items']}) GROUP BY 1, 2",
    "q_inventory_methods": "WITH k AS (SELECT CAST(s_suppkey AS VARCHAR) AS source_id, CASE WHEN s_suppkey % 3 = 0 THEN 'rss' WHEN s_suppkey % 2 = 0 THEN 'wp_rest' ELSE 'needs_manual_review' END AS recommended_method FROM supplier) SELECT * FROM k WHERE recommended_method IN ('rss', 'wp_rest') UNION ALL SELECT * FROM k WHERE source_id = '1'",
    "q_terms_by_source": "SELECT p_brand AS source_id, lower(term) AS term, count(*) AS n FROM (SELECT p_brand, unnest(string_split(p_name, ' ')) AS term FROM part) GROUP BY 1, 2",
    "q_top_source": "SELECT source AS source_id, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 1",
    "q_latency": f"SELECT event_type AS model, l{_D.format(0.5)} AS median, l{_D.format(0.95)} AS p95 FROM (SELECT event_type, list_sort(list(value)) AS l, count(*) AS n FROM events GROUP BY 1)",
    "q_shootout": "SELECT event_type AS model, CASE WHEN event_id % 4 = 0 THEN 'human' ELSE 'silver' END AS subset, round(avg(CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(CASE WHEN event_id % 5 > 0 THEN 1.0 ELSE 0.0 END), 6) AS json_valid_rate, round(median(value), 6) AS median_latency, count(*) AS n FROM events GROUP BY 1, 2",
    "q_rouge_l_short": """WITH RECURSIVE p AS (SELECT a.p_partkey AS k, string_split(a.p_name || ' ' || b.p_name || ' ' || c.p_name, ' ') AS x, string_split(c.p_name || ' ' || d.p_name || ' ' || a.p_name, ' ') AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 JOIN part c ON c.p_partkey = a.p_partkey + 2 JOIN part d ON d.p_partkey = a.p_partkey + 5),
t AS (SELECT k, x, y, 0 AS i, list_transform(range(0, len(y) + 1), lambda j: CAST(0 AS BIGINT)) AS r FROM p UNION ALL
SELECT k, x, y, i + 1, list_transform(range(0, len(y) + 1), lambda j: greatest(r[j + 1], coalesce(list_max(list_transform(list_filter(range(1, j + 1), lambda q: y[q] = x[i + 1]), lambda q: r[q] + 1)), 0))) FROM t WHERE i < len(x))
SELECT k AS p_partkey, round(2 * r[len(y) + 1] / (len(x) + len(y)), 6) AS rouge_l FROM t WHERE i = len(x)""",
    "q_temperature": _temperature_sql(),
}
