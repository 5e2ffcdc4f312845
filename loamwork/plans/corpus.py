"""Queries over documents and parts as records: normalization, keys, duplicates, evidence, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow, hashing, text
from loamwork.operators import curation, inventory, labels, pick

#: Keyword lists over the words that part names have.
CUES = {"widget": "devices", "gear": "devices", "bolt": "fasteners", "nut": "fasteners", "large": "bulk", "cold": "cooled"}
FIRST = {"fasteners": ["bolt", "nut"], "devices": ["widget", "gear"], "bulk": ["large", "big"], "cooled": ["cold"]}
CLASSES = ["fasteners", "devices", "bulk", "cooled", "unused"]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    body = F.coalesce("text", F.lit(""))
    title = text.title_of(F.col("text"))
    return docs.select(
        F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("record_id"), F.col("source").alias("source_id"), title.alias("title"), body.alias("clean_text"),
        hashing.content_hash(F.concat(title, F.lit("\n"), body)).alias("content_hash"), F.concat(F.lit("https://example.org/doc/"), F.col("doc_id").cast("string")).alias("canonical_url"),
        F.concat(F.lit("2026-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("published_at"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("seq"), F.col("p_partkey").cast("string").alias("record_id"), F.col("p_brand").alias("source_id"), F.col("p_name").alias("title"))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by content hash alone, which SQL can follow."""
    return curation.duplicate_groups(records(spark, sf_dir), titles=False)


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by content hash and by near titles, without the texts."""
    return curation.duplicate_groups(records(spark, sf_dir), texts=False)


_BLANK = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_ENGLISH = "[" + ", ".join(f"'{w}'" for w in C.ENGLISH) + "]"
_REC = """rec AS (SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS record_id, source AS source_id, split_part(coalesce(text, ''), chr(10), 1) AS title, coalesce(text, '') AS body,
  '2026-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS published_at FROM documents)"""
_HASH = f"sha1(trim(regexp_replace(lower(title || chr(10) || body), '\\s+', ' ', 'g'), {_BLANK}))"


def _words(x: str) -> str:
    return f"len(list_filter(string_split_regex({x}, '\\s+'), lambda w: w <> ''))"


def _clean(x: str) -> str:
    lines = f"list_filter(list_transform(string_split({x}, chr(10)), lambda l: trim(l, {_BLANK})), lambda l: NOT regexp_matches(l, '{C.NOISE_LINE}'))"
    return f"trim(regexp_replace(array_to_string({lines}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), {_BLANK})"


_NORM = f"""WITH {_REC}, cleaned AS (SELECT *, {_clean("body")} AS clean FROM rec),
counted AS (SELECT *, {_words("clean")} AS word_count, regexp_extract_all(lower(title || ' ' || clean), '[a-z'']+') AS found FROM cleaned),
marked AS (SELECT *, CASE WHEN len(found) > 0 AND len(list_filter(found, lambda w: list_contains({_ENGLISH}, w))) / len(found) >= 0.22 THEN 'en' ELSE 'other' END AS language FROM counted),
outcomes AS (SELECT *, CASE WHEN clean = '' OR word_count < 40 THEN 'short' WHEN language <> 'en' THEN 'other_language' ELSE 'kept' END AS outcome FROM marked) """
_GROUPS = f"WITH {_REC}, hashed AS (SELECT *, {_HASH} AS h FROM rec), grp AS (SELECT *, min(seq) OVER (PARTITION BY h) AS group_id, count(*) OVER (PARTITION BY h) AS group_size FROM hashed) "
_CANON = _GROUPS + f", best AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY {_words('body')} DESC, published_at, seq) = 1 AS is_canonical FROM grp) "
_TITLE = "trim(regexp_replace(regexp_replace(regexp_replace(lower(title), '[^a-z0-9 ]+', ' ', 'g'), '" + C.TITLE_NOISE + "', ' ', 'g'), ' +', ' ', 'g'))"
_BLOCKS = f"WITH {_REC}, titled AS (SELECT seq, {_TITLE} AS t FROM rec), blk AS (SELECT seq, t, left(split_part(t, ' ', 1), 12) AS word, CAST(length(t) // 10 AS INTEGER) AS bucket FROM titled WHERE t <> '') "


def _rank(key: str, salt: str) -> str:
    return f"substr(sha1('{salt}:' || {key}), 1, 16)"


_CUE_LIST = "list_filter([" + ", ".join(f"CASE WHEN contains(lower(title), '{k}') THEN '{v}' END" for k, v in CUES.items()) + "], lambda x: x IS NOT NULL)"
_CUE_SQL = f"CASE WHEN len({_CUE_LIST}) = 0 THEN ['no_signal'] ELSE {_CUE_LIST} END"
_FIRST_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(title), '{k}')" for k in ks) + f" THEN '{c}'" for c, ks in FIRST.items()) + " END"
_ALL_LIST = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(title), '{k}')" for k in ks) + f" THEN '{c}' END" for c, ks in FIRST.items()) + "], lambda x: x IS NOT NULL)"
_PART = "prt AS (SELECT p_partkey AS seq, CAST(p_partkey AS VARCHAR) AS record_id, p_brand AS source_id, p_name AS title FROM part)"


def q_normalize_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.normalize(records(spark, sf_dir)).groupBy("source_id").agg(F.count("*").alias("n"))


def q_normalize_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.classify(records(spark, sf_dir)).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"))


def q_normalized_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.normalize(records(spark, sf_dir)).select("record_id", F.col("word_count").cast("long").alias("word_count"), "language", F.sha1("clean_text").alias("clean_sha1"))


def q_record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    return r.select("record_id", "content_hash", hashing.input_hash(F.col("title"), F.col("clean_text")).alias("input_hash"), hashing.stable_rank(F.col("record_id"), "classify:split:42").cast("string").alias("stable_rank"))


def q_record_id_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", hashing.record_id(F.col("url")).alias("record_id"))


def q_exact_dup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).select("record_id", F.col("group_id").cast("long").alias("group_id"), "group_size")


def q_dup_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.size_histogram(grouped(spark, sf_dir))


def q_dedupe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.dedupe_summary(grouped(spark, sf_dir))


def q_canonical_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.canonical_records(grouped(spark, sf_dir)).select("record_id", "duplicate_group_size")


def q_group_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.group_evidence(grouped(spark, sf_dir)).select("canonical_record_id", "size", F.array_join(F.transform("members", lambda m: m["record_id"]), ",").alias("members"))


def q_group_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.group_members(grouped(spark, sf_dir)).select("canonical_record_id", "size", "record_id", "source_id", "is_canonical")


def q_title_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.title_blocks(records(spark, sf_dir))


def q_block_candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.title_pairs(records(spark, sf_dir)).select("word", "bucket", F.col("loa").alias("a"), F.col("lob").alias("b"))


def q_near_title_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.title_edges(records(spark, sf_dir))


def q_dedupe_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark, sf_dir).select("record_id", "group_id", "group_size", "is_canonical")


def q_freeze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.freeze_summary(grouped(spark, sf_dir)).drop("content_sum")


def q_dup_histogram_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.size_histogram(linked(spark, sf_dir))


def q_dedupe_summary_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.dedupe_summary(linked(spark, sf_dir))


def q_canonical_record_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.canonical_records(linked(spark, sf_dir)).select("record_id", "duplicate_group_size")


def q_group_evidence_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.group_evidence(linked(spark, sf_dir)).select("canonical_record_id", "size", F.array_join(F.transform("members", lambda m: m["record_id"]), ",").alias("members"))


def q_freeze_manifest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.freeze_summary(linked(spark, sf_dir)).drop("content_sum")


def q_source_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.source_distribution(records(spark, sf_dir)).select("source_id", "n", F.round("share", 6).alias("share"), F.col("place").cast("long").alias("place"))


def q_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.term_counts(spark.read.parquet(f"{sf_dir}/part.parquet").select(F.explode(F.split("p_name", " ")).alias("term")))


def q_title_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = curation.cue_counts(parts(spark, sf_dir), text.title_signals(F.col("title"), CUES))
    return found.select("cue", "n", F.array_join("examples", "|").alias("examples"))


def q_signal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = curation.signal_coverage(parts(spark, sf_dir), text.first_signal(F.col("title"), FIRST), CLASSES)
    return found.select("category", "n", F.round("share", 6).alias("share"), "starved")


def q_audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.audit_sample(parts(spark, sf_dir), text.first_signal(F.col("title"), FIRST)).select("category", "record_id", F.col("place").cast("long").alias("place"))


def q_stratified_pilot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.stratified(parts(spark, sf_dir), 50, text.all_signals(F.col("title"), FIRST)).select("record_id", "bucket", F.col("turn").cast("long").alias("turn"))


def q_length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = records(spark, sf_dir).select(text.word_count(F.col("clean_text")).cast("long").alias("n_words"))
    found = curation.length_summary(counted, "n_words", [512, 1024])
    return found.select("n", "p50", "p90", "p95", "p99", "max", F.round("fit_512", 6).alias("fit_512"), F.round("fit_1024", 6).alias("fit_1024"))


def q_token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the records' summarizer inputs, of these with a target, and of whole texts: percentiles and the shares that fit common contexts."""
    import public_tokenizers

    count = arrow.token_counter(public_tokenizers.path("byte_bpe_50k.json"))
    shown = text.prompt_user("summarize", F.col("title"), F.col("clean_text"))
    variants = {"input_truncated": shown, "input_plus_target": F.concat(shown, F.lit("\n\n" + C.PROXY_TARGET)), "full_text": F.concat(F.lit("TITLE: "), "title", F.lit("\n\n"), "clean_text")}
    # one pass: a document's variants follow each other, and share their words
    each = records(spark, sf_dir).select(F.inline(F.array(*[F.struct(F.lit(name).alias("variant"), x.alias("x")) for name, x in variants.items()])))
    return curation.length_summary(each.select("variant", count("x").alias("tokens")), "tokens", C.CONTEXTS, ["variant"])


def q_heldout_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.held_out_sources(records(spark, sf_dir), "classify")


def q_group_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.assign_splits(grouped(spark, sf_dir), "classify").select("record_id", "split")


def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_group_split(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def q_group_split_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.assign_splits(linked(spark, sf_dir), "classify").select("record_id", "split")


def q_split_counts_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_group_split_full(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def q_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    return r.select("record_id", *[F.sha1(text.prompt_user(t, F.col("title"), F.col("clean_text"))).alias(t) for t in ("summarize", "classify")])


def q_section_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = records(spark, sf_dir)
    marked = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("Deadline: - "), "clean_text")).otherwise(F.concat(F.lit("FUNDING and summary. "), "clean_text"))
    return r.select("record_id", F.round(text.section_compliance(marked), 6).alias("score"))


def q_resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").cast("string").alias("record_id"), F.when(F.col("quality") == 1, "completed").otherwise("needs_review").alias("status"))
    return labels.pending(records(spark, sf_dir), known).groupBy("source_id").agg(F.count("*").alias("n"))


def q_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("pos"), F.regexp_replace("s_name", "[0-9]$", "").alias("name"))
    return inventory.registry(named).select("pos", "source_id")


def q_last_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return pick.top(c, "c_nationkey", F.desc("c_acctbal"), F.col("c_custkey"), n=3).select("c_nationkey", "c_custkey", "c_acctbal")


_SPLIT = _GROUPS + f""", held AS (SELECT DISTINCT source_id FROM rec WHERE CAST(('0x' || {_rank("source_id", "classify:unseen:42")}) AS UBIGINT) % 1000 < 150),
marks AS (SELECT g.*, bool_or(h.source_id IS NOT NULL) OVER (PARTITION BY group_id) AS unseen FROM grp g LEFT JOIN held h USING (source_id)),
pool AS (SELECT *, row_number() OVER (ORDER BY {_rank("CAST(group_id AS VARCHAR)", "classify:split:42")}, group_id) - 1 AS spot, count(*) OVER () AS total FROM marks WHERE NOT unseen),
placed AS (SELECT record_id, min(spot) OVER (PARTITION BY group_id) AS spot, total FROM pool),
final AS (SELECT record_id, CASE WHEN spot < floor(total * 0.8) THEN 'train' WHEN spot < floor(total * 0.9) THEN 'validation' ELSE 'test' END AS split FROM placed UNION ALL SELECT record_id, 'unseen_sources_test' FROM marks WHERE unseen) """

QUERIES = {f.__name__: f for f in (
    q_normalize_by_source, q_normalize_outcomes, q_normalized_records, q_record_keys, q_record_id_uuid5, q_exact_dup_groups, q_dup_histogram, q_dedupe_summary, q_canonical_record,
    q_group_evidence, q_group_members, q_title_blocks, q_block_candidate_pairs, q_near_title_edges, q_dedupe_full, q_freeze_manifest,
    q_dup_histogram_full, q_dedupe_summary_full, q_canonical_record_full, q_group_evidence_full, q_freeze_manifest_full, q_group_split_full, q_split_counts_full, q_source_distribution, q_term_counts, q_title_signals, q_signal_coverage,
    q_audit_sample, q_stratified_pilot, q_length_percentiles, q_token_stats, q_heldout_sources, q_group_split, q_split_counts, q_prompts, q_section_compliance, q_resume_pending, q_registry, q_last_of_nation,
)}

_UPPER = "upper(CASE WHEN seq % 3 = 0 THEN 'Deadline: - ' || body ELSE 'FUNDING and summary. ' || body END)"
ORACLES = {
    "q_normalize_by_source": _NORM + "SELECT source_id, count(*) AS n FROM outcomes WHERE outcome = 'kept' GROUP BY 1",
    "q_normalize_outcomes": _NORM + "SELECT outcome, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS words FROM outcomes GROUP BY 1",
    "q_normalized_records": _NORM + "SELECT record_id, word_count, language, sha1(clean) AS clean_sha1 FROM outcomes WHERE outcome = 'kept'",
    "q_record_keys": f"WITH {_REC} SELECT record_id, {_HASH} AS content_hash, sha256(title || chr(10) || body) AS input_hash, CAST(CAST(('0x' || {_rank('record_id', 'classify:split:42')}) AS UBIGINT) AS VARCHAR) AS stable_rank FROM rec",
    "q_record_id_uuid5": f"SELECT page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS record_id FROM (SELECT page_id, sha1(unhex('{C.RECORD_NAMESPACE}') || encode(url)) AS h FROM pages)",
    "q_exact_dup_groups": _GROUPS + "SELECT record_id, group_id, group_size FROM grp",
    "q_dup_histogram": _GROUPS + "SELECT size, count(*) AS n_groups FROM (SELECT group_id, count(*) AS size FROM grp GROUP BY 1) GROUP BY 1",
    "q_dedupe_summary": _GROUPS + "SELECT CAST(sum(n) AS BIGINT) AS records, count(*) AS groups, CAST(sum(n) - count(*) AS BIGINT) AS removed, count(*) FILTER (s > 1) AS cross_source FROM (SELECT group_id, count(*) AS n, count(DISTINCT source_id) AS s FROM grp GROUP BY 1)",
    "q_canonical_record": _CANON + "SELECT record_id, group_size AS duplicate_group_size FROM best WHERE is_canonical",
    "q_group_evidence": _CANON + "SELECT max(CASE WHEN is_canonical THEN record_id END) AS canonical_record_id, count(*) AS size, string_agg(record_id, ',' ORDER BY seq) AS members FROM best GROUP BY group_id",
    "q_group_members": _CANON + "SELECT max(CASE WHEN is_canonical THEN record_id END) OVER (PARTITION BY group_id) AS canonical_record_id, group_size AS size, record_id, source_id, is_canonical FROM best",
    "q_title_blocks": _BLOCKS + "SELECT seq, t, word, bucket FROM blk",
    "q_block_candidate_pairs": _BLOCKS + ", d AS (SELECT word, bucket, t, min(seq) AS lo, max(seq) AS hi FROM blk GROUP BY 1, 2, 3) SELECT x.word, x.bucket, x.lo AS a, y.lo AS b FROM d x JOIN d y ON x.word = y.word AND x.bucket = y.bucket AND x.t <> y.t AND x.lo < y.hi AND 2 * least(length(x.t), length(y.t)) >= 0.9 * (length(x.t) + length(y.t))",
    "q_freeze_manifest": _CANON + "SELECT count(*) AS records, count(DISTINCT source_id) AS sources, count(*) FILTER (group_size > 1) AS merged_groups, CAST(sum(CASE WHEN group_size > 1 THEN group_size ELSE 0 END) AS BIGINT) AS records_in_merged_groups FROM best WHERE is_canonical",
    "q_source_distribution": f"WITH {_REC} SELECT source_id, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, row_number() OVER (ORDER BY count(*) DESC, source_id) AS place FROM rec GROUP BY 1",
    "q_term_counts": "SELECT lower(term) AS term, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS term FROM part) GROUP BY 1 ORDER BY n DESC, term LIMIT 40",
    "q_title_signals": f"WITH {_PART}, e AS (SELECT seq, source_id, left(title, 90) AS title, unnest({_CUE_SQL}) AS cue FROM prt), r AS (SELECT *, row_number() OVER (PARTITION BY cue ORDER BY seq, title) AS k FROM e) SELECT cue, count(*) AS n, string_agg(title || ' (' || source_id || ')', '|' ORDER BY seq) FILTER (k <= 3) AS examples FROM r GROUP BY 1",
    "q_signal_coverage": f"WITH {_PART}, f AS (SELECT coalesce({_FIRST_SQL}, 'no_signal') AS category FROM prt), c AS (SELECT unnest([{', '.join(repr(x) for x in [*CLASSES, 'no_signal'])}]) AS category) SELECT c.category, count(f.category) AS n, round(count(f.category) / (SELECT count(*) FROM prt), 6) AS share, c.category <> 'no_signal' AND count(f.category) < 0.02 * (SELECT count(*) FROM prt) AS starved FROM c LEFT JOIN f USING (category) GROUP BY 1",
    "q_audit_sample": f"WITH {_PART}, f AS (SELECT record_id, {_FIRST_SQL} AS category, seq FROM prt), r AS (SELECT category, record_id, row_number() OVER (PARTITION BY category ORDER BY seq) AS place FROM f WHERE category IS NOT NULL) SELECT * FROM r WHERE place <= 12",
    "q_stratified_pilot": f"WITH {_PART}, e AS (SELECT seq, record_id, unnest(CASE WHEN len({_ALL_LIST}) = 0 THEN ['no_signal'] ELSE {_ALL_LIST} END) AS bucket FROM prt), r AS (SELECT record_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY seq) AS turn FROM e) SELECT * FROM r ORDER BY turn, bucket LIMIT 50",
    "q_length_percentiles": f"WITH {_REC}, v AS (SELECT {_words('body')} AS w FROM rec), s AS (SELECT list(w ORDER BY w) AS l, count(*) AS n, round(avg(CASE WHEN w <= 512 THEN 1.0 ELSE 0.0 END), 6) AS fit_512, round(avg(CASE WHEN w <= 1024 THEN 1.0 ELSE 0.0 END), 6) AS fit_1024, max(w) AS max FROM v) SELECT n, " + ", ".join(f"l[CAST(least(floor(n * {q}), n - 1) AS BIGINT) + 1] AS {p}" for p, q in (("p50", "CAST(0.5 AS DOUBLE)"), ("p90", "CAST(0.9 AS DOUBLE)"), ("p95", "CAST(0.95 AS DOUBLE)"), ("p99", "CAST(0.99 AS DOUBLE)"))) + ", max, fit_512, fit_1024 FROM s",
    "q_heldout_sources": f"WITH {_REC} SELECT DISTINCT source_id, CAST(('0x' || {_rank('source_id', 'classify:unseen:42')}) AS UBIGINT) % 1000 < 150 AS held_out FROM rec",
    "q_group_split": _SPLIT + "SELECT record_id, split FROM final",
    "q_split_counts": _SPLIT + "SELECT split, count(*) AS n FROM final GROUP BY 1",
    "q_prompts": f"WITH {_REC} SELECT record_id, sha1('TITLE: ' || title || chr(10) || chr(10) || 'OPPORTUNITY TEXT:' || chr(10) || array_to_string(list_slice(list_filter(string_split_regex(body, '\\s+'), lambda w: w <> ''), 1, 600), ' ')) AS summarize, sha1('CATEGORIES: {', '.join(C.CATEGORIES)}' || chr(10) || chr(10) || 'TITLE: ' || title || chr(10) || chr(10) || 'OPPORTUNITY TEXT:' || chr(10) || substr(body, 1, 6000)) AS classify FROM rec",
    "q_section_compliance": f"WITH {_REC} SELECT record_id, round(least(1.0, ({' + '.join(f'CAST(contains({_UPPER}, {s!r}) AS INTEGER)' for s in C.SUMMARY_SECTIONS)}) / 3) * CASE WHEN contains({_UPPER}, '-') THEN 1.0 ELSE 0.5 END, 6) AS score FROM rec",
    "q_resume_pending": "SELECT source AS source_id, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) GROUP BY 1",
    "q_registry": "WITH n AS (SELECT s_suppkey AS pos, trim(regexp_replace(lower(regexp_replace(s_name, '[0-9]$', '')), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY pos) AS k FROM n) SELECT pos, CASE WHEN k = 1 THEN slug ELSE slug || '_' || k END AS source_id FROM r",
    "q_last_of_nation": "SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer) WHERE k <= 3",
}
