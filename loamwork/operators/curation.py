"""Normalization, deduplication, freezing and evidence reports over records.

Records have record_id, source_id, title, clean_text, content_hash, canonical_url, published_at and
seq, their place in the input, which decides ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow, hashing, text
from loamwork.operators.components import connected_components
from loamwork.operators.pick import top
from loamwork.runtime import written


#: Titles on one side of a task's share of a block.
DEAL = 512


def classify(records: DataFrame) -> DataFrame:
    """All records with clean_text, word_count, language and outcome: kept, short or other_language.

    One narrow pass; the counts of all outcomes come from one aggregation over it.
    """
    cleaned = records.withColumn("clean_text", text.clean_text(F.col("clean_text")))
    counted = cleaned.withColumn("word_count", text.word_count(F.col("clean_text")))
    english = text.is_english(F.concat_ws(" ", F.coalesce(F.col("title"), F.lit("")), F.col("clean_text")))
    marked = counted.withColumn("language", F.when(english, "en").otherwise("other"))
    return marked.withColumn("outcome", F.when((F.col("clean_text") == "") | (F.col("word_count") < C.MIN_WORDS), "short").when(F.col("language") != "en", "other_language").otherwise("kept"))


def normalize(records: DataFrame, english_only: bool = True) -> DataFrame:
    wanted = ["kept"] if english_only else ["kept", "other_language"]
    return classify(records).where(F.col("outcome").isin(wanted)).drop("outcome")


def title_blocks(records: DataFrame) -> DataFrame:
    """(seq, t, word, bucket): the normalized title and the block it is compared in."""
    return _blocks(_titled(records))


def _titled(records: DataFrame) -> DataFrame:
    return records.select("seq", text.normalize_title(F.col("title")).alias("t"))


def _blocks(titled: DataFrame) -> DataFrame:
    return titled.where("t <> ''").select("seq", "t", text.block_word(F.col("t")).alias("word"), text.block_length(F.col("t")).alias("bucket"))


def title_pairs(records: DataFrame, threshold: float = C.TITLE_THRESHOLD, letters: bool = False) -> DataFrame:
    """(word, bucket, ta, loa, hia, tb, lob, hib): pairs of distinct titles of a block that a bound on lengths lets pass.

    Equal titles are collapsed first, so that their number does not enter the pairs. The similarity of
    two texts is at most twice the shorter one's length over the lengths' sum. Because it depends on
    the order of its arguments and records compare in input order, both orders are kept wherever the
    two titles' records interleave.

    With `letters` a pair must also agree in so many letters and runs of three letters that its similarity can
    reach the threshold. The join compares these as bits, in compiled code, and makes rows of none but the pairs
    that pass: their number follows that of similar titles, not the square of a block.
    """
    distinct = _distinct(title_blocks(records))
    return _marked_pairs(distinct, threshold) if letters else _pairs(distinct, threshold)


def _distinct(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("word", "bucket", "t").agg(F.min("seq").alias("lo"), F.max("seq").alias("hi"))


def _marked_pairs(distinct: DataFrame, threshold: float) -> DataFrame:
    bits, runs = [f"m{i}" for i in range(arrow.LETTER_WORDS)], [f"r{i}" for i in range(arrow.GRAM_WORDS)]
    # bits are made once, not once for each side and chunk
    marked = distinct.withColumn("_marks", arrow.marks("t")).select("*", *[F.get("_marks", F.lit(i)).alias(c) for i, c in enumerate(["anchors", *bits, *runs])]).drop("_marks")
    return _pairs(written(marked), threshold, bits, runs)


def _pairs(distinct: DataFrame, threshold: float, bits: Sequence[str] = (), runs: Sequence[str] = ()) -> DataFrame:
    # a block is dealt in chunks of DEAL titles on one side, so that a frequent word's pairs are split over tasks
    sizes = distinct.groupBy("word", "bucket").agg(F.ceil(F.count("*") / DEAL).cast("int").alias("chunks"))
    dealt = distinct.join(sizes, ["word", "bucket"]).withColumn("n", F.length("t"))
    a, b = (dealt.select("word", "bucket", "chunks", *[F.col(c).alias(f"{c}{k}") for c in ("t", "lo", "hi", "n", *(["anchors"] if runs else []), *bits, *runs)]) for k in ("a", "b"))
    a = a.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    b = b.withColumn("chunk", F.pmod(F.xxhash64("tb"), F.col("chunks")).cast("int")).drop("chunks")
    wanted = (F.col("ta") != F.col("tb")) & (F.col("loa") < F.col("hib")) & (2 * F.least("na", "nb") >= threshold * (F.col("na") + F.col("nb")))
    if runs:
        # the characters that only one of two titles has, with a margin for the rounding of the product
        alone = (1 - threshold) * (F.col("na") + F.col("nb")) + 1e-6
        apart = lambda marks: sum((F.bit_count(F.col(f"{m}a").bitwiseXOR(F.col(f"{m}b"))) for m in marks), F.lit(0))
        # what is alone touches one letter each and one run of three; a gap between two matching blocks touches two runs
        # more of each title. Gaps are at most as many as characters alone, or as what blocks can be found by; what a
        # title has more often shows in as many bits at most
        wanted &= (apart(bits) <= alone) & (apart(runs) <= alone + 4 * F.least(alone, F.col("anchorsb")))
    # what the two sides have of a block is known from its key, so that the join's condition holds all the rest
    joined = a.alias("a").join(b.alias("b"), (F.col("a.word") == F.col("b.word")) & (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.chunk") == F.col("b.chunk")) & wanted)
    return joined.select("a.word", "a.bucket", "ta", "loa", "hia", "tb", "lob", "hib")


def title_edges(records: DataFrame, threshold: float = C.TITLE_THRESHOLD) -> DataFrame:
    """(a, b): the first records of equal titles and of titles that are similar enough."""
    same, pairs = _same_and_pairs(records, threshold)
    return _as_edges(same, pairs.where(arrow.similar_at(threshold)("ta", "tb")))


def title_links(records: DataFrame, threshold: float = C.TITLE_THRESHOLD) -> DataFrame:
    """(a, b): as many of title_edges() as have the same connected components; pairs that others link are not compared."""
    same, pairs = _same_and_pairs(records, threshold)
    return _as_edges(same, pairs.where(arrow.linking_at(threshold)("ta", "tb", "loa", "lob")))


def _same_and_pairs(records: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    # titles are normalized once: a filter on them would be pushed below, and normalize them for itself
    blocks = _blocks(written(_titled(records)))
    # a minimum is combined before the shuffle, and the join may be split at a frequent title
    same = blocks.join(blocks.groupBy("word", "bucket", "t").agg(F.min("seq").alias("a")), ["word", "bucket", "t"]).where("seq <> a").select("a", F.col("seq").alias("b"))
    return same, _marked_pairs(_distinct(blocks), threshold)


def _as_edges(same: DataFrame, near: DataFrame) -> DataFrame:
    return same.unionByName(near.select(F.col("loa").alias("a"), F.col("lob").alias("b")))


def duplicate_groups(records: DataFrame, titles: bool = True, threshold: float = C.TITLE_THRESHOLD, texts: bool = True) -> DataFrame:
    """`records` with group_id (the least seq of the group), group_size and is_canonical.

    What decides about groups is a small row of each record; texts are read for it, and to return the records.
    With `texts` false clean_text is not returned, and with `titles` the texts are then read once.
    """
    # copies are one node, so that only links between different texts are followed
    copy = F.coalesce("content_hash", F.concat(F.lit("none:"), F.col("seq").cast("string")))
    # the longest, then earliest, then first record of a group: a minimum, which is combined before the shuffle
    order = F.struct((-text.word_count(F.col("clean_text"))).alias("words"), F.coalesce(F.nullif(F.col("published_at"), F.lit("")), F.lit("9999-12-31")).alias("date"), "seq")
    returned = records if texts else records.drop("clean_text")
    kept = ["seq", "content_hash", "title"] if texts else returned.columns
    small = records.select(*(kept if titles else ["seq", "content_hash"]), order.alias("_order"))
    small = (written(small) if titles else small).withColumn("_copy", copy)
    keyed = small.drop("_order") if titles and not texts else returned.withColumn("_copy", copy)
    copies = small.groupBy("_copy").agg(F.min("seq").alias("group_id"), F.count("*").alias("group_size"), F.min("_order").alias("_order"))
    if titles:
        own = small.select("seq", "_copy").join(copies.select("_copy", "group_id"), "_copy").drop("_copy")
        linked = title_links(small, threshold).join(own.toDF("a", "ga"), "a").join(own.toDF("b", "gb"), "b").select("ga", "gb")
        parts = connected_components(linked, "ga", "gb").toDF("group_id", "component")
        copies = written(copies.join(parts, "group_id", "left").withColumn("group_id", F.coalesce("component", "group_id")).drop("component"))
        whole = copies.groupBy("group_id").agg(F.sum("group_size").alias("group_size"), F.min("_order").alias("_order"))
        copies = copies.select("_copy", "group_id").join(whole, "group_id")
    best = copies.select("_copy", "group_id", "group_size", F.col("_order.seq").alias("_best"))
    return keyed.join(best, "_copy").withColumn("is_canonical", F.col("seq") == F.col("_best")).drop("_copy", "_best")


def canonical_records(grouped: DataFrame) -> DataFrame:
    return grouped.where("is_canonical").withColumnRenamed("group_size", "duplicate_group_size").drop("is_canonical")


def group_evidence(grouped: DataFrame) -> DataFrame:
    """(canonical_record_id, size, members) of each group, for reports on groups of moderate size; group_members() has rows instead."""
    member = F.struct("seq", "record_id", "source_id", F.substring("title", 1, 120).alias("title"), "canonical_url", "is_canonical")
    return grouped.groupBy("group_id").agg(F.max(F.when(F.col("is_canonical"), F.col("record_id"))).alias("canonical_record_id"), F.count("*").alias("size"), F.array_sort(F.collect_list(member)).alias("members"))


def group_members(grouped: DataFrame) -> DataFrame:
    """(canonical_record_id, size, seq, record_id, source_id, title, canonical_url, is_canonical): a group's evidence in rows, whatever its size."""
    best = grouped.groupBy("group_id").agg(F.max(F.when(F.col("is_canonical"), F.col("record_id"))).alias("canonical_record_id"), F.count("*").alias("size"))
    return grouped.select("group_id", "seq", "record_id", "source_id", F.substring("title", 1, 120).alias("title"), "canonical_url", "is_canonical").join(best, "group_id").select("canonical_record_id", "size", "seq", "record_id", "source_id", "title", "canonical_url", "is_canonical")


def dedupe_summary(grouped: DataFrame) -> DataFrame:
    """One row: records, groups, canonical, removed and groups with several sources."""
    by_group = grouped.groupBy("group_id").agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("sources"))
    return by_group.agg(F.sum("n").alias("records"), F.count("*").alias("groups"), (F.sum("n") - F.count("*")).alias("removed"), F.count_if(F.col("sources") > 1).alias("cross_source"))


def size_histogram(grouped: DataFrame) -> DataFrame:
    return grouped.groupBy("group_id").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n_groups"))


def source_distribution(records: DataFrame) -> DataFrame:
    """(source_id, n, share, place), the most frequent first."""
    counts = records.groupBy("source_id").agg(F.count("*").alias("n"))
    total = records.agg(F.count("*").alias("total"))
    # one row a source from here on
    return counts.crossJoin(F.broadcast(total)).select("source_id", "n", (F.col("n") / F.col("total")).alias("share"), F.row_number().over(Window.orderBy(F.desc("n"), "source_id")).alias("place"))


def freeze_summary(grouped: DataFrame) -> DataFrame:
    """What a corpus manifest counts, with a hash of the records that does not depend on their order."""
    kept = grouped.where("is_canonical")
    return kept.agg(
        F.count("*").alias("records"), F.count_distinct("source_id").alias("sources"), F.count_if(F.col("group_size") > 1).alias("merged_groups"),
        F.sum(F.when(F.col("group_size") > 1, F.col("group_size")).otherwise(0)).alias("records_in_merged_groups"),
        F.sum(F.xxhash64("record_id", "content_hash").cast("decimal(38,0)")).alias("content_sum"),
    )


def term_counts(terms: DataFrame, n: int = 40) -> DataFrame:
    """The `n` most frequent of column `term`, in lower case, stripped."""
    return terms.groupBy(text.strip(F.lower("term")).alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(n)


def term_counts_by_source(terms: DataFrame) -> DataFrame:
    """(source_id, term, n) of column `term`, in lower case, stripped."""
    return terms.groupBy("source_id", text.strip(F.lower("term")).alias("term")).agg(F.count("*").alias("n"))


def top_source(records: DataFrame) -> DataFrame:
    """One row: the source with most records (of equals the first by name) and its share of all."""
    counts = records.groupBy("source_id").agg(F.count("*").alias("n"))
    return counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "source_id"))["source_id"].alias("source_id"), (F.max("n") / F.sum("n")).alias("share"))


def cue_counts(records: DataFrame, cues: Column | None = None, examples: int = 3) -> DataFrame:
    """(cue, n, examples): how often each cue stands in titles and the first titles that have it."""
    cue = text.title_signals(F.col("title")) if cues is None else cues
    each = records.select("seq", "source_id", F.substring("title", 1, 90).alias("title"), F.explode(cue).alias("cue"))
    shown = top(each, "cue", F.col("seq"), F.col("title"), n=examples)
    texts = F.transform(F.array_sort(F.collect_list(F.struct("seq", F.concat("title", F.lit(" ("), "source_id", F.lit(")")).alias("x")))), lambda s: s["x"])
    return each.groupBy("cue").agg(F.count("*").alias("n")).join(shown.groupBy("cue").agg(texts.alias("examples")), "cue")


def signal_coverage(records: DataFrame, signal: Column | None = None, categories: list[str] | None = None) -> DataFrame:
    """(category, n, share, starved) for every category, those without a record included, and for no_signal."""
    spark = records.sparkSession
    found = records.select(F.coalesce(text.first_signal(F.col("title")) if signal is None else signal, F.lit("no_signal")).alias("category"))
    counts = found.groupBy("category").agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(c,) for c in [*(categories or C.CATEGORIES), "no_signal"]], "category string")
    total = records.agg(F.count("*").alias("total"))
    full = every.join(counts, "category", "left").withColumn("n", F.coalesce("n", F.lit(0))).crossJoin(F.broadcast(total))
    return full.select("category", "n", (F.col("n") / F.col("total")).alias("share"), ((F.col("category") != "no_signal") & (F.col("n") < 0.02 * F.col("total"))).alias("starved"))


def audit_sample(records: DataFrame, signal: Column | None = None) -> DataFrame:
    """The first records of each category, more of those that overlap others."""
    marked = records.withColumn("category", text.first_signal(F.col("title")) if signal is None else signal).where("category IS NOT NULL")
    wanted = F.lit(C.AUDIT_SAMPLE)
    for category, n in C.AUDIT_OVERSAMPLE.items():
        wanted = F.when(F.col("category") == category, n).otherwise(wanted)
    ranked = marked.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy("seq")))
    # a constant limit is pushed below the window's shuffle, one that depends on the row is not
    return ranked.where(F.col("place") <= max(C.AUDIT_SAMPLE, *C.AUDIT_OVERSAMPLE.values())).where(F.col("place") <= wanted)


def stratified(records: DataFrame, n: int, signals: Column | None = None, distinct: bool = False) -> DataFrame:
    """Round robin over the signals' buckets and one for records without any, `n` rows in all.

    A record stands in the bucket of each of its signals and can come several times unless `distinct`.
    """
    found = text.all_signals(F.col("title")) if signals is None else signals
    each = records.withColumn("bucket", F.explode(F.when(F.size(found) == 0, F.array(F.lit("no_signal"))).otherwise(found)))
    turns = each.withColumn("turn", F.row_number().over(Window.partitionBy("bucket").orderBy("seq"))).where(F.col("turn") <= n)
    if distinct:
        turns = top(turns, "record_id", F.col("turn"), F.col("bucket"))
    return turns.orderBy("turn", "bucket").limit(n)


def length_summary(values: DataFrame, column: str, limits: list[int], by: Sequence[str] = ()) -> DataFrame:
    """Percentiles by nearest rank (the element at floor(n q)), the maximum and the shares within limits, of all values or of each group.

    Counts of each value are sorted instead of the values: their number is bounded by the longest
    text, not by the corpus.
    """
    counts = values.groupBy(*by, F.col(column).alias("v")).agg(F.count("*").alias("c"))
    group = Window.partitionBy(*by)
    running = counts.withColumns({"upto": F.sum("c").over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)), "n": F.sum("c").over(group)})
    at = [F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * q), F.col("n") - 1), F.col("v"))).alias(name) for name, q in (("p50", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))]
    fits = [(F.sum(F.when(F.col("v") <= x, F.col("c")).otherwise(0)) / F.max("n")).alias(f"fit_{x}") for x in limits]
    return running.groupBy(*by).agg(F.max("n").alias("n"), *at, F.max("v").alias("max"), *fits)
