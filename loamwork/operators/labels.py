"""Annotation, verification, consensus, quality tiers and datasets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamwork import constants as C
from loamwork.functions import arrow, hashing, text
from loamwork.operators.pick import best_annotation, last, latest

ANSWER = "primary_category string, secondary_plausible_categories array<string>, classification_ambiguity double, summary string, ambiguity_score double"
#: Places in the input order that a task of the review queue sorts together.
STRETCH = 1 << 16
HUMAN = ["approved", "approve", "corrected"]


def pending(records: DataFrame, done: DataFrame, status: str = "completed") -> DataFrame:
    """Records without an entry of this status."""
    return records.join(done.where(F.col("status") == status).select("record_id"), "record_id", "left_anti")


def parse_answer(raw: Column) -> Column:
    """The answer's fields, or null where its braces hold no single JSON object."""
    return F.from_json(arrow.strict_json(raw), ANSWER)


def validate(task: str, parsed: Column) -> Column:
    """valid, ambiguous or invalid."""
    if task == "classify":
        amb = F.coalesce(parsed["classification_ambiguity"], F.lit(0.0))
        second = F.coalesce(F.size(parsed["secondary_plausible_categories"]), F.lit(0)) > 0
        known = F.coalesce(parsed["primary_category"].isin(C.CATEGORIES), F.lit(False))
        return F.when(~known, "invalid").when((amb >= 0.6) | (second & (amb >= 0.4)), "ambiguous").otherwise("valid")
    summary = parsed["summary"]
    return F.when(summary.isNull() | (text.word_count(summary) > 250), "invalid").when(F.coalesce(parsed["ambiguity_score"], F.lit(0.0)) >= 0.6, "ambiguous").otherwise("valid")


def agreement(first: Column, second: Column) -> Column:
    return F.when(first.eqNullSafe(second), "agree").otherwise("disagree")


def route(answers: DataFrame) -> DataFrame:
    """Which answer counts and whether a person must look, from columns v1, l1, v2, l2, v3, l3.

    v is the validation of the first, second and third opinion (null: not asked), l its label. An
    invalid first answer is replaced by a second that is not; an ambiguous one is compared with a
    valid second, and if they differ a valid third decides.
    """
    recovered = (F.col("v1") == "invalid") & F.col("v2").isin("valid", "ambiguous")
    compared = (F.col("v1") == "ambiguous") & (F.col("v2") == "valid")
    agrees = compared & F.col("l1").eqNullSafe(F.col("l2"))
    adjudicated = compared & ~F.coalesce(agrees, F.lit(False)) & (F.col("v3") == "valid")
    flag = lambda c: F.coalesce(c, F.lit(False))
    label = F.when(flag(adjudicated), F.col("l3")).when(flag(recovered), F.col("l2")).otherwise(F.col("l1"))
    validation = F.when(flag(recovered), F.col("v2")).otherwise(F.col("v1"))
    review = ((validation != "valid") & ~flag(agrees)) | flag(adjudicated)
    return answers.withColumn("label", label).withColumn("validation_status", validation).withColumn("needs_human_review", review)


def annotate(records: DataFrame, task: str, provider: Callable, schema: str = "record_id string, response string") -> DataFrame:
    """Ask `provider`, a mapInPandas function over (record_id, prompt), and validate what it answers."""
    asked = records.select("record_id", text.prompt_user(task, F.col("title"), F.col("clean_text")).alias("prompt"))
    answered = asked.mapInPandas(provider, schema).withColumn("parsed_annotation", parse_answer(F.col("response")))
    checked = answered.withColumn("validation_status", validate(task, F.col("parsed_annotation")))
    return checked.withColumn("status", F.when(F.col("validation_status") == "valid", "completed").otherwise("needs_review")).withColumn("needs_human_review", F.col("validation_status") != "valid")


def verify_targets(entries: DataFrame, per_category: int) -> DataFrame:
    """The first entries of each category that are completed, valid and need no review."""
    good = entries.where((F.col("status") == "completed") & (F.col("validation_status") == "valid") & ~F.coalesce("needs_human_review", F.lit(False)))
    return good.withColumn("_n", F.row_number().over(Window.partitionBy("label").orderBy("seq"))).where(F.col("_n") <= per_category).drop("_n")


def bulk_targets(entries: DataFrame, records: DataFrame, verdicts: DataFrame, overlay: DataFrame) -> DataFrame:
    """Entries of known records without a valid verdict that no person or verifier has confirmed."""
    settled = overlay.where(F.startswith(F.col("basis"), F.lit("confirmed")) | F.startswith(F.col("basis"), F.lit("human"))).select("record_id")
    done = verdicts.where(F.col("verifier_validation") == "valid").select("record_id")
    return entries.join(records.select("record_id"), "record_id", "left_semi").join(done, "record_id", "left_anti").join(settled, "record_id", "left_anti")


def revalidate(entries: DataFrame, flex_words: int = 250) -> DataFrame:
    """Entries in review whose summary is short enough become completed and valid, with a flag."""
    flips = F.coalesce((F.col("status") == "needs_review") & F.col("summary").isNotNull() & (text.word_count(F.col("summary")) <= flex_words), F.lit(False))
    flags = F.coalesce(F.col("review_flags"), F.array().cast("array<string>"))
    return (
        entries.withColumn("_flips", flips)
        .withColumn("review_flags", F.when(F.col("_flips"), F.array_append(flags, f"revalidated_flex_{flex_words}w")).otherwise(F.col("review_flags")))
        .withColumn("status", F.when(F.col("_flips"), "completed").otherwise(F.col("status")))
        .withColumn("validation_status", F.when(F.col("_flips"), "valid").otherwise(F.col("validation_status")))
        .withColumn("needs_human_review", F.when(F.col("_flips"), F.lit(False)).otherwise(F.col("needs_human_review")))
        .drop("_flips")
    )


def second_pass_targets(entries: DataFrame) -> DataFrame:
    """Entries that need a person and have none yet."""
    return entries.where(F.coalesce("needs_human_review", F.lit(False)) & (F.coalesce("review_status", F.lit("")) == ""))


def merge_review(entries: DataFrame, edits: DataFrame) -> DataFrame:
    """Human edits over annotations: an edit's label replaces the stored one, and changes turn approval into correction.

    `edits` has record_id, action and edited_label (null: unchanged). Edited fields join those that an
    entry has from earlier reviews.
    """
    joined = entries.join(edits, "record_id", "left")
    changed = F.col("edited_label").isNotNull() & ~F.col("edited_label").eqNullSafe(F.col("label"))
    none = F.array().cast("array<string>")
    before = F.coalesce("human_edited_fields", none) if "human_edited_fields" in entries.columns else none
    return (
        joined.withColumn("human_edited_fields", F.array_sort(F.array_union(before, F.when(changed, F.array(F.lit("primary_category"))).otherwise(none))))
        .withColumn("review_status", F.when((F.col("action") == "approved") & changed, "corrected").otherwise(F.coalesce("action", "review_status")))
        .withColumn("label", F.coalesce("edited_label", "label"))
        .drop("action", "edited_label")
    )


def review_queue(entries: DataFrame) -> DataFrame:
    """`entries` with place: rejected first, then undecided, ambiguous, corrected, approved; more flags first.

    Rows are counted by range (severity, flags and stretches of the input order), the few ranges' counts
    are summed up in order, and rows get their places within their range, so that no task sorts them all.
    """
    status = F.col("review_status")
    severity = F.when(status.isin("rejected", "reject"), 0).when(status.isin("ambiguous", "mark ambiguous"), 2).when(status == "corrected", 3).when(status.isin("approved", "approve"), 4).otherwise(1)
    flags = F.coalesce(F.size("review_flags"), F.lit(0))
    marked = entries.withColumn("severity", severity).withColumn("_flags", -flags).withColumn("_stretch", F.floor(F.col("seq") / STRETCH))
    key = ["severity", "_flags", "_stretch"]
    upto = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    before = marked.groupBy(*key).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(*key).orderBy("seq"))
    return marked.join(before, key).withColumn("place", (F.col("_before") + within).cast("int")).drop("_flags", "_stretch", "_before")


def quality_tier(verified: Column | None = None) -> Column:
    """gold, silver or quarantine; only a verdict that is false, not a missing one, sends to quarantine."""
    out = F.when(F.col("parsed_annotation").isNull(), "quarantine").when(F.col("review_status").isin(HUMAN), "gold")
    if verified is not None:
        out = out.when(F.coalesce(~verified, F.lit(False)), "quarantine")
    return out.when(F.coalesce("needs_human_review", F.lit(False)), "quarantine").otherwise("silver")


def consensus(records: DataFrame, annotations: DataFrame, verdicts: DataFrame, seq: str = "seq") -> DataFrame:
    """(record_id, final_label, basis, needs_human_review, to_verify) of each annotated record.

    `annotations` has record_id, label, review_status and stamps; `verdicts` has record_id, verifier
    (its name), priority (the order of verifiers), verifier_label, verifier_validation and stamps. Only
    the latest row of each counts.
    """
    stamps = ["reviewed_at", "verified_at", "teacher_timestamp"]
    own = latest(annotations, "record_id", stamps, seq).select("record_id", "label", "review_status")
    stamp = F.coalesce(*[F.nullif(F.col(s), F.lit("")) for s in stamps if s in verdicts.columns], F.lit(""))
    newest = verdicts.withColumn("_n", F.row_number().over(Window.partitionBy("verifier", "record_id").orderBy(stamp.desc(), F.col(seq)))).where("_n = 1")
    valid = newest.where(F.col("verifier_validation") == "valid").join(own.select("record_id", "label"), "record_id")
    dissent = ~F.col("verifier_label").eqNullSafe(F.col("label"))
    votes = valid.groupBy("record_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("priority", "verifier"))), lambda s: s["verifier"]), "+").alias("names"),
        F.count("*").alias("n"), F.count_if(dissent).alias("n_dissent"),
        F.transform(F.array_sort(F.collect_list(F.when(dissent, F.struct("priority", F.col("verifier_label").alias("l"))))), lambda s: s["l"]).alias("others"),
    )
    # the most frequent dissenting label, of equals the one that the first verifier gave; a verifier votes once
    often = F.transform("others", lambda x: F.size(F.filter("others", lambda y: y.eqNullSafe(x))))
    top_votes = F.array_max(often)
    joined = records.select("record_id").join(own, "record_id").join(votes, "record_id", "left").withColumn("votes", top_votes).withColumn("other", F.get("others", F.array_position(often, top_votes).cast("int") - 1))
    human, reject = F.coalesce(F.col("review_status").isin(HUMAN), F.lit(False)), F.coalesce(F.col("review_status") == "reject", F.lit(False))
    none, all_agree = F.col("n").isNull(), F.col("n_dissent") == 0
    overruled, split = F.col("votes") >= 2, F.col("n") >= 2
    basis = (
        F.when(human, F.concat(F.lit("human_"), "review_status")).when(reject, "human_reject").when(none, "teacher_unverified").when(all_agree, F.concat(F.lit("confirmed_"), "names"))
        .when(overruled, F.concat(F.lit("consensus_2of3_"), "other")).when(split, "split_verdicts").otherwise(F.concat(F.lit("single_disagreement_"), "names"))
    )
    settled = human | reject
    return joined.select(
        "record_id",
        F.when(reject, F.lit(None)).when(~settled & ~none & overruled, F.col("other")).otherwise(F.col("label")).alias("final_label"),
        basis.alias("basis"),
        (~settled & ~none & ~all_agree).alias("needs_human_review"),
        (~settled & (none | (~all_agree & ~overruled & ~split))).alias("to_verify"),
    ).withColumn("needs_human_review", F.coalesce("needs_human_review", F.lit(False))).withColumn("to_verify", F.coalesce("to_verify", F.lit(False)))


def consensus_outcome(basis: Column) -> Column:
    """The class of a basis that statistics count."""
    return (
        F.when(basis == "human_reject", "gold_rejected").when(F.startswith(basis, F.lit("human_")), "gold_human").when(basis == "teacher_unverified", "unverified_silver")
        .when(F.startswith(basis, F.lit("confirmed_")), "confirmed").when(F.startswith(basis, F.lit("consensus_2of3_")), "overruled_2of3")
        .when(basis == "split_verdicts", "split_needs_human").otherwise("single_disagreement")
    )


def apply_overlay(entries: DataFrame, overlay: DataFrame) -> DataFrame:
    """The best entry of each record with the consensus label and flags over it."""
    best = best_annotation(entries)
    over = overlay.select("record_id", "final_label", "basis", F.col("needs_human_review").alias("_review"))
    joined = best.join(over, "record_id", "left")
    return (
        joined.withColumn("label", F.coalesce("final_label", "label"))
        .withColumn("review_status", F.when(F.col("basis") == "human_corrected", "corrected").when(F.col("basis").isin("human_approve", "human_approved"), "approved").when(F.col("basis") == "human_reject", "reject").otherwise(F.col("review_status")))
        .withColumn("needs_human_review", F.coalesce("needs_human_review", F.lit(False)) | F.coalesce("_review", F.lit(False)))
        .drop("final_label", "basis", "_review")
    )


def training_example(task: str) -> tuple[Column, Column]:
    """Input and target; a null target means that the record is skipped."""
    head = F.concat(F.lit("TITLE: "), "title", F.lit("\n\nOPPORTUNITY TEXT:\n"))
    if task == "summarize":
        return F.concat(head, text.first_words(F.col("clean_text"), 600)), F.nullif(F.col("label"), F.lit(""))
    return F.concat(head, "clean_text"), F.when(F.col("label").isin(C.CATEGORIES), F.col("label"))


def held_out_sources(sources: DataFrame, task: str) -> DataFrame:
    """Sources that are kept for the unseen split whole."""
    rank = hashing.stable_rank(F.col("source_id"), f"{task}:unseen:{C.SEED}")
    return sources.select("source_id").distinct().withColumn("held_out", rank % 1000 < C.UNSEEN_FRACTION * 1000)


def assign_splits(records: DataFrame, task: str) -> DataFrame:
    """`records` (with group_id) with split: unseen_sources_test, train, validation or test.

    A group with a record of a held-out source is unseen. The others are ordered by the hash of their
    group; eight and nine tenths of the records are the cuts, and a group across a cut goes to the
    earlier split. Ranks come from one row a group: sizes are summed within ranges of the hash and
    carried over ranges, so that no task sorts all groups.
    """
    held = held_out_sources(records, task).where("held_out").select("source_id", F.lit(True).alias("_held"))
    marked = records.join(held, "source_id", "left")
    groups = marked.groupBy("group_id").agg(F.count("*").alias("n"), F.max(F.coalesce("_held", F.lit(False))).alias("unseen"))
    groups = groups.withColumn("rank", hashing.rank_hex(F.col("group_id").cast("string"), f"{task}:split:{C.SEED}")).withColumn("range", F.substring("rank", 1, 3))
    pool = groups.where("NOT unseen")
    ranges = pool.groupBy("range").agg(F.sum("n").alias("rows")).withColumn("before", F.coalesce(F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = pool.agg(F.sum("n").alias("total"))
    within = Window.partitionBy("range").orderBy("rank", "group_id").rowsBetween(Window.unboundedPreceding, -1)
    # `at` is the place of the group's first record among all
    placed = pool.join(ranges, "range").crossJoin(F.broadcast(total)).withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    split = F.when(F.col("at") < F.floor(F.col("total") * F.lit(0.8)), "train").when(F.col("at") < F.floor(F.col("total") * F.lit(0.9)), "validation").otherwise("test")
    named = placed.select("group_id", split.alias("split")).unionByName(groups.where("unseen").select("group_id", F.lit("unseen_sources_test").alias("split")))
    return records.join(named, "group_id")


def build_dataset(records: DataFrame, entries: DataFrame, task: str, overlay: DataFrame | None = None, verdicts: DataFrame | None = None, fresh_only: bool = False) -> DataFrame:
    """(record_id, source_id, input, target, tier, split) of all trainable records.

    With `fresh_only`, annotations whose input_hash is not that of the record today are left out.
    """
    best = apply_overlay(entries, overlay) if overlay is not None else best_annotation(entries)
    joined = best.drop("title", "clean_text", "source_id").join(records, "record_id")
    if fresh_only:
        joined = joined.where(F.col("input_hash") == hashing.input_hash(F.col("title"), F.col("clean_text")))
    verified = None
    if verdicts is not None:
        joined = joined.join(verdicts.where("verifier_validation = 'valid'").select("record_id", "agreement"), "record_id", "left")
        verified = F.col("agreement")
    source, target = training_example(task)
    tiered = joined.withColumn("tier", quality_tier(verified)).where(F.col("tier").isin("gold", "silver")).withColumn("input", source).withColumn("target", target).where("target IS NOT NULL")
    return assign_splits(tiered, task).select("record_id", "source_id", "input", "target", "tier", "split")


def noul_items(records: DataFrame, annotations: DataFrame) -> DataFrame:
    """Binary questions of each eligible record: its category, a neighbouring one, and its deadline.

    `annotations` has record_id, label, status and needs_human_review. The neighbour is chosen by hash.
    Where it has no question of its own, the record gets neither that item nor the deadline's.
    """
    good = annotations.where((F.col("status") == "completed") & ~F.coalesce("needs_human_review", F.lit(False)) & F.col("label").isin(list(C.NOUL_NEIGHBOURS)))
    other = F.lit(None).cast("string")
    odd = F.conv(F.substring(F.sha1(F.concat(F.lit("noul:"), F.col("record_id").cast("string"))), 16, 1), 16, 10).cast("int") % 2 == 1
    for category, (a, b) in C.NOUL_NEIGHBOURS.items():
        other = F.when(F.col("label") == category, F.when(odd, b).otherwise(a)).otherwise(other)
    asked = records.join(good.select("record_id", "label"), "record_id").withColumn("_other", other)
    deadline = F.coalesce(text.strip(F.col("deadline")), F.lit("")) != ""
    item = lambda family, target, case: F.struct(family.alias("family"), target.alias("target"), case.alias("case"))
    positive = item(F.concat(F.lit("category_"), "label"), F.lit(True), F.lit("positive"))
    negative = item(F.concat(F.lit("category_"), "_other"), F.lit(False), F.lit("negative"))
    dated = item(F.lit("deadline_stated"), deadline, F.when(deadline, "qualified").otherwise("negative"))
    has_family = F.col("_other").isin(list(C.NOUL_NEIGHBOURS))
    each = asked.select("record_id", "source_id", F.substring("clean_text", 1, 6000).alias("state"), F.explode(F.when(has_family, F.array(positive, negative, dated)).otherwise(F.array(positive))).alias("i"))
    return each.select("record_id", "source_id", "state", "i.*", F.concat_ws(":", F.col("record_id").cast("string"), F.col("i.family"), F.col("i.target").cast("string")).alias("item_id"))


def disputed(verdicts: DataFrame) -> DataFrame:
    """The last verdict of each record that a verifier disagreed with."""
    return last(verdicts.where(~F.coalesce("agreement", F.lit(True))))


def training_rows(split: DataFrame, task: str, first: int | None = None) -> DataFrame:
    """(text, label index) or (prompt, completion), all or the first rows by record id."""
    rows = split if first is None else split.orderBy("record_id").limit(first)
    if task == "classify":
        return rows.select(F.col("input").alias("text"), text.category_index(F.col("target")).alias("label"))
    return rows.select(F.col("input").alias("prompt"), F.col("target").alias("completion"))


def provenance(entries: DataFrame, task: str, prompt_version: str, schema_version: str) -> DataFrame:
    """`entries` of records with what an annotation was made from: its input's hash, task and versions."""
    known = {"input_hash": hashing.input_hash(F.col("title"), F.col("clean_text")), "task": F.lit(task), "prompt_version": F.lit(prompt_version), "schema_version": F.lit(schema_version)}
    return entries.withColumns(known | {"taxonomy_version": F.lit("taxonomy_v1" if task == "classify" else None).cast("string")})


def run_statistics(records: DataFrame, entries: DataFrame, before: DataFrame) -> DataFrame:
    """One row: what a run did with `records`, of which those with an entry in `before` were skipped.

    An entry of an unknown status is an error.
    """
    status, flags = F.coalesce("status", F.lit("error")), F.concat_ws(" ", "review_flags")
    known = ["completed", "rate_limited", "needs_review"]
    counts = [F.count_if(status == s).alias(s) for s in known] + [F.count_if(~status.isin(known)).alias("errors"), F.count_if(flags.contains("disagree")).alias("disagreements")]
    counted = entries.agg(*counts, F.count_if(F.array_contains(F.coalesce("review_flags", F.array().cast("array<string>")), "recovered_by_second_opinion")).alias("second_opinions"))
    skipped = records.join(before.select("record_id"), "record_id", "left_semi").agg(F.count("*").alias("skipped"))
    return counted.crossJoin(F.broadcast(skipped))


def noul_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("family", "target").agg(F.count("*").alias("n"))
