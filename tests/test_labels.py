from pyspark.sql import functions as F

from loamwork.operators import decision, labels

ANN = "seq long, record_id string, label string, review_status string, status string, parsed_annotation string, needs_human_review boolean, reviewed_at string, verified_at string, teacher_timestamp string"
VER = "seq long, record_id string, verifier string, priority int, verifier_label string, verifier_validation string, verified_at string"


def annotation(i, label="phd", review=None, stamp="", seq=None):
    return (seq if seq is not None else i, f"r{i}", label, review, "completed", "{}", False, stamp, "", "")


def test_consensus_table(spark):
    anns = [annotation(i) for i in range(6)] + [annotation(6, review="corrected"), annotation(7, review="reject"), annotation(8), annotation(8, label="grants", stamp="2026", seq=99)]
    ver = [
        (0, "r1", "bulk", 0, "phd", "valid", ""), (1, "r1", "single", 1, "phd", "valid", ""), (2, "r2", "bulk", 0, "grants", "valid", ""), (3, "r2", "single", 1, "grants", "valid", ""),
        (4, "r3", "bulk", 0, "grants", "valid", ""), (5, "r3", "single", 1, "phd", "valid", ""), (6, "r4", "single", 1, "grants", "valid", ""), (7, "r5", "bulk", 0, "grants", "invalid", ""),
        (8, "r6", "bulk", 0, "grants", "valid", ""), (9, "r8", "bulk", 0, "grants", "valid", ""),
    ]
    records = spark.createDataFrame([(f"r{i}",) for i in range(10)], "record_id string")
    found = {r["record_id"]: tuple(r)[1:] for r in labels.consensus(records, spark.createDataFrame(anns, ANN), spark.createDataFrame(ver, VER)).collect()}
    assert found == {
        "r0": ("phd", "teacher_unverified", False, True), "r1": ("phd", "confirmed_bulk+single", False, False), "r2": ("grants", "consensus_2of3_grants", True, False),
        "r3": ("phd", "split_verdicts", True, False), "r4": ("phd", "single_disagreement_single", True, True), "r5": ("phd", "teacher_unverified", False, True),
        "r6": ("phd", "human_corrected", False, False), "r7": (None, "human_reject", False, False), "r8": ("grants", "confirmed_bulk", False, False),
    }


def test_routing(spark):
    rows = [
        ("valid", "a", None, None, None, None), ("invalid", "a", "valid", "b", None, None), ("invalid", "a", "invalid", "b", None, None), ("ambiguous", "a", "valid", "a", None, None),
        ("ambiguous", "a", "valid", "b", "valid", "c"), ("ambiguous", "a", "ambiguous", "b", None, None), ("ambiguous", "a", "valid", "b", "invalid", "c"),
    ]
    found = labels.route(spark.createDataFrame(rows, "v1 string, l1 string, v2 string, l2 string, v3 string, l3 string")).collect()
    assert [(r["label"], r["needs_human_review"]) for r in found] == [("a", False), ("b", False), ("a", True), ("a", False), ("c", True), ("a", True), ("a", True)]


def test_validation(spark):
    answers = ['{"primary_category": "phd", "classification_ambiguity": 0.1}', '{"primary_category": "nope"}', '{"primary_category": "phd", "classification_ambiguity": 0.6}', '{"primary_category": "phd", "secondary_plausible_categories": ["grants"], "classification_ambiguity": 0.4}', "no", '{"a": 1} {"b": 2}']
    df = spark.createDataFrame([(a,) for a in answers], "raw string")
    assert [r["v"] for r in df.select(labels.validate("classify", labels.parse_answer(F.col("raw"))).alias("v")).collect()] == ["valid", "invalid", "ambiguous", "ambiguous", "invalid", "invalid"]


def test_tiers(spark):
    rows = [(None, None, False, None), ("{}", "approved", True, False), ("{}", None, True, None), ("{}", None, False, None), ("{}", None, False, False), ("{}", None, False, True)]
    df = spark.createDataFrame(rows, "parsed_annotation string, review_status string, needs_human_review boolean, ok boolean")
    assert [r["t"] for r in df.select(labels.quality_tier(F.col("ok")).alias("t")).collect()] == ["quarantine", "gold", "quarantine", "silver", "quarantine", "silver"]


def test_revalidation_flips_short_summaries(spark):
    rows = [("needs_review", "invalid", True, "short", None), ("needs_review", "invalid", True, "w " * 300, ["f"]), ("error", "invalid", True, "short", ["f"])]
    df = spark.createDataFrame(rows, "status string, validation_status string, needs_human_review boolean, summary string, review_flags array<string>")
    found = labels.revalidate(df).collect()
    assert [(r["status"], r["needs_human_review"], r["review_flags"]) for r in found] == [("completed", False, ["revalidated_flex_250w"]), ("needs_review", True, ["f"]), ("error", True, ["f"])]


def test_annotate_with_a_stub(spark):
    def provider(batches):
        for pdf in batches:
            pdf["response"] = ['{"primary_category": "phd"}' if "PhD" in p else "?" for p in pdf["prompt"]]
            yield pdf[["record_id", "response"]]

    records = spark.createDataFrame([("r1", "PhD in Oslo", "text"), ("r2", "Other", "text")], "record_id string, title string, clean_text string")
    assert {r["record_id"]: r["status"] for r in labels.annotate(records, "classify", provider).collect()} == {"r1": "completed", "r2": "needs_review"}


def test_review_edits(spark):
    entries = spark.createDataFrame([("r1", "phd", None), ("r2", "phd", None)], "record_id string, label string, review_status string")
    edits = spark.createDataFrame([("r1", "approved", "grants"), ("r2", "approved", None)], "record_id string, action string, edited_label string")
    found = {r["record_id"]: (r["label"], r["review_status"], r["human_edited_fields"]) for r in labels.merge_review(entries, edits).collect()}
    assert found == {"r1": ("grants", "corrected", ["primary_category"]), "r2": ("phd", "approved", [])}


def test_edited_fields_add_up(spark):
    entries = spark.createDataFrame([("r", "phd", "", ["summary"]), ("q", "phd", "", None)], "record_id string, label string, review_status string, human_edited_fields array<string>")
    edits = spark.createDataFrame([("r", "approved", "grants"), ("q", "approved", None)], "record_id string, action string, edited_label string")
    found = {r["record_id"]: r for r in labels.merge_review(entries, edits).collect()}
    assert found["r"]["human_edited_fields"] == ["primary_category", "summary"] and found["r"]["review_status"] == "corrected"
    assert found["q"]["human_edited_fields"] == [] and found["q"]["review_status"] == "approved"


def test_answers_do_not_depend_on_batches(spark):
    """One to eight questions together, in batches of any size, give the same answers; what was cut is never chosen."""
    questions = [(f"q{k}", "choice", f"Question {k}?", {"a": "x" * (k + 1), "b": "yy", "c": "zzz"}) for k in range(8)]
    schema = "question_id string, kind string, instructions string, criteria map<string,string>"
    states = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(3)], "state_id long, state string")

    def scorer(batches):
        for b in batches:
            yield b.drop(columns="prompt").assign(score=[None if o == "c" and q == "q3" else len(p) * 0.37 % 3.1 for p, o, q in zip(b["prompt"], b["option"], b["question_id"])])

    answers = {}
    for n in (1, 4, 8):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
        for at in range(0, 8, n):
            asked = spark.createDataFrame(questions[at : at + n], schema)
            for r in decision.answer(decision.score(decision.expand(states, asked), scorer)).collect():
                answers.setdefault((r["state_id"], r["question_id"]), []).append(r["probabilities"])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(answers) == 24 and all(len(x) == 3 and all(abs(x[0][k] - y[k]) < 1e-9 for y in x for k in "abc") for x in answers.values())
    assert answers[0, "q3"][0]["c"] == 0.0
