"""Typed questions over states: expansion, scoring, probabilities, gate and validation.

`states` has state_id and state; `questions` has question_id, kind (noul or choice), instructions and
criteria, a map of option to its description. Errors are rows, not exceptions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamwork.functions.text import first_words
from loamwork.operators import metrics

GATE = 0.5
MAX_STATE = 60_000
#: The score of a criterion that did not fit.
TRUNCATED = -1e9


def validate_questions(questions: DataFrame) -> DataFrame:
    """`questions` with error, null where the question can be asked."""
    keys = F.map_keys("criteria")
    both = F.array_contains(keys, "true") & F.array_contains(keys, "false")
    error = F.when(~F.col("kind").isin("noul", "choice"), "unknown question type").when(F.col("criteria").isNull(), "criteria are missing").when((F.col("kind") == "noul") & ~both, "noul needs true and false").when((F.col("kind") == "choice") & (F.size("criteria") < 2), "choice needs two criteria")
    return questions.withColumn("error", error)


def state_error(state: Column) -> Column:
    n = F.length(F.coalesce(state, F.lit("")))
    return F.when(n < 1, "state is empty").when(n > MAX_STATE, "state is too long")


def prompt(state: Column, instructions: Column, criterion: Column, max_words: int = 600) -> Column:
    return F.concat(F.lit("STATE:\n"), first_words(state, max_words), F.lit("\n\nQUESTION: "), instructions, F.lit("\nANSWER: "), criterion)


def expand(states: DataFrame, questions: DataFrame) -> DataFrame:
    """One row for each state, question and option. The questions are a request's few, which bounds what is broadcast."""
    options = questions.select("question_id", "kind", "instructions", F.posexplode(F.map_entries("criteria")).alias("place", "o"))
    return states.join(F.broadcast(options), F.lit(True)).select("state_id", "question_id", "kind", "place", F.col("o.key").alias("option"), prompt(F.col("state"), F.col("instructions"), F.col("o.value")).alias("prompt"))


def score(expanded: DataFrame, scorer: Callable) -> DataFrame:
    """`scorer` is a mapInPandas function from (.., prompt) to (.., score); questions are scored independently.

    A score is the mean log-probability of a criterion's tokens; it is null where the prompt was cut
    before the criterion's end, which then counts as all but impossible.
    """
    columns = [c for c in expanded.columns if c != "prompt"]
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in expanded.schema if f.name in columns)
    return expanded.mapInPandas(scorer, f"{ddl}, score double").withColumn("score", F.coalesce("score", F.lit(TRUNCATED)))


def answer(scored: DataFrame) -> DataFrame:
    """Probabilities of each question's options and what follows from them."""
    entries = F.array_sort(F.collect_list(F.struct("place", "option", "score")))
    grouped = scored.groupBy("state_id", "question_id").agg(F.first("kind").alias("kind"), entries.alias("e"))
    probable = grouped.withColumn("p", metrics.softmax(F.transform("e", lambda x: x["score"])))
    best, top = metrics.top1(F.col("p"))
    choice = F.get("e", best)["option"]
    yes = F.element_at(F.filter(F.arrays_zip("e", "p"), lambda z: z["e"]["option"] == "true"), 1)["p"]
    return probable.select(
        "state_id", "question_id", "kind", F.map_from_arrays(F.transform("e", lambda x: x["option"]), "p").alias("probabilities"),
        F.when(F.col("kind") == "noul", yes).alias("noul"), F.when(F.col("kind") == "choice", choice).alias("choice"), top.alias("top_probability"),
        metrics.margin(F.col("p")).alias("margin"), metrics.entropy(F.col("p")).alias("entropy"), metrics.confidence(F.col("p")).alias("confidence"),
    )


def gate(rows: DataFrame, probability: str, gated: bool = True) -> DataFrame:
    """`rows` with error where the state is not likely enough to be a posting; endpoints without a gate pass all."""
    closed = F.col(probability) < GATE if gated else F.lit(False)
    return rows.withColumn("error", F.when(closed, "not_an_opportunity"))
