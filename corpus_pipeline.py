"""A corpus pipeline: quality, shared lines, near copies, personal data, packing.

Every stage reads all that its predecessor kept. All but the last return the columns of documents,
with n_chars counted anew where the text has changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm import line_dedup, packing, pii, quality_classifier, simhash_dedup
from loamwork.llm.common import labels, text_hash
from loamwork.runtime import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking scores at its threshold or above; the texts stay as they are.

    Null texts are scored as empty ones; rows that repeat one another, or an id, are judged each by its
    own text. Columns beyond those of documents are dropped, and an empty table gives an empty result,
    here and in the stages below.
    """
    model = quality_classifier.train(docs, labels(spark, sf_dir))
    return quality_classifier.score(docs.select(*COLUMNS), model).where(F.col("score") >= quality_classifier.CUT).drop("score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others keep; one that loses all its lines stays, empty. Null texts become empty."""
    kept = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return _counted(kept.drop("text").withColumnRenamed("kept_text", "text"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; rows without an id stay.

    Empty texts are one group. Texts that share an id are judged each by its own group; a row that
    stands several times with the group's smallest id stays as often.
    """
    found = simhash_dedup.near_duplicates(docs).where(F.col("doc_id") != F.col("component_id")).select("doc_id", F.col("tid").alias("_tid")).distinct()
    return docs.select(*COLUMNS).withColumn("_tid", text_hash()).join(found, ["doc_id", "_tid"], "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; null and empty texts stay, and texts of any length are searched whole."""
    return _counted(pii.replace_entities(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens.

    Null and empty texts are pieces of their end mark alone; only longer documents are cut; rows that
    repeat an id are packed each on its own, with pieces counted from 0.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL has neither the ranking's model, nor the fingerprints' hash, nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written to the checkpoint folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
