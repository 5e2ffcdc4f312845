"""Quality scores learnt from preference pairs after Bradley and Terry.

Every labelled document of quality 1 is preferred to every one of quality 0. From a bounded sample of
labelled rows, pairs are drawn and weights are fitted by logistic loss on the difference of the two
documents' features. The threshold is a quantile of the sample's scores: as large a share lies below
it as has quality 0. A logistic curve through that point turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, labels, runs, text_bytes
from loamwork.llm.textstats import N_FEATURES, features

#: Labelled rows to learn from at most, pairs drawn from them, and the probability at the threshold.
SAMPLE = 6000
PAIRS = 20000
CUT = 0.3


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(labels_table: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, label) of at most `size` labelled rows outside the held-out fold, the same ones whatever the partitioning."""
    usable = labels_table.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    return usable.select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(size)


def sampled_texts(docs: DataFrame, labels_table: DataFrame, label: str, size: int) -> DataFrame:
    """(doc_id, label, text) of the sample: its ids are sent to the tasks that read the texts.

    Rows without an id or a label of 0 or 1 are not used, nor ids that no document has. Repeated rows
    count once, an id with both labels twice. Of the texts of an id the least is taken (null if it has
    no other), so that an id that many documents share brings one row.
    """
    chosen = labelled_sample(labels_table, label, size).distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


@dataclass(frozen=True)
class Ranking:
    """score() is the probability of label 1; `slope` 0 stands for a constant."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float
    constant: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.full(len(x), self.constant)
        raw = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        z = self.slope * (raw - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, n_pairs: int = PAIRS, ridge: float = 1.0) -> Ranking:
    """With no label the score is 0.5, with labels of one kind it is that label."""
    blank = np.zeros(x.shape[1] if x.ndim == 2 else N_FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(blank, blank + 1, blank, 0.0, 0.0, float(y.mean()) if len(y) else 0.5)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(0)
    d = z[rng.choice(good, n_pairs)] - z[rng.choice(bad, n_pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        lost = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        step = np.linalg.solve((d.T * (lost * (1 - lost))) @ d + ridge * np.eye(len(w)), d.T @ lost - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ w
    ordered = np.sort(raw)
    at = min(len(bad), len(raw) - 1)
    threshold = float((ordered[at - 1] + ordered[at]) / 2)
    slope, offset = 1.0, np.log(CUT / (1 - CUT))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * (raw - threshold) + offset, -30, 30)))
        g = ((y - p) * (raw - threshold)).sum() - slope
        h = (p * (1 - p) * (raw - threshold) ** 2).sum() + 1
        slope = min(50.0, max(0.05, slope + g / h))
    return Ranking(mean, scale, w, threshold, float(slope))


def _with_features(docs: DataFrame, columns: str) -> DataFrame:
    names = [c.split(" ")[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            found = pa.array([features(t) for t in text_bytes(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], found], names=[*names, "features"])

    return docs.mapInArrow(run, f"{columns}, features array<double>")


def train(docs: DataFrame, labels_table: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Ranking:
    """A ranking learnt from at most `sample` labelled rows, which bounds what reaches the driver.

    Rows and texts are chosen as sampled_texts() says. Without labels, or with labels of one kind, the
    score is a constant. Other columns of either table are not read.
    """
    texts = sampled_texts(docs, labels_table, label, sample)
    rows = _with_features(texts.select("label", "doc_id", "text"), "label int, doc_id long").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["features"]))
    x = np.array([r["features"] for r in rows]).reshape(-1, N_FEATURES)
    return fit(x, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """`docs` with score double.

    Only the text decides. Null texts count as empty; empty texts are scored like others, and texts
    of any length are read whole. Repeated rows get equal scores.
    """
    kept = [f for f in docs.schema.fields if f.name != "score"]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            found = model.score(np.array([features(t) for t in text_bytes(batch)]))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(found)], names=[*[f.name for f in kept], "score"])

    return docs.mapInArrow(run, ddl)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score(docs, train(docs, labels(spark, sf_dir)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


QUERIES = {"op8_quality_classifier": op8_quality_classifier}
ORACLES: dict[str, str] = {}
