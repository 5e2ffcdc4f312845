"""Quality rules: base counts with fixed thresholds, then a classifier over hashed n-grams.

Words, pairs of words and character trigrams (of code points) are hashed into buckets. A logistic regression over the
buckets' shares is trained on a bounded sample of labelled rows, its probability is calibrated on rows
that it has not seen, and Arrow batches of texts are scored against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, labels, runs, text_bytes
from loamwork.llm.quality_classifier import sampled_texts
from loamwork.llm.textstats import base_counts
from loamwork.runtime import written

#: Labelled rows to learn from at most, log2 of the buckets of each kind, and the threshold of the verdict.
SAMPLE = 3000
BUCKET_BITS = 14
KEEP = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KINDS = 3
_SHIFT = np.uint64(64 - BUCKET_BITS)


def grams(text: bytes, words: list[bytes]) -> list[np.ndarray]:
    """The bucket of each word, of each pair of words and of each three successive code points."""
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(0)), np.uint64, len(words))
    pairs = (hashed[:-1] * _ODD + hashed[1:]) * _ODD if len(words) > 1 else hashed[:0]
    x = np.frombuffer(text if text.isascii() else text.decode().encode("utf-32-le"), np.uint8 if text.isascii() else np.uint32).astype(np.uint64)
    chars = ((x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:]) + np.uint64(1)) * _ODD if len(x) > 2 else x[:0]
    return [h >> _SHIFT for h in (hashed, pairs, chars)]


@dataclass(frozen=True)
class Linear:
    """Weights by kind and bucket; the calibrated probability is a logistic function of the raw score."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, text: bytes, words: list[bytes]) -> float:
        return self.bias + sum(float(w[g].mean()) for w, g in zip(self.weights, grams(text, words), strict=True) if len(g))

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(y: np.ndarray, lengths: np.ndarray, place: np.ndarray, share: np.ndarray, rounds: int = 60, ridge: float = 1e-3) -> Linear:
    """Labels and numbers of buckets by row; the rows' buckets and shares, one after another.

    With labels of one kind or none the probability is their mean, or 0.5.
    """
    size = _KINDS << BUCKET_BITS
    if len(set(y.tolist())) < 2:
        p = min(0.999, max(0.001, float(y.mean()) if len(y) else 0.5))
        return Linear(np.zeros((_KINDS, 1 << BUCKET_BITS)), float(np.log(p / (1 - p))))
    owner = np.repeat(np.arange(len(y), dtype=np.int32), lengths)
    learns = np.arange(len(y)) % 5 != 0
    # accelerated gradient descent; a bucket's step is scaled by how much it occurs
    energy = np.bincount(place, share * share, size) / len(y)
    scale = 1 / np.sqrt(energy + energy[energy > 0].mean())
    w, v, bias, pull = np.zeros(size), np.zeros(size), 0.0, 0.0
    on = learns[owner]
    for _ in range(rounds):
        z = np.bincount(owner, share * (w * scale)[place], len(y)) + bias
        e = np.where(learns, y - _sigmoid(z), 0.0)
        g = np.bincount(place[on], (share * e[owner])[on], size) * scale / learns.sum() - ridge * w
        v, pull = 0.9 * v + g, 0.9 * pull + e.sum() / learns.sum()
        w, bias = w + 0.5 * v, bias + 0.5 * pull
    z = np.bincount(owner, share * (w * scale)[place], len(y)) + bias
    slope, shift = _platt(z[~learns], y[~learns])
    return Linear((w * scale).reshape(_KINDS, -1), float(bias), slope, shift)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's curve with his smoothed targets; rows of one kind leave the score as it is."""
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    if not ones or not zeros:
        return 1.0, 0.0
    t = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    x = np.c_[z, np.ones(len(z))]
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ ab)
        ab = ab + np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-3 * np.eye(2), x.T @ (t - p))
    return max(0.1, float(ab[0])), float(ab[1])


def train(docs: DataFrame, labels_table: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Linear:
    """A classifier learnt from at most `sample` labelled rows; their texts' buckets and shares come back.

    Rows and texts are chosen as quality_classifier.sampled_texts() says. Without labels, or with labels
    of one kind, the probability is a constant. Other columns of either table are not read.
    """
    texts = sampled_texts(docs, labels_table, label, sample)

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            places, values = [], []
            for text in text_bytes(batch):
                found = [np.unique(g, return_counts=True) for g in grams(text, text.split())]
                places.append(np.concatenate([(k << BUCKET_BITS) + g.astype(np.int64) for k, (g, _) in enumerate(found)]))
                values.append(np.concatenate([c / max(1, c.sum()) for _, c in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                names=["doc_id", "label", "place", "share"],
            )

    found = written(texts.select("doc_id", "label", "text").mapInArrow(shares, "doc_id long, label int, place array<int>, share array<float>"))
    rows = found.orderBy("doc_id", "label").toArrow()
    # columns as they are in memory, without a Python object for each bucket
    place, share = (rows.column(c).combine_chunks() for c in ("place", "share"))
    return fit(rows.column("label").to_numpy().astype(float), np.diff(place.offsets.to_numpy()), place.flatten().to_numpy(), share.flatten().to_numpy())


def judge(docs: DataFrame, model: Linear, keep: float = KEEP) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept).

    Null texts have no words and fail. Texts of any length are read whole; repeated rows get equal
    verdicts; an empty table gives an empty result. Only doc_id and text are read.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            found, raw = [], []
            for text in text_bytes(batch):
                words = text.split()
                found.append(base_counts(text, words))
                raw.append(model.raw(text, words))
            failed = np.array([c["n_words"] < MIN_WORDS or 100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"] for c in found])
            p = model.probability(np.array(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([c[k] for c in found], pa.int64()) for k in counts], pa.array(failed), pa.array(p), pa.array(~failed & (p >= keep))],
                names=["doc_id", *counts, "base_failed", "probability", "kept"],
            )

    longs = ", ".join(f"{c} long" for c in counts)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, {longs}, base_failed boolean, probability double, kept boolean")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, train(docs, labels(spark, sf_dir)))


QUERIES = {"op10_quality_rules": op10_quality_rules}
ORACLES: dict[str, str] = {}
