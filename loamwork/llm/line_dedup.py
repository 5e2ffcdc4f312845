"""Line dedup: lines that many documents share stay only in the document with the largest id.

Each line's key is hashed to 128 bits. The hashes are range-partitioned by (hash, document), sorted
within partitions by hash, then document from the largest down, then position, and streamed: the
first document of a group keeps its lines and the others lose theirs, provided that enough documents
hold the key. What comes back is one zlib-compressed keep bitmap for each document that loses a line,
never text.

Because the document is part of the range key, a line that a third of all documents hold is spread
over many partitions; a first pass over the sorted rows tells the second how many documents of a
partition's first and last group lie in its neighbours (two rows a partition reach the driver).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import BLANK, documents, runs, text_bytes, text_hash, unused
from loamwork.runtime import cut

MIN_CHARS = 40
MIN_DOCS = 5
_STRIP = BLANK.encode()
_LINES = "h1 long, h2 long, doc_id long, tid long, pos int"


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, tid, pos) of each line whose key has at least `min_chars` code points; tid is the text's hash."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            digests, rows, places = [], [], []
            for row, text in enumerate(text_bytes(batch)):
                for pos, line in enumerate(text.lower().split(b"\n")):
                    key = line.strip(_STRIP)
                    if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        places.append(pos)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            ids, tids = (batch.column(c).take(pa.array(rows, pa.int64())) for c in ("doc_id", "tid"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), ids, tids, pa.array(places, pa.int32())],
                names=["h1", "h2", "doc_id", "tid", "pos"],
            )

    return docs.where("doc_id is not null").select("doc_id", text_hash().alias("tid"), "text").mapInArrow(hashes, _LINES)


class _Groups:
    """Streams sorted rows; hands out which of them are dropped, and what the edges of the partition hold."""

    def __init__(self, min_docs: int, before: int = 0, first_total: int = 0, last: tuple | None = None, last_total: int = 0):
        self.min_docs, self.before, self.first_total, self.last, self.last_total = min_docs, before, first_total, last, last_total
        self.key = self.top = self.doc = None
        self.n = 0
        self.held: list[tuple[np.ndarray, ...]] = []
        self.first: tuple | None = None

    def _enough(self) -> bool:
        """Whether the open group is known to have enough documents."""
        total = self.n
        if self.first is None:
            total = max(total, self.first_total)
        if self.key == self.last:
            total = max(total, self.last_total)
        return total >= self.min_docs

    def _open(self, key: tuple, doc: int) -> None:
        inside = self.first is None and self.key is None and self.before > 0
        self.key, self.doc, self.n, self.held = key, None, 0, []
        self.top = None if inside else doc

    def close(self) -> None:
        if self.key is not None and self.first is None:
            self.first = (*self.key, self.n)

    def feed(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, *more: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        ends = np.r_[starts[1:], len(h1)]
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        counted = np.add.reduceat(fresh.astype(np.int64), starts)
        for i in range(len(starts)):
            lo, hi = starts[i], ends[i]
            if 0 < i < len(starts) - 1 and counted[i] < self.min_docs and self.first is not None:
                continue  # a whole group, and too small
            key = (int(h1[lo]), int(h2[lo]))
            if key != self.key:
                self.close()
                self._open(key, int(doc[lo]))
            self.n += int(counted[i]) - (self.doc == int(doc[lo]))
            self.doc = int(doc[hi - 1])
            rows = (doc[lo:hi], *(x[lo:hi] for x in more))
            if self._enough():
                for each in [*self.held, rows]:
                    lost = slice(None) if self.top is None else each[0] != self.top
                    yield tuple(x[lost] for x in each)
                self.held = []
            else:
                self.held.append(rows)


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc_id", "tid", "pos")]


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tid, pos) of each line that goes."""
    sorted_rows = cut(
        line_hashes(docs, min_chars)
        .repartitionByRange("h1", "h2", F.desc("doc_id"))
        .sortWithinPartitions("h1", "h2", F.desc("doc_id"), "pos")
        .withColumn("part", F.spark_partition_id())
    )

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, part = _Groups(1 << 62), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                for _ in groups.feed(*_columns(batch)):
                    pass
                groups.held = []
        groups.close()
        if part is not None:
            first = groups.first
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "f1": first[0], "f2": first[1], "fn": first[2], "l1": groups.key[0], "l2": groups.key[1], "ln": groups.n}]
            )

    found = sorted_rows.mapInArrow(edges, "part long, f1 long, f2 long, fn long, l1 long, l2 long, ln long").collect()
    known = _neighbours(sorted((tuple(r) for r in found), key=lambda r: r[0]))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if groups is None:
                groups = _Groups(min_docs, *known.get(batch.column("part")[0].as_py(), ()))
            lost = list(groups.feed(*_columns(batch)))
            if lost:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*lost, strict=True)], names=["doc_id", "tid", "pos"])

    return sorted_rows.mapInArrow(stream, "doc_id long, tid long, pos int")


def _neighbours(found: list[tuple]) -> dict[int, tuple]:
    """For each partition: documents of its first group in partitions before it, of that group in all, its last group, and of that in all."""
    totals: dict[tuple, int] = {}
    before: dict[int, int] = {}
    for part, f1, f2, fn, l1, l2, ln in found:
        before[part] = totals.get((f1, f2), 0)
        totals[f1, f2] = before[part] + fn
        if (l1, l2) != (f1, f2):
            totals[l1, l2] = ln
    return {p: (before[p], totals[f1, f2], (l1, l2), totals[l1, l2]) for p, f1, f2, _, l1, l2, _ in found}


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, tid, n_dropped, keep): for each text that loses lines, a zlib-compressed bitmap.

    Bit i, least significant first, is 1 if line i stays; lines beyond the bitmap stay. Documents
    without a row here stay whole.
    """
    lost = dropped_lines(docs, min_chars, min_docs).groupBy("doc_id", "tid").agg(F.collect_set("pos").alias("pos"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, counts = [], []
            for places in batch.column("pos").to_pylist():
                bits = np.ones(max(places) // 8 * 8 + 8, np.uint8)
                bits[places] = 0
                maps.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
                counts.append(len(places))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(counts, pa.int64()), pa.array(maps, pa.binary())], names=["doc_id", "tid", "n_dropped", "keep"])

    return lost.mapInArrow(pack, "doc_id long, tid long, n_dropped long, keep binary")


def kept_text(text: bytes, keep: bytes | None) -> tuple[bytes, int]:
    """The text without the lines whose bit is 0, and the number of lines that went."""
    if keep is None:
        return text, 0
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    bits = bits[: len(lines)].tolist() + [1] * (len(lines) - len(bits))
    return b"\n".join(x for x, b in zip(lines, bits, strict=True) if b), bits.count(0)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with n_lines, n_dropped and kept_text; other columns stay.

    Null and empty texts have one empty line. Rows without a doc_id stay whole; rows that repeat a
    doc_id count as one document when holders of a line are counted, and each loses the lines of its
    own text. Ties cannot occur: a line's keeper is the largest id. An empty table gives an empty result.
    """
    tid, held = unused(docs, "_tid"), unused(docs, "_keep")
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).select("doc_id", F.col("tid").alias(tid), F.col("keep").alias(held))
    joined = docs.withColumn(tid, text_hash()).join(bitmaps, ["doc_id", tid], "left")
    out = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_dropped", "kept_text")]
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out] + ["n_lines long, n_dropped long, kept_text string"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            texts = text_bytes(batch)
            done = [kept_text(t, k) for t, k in zip(texts, batch.column(held).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in out], pa.array([t.count(b"\n") + 1 for t in texts], pa.int64()), pa.array([n for _, n in done], pa.int64()), pa.array([t for t, _ in done], pa.binary()).cast(pa.string())],
                names=[*[f.name for f in out], "n_lines", "n_dropped", "kept_text"],
            )

    return joined.mapInArrow(apply, ddl)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = """
WITH lines AS (
  SELECT doc_id, i AS pos, parts[i] AS line,
         trim(translate(parts[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), shared AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, s.keeper IS NOT NULL AND s.keeper <> l.doc_id AS gone
  FROM lines l LEFT JOIN shared s ON l.k = s.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {"op3_line_dedup": OP3_SQL}
