"""Best-fit packing of token pieces into fixed-length sequences after dominance reduction.

Lengths are whole numbers up to the capacity, so a packing problem is a histogram of at most
`capacity` counts, whatever the corpus holds. The driver collects that histogram alone and plans on
it. First Martello and Toth's reduction: a set of pieces that dominates every other set its largest
piece could be part of is fixed as a sequence for good, which never costs an optimal solution a
sequence. Then the rest is packed best-fit, longest first, on counts of equal lengths. The plan is a
list of segments (length, first rank, count, first sequence, offset), a few for each length; pieces
find their place by their rank among the pieces of their length.

Ranks need no sort: each task numbers its own pieces by length, and a running total of the tasks'
histograms (one row a task and length) turns these numbers into global ones. The pieces are written
to the checkpoint folder before they are ranked, so that a task that is repeated cannot renumber.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamwork.llm.bpe import compiled, default_vocabulary, texts
from loamwork.llm.common import documents, runs
from loamwork.runtime import cut

CAPACITY = 1024
END = 2

Segment = tuple[int, int, int, int, int]


def reduce_dominated(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets of up to three lengths; takes their pieces out of `counts`.

    A set that holds the longest open piece j dominates the others with j if their further pieces
    fit into its own. This holds for j alone when nothing fits beside it; for j and a piece that
    fills the sequence exactly; for j and the longest piece that fits when no two do; and for j, the
    longest a and then the longest b when no three fit and no pair beats b on its shorter piece.
    """
    fixed = []

    def fix(*pieces: int) -> None:
        times = min(counts[s] // pieces.count(s) for s in pieces)
        for s in pieces:
            counts[s] -= times
        fixed.append((pieces, times))

    def fitting(space: int, without: tuple[int, ...] = ()) -> int | None:
        """The longest open length up to `space`."""
        return next((s for s in range(min(space, capacity), 0, -1) if counts.get(s, 0) > without.count(s)), None)

    def smallest(n: int, without: int) -> int:
        """The least total of n open pieces beside one of length `without`."""
        total = 0
        for s in sorted(s for s, c in counts.items() if c):
            take = min(n, counts[s] - (s == without))
            total, n = total + take * s, n - take
            if not n:
                return total
        return capacity + 1

    for j in sorted(counts, reverse=True):
        while counts[j]:
            space = capacity - j
            a = fitting(space, (j,))
            if a is None:
                fix(j)
            elif a == space or smallest(2, j) > space:
                fix(j, a)
            elif smallest(3, j) > space:
                b = fitting(space - a, (j, a))
                if b is None:
                    break
                above = sorted(s for s, c in counts.items() if s > b for _ in range(min(2, c - (s == j))))
                if len(above) > 1 and above[0] + above[1] <= space:
                    break
                fix(j, a, b)
            else:
                break
    return fixed


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Segment], int]:
    """Segments that place all pieces, and the number of sequences."""
    left = {s: c for s, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    segments: list[Segment] = []
    n_sequences = 0

    def place(size: int, times: int, first: int, offset: int) -> None:
        segments.append((size, rank[size], times, first, offset))
        rank[size] += times

    open_ranges: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def offer(space: int, first: int, times: int) -> None:
        if space and times:
            if space not in open_ranges:
                open_ranges[space] = []
                heapq.heappush(spaces, space)
            open_ranges[space].append((first, times))

    for pieces, times in reduce_dominated(left, capacity):
        offset = 0
        for size in pieces:
            place(size, times, n_sequences, offset)
            offset += size
        offer(capacity - offset, n_sequences, times)
        n_sequences += times
    for size in sorted(left, reverse=True):
        n = left[size]
        for space in sorted(s for s in open_ranges if s >= size):
            while n and open_ranges.get(space):
                first, times = open_ranges[space].pop()
                each = space // size
                full = min(times, n // each)
                for level in range(each if full else 0):
                    place(size, full, first, capacity - space + level * size)
                offer_left = space - each * size
                n -= full * each
                if full:
                    offer(offer_left, first, full)
                if full < times and n:
                    for level in range(n):
                        place(size, 1, first + full, capacity - space + level * size)
                    offer(space - n * size, first + full, 1)
                    n, full = 0, full + 1
                if full < times:
                    open_ranges[space].append((first + full, times - full))
            if not open_ranges.get(space):
                open_ranges.pop(space, None)
            if not n:
                break
        if n:
            each = capacity // size
            full, rest = divmod(n, each)
            for level in range(each if full else 0):
                place(size, full, n_sequences, level * size)
            offer(capacity - each * size, n_sequences, full)
            n_sequences += full
            for level in range(rest):
                place(size, 1, n_sequences, level * size)
            if rest:
                offer(capacity - rest * size, n_sequences, 1)
                n_sequences += 1
    return segments, n_sequences


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, own_rank), the tokens of each document and an end token.

    Documents longer than the capacity are cut into pieces of that length, of which the first may be shorter.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = compiled(path)
        seen = [0] * (capacity + 1)
        for batch in runs(batches):
            rows: list[tuple] = []
            for doc_id, part, ids in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), bpe.encode(texts(batch)), strict=True):
                ids.append(END)
                coded = np.array(ids, "<u4").tobytes()
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((doc_id, k, lo, hi - lo, crc32(coded[4 * lo : 4 * hi]), part, seen[hi - lo]))
                    seen[hi - lo] += 1
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), *[pa.int64()] * 5], strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "own_rank"])

    marked = docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part"))
    return marked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, own_rank long")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are a piece of one end token. Documents of any length are packed whole;
    repeated rows are packed each. Pieces of equal length are placed in any order. Only doc_id and
    text are read; an empty table gives an empty result.
    """
    cut_up = cut(pieces(docs, capacity, vocabulary))
    by_task = cut(cut_up.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = plan(counts, capacity)
    table = np.array(sorted(segments), np.int64).reshape(-1, 5)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut_up.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("own_rank"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1] if batch.num_rows else table[:0]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in out[:5]], pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], names=out)

    return ranked.select(*out[:5], "rank").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
ORACLES: dict[str, str] = {}
