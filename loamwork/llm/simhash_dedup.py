"""SimHash near-dedup: fingerprints within two bits of each other are linked through deletion variants.

A 64-bit fingerprint is cut into two segments, fewer than a plain pigeonhole index would need, so
that of two fingerprints that differ in at most two bits one segment differs in at most one. Every
segment is indexed 32 times, each time with another bit replaced by a wildcard: two segments that
differ in at most one bit share a variant. An equality join on (segment, wildcard, remaining bits)
finds the candidates, its residual condition counts their differing bits, and a canonical choice of
variant reports every pair once.

Equal fingerprints are collapsed before anything is joined, so copies cost nothing. A bucket of the
index that holds many distinct fingerprints is not compared pair by pair: its members agree in 31
bits, and the other 33 are cut once more into three pieces, one of which two linked fingerprints
share (see `_refined`). Links and components stay on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.llm.common import documents, runs, text_bytes, text_hash
from loamwork.operators.components import connected_components
from loamwork.runtime import written

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Distinct fingerprints in one bucket of the index beyond which the bucket is cut again.
BUCKET = 256


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
        hashes = list(map(xxhash.xxh64_intdigest, grams, repeat(SEED)))
    values = np.array(hashes, dtype="<u8")
    bits = np.unpackbits(values.view(np.uint8), bitorder="little").reshape(-1, 64)
    # counts of up to 255 rows fit a byte; summing bytes first keeps the arrays narrow
    counts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(bits), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tid, fp): fp holds the 64 bits of the fingerprint as a signed long; tid, the text's hash, tells texts of one id apart."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches):
            found = np.array([simhash(t, shingle) for t in text_bytes(batch)], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tid"), pa.array(found)], names=["doc_id", "tid", "fp"])

    return docs.select("doc_id", text_hash().alias("tid"), "text").mapInArrow(compute, "doc_id long, tid long, fp long")


def _segments(fp: Column) -> tuple[Column, Column]:
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return low, F.shiftrightunsigned(fp, 32)


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp), 64 for each fp; a key is the segment's number, the wildcard's place and the other 31 bits."""
    low, high = _segments(F.col("fp"))
    keys = F.array(
        *[
            segment.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << i)).cast("long")).bitwiseOR(F.lit((s << 40) | (i << 32)).cast("long"))
            for s, segment in enumerate((low, high))
            for i in range(32)
        ]
    )
    return fps.select(F.explode(keys).alias("key"), "fp")


def _reported(a: str, b: str, max_bits: int) -> Column:
    """Whether the pair is linked and this is the one variant that reports it.

    Linked segments that are equal share all their variants and report by wildcard 0; those that
    differ in one bit share that bit's variant. A pair that both segments find is left to the first.
    """
    x = F.col(a).bitwiseXOR(F.col(b))
    low, high = _segments(x)
    second = F.shiftright(F.col("key"), 40) == 1
    place = F.shiftright(F.col("key"), 32).bitwiseAND(F.lit(63).cast("long"))
    own = F.when(second, high).otherwise(low)
    wildcard = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
    chosen = (own == wildcard) | ((own == 0) & (place == 0))
    return (F.col(a) < F.col(b)) & (F.bit_count(x) <= max_bits) & chosen & (~second | (F.bit_count(low) > 1))


def linked_pairs(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b), each pair of distinct fingerprints in `fps` that differ in at most `max_bits` bits, a < b as signed numbers, once."""
    if not 0 < max_bits <= 2:
        raise ValueError("two segments with one wildcard find at most two differing bits")
    # 64 rows come of one: dealt before by a fixed number, as adaptive execution merges small partitions
    index = _variants(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"))
    sizes = index.groupBy("key").agg(F.count("*").alias("n"))
    crowded = sizes.where(F.col("n") > bucket).select("key")
    usual = index.join(sizes.where((F.col("n") > 1) & (F.col("n") <= bucket)).select("key"), "key", "left_semi")
    full = index.join(crowded, "key", "left_semi")
    return _joined(usual, ["key"], max_bits).unionByName(_joined(_refined(full), ["key", "piece", "bits"], max_bits).distinct())


def _refined(full: DataFrame) -> DataFrame:
    """Each row three times, with one third of the 33 bits that its key leaves open.

    The open bits are the other segment and the wildcard. Two linked fingerprints differ in at most
    two of them, so at least one of the three pieces is equal.
    """
    low, high = _segments(F.col("fp"))
    second = F.shiftright(F.col("key"), 40) == 1
    other = F.when(second, low).otherwise(high)
    own = F.when(second, high).otherwise(low)
    wild = F.when(own == F.col("key").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.lit(0)).otherwise(F.lit(1)).cast("long")
    open_bits = F.shiftleft(other, 1).bitwiseOR(wild)
    pieces = F.array(*[F.shiftright(open_bits, 11 * k).bitwiseAND(F.lit(0x7FF).cast("long")) for k in range(3)])
    return full.select("key", "fp", F.posexplode(pieces).alias("piece", "bits"))


def _joined(rows: DataFrame, on: list[str], max_bits: int) -> DataFrame:
    a = rows.withColumnRenamed("fp", "a")
    b = rows.withColumnRenamed("fp", "b")
    return a.join(b, on).where(_reported("a", "b", max_bits)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, tid, fp, component_id, n_links): component_id is the smallest doc_id reachable over links.

    Null, empty and blank texts have fingerprint 0, which is linked like any other; texts of any
    length are read whole. Repeated rows give equal fingerprints. A null doc_id takes part in its
    fingerprint's component without naming it. n_links counts the distinct fingerprints linked to
    the document's own. Only doc_id and text are read; an empty table gives an empty result.
    """
    marked = written(fingerprints(docs, shingle))
    groups = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    pairs = written(linked_pairs(groups.select("fp"), max_bits))
    parts = connected_components(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    linked = groups.join(parts.withColumnRenamed("node", "fp"), "fp")
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "component").join(degree, "fp").select("fp", "component_id", "n_links")
    # written first, so that the join stands alone above its exchanges and may be split at a frequent fingerprint
    whole = written(groups.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return marked.join(whole, "fp").select("doc_id", "tid", "fp", "component_id", "n_links")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


QUERIES = {"op4_simhash_dedup": op4_simhash_dedup}
ORACLES: dict[str, str] = {}
