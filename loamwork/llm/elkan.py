"""Centroid clustering of integer vectors with Elkan's bounds.

Each vector carries an upper bound of the distance to its centroid and a lower bound to each of the k
centroids from round to round. When centroids move, bounds are widened by the way that they moved. A
distance is computed only where neither the bounds nor half the distance between two centroids rules
the other centroid out. Bounds are rounded away from the truth and rule out strictly farther centroids
only, so that ties stay; distances that decide are exact integers.

A round is one pass over the vectors in place: tasks return sums for each centroid, which are added up
before k of them reach the driver. Nothing is shuffled but these sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamwork.runtime import written

K = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = "2"
#: Components are held to this, so that squared distances of up to 128 components fit 64 bits.
LARGEST = 1 << 27

_STATE = "id long, v binary, cluster int, upper double, lower binary"


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x, np.inf)


def _root_up(squared: np.ndarray) -> np.ndarray:
    return _up(_up(np.sqrt(squared.astype(np.float64))))


def _root_down(squared: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.nextafter(np.sqrt(squared.astype(np.float64)), -np.inf), -np.inf), 0)


def _narrow_down(x: np.ndarray) -> np.ndarray:
    """Single precision, never above x."""
    return np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), 0)


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.clip(np.floor(scale * values.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


class Bounds:
    """What a round knows of its centroids: how far each has moved, and how far they lie apart."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.centroids = centroids
        self.moved = np.zeros(len(centroids)) if before is None else _root_up(squared(centroids, before))
        self.half = np.stack([_root_down(squared(centroids, c)) / 2 for c in centroids])
        apart = self.half + np.diag(np.full(len(centroids), np.inf))
        self.nearest = apart.min(axis=1)

    def assign(self, v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """New clusters and bounds, and the number of distances that had to be computed."""
        cluster, lower = cluster.copy(), lower.astype(np.float64)
        upper = _up(upper + self.moved[cluster])
        lower = np.maximum(np.nextafter(lower - self.moved, -np.inf), 0)
        open_ = np.flatnonzero(upper >= self.nearest[cluster])
        every = np.arange(len(self.centroids))
        doubt = (lower[open_] <= upper[open_, None]) & (self.half[cluster[open_]] <= upper[open_, None]) & (every != cluster[open_, None])
        open_ = open_[doubt.any(axis=1)]
        # the distance to the own centroid first, which often settles the rest
        best = np.zeros(len(v), np.int64)
        best[open_] = squared(v[open_], self.centroids[cluster[open_]])
        upper[open_] = _root_up(best[open_])
        lower[open_, cluster[open_]] = _root_down(best[open_])
        computed = len(open_)
        for c in range(len(self.centroids)):
            own, limit = cluster[open_], upper[open_]
            rows = open_[(own != c) & (lower[open_, c] <= limit) & (self.half[own, c] <= limit)]
            if not len(rows):
                continue
            computed += len(rows)
            d = squared(v[rows], self.centroids[c])
            lower[rows, c] = _root_down(d)
            closer = (d < best[rows]) | ((d == best[rows]) & (c < cluster[rows]))
            to = rows[closer]
            cluster[to], best[to], upper[to] = c, d[closer], _root_up(d[closer])
        return cluster, upper, _narrow_down(lower), computed


def _rows(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """A column of equally long byte strings as a matrix."""
    if not len(column):
        return np.zeros((0, width), dtype)
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    size = np.dtype(dtype).itemsize * width
    return np.frombuffer(column.buffers()[2], np.uint8)[start : start + size * len(column)].view(dtype).reshape(len(column), width)


def _binary(matrix: np.ndarray) -> pa.Array:
    matrix = np.ascontiguousarray(matrix)
    size = matrix.itemsize * matrix.shape[1]
    offsets = np.arange(0, size * (len(matrix) + 1), size, dtype=np.int32) if size else np.zeros(len(matrix) + 1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(offsets), pa.py_buffer(matrix.tobytes())])


def _state(ids: pa.Array, v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, _binary(v.astype(np.int32)), pa.array(cluster, pa.int32()), pa.array(upper), _binary(lower)], names=["id", "v", "cluster", "upper", "lower"])


def _first(kept: DataFrame, centroids: np.ndarray, dim: int, scale: int) -> DataFrame:
    bounds = Bounds(centroids, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = integers(batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), scale)
            none = np.zeros((len(v), len(centroids)), np.float32)
            cluster, upper, lower, _ = bounds.assign(v, np.zeros(len(v), np.int64), _root_up(squared(v, centroids[0])), none)
            yield _state(batch.column("id"), v, cluster, upper, lower)

    return kept.mapInArrow(run, _STATE)


def _next(state: DataFrame, centroids: np.ndarray, before: np.ndarray, dim: int) -> DataFrame:
    bounds = Bounds(centroids, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _rows(batch.column("v"), np.int32, dim).astype(np.int64)
            cluster, upper, lower, _ = bounds.assign(v, batch.column("cluster").to_numpy().astype(np.int64), batch.column("upper").to_numpy(), _rows(batch.column("lower"), np.float32, len(centroids)))
            yield _state(batch.column("id"), v, cluster, upper, lower)

    return state.mapInArrow(run, _STATE)


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids with the floor of their vectors' means; one without vectors stays. At most k rows come to the driver."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            counts += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, _rows(batch.column("v"), np.int32, dim))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = state.select("cluster", "v").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dim)]).alias("sums"))
    new = centroids.copy()
    for row in total.collect():
        new[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return new


def _distances(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _rows(batch.column("v"), np.int32, dim).astype(np.int64)
            d = squared(v, centroids[batch.column("cluster").to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(d)], names=["id", "cluster", "distance"])

    return state.select("id", "v", "cluster").mapInArrow(run, "id long, cluster int, distance long")


@dataclass
class Clustering:
    """`assigned` has (id, cluster, distance) of every kept vector, `centroids` the final ones, of which there may be fewer than k."""

    assigned: DataFrame
    centroids: np.ndarray


def is_kept(vector: Column, dim: int) -> Column:
    """Whether a vector has `dim` components, all of them finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & (F.size(vector) == dim) & F.forall(vector, finite)


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> Clustering:
    """Group vectors around k centroids.

    A vector with another number of components, or with one that is null, infinite or no number, is
    left out. Components become floor(scale * x), held to 2^27 on both sides. The first centroids are
    the k vectors whose `seed:id` has the smallest sha256; vectors of one id are taken in their own
    order, and those without an id are no first centroid, but are grouped with the others. With fewer
    vectors than k there are as many centroids as vectors with an id; without any the result is empty.
    Repeated rows count as often as they stand. Other columns are not read.

    State between rounds is held by the executors and computed anew, round by round, where one is lost;
    each round's centroids are part of its plan. Only the result is written.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector")).where(is_kept(F.col("vector"), dim))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.where(F.col("id").isNotNull()).orderBy(drawn, "vector").limit(k).collect()
    if not first:
        return Clustering(spark.createDataFrame([], "id long, cluster int, distance long"), np.zeros((0, dim), np.int64))
    centroids = integers(np.array([r["vector"] for r in first]), scale)
    state = _first(kept, centroids, dim, scale).persist()
    for _ in range(rounds):
        before, centroids = centroids, _means(state, centroids)
        last, state = state, _next(state, centroids, before, dim).persist()
        if (centroids == before).all():
            # bounds stay as they are, so that nothing can change any more
            state.unpersist()
            state = last
            break
        state.select("cluster").write.format("noop").mode("overwrite").save()
        last.unpersist()
    assigned = written(_distances(state, centroids))
    state.unpersist()
    return Clustering(assigned, centroids)


def clusters(vectors: DataFrame, **how: object) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector; see cluster(). A sum beyond 64 bits is null."""
    found = cluster(vectors, **how)
    spark = vectors.sparkSession
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    sums = {r["cluster"]: r["total"] for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    held = lambda x: int(x) if x < 1 << 63 else None
    # a row for each centroid that has vectors, at most k
    facts = spark.createDataFrame([(c, held(s), held(sum(sums.values())), digests[c]) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.assigned.join(F.broadcast(facts), "cluster")
    return joined.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_elkan_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(k: int = K, rounds: int = ROUNDS, dim: int = DIM) -> str:
    steps = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS c, v FROM kept WHERE vec_id IS NOT NULL ORDER BY sha256('{SEED}:' || vec_id), v LIMIT {k})""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best FROM (
  SELECT rid, vec_id, kept.v, c, CAST(list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM kept, c{r}) GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
  SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) AS g(i) GROUP BY 1, 2) GROUP BY c) AS m ON m.c = c{r}.c)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""


QUERIES = {"op12_elkan_clusters": op12_elkan_clusters}
ORACLES = {"op12_elkan_clusters": _sql()}
