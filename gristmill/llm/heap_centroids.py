"""Operator 11: centroid clustering whose clusters keep their vectors in a heap of bound gaps."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import list_matrix, new_path, stored

#: Distances are sums of squares in 64 bits: exact while no scaled component reaches this.
LARGEST = 2**27
#: What rounding may take from a gap: vectors this near to expiry are looked at again.
MARGIN = 1e-3
ROWS = "vec_id long, x array<int>"
HEAP = ROWS + ", was int, cluster int, key double"


class Heap:
    """The heaps of all clusters: one folder per round, its rows sorted by the key they were pushed with.

    A key is a gap plus the drift of its cluster at that time. Drift never falls, so what it has used up is a range
    of keys, and an entry is gone once it has been popped: nothing is rewritten.
    """

    def __init__(self, frame: DataFrame) -> None:
        self.spark, self.folder = frame.sparkSession, new_path(frame.sparkSession, "cluster-heap")
        self.pushed = 0
        self.spent: list[float] = []

    def push(self, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/turn={self.pushed}"
        rows.sortWithinPartitions("cluster", "key").write.option("compression", "zstd").parquet(path)
        self.pushed += 1
        return self.spark.read.schema(HEAP).parquet(path)

    def _entries(self) -> DataFrame:
        """Entries that have not been popped; those of the last round have not been looked at yet."""
        rows = self.spark.read.schema(HEAP + ", turn int").parquet(self.folder)
        if not self.spent:
            return rows
        return rows.where((F.col("turn") == self.pushed - 1) | ~_used_up(self.spent))

    def pop(self, drift: list[float]) -> DataFrame:
        popped = self._entries().where(_used_up(drift)).drop("turn")
        self.spent = list(drift)
        return popped

    def waiting(self) -> DataFrame:
        return self._entries().drop("turn")


def _used_up(drift: list[float]) -> Column:
    due = [(F.col("cluster") == c) & (F.col("key") <= d + MARGIN) for c, d in enumerate(drift)]
    return reduce(lambda a, b: a | b, due)


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """``vec_id, x``: floor(scale * component) of vectors with ``size`` components, none null or non-finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, matrix = list_matrix(batch.column(1), size)
            scaled = np.floor(matrix * float(scale))
            if scaled.size and np.abs(scaled).max() >= LARGEST:
                raise ValueError(f"a component reaches {LARGEST // scale}: distances would not be exact")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), _lists(scaled)], ["vec_id", "x"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, ROWS)


def _lists(matrix: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(matrix, dtype=np.int32).ravel())
    return pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], flat)


def _matrix(lists: pa.ListArray, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per vector and a column per centroid."""
    out = np.empty((len(x), len(centroids)), dtype=np.int64)
    for c, centre in enumerate(centroids):
        step = x - centre
        out[:, c] = np.einsum("ij,ij->i", step, step)
    return out


def _scan(centroids: np.ndarray, drift: list[float]):
    """Exact scans of popped rows: the nearest centroid, and the gap to the second nearest as the key to push."""
    offsets = np.array(drift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), centroids.shape[1])
            far = distances(x, centroids)
            cluster = far.argmin(axis=1)
            rows = np.arange(len(x))
            upper = np.sqrt(far[rows, cluster])
            far[rows, cluster] = np.iinfo(np.int64).max
            lower = np.sqrt(far.min(axis=1)) if len(centroids) > 1 else np.full(len(x), np.inf)
            key = lower - upper + offsets[cluster]
            columns = [batch.column(0), batch.column(1), batch.column(2)]
            made = [pa.array(cluster.astype(np.int32)), pa.array(key)]
            yield pa.RecordBatch.from_arrays(columns + made, ["vec_id", "x", "was", "cluster", "key"])

    return run


def _partial_sums(size: int):
    """What the rows of a task add to the members and the sums of each cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.concatenate([np.ones((batch.num_rows, 1), dtype=np.int64), _matrix(batch.column(0), size)], axis=1)
            for side, sign in ((2, 1), (1, -1)):
                at = batch.column(side).to_numpy(zero_copy_only=False)
                for c in np.unique(at[at >= 0]):
                    sums[int(c)] = sums.get(int(c), 0) + sign * x[at == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), type=pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))],
            ["cluster", "sums"],
        )

    return run


def _added(generation: DataFrame, size: int) -> dict[int, list[int]]:
    """Members and sums that the moves of a generation add to each cluster: one row per cluster and dimension."""
    moved = generation.where("cluster <> was").select("x", "was", "cluster")
    parts = moved.mapInArrow(_partial_sums(size), "cluster int, sums array<long>")
    cells = parts.select("cluster", F.posexplode("sums").alias("at", "part"))
    out: dict[int, list[int]] = {}
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    for row in cells.groupBy("cluster", "at").agg(total).collect():
        out.setdefault(row["cluster"], [0] * (size + 1))[row["at"]] = int(row["total"])
    return out


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; equal ids go by their components, null ids last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    chosen = rows.orderBy(digest.asc_nulls_last(), "x").limit(clusters).collect()
    return np.array([row["x"] for row in chosen], dtype=np.int64)


def cluster_vectors(
    vectors: DataFrame, size: int = 64, clusters: int = 8, rounds: int = 10, scale: int = 1024, seed: int = 3
) -> DataFrame:
    """Lloyd's rounds over whole-number vectors, exact to the last unit, without looking at every vector each round.

    ``vectors`` needs vec_id and embedding; other columns are ignored. One row per vector with exactly ``size``
    components, none null or non-finite; repeated rows are separate rows, an id may be null (such a vector starts
    no centroid while there are others). Columns: vec_id, cluster, distance (squared, to the final centroid),
    cluster_inertia and inertia (distance summed over the cluster and over all; null where a sum leaves 64 bits),
    centroid_sha256 of the final centroid's components. With fewer vectors than clusters every vector starts one;
    an empty table gives no rows. A component of ``LARGEST / scale`` or more is an error.

    Every vector carries the gap between the bound on its second-nearest centroid and that on its own. Instead of
    touching all bounds when centroids move, a cluster adds up the drift that can close its gaps; a vector expires
    when the drift passes the key it was pushed with. A cluster's heap is a table sorted by that key, a folder per
    round: what expires is a range of keys, so the scan skips the rest, and popped rows are scanned exactly and
    pushed into a new table. Centroid sums follow from the vectors that changed cluster. The driver holds the
    centroids and their sums; each table is written once and outlives lost executors.
    """
    rows = stored(whole_vectors(vectors, size, scale), "cluster-rows")
    centroids = first_centroids(rows, clusters, seed)
    k = len(centroids)
    if not k:
        kinds = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return rows.sparkSession.createDataFrame([], kinds)
    drift = [0.0] * k
    totals = [[0] * (size + 1) for _ in range(k)]
    heap = Heap(rows)
    popped = rows.withColumn("was", F.lit(-1))
    for turn in range(rounds + 1):
        pushed = popped.select("vec_id", "x", "was").mapInArrow(_scan(centroids, drift), HEAP)
        generation = heap.push(pushed)
        if turn == rounds:
            break
        for c, added in _added(generation, size).items():
            totals[c] = [a + b for a, b in zip(totals[c], added)]
        moved = [[s // t[0] for s in t[1:]] if t[0] else old.tolist() for t, old in zip(totals, centroids)]
        steps = [math.sqrt(sum((a - int(b)) ** 2 for a, b in zip(new, old))) for new, old in zip(moved, centroids)]
        if not any(steps):
            break
        centroids = np.array(moved, dtype=np.int64)
        for c in range(k):
            drift[c] += steps[c] + max((s for j, s in enumerate(steps) if j != c), default=0.0)
        popped = heap.pop(drift).withColumn("was", F.col("cluster"))
    return _with_inertia(heap.waiting(), centroids)


def _with_inertia(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = _matrix(batch.column(1), centroids.shape[1]) - centroids[batch.column(2).to_numpy()]
            far = pa.array(np.einsum("ij,ij->i", step, step))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), far], ["vec_id", "cluster", "distance"])

    measured = placed.select("vec_id", "x", "cluster").mapInArrow(run, "vec_id long, cluster int, distance long")
    measured = stored(measured, "cluster-distances")
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {row["cluster"]: int(row["total"]) for row in measured.groupBy("cluster").agg(total).collect()}
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def long(value: int) -> Column:
        return F.lit(value if value < 2**63 else None).cast("long")

    at = F.col("cluster") + 1
    return measured.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[long(sums.get(c, 0)) for c in range(len(centroids))]), at).alias("cluster_inertia"),
        long(sum(sums.values())).alias("inertia"),
        F.element_at(F.array(*[F.lit(n) for n in names]), at).alias("centroid_sha256"),
    )
