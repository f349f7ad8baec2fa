"""Customer segments: features, scaling, clustering, profiles, personas."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel, KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions import numbers
from gristmill.operators import sampling
from gristmill.operators.storage import partition_steps, partitions_of, stored

FEATURES = ("total_spend", "purchase_count", "avg_basket_size", "days_since_last_purchase")

# Number of clusters, seed, iterations, and the sweep over cluster numbers.
CLUSTERS = 5
SEED = 42
ITERATIONS = 20
ELBOW = (3, 4, 5, 6, 7)
#: Partial sums that one task adds up.
FAN = 16


def customer_features(orders: DataFrame) -> DataFrame:
    """Spend, number of purchases, mean purchase and days since the last one per customer.

    ``orders`` has customer_id, amount (exact) and order_date; recency counts from the
    latest date of the table.
    """
    latest = orders.select(F.max("order_date")).scalar()
    per_customer = orders.groupBy("customer_id").agg(
        F.sum("amount").cast("double").alias("total_spend"),
        F.count(F.lit(1)).alias("purchase_count"),
        numbers.ratio(F.sum("amount"), F.count("amount")).alias("avg_basket_size"),
        F.max("order_date").alias("_last"),
    )
    return per_customer.select(
        "customer_id", *FEATURES[:3], F.datediff(latest, "_last").cast("long").alias(FEATURES[3])
    )


def assembled(frame: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(frame)


def scaled(frame: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Features with mean 0 and sample deviation 1, as vector ``scaled_features``."""
    vectors = assembled(frame, columns)
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)
    return scaler.fit(vectors).transform(vectors)


def as_columns(vector: str, names: Sequence[str]) -> list[Column]:
    values = vector_to_array(F.col(vector))
    return [values[i].alias(name) for i, name in enumerate(names)]


def kmeans(frame: DataFrame, k: int = CLUSTERS, seed: int = SEED, iterations: int = ITERATIONS):
    return KMeans(featuresCol="scaled_features", predictionCol="cluster", k=k, seed=seed, maxIter=iterations).fit(frame)


class Shifted(NamedTuple):
    """A model of the scaled features plus ``shift``, used with the features themselves."""

    model: BisectingKMeansModel
    shift: float

    def clusterCenters(self) -> list[np.ndarray]:
        return [centre - self.shift for centre in self.model.clusterCenters()]

    def transform(self, frame: DataFrame) -> DataFrame:
        return self.model.transform(_shifted(frame, self.shift)).drop("shifted_features")


def _shifted(frame: DataFrame, shift: float) -> DataFrame:
    values = F.transform(vector_to_array("scaled_features"), lambda v: v + F.lit(shift))
    return frame.withColumn("shifted_features", array_to_vector(values))


def bisecting(frame: DataFrame, k: int = CLUSTERS, seed: int = SEED, iterations: int = ITERATIONS) -> Shifted:
    """The two halves of a cluster start at its centre, moved by a share of the centre's length.

    Scaled features have their centre at the origin, where nothing is moved and no cluster is found, so all values
    are shifted to 1 and above first.
    """
    low = frame.select(F.min(F.array_min(vector_to_array("scaled_features")))).first()[0]
    shift = 1.0 - (low or 0.0)
    estimator = BisectingKMeans(
        featuresCol="shifted_features", predictionCol="cluster", k=k, seed=seed, maxIter=iterations
    )
    return Shifted(estimator.fit(_shifted(frame, shift)), shift)


def centroids(model, frame: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """One row per cluster with its centre."""
    rows = [(i, *(float(v) for v in centre)) for i, centre in enumerate(model.clusterCenters())]
    schema = "cluster INT, " + ", ".join(f"{name} DOUBLE" for name in names)
    return frame.sparkSession.createDataFrame(rows, schema)


def cost(model, frame: DataFrame) -> float:
    """Sum of squared distances of the rows to the centres of their clusters.

    The cost that a fit states belongs to its rounds: it is that of centres before their last move, and after
    bisecting also of rows that had another cluster by then, so that it can be too low as well.
    """
    centres = F.array(*(F.array(*(F.lit(float(v)) for v in centre)) for centre in model.clusterCenters()))
    own = F.element_at(centres, F.col("cluster") + 1)
    squares = numbers.squared_distance(vector_to_array("scaled_features"), own)
    return float(model.transform(frame).agg(F.sum(squares)).first()[0])


def nearest(frame: DataFrame, centres: Sequence[Sequence[float]], values: str = "scaled_values") -> DataFrame:
    """Cluster and squared distance of the nearest of a few given centres, in plain SQL."""
    distances = [
        F.struct(
            numbers.squared_distance(F.col(values), F.array(*(F.lit(float(v)) for v in centre))).alias("distance"),
            F.lit(i).alias("cluster"),
        )
        for i, centre in enumerate(centres)
    ]
    best = F.array_min(F.array(*distances))
    return frame.withColumns({"cluster": best["cluster"], "squared_distance": best["distance"]})


def cost_by_cluster(assigned: DataFrame) -> DataFrame:
    """Size and within-cluster sum of squared distances."""
    return assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("squared_distance").alias("cost")
    )


def profile(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size and mean features of each cluster."""
    return assigned.groupBy(cluster).agg(
        F.count("customer_id").alias("customers"),
        F.round(F.avg("total_spend"), 2).alias("avg_spend"),
        F.round(F.avg("purchase_count"), 2).alias("avg_purchases"),
        F.round(F.avg("avg_basket_size"), 2).alias("avg_basket"),
        F.round(F.avg("days_since_last_purchase"), 2).alias("avg_recency"),
    )


def personas(profiles: DataFrame) -> DataFrame:
    """A label per cluster from rules against the mean and median over the clusters, first match wins.

    ``profiles`` has one row per cluster, so one window over all of them is small.
    """
    every = Window.partitionBy()
    mean = {c: F.avg(c).over(every) for c in ("avg_spend", "avg_purchases", "avg_recency")}
    median = {c: F.percentile(c, F.lit(0.5)).over(every) for c in mean}
    spend, purchases, recency = F.col("avg_spend"), F.col("avg_purchases"), F.col("avg_recency")
    # Factors and labels of the rules.
    label = (
        F.when(spend > mean["avg_spend"] * 1.5, "High-Value Loyal Customers")
        .when((purchases > mean["avg_purchases"] * 1.2) & (spend > median["avg_spend"]), "Frequent Moderate Spenders")
        .when(recency > mean["avg_recency"] * 1.3, "At-Risk Inactive Customers")
        .when((recency < median["avg_recency"]) & (purchases < median["avg_purchases"]), "New / Recent Bargain Buyers")
        .otherwise("Low-Value Occasional Customers")
    )
    return profiles.withColumn("persona", label)


def _packed(frame: DataFrame) -> DataFrame:
    """Scaled features as blocks of some thousand rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0).drop_null()
            packed = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([packed], type=pa.binary())], ["block"])

    return frame.select(vector_to_array("scaled_features")).mapInArrow(run, "block binary")


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            yield np.frombuffer(raw).reshape(-1, width)


def _added(blocks: DataFrame, parts: int, scan: Callable[[Iterator[np.ndarray]], np.ndarray], width: int) -> np.ndarray:
    """The sum over all tasks of what ``scan`` makes of a task's blocks, added up in a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.ascontiguousarray(scan(_matrices(batches, width)), dtype=np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], type=pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.frombuffer(raw) for batch in batches for raw in batch.column(0).to_pylist()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([sum(found).tobytes()], type=pa.binary())], ["sums"])

    summed = blocks.mapInArrow(run, "sums binary")
    while parts > FAN:
        parts = -(-parts // FAN)
        summed = summed.repartition(parts).mapInArrow(add, "sums binary")
    return sum(np.frombuffer(row["sums"]) for row in summed.collect())


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a column per centre; the dimensions are added in their order."""
    out = np.zeros((len(x), len(centres)))
    for d in range(x.shape[1]):
        step = x[:, d, None] - centres[None, :, d]
        out += step * step
    return out


def far_centres(blocks: DataFrame, parts: int, width: int, k: int) -> np.ndarray:
    """Rows far from each other: first the one farthest from the origin, then each time the one farthest from all so far.

    Equally far ones go by their values. The first few of them serve a smaller number of clusters.
    """
    chosen = np.zeros((1, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: tuple = ()
        for x in _matrices(batches, width):
            if len(x):
                far = _squares(x, chosen).min(axis=1)
                top = x[far == far.max()]
                best = min([b for b in (best,) if b] + [(-far.max(), *min(map(tuple, top)))])
        names = [f"v{i}" for i in range(width + 1)]
        yield pa.RecordBatch.from_arrays([pa.array([v] if best else [], type=pa.float64()) for v in best or names], names)

    schema = ", ".join(f"v{i} double" for i in range(width + 1))
    centres = []
    for _ in range(k):
        row = blocks.mapInArrow(run, schema).orderBy(*(f"v{i}" for i in range(width + 1))).first()
        if row is None:
            break
        centres.append(list(row)[1:])
        chosen = np.array(centres)
    return np.array(centres).reshape(-1, width)


def stacked_kmeans(frame: DataFrame, ks: Sequence[int], iterations: int = ITERATIONS) -> dict[int, tuple[np.ndarray, float]]:
    """Centres and cost for every number of clusters, each round of all of them in one scan of the rows.

    Rounds start from the same far rows (``far_centres``) and end when no centre moves, or after ``iterations``. A
    centre without rows stays where it is. The cost is the sum of squared distances to the final centres. Fewer rows
    than clusters give fewer centres; without rows the cost is 0.
    """
    first = frame.select(vector_to_array("scaled_features").alias("v")).first()
    width = len(first["v"]) if first else 1
    with stored(_packed(frame)) as blocks:
        parts = partitions_of(blocks)
        starts = far_centres(blocks, parts, width, max(ks)) if first else np.zeros((0, width))
        if not len(starts):
            return {k: (starts, 0.0) for k in ks}
        centres = {k: starts[:k] for k in ks}
        sizes = [len(c) * (width + 1) for c in centres.values()]

        def scan(matrices: Iterator[np.ndarray]) -> np.ndarray:
            total = [np.zeros(size + 1) for size in sizes]
            for x in matrices:
                counted = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                for sums, c in zip(total, centres.values()):
                    far = _squares(x, c)
                    at = far.argmin(axis=1)
                    cells = sums[:-1].reshape(len(c), width + 1)
                    for j in range(width + 1):
                        cells[:, j] += np.bincount(at, counted[:, j], len(c))
                    sums[-1] += far.min(axis=1).sum()
            return np.concatenate(total)

        for turn in range(iterations + 1):
            found, still = _added(blocks, parts, scan, width), True
            parts_of = np.split(found, np.cumsum([size + 1 for size in sizes])[:-1])
            costs = {k: float(sums[-1]) for k, sums in zip(ks, parts_of)}
            if turn == iterations:
                break
            moved = {}
            for k, sums in zip(ks, parts_of):
                cells = sums[:-1].reshape(-1, width + 1)
                moved[k] = np.where(cells[:, :1] > 0, cells[:, 1:] / np.maximum(cells[:, :1], 1), centres[k])
                still = still and np.array_equal(moved[k], centres[k])
            if still:
                break
            centres.update(moved)
    return {k: (centres[k], costs[k]) for k in ks}


def knee(costs: Sequence[tuple[int, float]]) -> int:
    """The number of clusters farthest below the straight line from the first to the last cost; the least of equals.

    Both axes are scaled to 0..1 first.
    """
    (k0, c0), (k1, c1) = costs[0], costs[-1]
    if k0 == k1 or c0 == c1:
        return k0
    gaps = [(1 - (k - k0) / (k1 - k0) - (c - c1) / (c0 - c1), -k) for k, c in costs]
    return -max(gaps)[1]


def elbow(frame: DataFrame, ks: Sequence[int] = ELBOW) -> DataFrame:
    """Cost per number of clusters, and which of them the knee of the costs suggests."""
    found = stacked_kmeans(frame, ks)
    best = knee([(k, found[k][1]) for k in ks])
    rows = [(k, found[k][1], k == best) for k in ks]
    return frame.sparkSession.createDataFrame(rows, "k INT, cost DOUBLE, chosen BOOLEAN")


def split_of_squares(assigned: DataFrame, names: Sequence[str] = FEATURES) -> DataFrame:
    """Sums of squares within and between the clusters of an assignment; together they are that of the table.

    ``assigned`` has cluster and scaled_features; one row: rows, clusters, within, between.
    """
    values = assigned.select("cluster", *as_columns("scaled_features", names))
    each = values.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        sum(F.var_pop(c) for c in names).alias("spread"),
        sum(F.avg(c) * F.avg(c) for c in names).alias("away"),
    )
    return each.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clusters"),
        F.sum(F.col("n") * F.col("spread")).alias("within"), F.sum(F.col("n") * F.col("away")).alias("between"),
    )


def method_comparison(frame: DataFrame, k: int = CLUSTERS) -> DataFrame:
    """K-Means beside bisecting K-Means: the cost of each."""
    rows = []
    with stored(frame.select("scaled_features")) as kept:
        for name, fit in (("k-means", kmeans), ("bisecting k-means", bisecting)):
            rows.append((name, k, cost(fit(kept, k), kept)))
    return frame.sparkSession.createDataFrame(rows, "method STRING, k INT, cost DOUBLE")


def partition_effect(frame: DataFrame, iterations: int = 10) -> DataFrame:
    """Seconds of the same fit over a quarter, half and all of the partitions."""
    rows = []
    for n in partition_steps(frame):
        with stored(frame.select("scaled_features").repartition(n)) as kept:
            start = time.perf_counter()
            model = kmeans(kept, CLUSTERS, SEED, iterations)
            rows.append((n, float(model.summary.trainingCost), time.perf_counter() - start))
    return frame.sparkSession.createDataFrame(rows, "partitions INT, cost DOUBLE, seconds DOUBLE")


def plane(frame: DataFrame, sample_size: int | None = None, key: str = "customer_id") -> DataFrame:
    """Two principal components per row; the components come from all rows.

    ``sample_size`` keeps exactly so many rows of the result, for a plot.
    """
    model = PCA(k=2, inputCol="scaled_features", outputCol="components").fit(frame)
    shown = frame if sample_size is None else sampling.exactly(frame, key, sample_size)
    others = [c for c in frame.columns if c not in ("features", "scaled_features")]
    return model.transform(shown).select(*others, *as_columns("components", ("pc1", "pc2")))
