"""Operator 11 against plain rounds over all vectors."""

import hashlib

import numpy as np
import pytest

from gristmill.llm import heap_centroids
from conftest import rows as sorted_rows

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, cluster string, key double, turn int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "c", 0.0, 9) for i, v in vectors], SCHEMA)


def plain(vectors, size, clusters=8, rounds=10):
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by Python's own whole numbers."""
    kept = [
        (i, [int(np.floor(1024 * np.float64(np.float32(c)))) for c in v])
        for i, v in vectors
        if v is not None and len(v) == size and all(c is not None and np.isfinite(c) for c in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in order[:clusters]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centres)) for _, x in kept]

    for _ in range(rounds):
        at = [k for _, k in nearest()]
        for k in range(len(centres)):
            own = [x for (_, x), c in zip(kept, at) if c == k]
            if own:
                centres[k] = [sum(column) // len(own) for column in zip(*own)]
    best = nearest()
    sums = [sum(d for d, k in best if k == c) for c in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, k, d, sums[k], sum(sums), names[k]) for (i, _), (d, k) in zip(kept, best)), key=repr)


def clouds(seed, n, size, spread):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(5, size))
    at = draw.integers(0, 5, n)
    found = middles[at] + spread * draw.normal(size=(n, size))
    return [(int(i), [float(c) for c in np.float32(v)]) for i, v in enumerate(found)]


@pytest.mark.parametrize("seed, spread", [(1, 0.1), (2, 0.7), (3, 3.0)])
def test_equal_to_plain_rounds(spark, seed, spread):
    vectors = clouds(seed, 250, 6, spread)
    found = heap_centroids.cluster_vectors(frame(spark, vectors), size=6)
    assert sorted_rows(found) == plain(vectors, 6)


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    grid = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(64)]
    odd = [
        (100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [nan, 1.0]), (105, [inf, 0.0]),
        (106, [0.0, 0.0]), (107, [-0.0, -2.5]), (None, [1.5, -7.25]), (5, [1.0, 1.0]), (5, [1.0, 1.0]),
    ]
    found = heap_centroids.cluster_vectors(frame(spark, grid + odd), size=2)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted_rows(found) == plain(grid + odd, 2)


def test_few_and_no_vectors(spark):
    few = [(3, [1.0, 2.0]), (1, [5.0, 5.0]), (2, [5.0, 5.0])]
    assert sorted_rows(heap_centroids.cluster_vectors(frame(spark, few), size=2)) == plain(few, 2)
    none = heap_centroids.cluster_vectors(frame(spark, []), size=2)
    assert none.collect() == [] and none.columns[0] == "vec_id"


def test_one_group_of_copies_holds_most_rows(spark):
    vectors = clouds(4, 60, 4, 1.0) + [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(600)]
    found = heap_centroids.cluster_vectors(frame(spark, vectors), size=4, clusters=5)
    assert sorted_rows(found) == plain(vectors, 4, clusters=5)


def test_only_expired_vectors_are_scanned(spark, monkeypatch):
    """Far apart clusters: what is pushed after the first rounds is a small part of what Lloyd's rounds would scan."""
    vectors = clouds(5, 400, 8, 0.05)
    pushed, plain_push = [], heap_centroids.Heap.push

    def push(self, rows):
        made = plain_push(self, rows)
        pushed.append(made.count())
        return made

    monkeypatch.setattr(heap_centroids.Heap, "push", push)
    heap_centroids.cluster_vectors(frame(spark, vectors), size=8).count()
    assert pushed[0] == 400 and sum(pushed[2:]) < 400 * (len(pushed) - 2) / 2


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="distances would not be exact"):
        heap_centroids.cluster_vectors(frame(spark, [(1, [2.0**20, 0.0])]), size=2).collect()
