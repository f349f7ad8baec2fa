"""Embedding links against all pairs."""

from __future__ import annotations

import math

import brute
import numpy as np
import pytest

from gristmill.llm import projections, queries


def around(seed, groups, size, dimensions=32, noise=0.02, labels=2):
    rng = np.random.default_rng(seed)
    rows, vec_id = [], 0
    for g in range(groups):
        centre = rng.standard_normal(dimensions)
        for _ in range(size):
            v = centre / np.linalg.norm(centre) + noise * rng.standard_normal(dimensions)
            rows.append((vec_id, [float(x) for x in v], g % labels))
            vec_id += 1
    return rows


SCHEMA = "vec_id bigint, embedding array<double>, label int"


def found(frame):
    return sorted(tuple(r) for r in projections.near_vectors(frame).collect())


def recall(ours, exact):
    linked = sum(row[1] for row in exact)
    assert all(a[1] <= b[1] for a, b in zip(ours, exact))
    return sum(row[1] for row in ours) / linked


def test_recall(spark):
    rows = around(1, 150, 6, noise=0.025)
    assert recall(found(spark.createDataFrame(rows, SCHEMA)), brute.links(rows, 0.98)) >= 0.99


def test_blocks(spark, monkeypatch):
    rows = around(2, 4, 60, noise=0.01)
    monkeypatch.setattr(projections, "BLOCK", 25)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute.links(rows, 0.98)


@pytest.mark.parametrize("vectors", [2, 1000, 10**6, 10**9])
def test_layout_reaches_the_recall(vectors):
    cuts, tables = projections.layout(vectors)
    p = 1 - math.sqrt(2 / math.pi) / projections.INTERVAL
    assert 1 - (1 - p**cuts) ** tables >= projections.RECALL and tables < 200


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    ours = sorted(tuple(r) for r in queries.op6_embedding_near_dedup(spark, sf_dir).collect())
    assert ours == brute.links(rows, 0.98)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [1.0, inf], 1), (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2),
        (12, [1e-300, 1e-302], 1), (13, [1e300, -1e298], 1), (14, [1.0, -0.0], 1), (15, [-1.0, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "n", 1) for r in rows], f"{SCHEMA}, node string, cells int")
    assert found(frame) == brute.links(rows, 0.98)
    twice = spark.createDataFrame([(1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (None, [1.0, 0.5], 1)], SCHEMA)
    result = sorted((tuple(r) for r in projections.near_vectors(twice).collect()), key=repr)
    assert result == [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False)]


def test_no_vectors(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
