"""Operator 1: near-duplicate documents by min-max hashing.

Every hash function gives two signature values, the smallest and the largest hash of a document's shingles, so
the signature costs half the hash evaluations. Bands of the signature bring similar documents into one candidate
cluster; inside a cluster the full shingle sets decide.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import LOWER, U, arrow_rows, components, mix, shingle_hashes, signed, stored

#: 150 hash functions, 300 values, 50 bands of 6: a pair at similarity 0.8 is missed with probability 2.5e-7.
FUNCTIONS, BAND_ROWS = 150, 6
BANDS = 2 * FUNCTIONS // BAND_ROWS
_A = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * U(0xA24BAED4963EE407)) | U(1)
_B = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * U(0x9FB21C651E98DF25))
#: Documents and shingles of a block; clusters of any size are cut into blocks of about this size.
BLOCK_DOCUMENTS, BLOCK_SHINGLES = 1000, 1_000_000
PIVOTS = 4


def signature(shingles: np.ndarray) -> np.ndarray:
    """Smallest, then largest value under every hash function."""
    low = np.full(FUNCTIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(FUNCTIONS, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        values = shingles[None, at : at + 2048] * _A[:, None] + _B[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_hashes(values: np.ndarray) -> np.ndarray:
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    grid = values.reshape(BANDS, BAND_ROWS)
    for i in range(BAND_ROWS):
        h = mix(h + grid[:, i])
    return h


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever the order of its members."""
    a, b = mix(shingles ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64), mix(shingles + U(len(shingles))).sum(dtype=np.uint64)
    return int(np.int64(a)), int(np.int64(b))


def _profiles(size: int):
    def make(columns: list[list]) -> list:
        ids, texts = columns
        counts, ones, twos, bands = [], [], [], []
        for text in texts:
            s = shingle_hashes((text or b"").translate(LOWER), size)
            one, two = fingerprint(s) if len(s) else (None, None)
            counts.append(len(s))
            ones.append(one)
            twos.append(two)
            bands.append(signed(band_hashes(signature(s))) if len(s) else None)
        return [ids, counts, ones, twos, bands]

    return make


def _sets(size: int):
    def make(columns: list[list]) -> list:
        sets = [s for s in (shingle_hashes((t or b"").translate(LOWER), size) for t in columns[0]) if len(s)]
        marks = [fingerprint(s) for s in sets]
        return [[one for one, _ in marks], [two for _, two in marks], [s.tobytes() for s in sets]]

    return make


def _linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Index pairs whose sets meet the threshold; ``right`` None means all pairs of ``left``."""
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    code = np.concatenate(sets)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    new = np.empty(len(code), dtype=bool)
    new[0] = True
    np.not_equal(code[1:], code[:-1], out=new[1:])
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids) > 1
    column = np.cumsum(shared) - 1
    use = shared[ids]
    owner, ids = owner[use], column[ids[use]]
    n, m = len(left), len(right or left)
    both = np.zeros((n, m), dtype=np.float32)
    width = 4096
    cuts = np.searchsorted(ids, np.arange(0, (ids[-1] + 1 if len(ids) else 0) + width, width))
    for a, b in zip(cuts[:-1], cuts[1:]):
        grid = np.zeros((len(sets), width), dtype=np.float32)
        grid[owner[a:b], ids[a:b] % width] = 1
        both += grid[:n] @ (grid[n:] if right is not None else grid).T
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    one, two = sizes[:n, None], (sizes[n:] if right is not None else sizes)[None, :]
    inter = both.astype(np.int64)
    return np.argwhere(100 * inter >= percent * (one + two - inter))


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the linked pairs."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((a, b))
    return edges


def _read(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint64) for x in column]


def _block_links(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets, nodes = _read(group["members"]), group["node"].tolist()
        edges = _forest(_linked(sets, None, percent), len(sets)) if len(sets) > 1 else []
        return pd.DataFrame({"a": [nodes[x] for x, _ in edges], "b": [nodes[y] for _, y in edges]}, dtype="object")

    return run


def _cross_links(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        one, two = group[group["outlier"]], group[~group["outlier"]]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": []}, dtype="object")
        pairs = _linked(_read(one["members"]), _read(two["members"]), percent)
        pairs = pairs + np.array([0, len(one)])
        nodes = one["node"].tolist() + two["node"].tolist()
        edges = _forest(pairs, len(nodes))
        return pd.DataFrame({"a": [nodes[x] for x, _ in edges], "b": [nodes[y] for _, y in edges]}, dtype="object")

    return run


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose word-shingle sets have Jaccard similarity of at least ``percent`` / 100.

    ``documents`` needs doc_id and text; other columns are ignored. The result has one row for each input row:
    doc_id, n_shingles, component_id (smallest doc_id reachable), kept. Null or wordless texts have no shingles
    and are linked with nothing. Rows that share a doc_id are judged by their own texts. A null doc_id is never
    the smallest; alone it stays its own component.

    Equal sets are one class from the start. A class with very many documents is one node, a cluster with very
    many classes is cut into blocks: each block compares all its classes and a few pivots of the cluster, and
    classes that are not in the cluster's largest component afterwards are compared with every block.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiles = stored(
        arrow_rows(rows, _profiles(size), "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"), "minmax"
    )
    filled = profiles.where("f1 IS NOT NULL")
    banded = filled.select("f1", F.explode("bands").alias("band"))
    # What is joined back by a key that many rows share is written first: only between two plain exchanges does
    # adaptive execution split such a key.
    buckets = banded.groupBy("band").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where("low < high")
    near = banded.join(stored(buckets.select("band", "low"), "minmax-buckets"), "band").where("f1 <> low")
    clusters = components(near.select(F.col("f1").alias("a"), F.col("low").alias("b")), "minmax-clusters")

    node = F.concat(F.hex("f1"), F.lit("-"), F.hex("f2"))
    first = filled.groupBy("f1", "f2").agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    members = first.join(clusters.select(F.col("node").alias("f1"), "component"), "f1")
    members = members.withColumn("cluster", F.col("component")).drop("component")
    # The texts of one document of each class; where ids repeat, the fingerprint picks the right row.
    texts = rows.join(members.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = arrow_rows(texts.select("text"), _sets(size), "f1 long, f2 long, members binary").dropDuplicates(["f1", "f2"])
    sets = members.join(sets, ["f1", "f2"]).select(node.alias("node"), "cluster", "n", "members")
    per_cluster = members.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count("*") / F.lit(BLOCK_DOCUMENTS))
        ).cast("int").alias("blocks"),
        *[F.min(F.struct(F.xxhash64(F.lit(i), "f1", "f2"), node)).getField("col2").alias(f"p{i}") for i in range(PIVOTS)],
    )
    sets = sets.join(stored(per_cluster, "minmax-sizes"), "cluster").withColumn("block", F.expr("pmod(hash(node), blocks)"))
    sets = stored(
        sets.withColumn("pivot", F.expr(" OR ".join(f"node = p{i}" for i in range(PIVOTS)))).drop(
            *[f"p{i}" for i in range(PIVOTS)]
        ),
        "minmax-sets",
    )
    spread = sets.withColumn(
        "block", F.explode(F.when(F.col("pivot"), F.expr("sequence(0, blocks - 1)")).otherwise(F.array("block")))
    )
    edge = "a string, b string"
    links = stored(
        spread.select("cluster", "block", "node", "members")
        .groupBy("cluster", "block")
        .applyInPandas(_block_links(percent), edge),
        "minmax-links",
    )
    parts = stored(components(links, "minmax-parts"), "minmax-parts")

    wide = sets.where("blocks > 1").join(parts, "node", "left")
    wide = stored(wide.withColumn("part", F.coalesce("component", "node")).drop("component"), "minmax-wide")
    largest = (
        wide.groupBy("cluster", "part").agg(F.count("*").alias("c"))
        .groupBy("cluster").agg(F.max(F.struct("c", "part")).getField("part").alias("largest"))
    )
    marked = wide.join(stored(largest, "minmax-largest"), "cluster").withColumn("outlier", F.col("part") != F.col("largest"))
    shares = marked.where("outlier").groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count("*") / F.lit(BLOCK_DOCUMENTS))
        ).cast("int").alias("rows")
    )
    marked = marked.join(stored(shares, "minmax-shares"), "cluster")
    columns = ["cluster", "row", "block", "node", "members", "outlier"]
    left = (
        marked.where("outlier")
        .withColumn("row", F.expr("pmod(xxhash64(node), rows)").cast("int"))
        .withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    right = marked.withColumn("row", F.explode(F.expr("sequence(0, rows - 1)"))).withColumn("outlier", F.lit(False))
    more = (
        left.select(*columns).unionByName(right.select(*columns))
        .groupBy("cluster", "row", "block").applyInPandas(_cross_links(percent), edge)
    )
    final = components(links.unionByName(more), "minmax-final")

    roots = first.withColumn("node", node).join(final, "node", "left")
    roots = roots.select("f1", "f2", "first_id", F.coalesce("component", "node").alias("component"))
    ids = roots.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = roots.join(stored(ids, "minmax-ids"), "component").select("f1", "f2", "component_id")
    out = profiles.join(found, ["f1", "f2"], "left").withColumn(
        "component_id", F.when(F.col("f1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
