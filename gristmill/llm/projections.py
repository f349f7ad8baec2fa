"""Operator 6: near-duplicate embeddings by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm.common import U, components, mix, stored

#: Projections that are counted, the half width of a query's window in standard deviations of a pair at the
#: threshold, and the projections that must collide. By the binomial law a linked pair passes with 0.9996.
COUNTED, WINDOW, NEEDED = 16, 2.5, 13
#: Width of the intervals that cut the line of a partitioning projection, in the same deviations.
INTERVAL = 6.0
#: Vectors that a table's cell should hold on average, and the recall that the tables together must reach.
CELL, RECALL = 200, 0.999
#: Vectors of a block; a cell with more is compared block by block.
BLOCK = 1000
SEED = 1


def _normal(rows: int, dimensions: int, salt: int) -> np.ndarray:
    """Fixed random directions: the same on every executor and in every run."""
    return np.random.default_rng([SEED, salt, dimensions]).standard_normal((rows, dimensions))


def deviation(cosine: float) -> float:
    """Standard deviation of the projected difference of two unit vectors at that cosine."""
    return math.sqrt(2 - 2 * cosine)


def layout(vectors: int) -> tuple[int, int]:
    """Partitioning projections per table, and tables, for that many vectors of one label.

    A random pair shares an interval with probability ``q``, a pair at the threshold with ``p``; the number of
    projections follows the table, the number of tables makes up for what they lose.
    """
    p, q = 1 - math.sqrt(2 / math.pi) / INTERVAL, 0.5
    cuts = max(1, math.ceil(math.log(max(2.0, vectors / CELL)) / math.log(1 / q)))
    return cuts, math.ceil(math.log(1 - RECALL) / math.log(1 - p**cuts))


def _cells(cuts: int, tables: int, cosine: float):
    step = INTERVAL * deviation(cosine)

    def run(unit: pd.Series) -> pd.Series:
        out = [None] * len(unit)
        grid = [np.asarray(x, dtype=np.float64) for x in unit]
        by_size: dict[int, list[int]] = {}
        for i, x in enumerate(grid):
            by_size.setdefault(len(x), []).append(i)
        for size, rows in by_size.items():
            lines = _normal(tables * cuts, size, 1)
            shift = np.random.default_rng([SEED, 2]).random(tables * cuts)
            at = np.floor(np.stack([grid[i] for i in rows]) @ lines.T / step + shift).astype(np.int64)
            h = mix(np.full((len(rows), tables), U(size), dtype=np.uint64))
            at = at.reshape(len(rows), tables, cuts).view(np.uint64)
            for c in range(cuts):
                h = mix(h + at[:, :, c])
            for i, row in zip(rows, h.view(np.int64)):
                out[i] = row
        return pd.Series(out)

    return run


def _unit(vectors: pd.Series) -> pd.Series:
    """Vectors of length one in double precision; None where there is no direction."""
    out = []
    for x in vectors:
        unit = None
        if x is not None and len(x):
            v = np.array([np.nan if c is None else c for c in x], dtype=np.float64)
            top = np.abs(v).max()
            if np.isfinite(v).all() and top > 0:
                v = v / top
                unit = v / math.sqrt(float(v @ v))
        out.append(unit)
    return pd.Series(out)


def _forest(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the edges that join what is not yet joined."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i, k in edges:
        x, y = find(i), find(k)
        if x != y:
            parent[x] = y
            kept.append((i, k))
    return kept


def _linked(unit: np.ndarray, cells: np.ndarray, side: np.ndarray | None, table: int, cosine: float) -> tuple:
    """Index pairs linked in one block pair, each only in the first table where the two share a cell."""
    half = WINDOW * deviation(cosine)
    shadow = unit @ _lines(unit.shape[1]).T
    order = np.argsort(shadow[:, 0], kind="stable")
    unit, shadow, cells = unit[order], shadow[order], cells[order]
    found: tuple[list, list] = ([], [])
    for start in range(0, len(unit), 256):
        query = slice(start, min(len(unit), start + 256))
        # On the first, sorted projection the windows are a stretch; the others are counted inside it.
        low = np.searchsorted(shadow[:, 0], shadow[query][0, 0] - half)
        high = np.searchsorted(shadow[:, 0], shadow[query][-1, 0] + half, "right")
        near = np.abs(shadow[query, None, :] - shadow[None, low:high, :]) <= half
        i, k = np.nonzero(near.sum(axis=2, dtype=np.uint8) >= NEEDED)
        i, k = i + start, k + low
        use = i < k if side is None else (side[order[i]] == 0) & (side[order[k]] == 1)
        i, k = i[use], k[use]
        for part in range(0, len(i), 65536):
            x, y = i[part : part + 65536], k[part : part + 65536]
            linked = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            x, y = x[linked], y[linked]
            new = ~(cells[x, :table] == cells[y, :table]).any(axis=1)
            found[0].append(order[x[new]])
            found[1].append(order[y[new]])
    return tuple(np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in found)


_known_lines: dict[int, np.ndarray] = {}


def _lines(dimensions: int) -> np.ndarray:
    if dimensions not in _known_lines:
        _known_lines[dimensions] = _normal(COUNTED, dimensions, 3)
    return _known_lines[dimensions]


#: Columns that tell the groups of a sorted partition apart.
GROUP = ["spot", "label_hash", "at", "cell", "one", "two"]


def _links(cosine: float):
    """Over sorted rows: a degree per vector (b is null) and the edges of a spanning forest, group by group.

    A group is a pair of blocks, so at most about two blocks of rows are held between batches.
    """
    names = ["a", "b", "n"]

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([rows.column(c).to_numpy() for c in GROUP])
        first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
        nodes = rows.column("node").to_pylist()
        sides, copies = rows.column("side").to_numpy(), rows.column("copies").to_numpy()
        flat = {c: _rows_of(rows.column(c)) for c in ("unit", "cells")}
        out: tuple[list, list, list] = ([], [], [])
        for start, end in zip(first, np.append(first[1:], rows.num_rows)):
            if end - start < 2:
                continue
            diagonal = keys[4, start] == keys[5, start]
            unit, cells = (np.stack(flat[c][start:end]) for c in ("unit", "cells"))
            i, k = _linked(unit, cells, None if diagonal else sides[start:end], int(keys[2, start]), cosine)
            if len(i):
                degree = np.bincount(i, copies[start + k], end - start) + np.bincount(k, copies[start + i], end - start)
                some = np.flatnonzero(degree)
                edges = _forest(list(zip(i.tolist(), k.tolist())))
                out[0].extend([nodes[start + x] for x in some] + [nodes[start + x] for x, _ in edges])
                out[1].extend([None] * len(some) + [nodes[start + y] for _, y in edges])
                out[2].extend([int(degree[x]) for x in some] + [0] * len(edges))
        kinds = (pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(out, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]) if held is not None else rows
            if not rows.num_rows:
                continue
            last = [rows.column(c)[rows.num_rows - 1].as_py() for c in GROUP]
            same = np.logical_and.reduce([rows.column(c).to_numpy() == v for c, v in zip(GROUP, last)])
            cut = int(np.argmax(same))
            held = rows.slice(cut).combine_chunks()
            if cut:
                yield from solve(rows.slice(0, cut).combine_chunks())
        if held is not None and held.num_rows:
            yield from solve(held)

    return run


def _rows_of(column: pa.ChunkedArray) -> list[np.ndarray]:
    """A list column as one array per row, cut from a single flat one."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, cuts = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    cuts = cuts - cuts[0]
    return [flat[x:y] for x, y in zip(cuts[:-1], cuts[1:])]


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Links between vectors of equal label whose cosine reaches the threshold, and their components.

    ``vectors`` needs vec_id, embedding and label. One row per input row: vec_id, n_links (other rows linked
    directly), component_id (smallest vec_id reachable), kept. A label that is null, a vector that is null,
    empty, zero or holds a null or non-finite component links with nothing; vectors of different length are not
    compared. Equal vectors of one label are one class: their links are counted, not listed. Rows that share a
    vec_id are separate rows. Other columns are ignored.

    Projections on random lines cut the space into cells, several times over, so that only neighbours meet;
    inside a cell every vector counts, over the sorted and the other counted projections, in how many a
    neighbour lies within its window, and pairs that reach the calibrated count are verified. Pairs of vectors
    that no table brings together are missed with a probability of 0.1 % at the threshold, less above it.
    """
    found = F.pandas_udf(_unit, T.ArrayType(T.DoubleType()))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.when(F.col("label").isNotNull(), found("embedding")).alias("unit"), F.col("embedding"),
    )
    # Classes are equal embeddings of a label, told apart by 128 bits; the sign of zero does not matter.
    plain = F.transform("unit", lambda x: x + F.lit(0.0))
    rows = stored(
        rows.select(
            "vec_id", "label", "unit",
            F.when(F.col("unit").isNotNull(), F.xxhash64("label", plain)).alias("c1"),
            F.xxhash64(plain, "label", F.lit(7)).alias("c2"),
        ), "vectors",
    )
    classes = rows.where("c1 IS NOT NULL").groupBy("label", "c1", "c2").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.min("unit").alias("unit")
    )
    node = F.concat(F.hex("c1"), F.lit("-"), F.hex("c2"))
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    cuts, tables = layout(most)
    cells = F.pandas_udf(_cells(cuts, tables, cosine), T.ArrayType(T.LongType()))
    classes = stored(classes.withColumn("node", node).withColumn("cells", cells("unit")), "vector-classes")
    spots = classes.select("label", "node", "unit", "cells", "copies", F.posexplode("cells").alias("at", "cell"))
    sizes = spots.groupBy("label", "at", "cell").agg(F.count("*").alias("size")).where("size > 1")
    spots = spots.join(sizes, ["label", "at", "cell"]).withColumn("blocks", F.expr(f"int(ceil(size / {BLOCK}))"))
    own = F.expr("pmod(xxhash64(node), blocks)").cast("int")
    spots = spots.withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    spots = spots.select(
        F.xxhash64("label", "at", "cell").alias("spot"), F.xxhash64("label").alias("label_hash"), "at", "cell",
        F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
        "node", "unit", "cells", "copies",
    )
    # Sorted groups instead of one call per group: most cells hold a few vectors.
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = spots.repartition(parts, *GROUP).sortWithinPartitions(*GROUP)
    links = stored(met.mapInArrow(_links(cosine), "a string, b string, n long"), "vector-links")
    degrees = links.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
    parts = components(links.where("b IS NOT NULL").select("a", "b"), "vector-parts")
    known = (
        classes.select("label", "c1", "c2", "copies", "first_id", "node")
        .join(degrees.withColumnRenamed("a", "node"), "node", "left")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    ids = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = known.join(ids, "component").select(
        "c1", "c2", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.select("vec_id", "c1", "c2").join(known, ["c1", "c2"], "left")
    component = F.when(F.col("c1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
