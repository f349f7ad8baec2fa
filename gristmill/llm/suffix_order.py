"""Operator 10: repeated passages of bytes, by sorting suffixes in range partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gristmill.llm.repeats import remove_repeats

BYTES = 400


def _equal_runs(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(head) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(head)))


def _per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal suffix heads of a batch become one row, so a head that all documents share stays small."""
    for batch in batches:
        lead, head, content = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        order = np.argsort(head, kind="stable")
        lead, head, content = lead[order], head[order], content[order]
        first, count = _equal_runs(head)
        if len(first):
            least, most = np.minimum.reduceat(content, first), np.maximum.reduceat(content, first)
            columns = (lead[first], head[first], count.astype(np.int64), least, most)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["lead", "head", "n", "least", "greatest"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare neighbours of a sorted bucket, the last head of a batch with the first of the next."""
    names = ["head", "least", "greatest"]
    held: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        head, n, least, most = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("head", "n", *names[1:]))
        if held is not None:
            head, n, least, most = (np.append([a], b) for a, b in zip(held, (head, n, least, most)))
        first, _ = _equal_runs(head)
        head, n = head[first], np.add.reduceat(n, first)
        least, most = np.minimum.reduceat(least, first), np.maximum.reduceat(most, first)
        held = (head[-1], n[-1], least[-1], most[-1])
        keep = np.flatnonzero(n[:-1] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (head, least, most)], names)
    if held is not None and held[1] > 1:
        yield pa.RecordBatch.from_arrays([pa.array([held[i]], type=pa.int64()) for i in (0, 2, 3)], names)


def by_order(runs: DataFrame) -> DataFrame:
    """Suffix heads met more than once: range-partitioned at sampled splitters, sorted, compared with neighbours.

    The key of a suffix is its first eight bytes, in their order, then a fingerprint of its whole head, so equal
    heads are neighbours. A splitter never falls between equal keys: across the boundary of two buckets the
    neighbours differ. Spark's sorter orders a bucket, as it spills where the bucket outgrows its memory.
    """
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = runs.mapInArrow(_per_task, "lead long, head long, n long, least long, greatest long")
    ordered = small.repartitionByRange(parts, "lead", "head").sortWithinPartitions("lead", "head")
    return ordered.mapInArrow(_neighbours, "head long, least long, greatest long")


def remove_repeated_bytes(documents: DataFrame, width: int = BYTES) -> DataFrame:
    """Remove every byte that a string of ``width`` bytes covers which also starts anywhere else.

    Suffixes are sorted at positions that the content chooses (see ``repeats``) by their first bytes: a sixth
    of the window, all but 40 bytes of it, then the whole. Each level sorts only the suffixes whose shorter
    heads met an equal neighbour.

    One row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256. Texts are
    UTF-8; null counts as empty; short texts lose nothing. Rows that are equal in doc_id and text count as two
    documents: each repeats the other. Other columns are ignored. Strings are judged on the input.
    """
    depths = (max(1, width // 6), max(1, width - width // 10), width)
    return remove_repeats(documents, "byte", width, depths, by_order).withColumnRenamed("n", "n_bytes")
