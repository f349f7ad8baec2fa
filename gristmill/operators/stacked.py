"""Many logistic regressions over one set of messages, fitted together.

Fits that differ in their setting or in the rows they learn from read the same term counts. Every scan of the
messages computes the loss and the gradient of all fits that still need one, so a sweep costs about as many scans as
its longest fit, and each fit takes the steps that it would take alone.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import ranking
from gristmill.operators.storage import partitions_of, stored

#: Penalty, most iterations, share of the absolute part of the penalty.
Setting = tuple[float, int, float]
#: Steps that the curvature is estimated from, relative change of the loss that ends a fit, rows of a block, and
#: partial sums that one task adds up.
MEMORY, TOLERANCE, BLOCK_ROWS, FAN = 10, 1e-6, 4096, 16


class Fit(NamedTuple):
    """A setting, and the name of the rows to learn from."""

    rows: str
    setting: Setting


@dataclass
class Linear:
    """A fitted model: a weight per term (for its plain count in a message) and an intercept.

    ``coefficients`` are the same weights for the counts times inverse document frequency.
    """

    terms: list[str]
    weights: np.ndarray
    coefficients: np.ndarray
    intercept: float
    train_rows: int


# ---- features ----------------------------------------------------------------------------------------


def with_terms(messages: DataFrame) -> DataFrame:
    """``terms``: the distinct words of each message that are not stop words, with their counts."""
    stop = StopWordsRemover.loadDefaultStopWords("english")
    kept = F.filter(text.tokens(F.col("message_text")), lambda word: ~word.isin(*stop))
    pieces = messages.withColumn("_pieces", F.sort_array(kept))
    return pieces.withColumn("terms", text.runs(F.col("_pieces"))).drop("_pieces")


class _Statistics(NamedTuple):
    """Of one set of rows: rows, positive rows, and per term of the union vocabulary its scaled deviation and mean."""

    rows: int
    positives: int
    idf: np.ndarray
    scale: np.ndarray
    centre: np.ndarray


def _statistics(messages: DataFrame, sets: Sequence[str], size: int, least: int) -> tuple[list[str], dict[str, _Statistics]]:
    """The vocabulary of every set in one aggregate: its ``size`` most frequent terms of ``least`` messages or more."""
    member = {name: F.col("rows").getItem(i) for i, name in enumerate(sets)}
    totals = messages.agg(
        *(F.count_if(m).alias(f"n{i}") for i, m in enumerate(member.values())),
        *(F.count_if(m & (F.col("label_idx") == 1.0)).alias(f"p{i}") for i, m in enumerate(member.values())),
    ).first()
    counts = messages.select("rows", F.inline("terms")).groupBy("term").agg(
        *(
            F.struct(
                F.lit(i).alias("set"), F.count_if(m).alias("df"), F.sum(F.when(m, F.col("tf"))).alias("occurrences"),
                F.sum(F.when(m, F.col("tf") * F.col("tf"))).alias("squares"),
            ).alias(f"s{i}")
            for i, m in enumerate(member.values())
        )
    )
    each = counts.select("term", F.inline(F.array(*(f"s{i}" for i in range(len(sets)))))).where(F.col("df") >= least)
    top = ranking.first_n_per_group(each, "set", "occurrences", "term", size).collect()
    terms = sorted({row["term"] for row in top})
    at = {term: i for i, term in enumerate(terms)}
    found = {}
    for i, name in enumerate(sets):
        n = totals[f"n{i}"]
        idf, scale, centre = (np.zeros(len(terms)) for _ in range(3))
        for row in top:
            if row["set"] == i:
                weight, mean = np.log((n + 1) / (row["df"] + 1)), row["occurrences"] / n
                spread = max(row["squares"] - n * mean * mean, 0.0) / max(n - 1, 1)
                j = at[row["term"]]
                idf[j] = weight
                if weight * spread > 0:
                    scale[j] = 1 / np.sqrt(spread)
                    centre[j] = mean * scale[j]
        found[name] = _Statistics(n, totals[f"p{i}"], idf, scale, centre)
    return terms, found


def _pieces(lists: pa.ListArray, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term number and count of every term of the vocabulary in a column of term counts."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    inside = lists.flatten()
    number = pc.index_in(inside.field("term"), terms)
    known = pc.is_valid(number).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    counts = inside.field("tf").to_numpy(zero_copy_only=False)
    return row[known], number.drop_null().to_numpy(zero_copy_only=False), counts[known].astype(np.float64)


BLOCK = "n int, labels binary, members binary, row binary, term binary, tf binary"
#: What the packed columns of a block hold.
KINDS = (np.float64, np.bool_, np.int32, np.int32, np.float64)


def _blocks(messages: DataFrame, terms: list[str]) -> DataFrame:
    """Messages as packed sparse rows, some thousand in a row of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, type=pa.string())
        names = [part.split()[0] for part in BLOCK.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(start, BLOCK_ROWS)
                row, term, tf = _pieces(some.column(2), known)
                members = some.column(1).flatten().to_numpy(zero_copy_only=False)
                labels = some.column(0).to_numpy(zero_copy_only=False)
                packed = (labels, members, row, term.astype(np.int32), tf)
                columns = [pa.array([some.num_rows], type=pa.int32())]
                columns += [pa.array([np.ascontiguousarray(p).tobytes()], type=pa.binary()) for p in packed]
                yield pa.RecordBatch.from_arrays(columns, names)

    return messages.select("label_idx", "rows", "terms").mapInArrow(run, BLOCK)


# ---- one scan for all fits ---------------------------------------------------------------------------


def _sums(
    blocks: DataFrame, parts: int, sets: np.ndarray, width: int, weights: np.ndarray, intercepts: np.ndarray
) -> np.ndarray:
    """Per fit: summed loss, summed residual, and the residuals times the counts of each term.

    ``weights`` has a row per fit; ``sets`` says which of the ``width`` sets of rows a fit learns from. The sums of
    ``parts`` tasks are added up in a tree; the driver adds the last few.
    """
    fits, size = weights.shape

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((fits, size + 2))
        for batch in batches:
            for i in range(batch.num_rows):
                # The batch holds many blocks, so they are read where they are, without a copy.
                n = batch.column(0)[i].as_py()
                labels, members, row, term, tf = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), dtype=kind) for c, kind in enumerate(KINDS, 1)
                )
                members = members.reshape(n, width)
                for k in range(fits):
                    margin = np.bincount(row, tf * weights[k, term], n) + intercepts[k]
                    own = members[:, sets[k]]
                    residual = np.where(own, 1 / (1 + np.exp(-np.clip(margin, -700, 700))) - labels, 0.0)
                    total[k, 0] += (np.logaddexp(0.0, margin) - labels * margin)[own].sum()
                    total[k, 1] += residual.sum()
                    total[k, 2:] += np.bincount(term, tf * residual[row], size)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(fits * (size + 2))
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total = total + np.frombuffer(raw)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], ["sums"])

    summed = blocks.mapInArrow(scan, "sums binary")
    while parts > FAN:
        parts = -(-parts // FAN)
        summed = summed.repartition(parts).mapInArrow(add, "sums binary")
    total = np.zeros(fits * (size + 2))
    for row in summed.collect():
        total = total + np.frombuffer(row["sums"])
    return total.reshape(fits, size + 2)


# ---- the steps of a fit ------------------------------------------------------------------------------


def minimise(start: np.ndarray, absolute: np.ndarray, iterations: int, tolerance: float = TOLERANCE) -> Generator:
    """Limited-memory quasi-Newton steps, for absolute penalties inside the orthant of the point.

    Yields points and is sent ``(value, gradient)`` of the smooth part there; returns the last point. ``absolute``
    holds the absolute penalty of each coordinate.
    """
    x, history = start, []
    value, slope = yield x
    whole = value + absolute @ np.abs(x)
    for _ in range(iterations):
        lean = _steepest(x, slope, absolute)
        direction = _direction(lean, history)
        direction[(direction * lean >= 0) & (absolute > 0)] = 0.0
        if direction @ lean >= 0:
            direction, history = -lean, []
        if not direction.any():
            break
        orthant = np.where(x != 0, np.sign(x), -np.sign(lean))
        step = 1.0 if history else min(1.0, 1 / np.linalg.norm(lean))
        for _ in range(30):
            point = x + step * direction
            point = np.where((absolute > 0) & (point * orthant < 0), 0.0, point)
            new_value, new_slope = yield point
            new_whole = new_value + absolute @ np.abs(point)
            if new_whole <= whole + 1e-4 * (lean @ (point - x)):
                break
            step /= 2
        else:
            break
        moved, turned = point - x, new_slope - slope
        if moved @ turned > 1e-12 * (turned @ turned):
            history = [*history, (moved, turned)][-MEMORY:]
        change = whole - new_whole
        x, slope, whole = point, new_slope, new_whole
        if change <= tolerance * max(abs(whole), 1e-12):
            break
    return x


def _steepest(x: np.ndarray, slope: np.ndarray, absolute: np.ndarray) -> np.ndarray:
    """The gradient with the absolute penalty; zero where no side of zero is lower."""
    at_zero = np.sign(slope) * np.maximum(np.abs(slope) - absolute, 0.0)
    return np.where(x == 0, at_zero, slope + absolute * np.sign(x))


def _direction(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out, parts = -slope, []
    for moved, turned in reversed(history):
        part = (moved @ out) / (moved @ turned)
        out = out - part * turned
        parts.append(part)
    if history:
        moved, turned = history[-1]
        out = out * ((moved @ turned) / (turned @ turned))
    for (moved, turned), part in zip(history, reversed(parts)):
        out = out + moved * (part - (turned @ out) / (moved @ turned))
    return out


def stacked_fits(
    messages: DataFrame, sets: Mapping[str, Column], fits: Sequence[Fit], size: int, least: int,
    tolerance: float = TOLERANCE,
) -> list[Linear]:
    """A model per fit, from ``label_idx`` and ``terms`` of the messages.

    ``sets`` says which rows belong to each named set. A set has a vocabulary, document frequencies, means and
    deviations of its own, as if it were fitted alone; features are centred and scaled, and the penalty applies to
    them in that form. The driver holds the vocabularies and, per fit, a few vectors of their length.
    """
    names = list(sets)
    marked = messages.withColumn("rows", F.array(*(F.coalesce(c, F.lit(False)) for c in sets.values())))
    terms, statistics = _statistics(marked, names, size, least)
    runs, points, solved = [], {}, {}
    for k, fit in enumerate(fits):
        own, (penalty, iterations, mix) = statistics[fit.rows], fit.setting
        absolute = np.append(np.full(len(terms), penalty * mix), 0.0)
        rate = min(max(own.positives / max(own.rows, 1), 1e-9), 1 - 1e-9)
        run = minimise(np.append(np.zeros(len(terms)), np.log(rate / (1 - rate))), absolute, iterations, tolerance)
        runs.append(run)
        points[k] = next(run)
    with stored(_blocks(marked, terms)) as blocks:
        parts = partitions_of(blocks)
        while points:
            live = sorted(points)
            own = [statistics[fits[k].rows] for k in live]
            weights = np.stack([points[k][:-1] * s.scale for k, s in zip(live, own)])
            intercepts = np.array([points[k][-1] - points[k][:-1] @ s.centre for k, s in zip(live, own)])
            at = np.array([names.index(fits[k].rows) for k in live])
            for k, s, sums in zip(live, own, _sums(blocks, parts, at, len(names), weights, intercepts)):
                x, quadratic = points[k], fits[k].setting[0] * (1 - fits[k].setting[2])
                value = sums[0] / max(s.rows, 1) + quadratic / 2 * (x[:-1] @ x[:-1])
                slope = np.append(s.scale * sums[2:] - s.centre * sums[1], sums[1]) / max(s.rows, 1)
                slope[:-1] += quadratic * x[:-1]
                try:
                    points[k] = runs[k].send((value, slope))
                except StopIteration as done:
                    solved[k] = done.value
                    del points[k]
    out = []
    for k, fit in enumerate(fits):
        own, x = statistics[fit.rows], solved[k]
        weights = x[:-1] * own.scale
        shares = np.divide(weights, own.idf, out=np.zeros_like(weights), where=own.idf > 0)
        out.append(Linear(terms, weights, shares, float(x[-1] - x[:-1] @ own.centre), own.rows))
    return out


def with_margins(messages: DataFrame, models: Sequence[Linear], *keep: str) -> DataFrame:
    """The columns ``keep`` and ``margins``: the log odds of every model, all from one scan.

    The models are of one call of ``stacked_fits``, so they share their list of terms.
    """
    names = [*keep, "margins"]
    terms, weights = models[0].terms, np.stack([m.weights for m in models])
    intercepts = np.array([m.intercept for m in models])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, type=pa.string())
        for batch in batches:
            row, term, tf = _pieces(batch.column(len(keep)), known)
            margins = np.stack([np.bincount(row, tf * w[term], batch.num_rows) for w in weights], axis=1) + intercepts
            flat = pa.array(margins.ravel())
            lists = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * len(weights), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists], names)

    kept = messages.select(*keep, "terms")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, margins array<double>")


def probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
