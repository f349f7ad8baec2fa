"""Operator 13: whitening by a QR reduction of the rows and a bidiagonal singular value solver."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold, list_matrix

#: Scaled components must stay below this, so that sums of a task and differences are exact.
LARGEST = 2.0**40
#: Directions whose singular value is a smaller part of the largest one are rounding, not variance.
RANK = 1e-11
#: Neighbouring singular values closer than this (relative) are one cluster of directions.
CLUSTER = 1e-3
EPS = np.finfo(float).eps


# ---- the solver: a small triangular matrix, on the driver ---------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections from both sides: diagonal, superdiagonal, and the product of those from the right."""
    a = np.array(r, dtype=float)
    p = len(a)
    right = np.eye(p)
    for k in range(p):
        v = _reflector(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < p - 2:
            v = _reflector(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    # Signs of a bidiagonal matrix move into its vectors: both diagonals become non-negative.
    diagonal, upper = np.diag(a).copy(), np.diag(a, 1).copy()
    sign = 1.0
    for k in range(p - 1):
        row = math.copysign(1.0, diagonal[k]) * sign
        nxt = math.copysign(1.0, upper[k]) * row
        right[:, k + 1] *= nxt
        sign = nxt
    return np.abs(diagonal), np.abs(upper), right


def _reflector(x: np.ndarray) -> np.ndarray | None:
    top = np.abs(x).max()
    if top == 0:
        return None
    v = x / top
    v[0] += math.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues, largest first, of the matrix with quotients ``q`` and differences ``e`` (squares of a bidiagonal).

    Differential quotient-difference steps with shifts: only positive numbers are added, multiplied and divided,
    so small values keep their relative accuracy. A shift that would turn a quotient negative is taken back.
    """
    q, e = list(map(float, q)), list(map(float, e))
    found, moved = [], 0.0
    while q:
        if len(q) == 1:
            found.append(q[0] + moved)
            break
        if e[-1] <= EPS * EPS * (q[-1] + moved):
            found.append(q.pop() + moved)
            e.pop()
            continue
        if q[0] * 1.5 < q[-1]:
            q.reverse()
            e.reverse()
        shift = _shift(q, e)
        for attempt in range(4):
            step = _step(q, e, shift if attempt < 3 else 0.0)
            if step is not None:
                break
            shift /= 8
        q, e = step
        moved += shift if attempt < 3 else 0.0
    return np.sort(found)[::-1]


def _shift(q: list[float], e: list[float]) -> float:
    """A guess below the smallest eigenvalue: that of the last two by two, less what couples it to the others."""
    a, b, c = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
    low = (a + c) / 2 - math.hypot((a - c) / 2, math.sqrt(b))
    couple = math.sqrt(q[-3] * e[-2]) if len(e) > 1 else 0.0
    return max(0.0, min(low - couple, q[-1]) * (1 - 4 * EPS))


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    d, quotients, differences = q[0] - shift, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        total = d + e[k]
        if total == 0:
            ratio, part = 0.0, q[k + 1]
            d = part - shift
        else:
            ratio = q[k + 1] / total
            part, d = e[k] * ratio, d * ratio - shift
        quotients.append(total)
        differences.append(0.0 if total == 0 else part)
    if d < 0:
        return None
    return quotients + [d], differences


def twisted(d: np.ndarray, l: np.ndarray, value: float) -> tuple[float, np.ndarray]:
    """The eigenvector of L D L' near ``value``: factorised from both ends, joined where the residual is smallest.

    Returns the Rayleigh correction of ``value`` too.
    """
    p = len(d)
    tiny = EPS * EPS * (abs(value) + d.max())
    s, below = np.empty(p), np.empty(p - 1)
    s[0] = -value
    for i in range(p - 1):
        pivot = s[i] + d[i] or tiny
        below[i] = d[i] * l[i] / pivot
        s[i + 1] = below[i] * l[i] * s[i] - value
    t, above = np.empty(p), np.empty(p - 1)
    t[-1] = d[-1] - value
    for i in range(p - 2, -1, -1):
        pivot = d[i] * l[i] * l[i] + t[i + 1] or tiny
        ratio = d[i] / pivot
        above[i] = l[i] * ratio
        t[i] = t[i + 1] * ratio - value
    gamma = s + t + value
    r = int(np.abs(gamma).argmin())
    z = np.zeros(p)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -below[i] * z[i + 1]
    for i in range(r, p - 1):
        z[i + 1] = -above[i] * z[i]
    size = float(z @ z)
    return float(gamma[r]) / size, z / math.sqrt(size)


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a triangular matrix, largest first, and its right singular vectors as columns."""
    p, top = len(r), np.abs(r).max(initial=0.0)
    if not top:
        return np.zeros(p), np.eye(p)
    diagonal, upper, right = bidiagonal(r / top)
    # A zero on the diagonal would leave the factor below without a value: it becomes a unit of rounding.
    diagonal = np.maximum(diagonal, EPS * EPS * max(diagonal.max(), upper.max(initial=0.0)))
    squares = dqds(diagonal**2, upper**2)
    d, l = diagonal**2, upper / diagonal[:-1]
    vectors = np.empty((p, p))
    full = np.diag(d + np.append(0.0, upper**2)) + np.diag(diagonal[:-1] * upper, 1) + np.diag(diagonal[:-1] * upper, -1)
    # Values at the level of rounding belong together, whatever their ratios.
    start, floor = 0, 1e-26 * squares[0]
    for k in range(p):
        if squares[max(k - 1, 0)] - squares[k] > CLUSTER * squares[max(k - 1, 0)] and squares[k] > floor:
            start = k
        vectors[:, k] = _vector(d, l, full, squares[k], vectors[:, start:k], k)
    return np.sqrt(squares) * top, right @ vectors


def _vector(d: np.ndarray, l: np.ndarray, full: np.ndarray, value: float, cluster: np.ndarray, k: int) -> np.ndarray:
    near = value
    for _ in range(3):
        correction, z = twisted(d, l, near) if len(d) > 1 else (0.0, np.ones(1))
        if abs(correction) <= 4 * EPS * abs(near) or abs(near + correction - value) > CLUSTER * value:
            break
        near += correction
    if not cluster.shape[1]:
        return z
    # Directions of a cluster are only defined together: made orthogonal, by inverse steps where one is lost.
    rest = _orthogonal(z, cluster)
    for attempt in range(20):
        if np.linalg.norm(rest) > 0.5:
            break
        start = _orthogonal(np.random.default_rng([k, attempt]).standard_normal(len(d)), cluster)
        shifted = full - (value * (1 + (attempt + 1) * EPS) + EPS * EPS) * np.eye(len(d))
        for _ in range(4):
            start = np.linalg.lstsq(shifted, start / np.linalg.norm(start), rcond=EPS * EPS)[0]
            start = _orthogonal(start / np.linalg.norm(start), cluster)
            start /= np.linalg.norm(start)
        rest = start
    rest = _orthogonal(rest / np.linalg.norm(rest), cluster)
    return rest / np.linalg.norm(rest)


def _orthogonal(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


# ---- passes over the rows -----------------------------------------------------------------------------


def _scaled(batch: pa.RecordBatch, size: int, scale: int, shift: int) -> tuple[pa.Array, np.ndarray]:
    at, matrix = list_matrix(batch.column(1), size)
    x = np.floor(matrix * float(scale))
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a component reaches {LARGEST / scale:.0f}: its differences would not be exact")
    return batch.column(0).take(at), x.astype(np.int64) + shift


def _sums(rows: DataFrame, scale: int, shift: int) -> tuple[int, int, list[int]]:
    """Vectors of the commonest length (of equally common ones the longest): length, number, sum per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.list_value_length(batch.column(1)), 0)
            for size in pa.compute.unique(lengths).to_pylist():
                if size:
                    x = _scaled(batch, size, scale, shift)[1]
                    held[size] = held.get(size, 0) + np.append(len(x), x.sum(axis=0))
        kinds = (pa.int32(), pa.int32(), pa.int64())
        flat = [(s, i, int(v)) for s, sums in held.items() for i, v in enumerate(sums)]
        columns = list(zip(*flat)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], ["size", "at", "part"])

    parts = rows.mapInArrow(run, "size int, at int, part long")
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    sums = parts.groupBy("size", "at").agg(total)
    first = sums.where("at = 0 AND total > 0").orderBy(F.desc("total"), F.desc("size")).first()
    if first is None:
        return 0, 0, []
    found = {row["at"]: int(row["total"]) for row in sums.where(F.col("size") == first["size"]).collect()}
    return first["size"], int(first["total"]), [found[i + 1] for i in range(first["size"])]


class Centre:
    """The means as whole parts and remainders, so that differences lose nothing to the common offset."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.whole = n, np.array([s // n for s in sums], dtype=np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def differences(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - S) squared; None where one leaves 64 bits."""
        step = x - self.whole
        if step.size and (float(np.abs(step).max()) + 1) * self.n < 2**31 / math.sqrt(max(1, x.shape[1])):
            exact = step * self.n - np.array(self.rest, dtype=np.int64)
            return np.einsum("ij,ij->i", exact, exact).tolist()
        exact = step.astype(object) * self.n - np.array(self.rest, dtype=object)
        return [v if v < 2**63 else None for v in (exact * exact).sum(axis=1)]


def _packed(matrix: np.ndarray, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([matrix.astype("<f8").tobytes()], type=pa.binary())], [name])


def _unpacked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            yield np.frombuffer(raw, dtype="<f8").reshape(-1, size)


def _triangle(blocks: Iterator[np.ndarray], size: int) -> np.ndarray:
    """R of all blocks below each other, with no more than a block and a triangle in memory."""
    r = np.zeros((0, size))
    for block in blocks:
        r = np.linalg.qr(np.concatenate([r, block]), mode="r")
    return r


def triangle(rows: DataFrame, centre: Centre, size: int, scale: int, shift: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows: one triangle per task, then triangles of triangles."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (centre.differences(_scaled(batch, size, scale, shift)[1]) for batch in batches)
        yield _packed(_triangle(blocks, size), "r")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _packed(_triangle(_unpacked(batches, size), size), "r")

    row = fold(rows.mapInArrow(reduce, "r binary"), combine).first()
    r = np.frombuffer(row["r"], dtype="<f8").reshape(-1, size)
    return np.concatenate([r, np.zeros((size - len(r), size))])


def identity_error(rows: DataFrame, centre: Centre, directions: np.ndarray, scale: int, shift: int) -> float:
    """Largest entry by which the covariance of the whitened rows differs from the identity, over all rows."""
    size, width = directions.shape

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            w = centre.differences(_scaled(batch, size, scale, shift)[1]) @ directions
            total[:-1] += w.T @ w
            total[-1] += w.sum(axis=0)
        yield _packed(total, "g")

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _packed(sum(_unpacked(batches, width), np.zeros((width + 1, width))), "g")

    row = fold(rows.mapInArrow(gram, "g binary"), combine).first()
    total = np.frombuffer(row["g"], dtype="<f8").reshape(-1, width) / centre.n
    return float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(width)).max())


def whitened(vectors: DataFrame, components: int = 32, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Vectors on the principal directions of all of them, each scaled to variance one.

    ``vectors`` needs vec_id and embedding; other columns are ignored. A vector that is null, empty or holds a null
    or non-finite component has no row, nor has one of another length than the commonest (of equally common lengths
    the longest). Components become x = floor(scale * c) + shift. One row per remaining vector (repeated rows and
    null ids are rows of their own) and component, numbered from 1 by falling variance: vec_id, component, n,
    deviation (exact sum of (n * x - S) squared, null where it leaves 64 bits), whitened, explained (share of the
    variance), identity_error. Directions without variance (all, if there is one vector or all are equal) have no
    rows; an empty table gives none. Of equal variances any orthogonal directions serve; a component of
    ``LARGEST / scale`` or more is an error.

    Three passes and the result's own. Tasks reduce centred rows to a triangle, block by block, and triangles are
    reduced to one in a tree of tasks. The driver sees that one triangle: Householder reflections make it
    bidiagonal, dqds finds its singular values, twisted factorisations its directions. The last pass before the
    result measures the covariance of the whitened rows.
    """
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    size, n, sums = _sums(rows, scale, shift)
    values, right = np.zeros(0), np.zeros((0, 0))
    if n:
        centre = Centre(n, sums)
        values, right = right_vectors(triangle(rows, centre, size, scale, shift))
    use = int((values > RANK * values.max(initial=0.0)).sum())
    use = min(use, components)
    if not use:
        return vectors.sparkSession.createDataFrame([], names)
    share = (values**2 / float((values**2).sum()))[:use]
    directions = right[:, :use] * (math.sqrt(n) / values[:use])
    error = identity_error(rows, centre, directions, scale, shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = _scaled(batch, size, scale, shift)
            m = len(x)
            columns = [
                ids.take(pa.array(np.repeat(np.arange(m), use))),
                pa.array(np.tile(np.arange(1, use + 1, dtype=np.int32), m)),
                pa.array(np.full(m * use, n)),
                pa.array(centre.deviations(x), type=pa.int64()).take(pa.array(np.repeat(np.arange(m), use))),
                pa.array((centre.differences(x) @ directions).ravel()),
                pa.array(np.tile(share, m)),
                pa.array(np.full(m * use, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in names.split(", ")])

    return rows.mapInArrow(run, names)
