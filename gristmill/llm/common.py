"""Helpers shared by the operators: stored tables, row keys, hashes inside tasks, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: White space that parts words: U+0020 and U+0009 to U+000D. ``bytes.split()`` uses the same six.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on lower-cased text: letters, digits and all that is not ASCII stay.
PLAIN_WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


# ---- tables ------------------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a session without one keeps its tables in its warehouse."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: computed once, and kept if executors are lost."""
    spark = frame.sparkSession
    path = new_path(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken, in any spelling."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key() -> tuple[Column, Column]:
    return F.xxhash64(F.col("doc_id").cast("long"), "text"), F.hash("text", F.col("doc_id").cast("long"))


def without_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents whose key is not among ``k1, k2`` of ``rows``."""
    names = [spare(documents.columns, c) for c in ("k1", "k2")]
    keyed = documents.withColumns(dict(zip(names, row_key())))
    return keyed.join(rows.select("k1", "k2").toDF(*names), names, "left_anti").select(*documents.columns)


def with_row_key(documents: DataFrame) -> DataFrame:
    """``doc_id, text, k1, k2``: 96 bits that stand for a row. Rows equal in doc_id and text share them."""
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    return documents.select(*columns).withColumns(dict(zip(("k1", "k2"), row_key())))


def arrow_rows(frame: DataFrame, make: Callable[[list[list]], list], schema: str, binary: tuple = ("text",)) -> DataFrame:
    """``frame.mapInArrow`` for a function from columns (lists; texts as UTF-8 bytes) to columns."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [
                (c.cast(pa.binary()) if name in binary else c).to_pylist()
                for name, c in zip(batch.schema.names, batch.columns)
            ]
            made = make(columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, type=kind) for values, kind in zip(made, kinds)], names=names
            )

    kinds = [_arrow_type(part.split()[1]) for part in schema.split(",")]
    return frame.mapInArrow(run, schema)


def list_matrix(lists: pa.ListArray, size: int) -> tuple[pa.Array, np.ndarray]:
    """Rows whose list has ``size`` numbers, none null or non-finite, as positions and as a matrix."""
    at = np.flatnonzero(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), -1)) == size)
    flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(np.float64).reshape(len(at), size)
    whole = np.isfinite(matrix).all(axis=1)
    return pa.array(at[whole]), matrix[whole]


def fold(frame: DataFrame, combine: Callable, fan: int = 16) -> DataFrame:
    """One row from many, by rounds in which a task combines what some ``fan`` tasks have left.

    ``combine`` goes from record batches to one batch of one row; rows of a task come one by one.
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while parts > 1:
        parts = -(-parts // fan)
        frame = frame.repartition(parts).mapInArrow(combine, frame.schema)
    return frame


def _arrow_type(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_arrow_type(name[6:-1]))
    plain = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    return (plain | {"binary": pa.binary(), "boolean": pa.bool_()})[name]


# ---- hashes of bytes and words -------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: A random 64-bit value for each byte, fixed by the bijection.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse, for exponents below ``n`` at least."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[which] = have = (made[0], made[1])
    return have


def prefix_sums(values: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums from which ``slice_hash`` gets the hash of any slice."""
    p, _ = powers(which, len(values) + 1)
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of values[start:end], equal for equal slices wherever they stand."""
    _, inverse = powers(which, len(sums))
    h = (sums[end] - sums[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * U(0x2545F4914F6CDD1D))


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in an array of bytes."""
    inside = np.empty(len(raw) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~SPACE[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(raw: bytes) -> np.ndarray:
    """One 64-bit hash for each word of a text in UTF-8."""
    data = np.frombuffer(raw, dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    start, end = word_bounds(data)
    return slice_hash(prefix_sums(BYTE_VALUES[data]), start, end)


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; the whole sequence where there are fewer words."""
    words = word_hashes(raw)
    if not len(words):
        return words
    k = min(size, len(words))
    n = len(words) - k + 1
    h = np.full(n, U(k), dtype=np.uint64)
    for i in range(k):
        h = mix(h + words[i : i + n])
    return np.unique(h)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---- connected components ---------------------------------------------------------------------------


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``node, component``: the smallest node reachable over ``edges(a, b)``; nodes without an edge are absent.

    Rounds of large-star and small-star, each a minimum per node (combined before the shuffle) and a join.
    Every round is a stored table.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = stored(pairs, purpose)
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), purpose)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = stored(
            small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), purpose
        )
        now = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        # Every node hangs on one smaller node, and nothing moved: these are the roots.
        if now == state or now[0] == 0:
            break
        state = now
    roots = pairs.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
