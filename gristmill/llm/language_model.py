"""Operator 12: log probabilities of whole documents under a gated recurrent language model."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import LOWER, fold, stored
from gristmill.llm.gated_network import END, RARE, Network, Parameters, class_cuts, first_parameters

#: Words with an output of their own, classes they fall into, and the size of the state.
WORDS, CLASSES, HIDDEN = 2046, 40, 12
#: Counts that every task holds; those of all other words are joined.
HELD = 65_536
#: Step size, the share (of 8) of the training documents that the first round reads, and tokens read at a time.
RATE, FIRST_SHARE, BUNDLE, SEED = 0.1, 1, 4_000_000, 1
#: A longer word is counted under a digest.
LONGEST = 64
#: Distinct words that a task counts before it passes them on.
FLUSH = 500_000


def tokens(raw: bytes) -> list[bytes]:
    return raw.translate(LOWER).split()


def key_of(word: bytes) -> bytes:
    return word if len(word) <= LONGEST else b"\0" + hashlib.blake2b(word, digest_size=16).digest()


def held_out(divisor: int = 7, remainder: int = 2) -> Column:
    """Whether crc32 of the id as text has that remainder; a document without an id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """``key, n``: how often each word stands in the texts, added up in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()):
                found.update(tokens(raw.as_py() or b""))
                if len(found) >= FLUSH:
                    yield rows(found)
                    found = Counter()
        yield rows(found)

    def rows(found: Counter) -> pa.RecordBatch:
        keys = pa.array([key_of(w) for w in found], type=pa.binary())
        return pa.RecordBatch.from_arrays([keys, pa.array(list(found.values()), type=pa.int64())], ["key", "n"])

    return texts.select("text").mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the commonest words, most frequent first; the first ``words`` of them have an output of their own."""

    held: list[bytes]
    counts: np.ndarray
    documents: int
    total: int
    distinct: int
    words: int

    def __post_init__(self) -> None:
        self.words = min(self.words, len(self.held))

    @property
    def rare_total(self) -> int:
        return self.total - int(self.counts[: self.words].sum())

    @property
    def output_counts(self) -> np.ndarray:
        """Of the end of a document, of all rare words, and of each word with an output."""
        return np.concatenate([[self.documents, self.rare_total], self.counts[: self.words]])

    def numbers(self) -> dict[bytes, int]:
        return {word: i for i, word in enumerate(self.held)}

    def parts(self) -> np.ndarray:
        """log10(count + 1) by number, and zero for a word that is not held (its number is -1)."""
        return np.append(np.log10(self.counts + 1.0), 0.0)


def numbered(raw: bytes, numbers: dict[bytes, int]) -> tuple[list[bytes], np.ndarray]:
    """Words of a text, and their numbers among the held ones or -1."""
    words = tokens(raw)
    at = np.fromiter(map(numbers.get, words, repeat(-1)), dtype=np.int32, count=len(words))
    if len(raw) > LONGEST:
        for i in np.flatnonzero(at < 0):
            if len(words[i]) > LONGEST:
                at[i] = numbers.get(key_of(words[i]), -1)
    return words, at


def network_numbers(at: np.ndarray, words: int) -> np.ndarray:
    """What the network reads: words with an output, the rare word for all others, and the end."""
    return np.append(np.where((at >= 0) & (at < words), at + 2, RARE), END).astype(np.int32)


def learn_vocabulary(training: DataFrame, words: int) -> tuple[Vocabulary, DataFrame]:
    counts = stored(word_counts(training), "word-counts")
    documents = training.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k")).first()
    top = counts.orderBy(F.desc("n"), "key").limit(HELD).collect()
    held = np.array([row["n"] for row in top], dtype=np.int64)
    return Vocabulary([bytes(r["key"]) for r in top], held, documents, total["n"] or 0, total["k"], words), counts


# ---- training --------------------------------------------------------------------------------------------


def _rows_of(weight: float, values: np.ndarray) -> pa.RecordBatch:
    packed = pa.array([values.astype("<f8").tobytes()], type=pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([weight], type=pa.float64()), packed], ["weight", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weight, sums = 0.0, None
    for batch in batches:
        for w, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(raw, dtype="<f8")
            weight, sums = weight + w, part if sums is None else sums + part
    if sums is not None:
        yield _rows_of(weight, sums)


def _pass(start: Parameters, memory: Parameters, cuts: np.ndarray, vocabulary: Vocabulary, rate: float):
    """A task reads its documents once, from the common start; it passes on what it has learned, by its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.numbers()
        mine, squares = start.like(start.flat()), memory.like(memory.flat())
        network, weight, bundle, size = Network(mine, cuts), 0, [], 0
        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()):
                read = network_numbers(numbered(raw.as_py() or b"", numbers)[1], vocabulary.words)
                bundle.append(read)
                size += len(read)
                if size >= BUNDLE:
                    network.train(bundle, squares, rate)
                    weight, bundle, size = weight + size, [], 0
        if bundle:
            network.train(bundle, squares, rate)
            weight += size
        if weight:
            yield _rows_of(weight, weight * np.concatenate([mine.flat(), squares.flat()]).astype(float))

    return run


def train(training: DataFrame, vocabulary: Vocabulary, hidden: int, classes: int, rate: float) -> tuple[Parameters, np.ndarray]:
    """Every training document is read once, in two rounds; after each the tasks' networks are averaged by tokens."""
    counts = vocabulary.output_counts
    cuts = class_cuts(counts, classes)
    now = first_parameters(counts, cuts, hidden, SEED)
    squares = now.like(np.zeros(0))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(8)) < FIRST_SHARE
    for part in (share, ~share):
        learned = training.where(part).select("text").mapInArrow(
            _pass(now, squares, cuts, vocabulary, rate), "weight double, sums binary"
        )
        row = fold(learned, _added).first()
        if row is not None:
            mean = np.frombuffer(row["sums"], dtype="<f8") / row["weight"]
            now, squares = now.like(mean[: len(mean) // 2]), squares.like(mean[len(mean) // 2 :])
    return now, cuts


# ---- scoring ---------------------------------------------------------------------------------------------

SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_rare long, n_held long, base double, rare double, "
    "logs double, keys array<binary>, times array<int>"
)


def _scores(parameters: Parameters, cuts: np.ndarray, vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, parts, network = vocabulary.numbers(), vocabulary.parts(), Network(parameters, cuts)
        end = math.log10(vocabulary.documents + 1)
        rows: list[tuple] = []
        texts: list[np.ndarray] = []
        size = 0
        for batch in batches:
            keys = [batch.column(i).to_pylist() for i in range(3)]
            for *key, raw in zip(*keys, batch.column(3).cast(pa.binary())):
                words, at = numbered(raw.as_py() or b"", numbers)
                read = network_numbers(at, vocabulary.words)
                held, rare = parts[at], at >= vocabulary.words
                rest = Counter(map(key_of, compress(words, (at < 0).tolist())))
                rows.append((
                    *key, len(read), int((read == RARE).sum()), int((at >= 0).sum()) + (vocabulary.documents > 0),
                    float(held.sum()) + end, float(held[rare].sum()), list(rest), list(rest.values()),
                ))
                texts.append(read)
                size += len(read)
                if size >= BUNDLE:
                    yield made(rows, network.score(texts))
                    rows, texts, size = [], [], 0
        if rows:
            yield made(rows, network.score(texts))

    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    kinds += [pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in SCORED.split(", ")]

    def made(rows: list[tuple], logs: np.ndarray) -> pa.RecordBatch:
        columns = list(zip(*rows))
        columns.insert(8, logs.tolist())
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names)

    return run


def document_scores(
    documents: DataFrame, words: int = WORDS, classes: int = CLASSES, hidden: int = HIDDEN, rate: float = RATE
) -> DataFrame:
    """Log probabilities of whole documents, under counts of single words and under a recurrent network.

    ``documents`` needs doc_id and text; other columns are ignored. It learns from documents whose crc32(doc_id as
    text) mod 7 is not 2 (a document without an id counts among them) and scores every row: doc_id, held_out,
    n_tokens, n_known (tokens seen in training), train_tokens, base_score, score. Text is lower-cased (A-Z) and cut
    into words; every document, an empty or null one too, ends with one more token. Repeated rows are rows of their
    own, in training as well. An empty table gives no rows; without training documents the base score is 0 and the
    network is untrained.

    The network reads the ``words`` most frequent words of the training documents, by number, and one rare word for
    all others; it predicts a class and then a word within it. A rare word's own share comes from the counts of all
    rare words: (count + 1) / (their tokens + their number + 1). States go on from window to window until the
    document ends, so the score is that of the whole text. Training reads all training documents once by truncated
    backpropagation, task by task; in two rounds the tasks' networks are averaged in a tree. The network is bounded;
    the counts are a table that grows with the corpus: tasks hold the ``HELD`` commonest, the others are joined to
    the distinct words of each document.
    """
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = given.where(~held_out())
    vocabulary, counts = learn_vocabulary(training, words)
    parameters, cuts = train(training, vocabulary, hidden, classes, rate)
    rows = given.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out().alias("held_out"), "text")
    scored = stored(rows.mapInArrow(_scores(parameters, cuts, vocabulary), SCORED), "scored-documents")
    rest = scored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("it")).select(
        "row", F.col("it.keys").alias("key"), F.col("it.times").alias("times")
    )
    found = rest.join(counts, "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("seen")
    )
    train_tokens = vocabulary.total + vocabulary.documents
    distinct = vocabulary.distinct + (vocabulary.documents > 0)
    whole = math.log10(train_tokens + distinct + 1)
    rare = math.log10(vocabulary.rare_total + vocabulary.distinct - vocabulary.words + 1)
    more = F.coalesce("more", F.lit(0.0))
    return scored.drop("keys", "times").join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_held") + F.coalesce("seen", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("logs") / math.log(10) + F.col("rare") + more - F.col("n_rare") * rare).alias("score"),
    )
