"""Operator 9: document quality learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import PLAIN_WORDS, SPACE, arrow_rows, word_hashes

#: Labelled documents that are learned from at most, by a seeded hash; each is compared with this many others.
SAMPLE, RIVALS = 8000, 8
#: Weight of the penalty on the coefficients, Newton steps, and the score that parts good from bad.
PENALTY, STEPS, CUT = 1e-3, 25, 0.3

_CLASS = np.zeros(256, dtype=np.int64)
for _name, _members in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|\t", b"%#$&*@^~+=<>{}[]\\/_`")
):
    _CLASS[list(_members)] = _name + 1
_CLASS[128:] = 8
_CLASS[SPACE] = 9
_CLASSES = 10


def features(raw: bytes | None) -> np.ndarray:
    """Shares of kinds of bytes, lengths of words and lines, and how much repeats. An empty text has its own mark."""
    data = np.frombuffer(raw or b"", dtype=np.uint8)
    kinds = np.bincount(_CLASS[data], minlength=_CLASSES) if len(data) else np.zeros(_CLASSES)
    words = word_hashes(raw or b"")
    if not len(words):
        return np.concatenate([np.zeros(FEATURES - 1), [1.0]])
    seen = max(1, int(kinds.sum() - kinds[9]))
    share = kinds / seen
    letters = kinds[1] + kinds[2] + kinds[8]
    upper = kinds[2] / max(1, kinds[1] + kinds[2])
    plain = word_hashes((raw or b"").translate(PLAIN_WORDS))
    counts = np.unique(words, return_counts=True)[1]
    pairs = np.unique(words[:-1] * np.uint64(3) + words[1:], return_counts=True)[1] if len(words) > 1 else np.ones(1)
    lines = [line for line in (raw or b"").split(b"\n") if line.strip()]
    n = len(words)
    saturated = [min(1.0, x / s) for x, s in ((share[7], 0.05), (share[5], 0.05), (share[6], 0.02), (upper, 0.3), (share[0], 0.05))]
    mean = seen / n
    return np.array(
        [
            *saturated, share[3], share[4], share[8], letters / seen, upper,
            len(counts) / n, counts.max() / n, len(pairs) / max(1, n - 1), pairs.max() / max(1, n - 1),
            max(0.0, 1 - len(counts) / n - 0.5), min(1.0, counts.max() / n / 0.2),
            np.log1p(n) / 10, min(1.0, 10 / n), min(2.0, mean / 10), abs(mean - 5) / 10,
            1 - len(set(lines)) / max(1, len(lines)), min(1.0, len(lines) / n * 10), len(plain) / n, 0.0,
        ], dtype=np.float64,
    )


FEATURES = 24


class Ranker:
    """Scores by logistic loss on differences of features, put on (0, 1) so that the chosen quantile is at ``CUT``."""

    def __init__(self, x: np.ndarray, good: np.ndarray, seed: int = 7):
        if not (good.any() and (~good).any()):
            # Nothing to prefer: every document has the same score, on the side of the labels there are.
            self.centre, self.scale, self.weights = np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES)
            self.threshold = 1.0 if len(good) and not good.any() else -1.0
            return
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(self.scale > 1e-9, self.scale, 1.0)
        z = self._standard(x)
        rng = np.random.default_rng(seed)
        better, worse = np.flatnonzero(good), np.flatnonzero(~good)
        one = np.concatenate([np.repeat(better, RIVALS), rng.choice(better, len(worse) * RIVALS)])
        two = np.concatenate([rng.choice(worse, len(better) * RIVALS), np.repeat(worse, RIVALS)])
        d = z[one] - z[two]
        w = np.zeros(FEATURES)
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            gradient = -(d * p[:, None]).mean(axis=0) + PENALTY * w
            hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + PENALTY * np.eye(FEATURES)
            step = np.linalg.solve(hessian, gradient)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w
        # The quantile of the scores that parts the preferred from the others with the fewest errors by rate.
        s = z @ w
        cuts = np.quantile(s, np.linspace(0.002, 0.998, 499))
        high = np.sort(s[good])
        low = np.sort(s[~good])
        lost = np.searchsorted(high, cuts) / len(high) + 1 - np.searchsorted(low, cuts) / len(low)
        best = np.flatnonzero(lost <= lost.min() + 1e-12)
        self.threshold = float(cuts[best[len(best) // 2]])

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        s = self._standard(x) @ self.weights - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def held_out(doc_id: str) -> F.Column:
    """Rows that are never learned from: crc32 of the id as text is a multiple of five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def _measured(columns: list[list]) -> list:
    return [columns[0], columns[2], [features(t) for t in columns[1]]]


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranker:
    """A ranker from at most ``sample`` labelled documents that are not held out, chosen by a hash of the id.

    Of rows that share an id one is learned from, by a hash of its features.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out("doc_id"))
    marked = marked.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").groupBy("doc_id").agg(
        F.max("quality").alias("high"), F.min("quality").alias("low")
    )
    # A document with two opinions has none.
    marked = marked.where("high = low").select("doc_id", F.col("high").cast("int").alias("quality"))
    per_class = [
        marked.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for q in (0, 1)
    ]
    chosen = per_class[0].unionByName(per_class[1])
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    found = arrow_rows(rows.select("doc_id", "text", "quality"), _measured, "doc_id long, quality int, x array<double>")
    found = found.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("x").alias("h"), "x"))["x"].alias("x"))
    got = sorted((row["doc_id"], row["quality"], tuple(row["x"])) for row in found.collect())
    x = np.array([row[2] for row in got]).reshape(-1, FEATURES)
    return Ranker(x, np.array([row[1] == 1 for row in got], dtype=bool))


def score(documents: DataFrame, ranker: Ranker) -> DataFrame:
    """``doc_id, text, score``: one row per input row, whole texts; an empty or null text is scored as empty."""

    def make(columns: list[list]) -> list:
        grid = np.array([features(t) for t in columns[1]]).reshape(-1, FEATURES)
        return [columns[0], ranker.scores(grid)]

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_rows(rows, make, "doc_id long, score double")


def keep_good(documents: DataFrame, ranker: Ranker) -> DataFrame:
    """The documents, with all their columns, whose score reaches ``CUT``; one pass, no shuffle."""

    def run(texts: pd.Series) -> pd.Series:
        grid = [features(t if t is None else t.encode("utf-8", "surrogatepass")) for t in texts]
        return pd.Series(ranker.scores(np.array(grid).reshape(-1, FEATURES)))

    good = F.pandas_udf(run, "double")
    return documents.where(good(F.col("text")) >= CUT)


def quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted.

    ``documents`` needs doc_id and text, ``labels`` doc_id and quality. Preference pairs of a better and a worse
    document, from the part of the labels that is not held out, give the coefficients by logistic loss on the
    difference of their features; a quantile of the scores parts good from bad and becomes score ``CUT``. Only the
    text enters a score. Every row has a score, whatever its text; rows that repeat are scored alike; a null
    doc_id is not held out; labels that are null, unknown or contradict each other are left out; without labels
    of both kinds every document has one score. Other columns are ignored. The driver holds the features of at
    most ``sample`` labelled documents.
    """
    found = score(documents, learn(documents, labels, sample))
    return found.select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
