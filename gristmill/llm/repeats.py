"""Passages that occur more than once, of any units (words or bytes): what operators 3 and 10 share.

A *window* is ``width`` consecutive units of one document. All windows that also start anywhere else are found
by levels of growing depth ``k`` (a tree of suffixes, level by level):

1. Each window hands its k-gram of smallest hash to the next step: the *head* of a suffix at a position that
   depends on the window's content alone, so equal windows choose equal heads. Windows next to each other mostly
   share the head, so a document has about ``2 n / (width - k)`` heads and not ``n``.
2. A head that stands nowhere else is a leaf: its windows are single and go no further. Under the other heads,
   stretches of windows whose whole content stands twice or more are repeated, and settled.
3. One stretch of each content under a head with several goes to the next depth. At depth ``width`` a head is the window itself, which settles it.

Contents are compared by 128 bits (two hashes with independent bases). Nothing is capped: a very long text is
worked through in chunks of ``CHUNK`` units that overlap, and a head that very many documents share is counted
per task before any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import (
    BYTE_VALUES,
    U,
    arrow_rows,
    prefix_sums,
    signed,
    slice_hash,
    stored,
    with_row_key,
    word_hashes,
)

#: Units of a text worked on at once. The low 20 bits of a packed hash hold a position in a chunk.
CHUNK = 1 << 19
_POSITION = U((1 << 20) - 1)

#: Counts the heads (lead, head, content) of a level: head, least and greatest content of those met more than once.
Grouping = Callable[[DataFrame], DataFrame]


def units(raw: bytes, unit: str) -> np.ndarray:
    """One 64-bit value per word or per byte."""
    return word_hashes(raw) if unit == "word" else BYTE_VALUES[np.frombuffer(raw, dtype=np.uint8)]


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` consecutive values, by running minima inside blocks of ``w``."""
    if w == 1:
        return x
    n = len(x) - w + 1
    whole = -(-len(x) // w) * w
    padded = np.full(whole, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def _leads(raw: bytes, at: np.ndarray, k: int) -> np.ndarray:
    """The first eight bytes (or ``k``) from each position as numbers in the order of the bytes."""
    data = np.frombuffer(raw, dtype=np.uint8)
    lead = np.zeros(len(at), dtype=np.uint64)
    for i in range(8):
        lead <<= U(8)
        if i < k:
            lead |= data[at + i].astype(np.uint64)
    return lead ^ U(1 << 63)


def heads(values: np.ndarray, spans: list[tuple[int, int]], width: int, k: int, raw: bytes | None = None) -> tuple:
    """Each run of windows inside ``spans`` that share a head: head, content hash, first and last window, lead.

    The lead is the start of the head in the order of its bytes (zero where ``raw`` is not given).
    """
    found: tuple[list, ...] = ([], [], [], [], [])
    w = width - k + 1
    for low, high in spans:
        for start in range(low, high + 1, CHUNK):
            end = min(high, start + CHUNK - 1)
            part = values[start : end + width]
            sums = prefix_sums(part)
            at = np.arange(len(part) - k + 1)
            grams = slice_hash(sums, at, at + k)
            # The position in the low bits makes the leftmost of equal heads the least, and tells heads apart.
            least = _sliding_least((grams & ~_POSITION) | at.astype(np.uint64), w) if w > 1 else at
            first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            last = np.concatenate([first[1:], [len(least)]]) - 1
            content = slice_hash(prefix_sums(part, 1), first, last + width, 1)
            stands = (least[first] & _POSITION).astype(np.int64) if w > 1 else first
            found[0].append(grams[stands])
            found[4].append(_leads(raw, stands + start, k) if raw is not None else np.zeros(len(first), dtype=np.uint64))
            found[1].append(content)
            found[2].append(first + start)
            found[3].append(last + start)
    if not found[0]:
        return ([], [], [], [], [])
    head, content, lows, highs, leads = (np.concatenate(x) for x in found)
    return signed(head), signed(content), lows.astype(np.int32), highs.astype(np.int32), signed(leads)


def merged(spans: list[tuple[int, int]], gap: int = 1) -> list[tuple[int, int]]:
    """Sorted inclusive spans, joined where they overlap or touch (``gap`` 1) or leave fewer units between."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def without(raw: bytes, unit: str, windows: list[tuple[int, int]], width: int) -> tuple[int, int, bytes]:
    """Units removed, number of maximal removed runs, and what stays, once all covered units are gone."""
    covered = merged([(low, high + width - 1) for low, high in windows])
    removed = sum(b - a + 1 for a, b in covered)
    if unit == "byte":
        at, kept = 0, []
        for a, b in covered:
            kept.append(raw[at:a])
            at = b + 1
        return removed, len(covered), b"".join([*kept, raw[at:]])
    words = raw.split()
    at, some = 0, []
    for a, b in covered:
        some += words[at:a]
        at = b + 1
    return removed, len(covered), b" ".join(some + words[at:])


def _first_level(unit: str, width: int, k: int):
    """Per document: number of units, hash of the whole kept text, and the heads of all its windows."""

    def make(columns: list[list]) -> list:
        out: list[list] = [columns[0], columns[2], columns[3], [], [], [], [], [], [], []]
        for raw in columns[1]:
            raw = raw or b""
            values = units(raw, unit)
            n = len(values)
            spans = [(0, n - width)] if n >= width else []
            kept = raw if unit == "byte" else b" ".join(raw.split())
            row = (n, hashlib.sha256(kept).hexdigest(), *heads(values, spans, width, k, raw if unit == "byte" else None))
            for column, value in zip(out[3:], row):
                column.append(value)
        return out

    return make


def _next_level(unit: str, width: int, k: int):
    def make(columns: list[list]) -> list:
        out: list[list] = [columns[0], columns[1], [], [], [], [], []]
        for packed, lows, highs in zip(*columns[2:5]):
            raw = zstandard.decompress(packed)
            spans = merged(list(zip(lows, highs)))
            row = heads(units(raw, unit), spans, width, k, raw if unit == "byte" else None)
            for column, value in zip(out[2:], row):
                column.append(value)
        return out

    return make


def _packed(columns: list[list]) -> list:
    press = zstandard.ZstdCompressor(level=1)
    return [columns[0], [press.compress(t or b"") for t in columns[1]], *columns[2:]]


def _removed(unit: str, width: int):
    def make(columns: list[list]) -> list:
        out: list[list] = [columns[0], columns[1], columns[2], [], [], []]
        for packed, lows, highs in zip(*columns[3:6]):
            removed, runs, kept = without(zstandard.decompress(packed), unit, list(zip(lows, highs)), width)
            out[3].append(removed)
            out[4].append(runs)
            out[5].append(hashlib.sha256(kept).hexdigest())
        return out

    return make


KEY = "k1 long, k2 int"
RUNS = "heads array<long>, contents array<long>, lows array<int>, highs array<int>, leads array<long>"


def _settle(level: DataFrame, grouping: Grouping, last: bool) -> DataFrame:
    """Runs under repeated heads, and whether all their windows are known to be repeated."""
    hits = _hits(level, grouping)
    columns = ["k1", "k2", "low", "high"]
    same = F.col("least") == F.col("greatest")
    hits = stored(hits.select(*columns, "head", "content", same.alias("same")), "hits")
    # Under a head with several contents, those that stand twice settle their windows; one stretch of each content
    # goes on, as windows in it can also stand in a stretch that differs elsewhere.
    mixed = hits.where("NOT same")
    kinds = mixed.groupBy("head", "content").agg(F.count("*").alias("n"), F.min(F.struct(*columns)).alias("one"))
    kinds = stored(kinds, "kinds")
    twice = kinds.where("n > 1").select("head", "content")
    settled = hits.where("same").select(*columns).unionByName(mixed.join(twice, ["head", "content"]).select(*columns))
    if last:
        # At full depth the content is the window, by a second hash: what shares only the head is another window.
        return settled.withColumn("settled", F.lit(True))
    going = kinds.select("one.*").withColumn("settled", F.lit(False))
    return stored(settled.withColumn("settled", F.lit(True)).unionByName(going), "judged")


def _hits(level: DataFrame, grouping: Grouping) -> DataFrame:
    runs = level.select("k1", "k2", F.inline(F.arrays_zip("heads", "contents", "lows", "highs", "leads")))
    runs = runs.toDF("k1", "k2", "head", "content", "low", "high", "lead")
    # Written, so that both sides of the join are plain exchanges and a hot head can be split.
    return runs.join(stored(grouping(runs.select("lead", "head", "content")), "groups"), "head")


def _spans(hits: DataFrame) -> DataFrame:
    """``lows, highs`` per row key. A group is no larger than its document."""
    return hits.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("s")).select(
        "k1", "k2", F.col("s.low").alias("lows"), F.col("s.high").alias("highs")
    )


def by_prefix(runs: DataFrame) -> DataFrame:
    """Heads met more than once, grouped by hash, counted per task first."""
    counted = runs.groupBy("head").agg(
        F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("greatest")
    )
    return counted.where("n > 1").drop("n")


def repeated_windows(documents: DataFrame, unit: str, width: int, depths: tuple[int, ...], grouping: Grouping):
    """Stored (documents' first level, packed texts with hits, window spans that are repeated)."""
    rows = with_row_key(documents)
    schema = f"doc_id long, {KEY}, n long, sha string, {RUNS}"
    first = stored(arrow_rows(rows, _first_level(unit, width, depths[0]), schema), "level")
    hits = _settle(first, grouping, len(depths) == 1)
    texts = arrow_rows(rows.select("doc_id", "text", "k1", "k2"), _packed, f"doc_id long, packed binary, {KEY}")
    touched = hits.select("k1", "k2").distinct()
    work = stored(texts.join(touched, ["k1", "k2"], "left_semi").select("k1", "k2", "packed"), "work")
    settled = [hits.where("settled")]
    for depth in depths[1:]:
        open_rows = work.join(_spans(hits.where("NOT settled")), ["k1", "k2"]).select("k1", "k2", "packed", "lows", "highs")
        level = stored(arrow_rows(open_rows, _next_level(unit, width, depth), f"{KEY}, {RUNS}", ()), "level")
        hits = _settle(level, grouping, depth == width)
        settled.append(hits.where("settled"))
    spans = settled[0]
    for more in settled[1:]:
        spans = spans.unionByName(more)
    return first, work, _spans(spans)


def remove_repeats(documents: DataFrame, unit: str, width: int, depths: tuple[int, ...], grouping: Grouping) -> DataFrame:
    """Per document: doc_id, n, n_removed, n_spans and the SHA-256 of what stays."""
    first, work, spans = repeated_windows(documents, unit, width, depths, grouping)
    cut = arrow_rows(
        work.dropDuplicates(["k1", "k2"]).join(spans, ["k1", "k2"]).select(
            "k1", "k2", F.lit(0).alias("z"), "packed", "lows", "highs"
        ),
        _removed(unit, width), "k1 long, k2 int, z int, removed long, runs long, cut string", (),
    )
    out = first.select("doc_id", "k1", "k2", "n", "sha").join(cut.drop("z"), ["k1", "k2"], "left")
    return out.select(
        "doc_id", "n", F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("runs", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("cut", "sha").alias("kept_sha256"),
    )
