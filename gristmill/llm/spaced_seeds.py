"""Operator 5: documents that hold passages of a benchmark, found by spaced seeds."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import PLAIN_WORDS, U, arrow_rows, mix, signed, stored, with_row_key, word_hashes

#: Words that a seed compares (1) and ignores (0). Each has seven compared words. Wherever the replaced words of a
#: leak stand (3 of 16, or as many as ``SHARE`` allows in an item of 12 to 15 words), one of these fits between them.
MASKS = ("11110111", "11100100111", "110010101011", "1111001011", "10100011111", "110010110101")
#: An aligned stretch of so many words, of which so large a share is equal, is a leak.
STRETCH, SHARE = 16, 0.8
#: Bits of the filter that lets documents drop positions at once: 2 MiB, whatever the size of the benchmark.
FILTER_BITS = 24
_WEIGHTS = mix(np.arange(1, 65, dtype=np.uint64)) | U(1)
_SPAN = max(map(len, MASKS))


def short_masks(n: int) -> list[list[int]]:
    """Places that seeds of an item of ``n`` words compare, fewer than a mask spans.

    The item is cut into two parts more than words may be replaced; each mask leaves out as many parts as words may be
    replaced, so wherever they stand one mask has none of them, and every mask keeps two parts.
    """
    replaced = n - math.ceil(n * SHARE - 1e-9)
    parts = replaced + 2
    return [[i for i in range(n) if i * parts // n not in left] for left in combinations(range(parts), replaced)]


def seed_hashes(words: np.ndarray, short: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions under every mask, and under those of items of the ``short`` lengths."""
    masks = [(k, len(m), [i for i, c in enumerate(m) if c == "1"]) for k, m in enumerate(MASKS)]
    masks += [(16 + k, n, places) for n in short for k, places in enumerate(short_masks(n))]
    found: tuple[list, list] = ([], [])
    for name, span, places in masks:
        n = len(words) - span + 1
        if n > 0:
            h = np.full(n, U(span * 64 + name), dtype=np.uint64)
            for j, i in enumerate(places):
                h += words[i : i + n] * _WEIGHTS[j]
            found[0].append(mix(h))
            found[1].append(np.arange(n, dtype=np.int32))
    if not found[0]:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int32)
    return np.concatenate(found[0]), np.concatenate(found[1])


def _words(raw: bytes | None) -> np.ndarray:
    return word_hashes((raw or b"").translate(PLAIN_WORDS))


def _items(columns: list[list]) -> list:
    words = [_words(t) for t in columns[1]]
    seeds = [seed_hashes(w, [len(w)] if 0 < len(w) < _SPAN else []) for w in words]
    return [columns[0], [signed(w) for w in words], [signed(h) for h, _ in seeds], [at for _, at in seeds]]


def _probe(bits, short: list[int]):
    """Positions of a document whose seed passes the filter."""

    def make(columns: list[list]) -> list:
        filled = np.frombuffer(bits.value, dtype=np.uint8)
        out: list[list] = [columns[2], columns[3], [], []]
        for text in columns[1]:
            h, at = seed_hashes(_words(text), short)
            place = (h & U((1 << FILTER_BITS) - 1)).astype(np.int64)
            hit = (filled[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            out[2].append(signed(h[hit]))
            out[3].append(at[hit])
        return out

    return make


def _verify(columns: list[list]) -> list:
    """Items of which an aligned stretch is in the text, and the best share of equal words."""
    out: list[list] = [columns[0], columns[1], [], []]
    for text, candidates in zip(columns[2], columns[3]):
        words = _words(text)
        items, best = set(), 0.0
        for one in candidates:
            item = np.array(one["words"], dtype=np.int64).view(np.uint64)
            first, last = max(0, -one["shift"]), min(len(item), len(words) - one["shift"])
            equal = item[first:last] == words[first + one["shift"] : last + one["shift"]]
            need = min(STRETCH, len(item))
            if len(equal) >= need:
                sums = np.concatenate([[0], np.cumsum(equal)])
                share = float((sums[need:] - sums[:-need]).max()) / need
                if share >= SHARE:
                    items.add(one["item_id"])
                    best = max(best, share)
        out[2].append(sorted(items))
        out[3].append(best)
    return out


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which documents hold a passage of a benchmark item, words replaced here and there included.

    ``documents`` needs doc_id and text, ``benchmark`` item_id and text. One row per input row: doc_id, k1, k2
    (the row's key), items (sorted ids of the items found), share (largest share of equal words in a stretch).
    Words are compared in lower case without punctuation. A document leaks an item if some alignment of the two
    has ``STRETCH`` words in a row (the whole item, if it is shorter) of which ``SHARE`` are equal; items of fewer
    words than a mask spans have masks of their own. Null and wordless texts hold nothing and match nothing, an item
    without an id is not sought, repeated items and rows are each judged alike, other columns are ignored.

    Seeds of the documents pass a filter of fixed size made from all seeds of the benchmark; the few that pass
    are joined by hash, so a benchmark of any size works, and every alignment found is checked word by word.
    """
    spark = documents.sparkSession
    wanted = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    schema = "item_id long, words array<long>, hashes array<long>, places array<int>"
    items = stored(arrow_rows(wanted, _items, schema), "seeds")
    # At most _SPAN - 1 lengths.
    lengths = items.select(F.size("words").alias("n")).where(f"n > 0 AND n < {_SPAN}").distinct().orderBy("n")
    short = [row["n"] for row in lengths.collect()]
    seeds = items.select("item_id", F.inline(F.arrays_zip("hashes", "places"))).toDF("item_id", "hash", "place")
    bit = seeds.select(F.col("hash").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit"))
    # 2 ** FILTER_BITS / 32768 rows of 4 KiB at most.
    parts = bit.groupBy(F.shiftright("bit", 15).alias("part")).agg(F.bitmap_construct_agg(F.expr("bit & 32767")).alias("bits"))
    filled = bytearray(1 << (FILTER_BITS - 3))
    for row in parts.collect():
        filled[row["part"] * 4096 : (row["part"] + 1) * 4096] = row["bits"]
    bits = spark.sparkContext.broadcast(bytes(filled))

    rows = with_row_key(documents)
    probes = arrow_rows(rows, _probe(bits, short), "k1 long, k2 int, hashes array<long>, places array<int>")
    hits = probes.select("k1", "k2", F.inline(F.arrays_zip("hashes", "places"))).toDF("k1", "k2", "hash", "at")
    lines = hits.join(seeds, "hash").select("k1", "k2", "item_id", (F.col("at") - F.col("place")).alias("shift"))
    lines = stored(lines.distinct(), "alignments")
    bodies = items.select("item_id", "words").dropDuplicates()
    per_row = lines.join(bodies, "item_id").groupBy("k1", "k2").agg(
        F.collect_list(F.struct("item_id", "shift", "words")).alias("candidates")
    )
    texts = rows.select("k1", "k2", F.col("text").cast("binary").alias("text")).join(per_row, ["k1", "k2"])
    found = arrow_rows(texts, _verify, "k1 long, k2 int, items array<long>, share double").dropDuplicates(["k1", "k2"])
    out = rows.select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left")
    return out.select(
        "doc_id", "k1", "k2", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("share", F.lit(0.0)).alias("share"),
    )
