"""Operator 2: a mix of sources with target weights, fitted to the word exactly by subset sums."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.llm.common import row_key, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights in the order of the sources, repeating; a source is used at most so many times over.
WEIGHTS, REPEATS = (1.0, 2.0, 3.0), 3
SEED = "mix-1"
#: Budget, in words, that is left to dynamic programming. More is filled by one document of each length first.
EXACT = 50_000
#: Parts of a class of documents of one length; only the part at the cut is ordered.
PARTS = 256


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> dict:
    """Words for each source: shares by weight, none above ``repeats`` times its size, the excess shared again."""
    order = sorted((s for s, _ in sizes), key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    size, target = dict(sizes), {}
    left, active = float(sum(size.values())), list(order)
    while active:
        total = sum(weight[s] for s in active)
        over = [s for s in active if left * weight[s] / total > repeats * size[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in active}
        for s in over:
            target[s] = float(repeats * size[s])
        left -= sum(target[s] for s in over)
        active = [s for s in active if s not in over]
    return target


def fit(lengths: dict[int, int], budget: int, seed: str) -> dict[int, int]:
    """How many documents of each length to take, of those there are, to come as close to ``budget`` words as can be.

    Every length gives its share of the budget first; then, in a seeded order, one more document of some
    lengths; the last ``EXACT`` words are settled by a bounded knapsack over the documents left.
    """
    lengths = {n: c for n, c in lengths.items() if n > 0 and c > 0}
    whole = sum(n * c for n, c in lengths.items())
    if whole == 0 or budget <= 0:
        return {}
    if budget >= whole:
        return lengths
    taken = {n: c * budget // whole for n, c in lengths.items()}
    left = budget - sum(n * c for n, c in taken.items())
    order = sorted(n for n, c in lengths.items() if c > taken[n])
    random.Random(f"{seed}|{budget}").shuffle(order)
    for n in order:
        if left > EXACT and n <= left:
            taken[n] += 1
            left -= n
    # Sums that the documents so far can reach, one bit each, after each step.
    within = (1 << (2 * left + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    reach = 1
    for n in order:
        spare, size = min(lengths[n] - taken[n], 2 * left // n), 1
        while spare > 0 and not reach >> left & 1:
            count = min(size, spare)
            steps.append((n, count, reach))
            reach = (reach | reach << n * count) & within
            spare -= count
            size *= 2
        if reach >> left & 1:
            break
    rest = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    if over := reach >> (left + 1):
        above = left + (over & -over).bit_length()
        rest = above if above - left < left - rest else rest
    for n, count, before in reversed(steps):
        if not before >> rest & 1:
            taken[n] += count
            rest -= n * count
    return {n: c for n, c in taken.items() if c}


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """How many words of each document a mix takes that meets the target of every source.

    ``documents`` needs doc_id, text and source. One row per input row: doc_id, size (words), source_size,
    target, taken, and k1, k2 (the row's key). Other columns are ignored. Sources by code point, null last, have the
    weights in turn; all sizes together are shared by weight. A target above the size of its source takes every
    document that many times over first. Null and wordless texts have size 0 and are never taken. Ties between
    documents are broken by a seeded hash of doc_id and text, so reruns agree; rows equal in both are alike.

    The driver sees one row per source; a source's lengths with their counts, not its documents, are fitted
    together. Within a length the documents with the smallest hashes are taken: whole parts of the hash range,
    and inside one part by rank.
    """
    spark: SparkSession = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("key"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"),
        *[key.alias(name) for name, key in zip(("k1", "k2"), row_key())],
    ).withColumn("part", F.expr(f"pmod(hash, {PARTS})").cast("int"))
    rows = stored(rows, "sizes")
    totals = rows.groupBy("key", "source").agg(F.sum("size").alias("n")).collect()
    target = targets([(row["source"], row["n"]) for row in totals], weights, repeats)
    known = {row["key"]: (row["n"], target[row["source"]]) for row in totals}
    plan = spark.createDataFrame(
        [(key, n, t, int(min(repeats, t // n)) if n else 0) for key, (n, t) in known.items()],
        "key string, source_size long, target double, times int",
    )

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        key = group["key"].iloc[0]
        n, t = known[key]
        times = int(min(repeats, t // n)) if n else 0
        budget = int(round(t - times * n)) if times < repeats else 0
        chosen = fit(dict(zip(group["size"].tolist(), group["count"].tolist())), budget, f"{seed}|{key}")
        return pd.DataFrame({"key": key, "size": list(chosen), "extra": list(chosen.values())})

    classes = rows.groupBy("key", "size").agg(F.count("*").alias("count"))
    chosen = classes.groupBy("key").applyInPandas(choose, "key string, size long, extra long")
    parts = rows.groupBy("key", "size", "part").agg(F.count("*").alias("c")).join(chosen, ["key", "size"])
    before = Window.partitionBy("key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("room", F.col("extra") - F.coalesce(F.sum("c").over(before), F.lit(0)))
    parts = stored(parts.where("room > 0").select("key", "size", "part", "c", "room"), "shares")
    whole = rows.join(parts, ["key", "size", "part"], "left").withColumn(
        "more", F.when(F.col("room").isNull(), 0).when(F.col("room") >= F.col("c"), 1)
    )
    columns = ["doc_id", "k1", "k2", "size", "key", "more"]
    rank = F.row_number().over(Window.partitionBy("key", "size", "part").orderBy("hash", "doc_id"))
    cut = whole.where("more IS NULL").withColumn("more", (rank <= F.col("room")).cast("int"))
    picked = whole.where("more IS NOT NULL").select(*columns).unionByName(cut.select(*columns))
    out = picked.join(plan, "key")
    return out.select(
        "doc_id", "k1", "k2", "size", "source_size", "target",
        (F.col("size") * (F.col("times") + F.col("more"))).alias("taken"),
    )
