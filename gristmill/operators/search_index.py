"""Search by posting lists of trigrams: a pattern is tried only on values that hold its literal parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.session import written

GRAM = 3


def folded(value: Column) -> Column:
    """Upper and then lower case, so that letters with several lower-case forms agree."""
    return F.lower(F.upper(value))


def grams(value: Column) -> Column:
    """The distinct runs of three characters of a folded text."""
    starts = F.sequence(F.lit(1), F.length(value) - (GRAM - 1))
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(value, i, GRAM)))
    return F.when(F.length(value) >= GRAM, cut)


def trigram_index(values: DataFrame, column: str) -> DataFrame:
    """``gram, value``: a posting for every trigram of every distinct value. Written once, read by any search."""
    distinct = values.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    postings = distinct.select("value", F.explode(grams(folded(F.col("value")))).alias("gram"))
    return written(postings.select("gram", "value").sortWithinPartitions("gram"), "trigrams")


def literal_parts(pattern: str) -> list[list[str]]:
    """For each alternative of a regular expression the texts that every match of it must hold.

    Only what is certain is kept: groups, classes, escapes that stand for classes, anchors and optional characters end
    a text. An alternative inside a group is not taken apart.
    """
    alternatives: list[list[str]] = [[]]
    run, at = "", 0

    def close() -> None:
        nonlocal run
        if run:
            alternatives[-1].append(run)
        run = ""

    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            follows = pattern[at + 1 : at + 2]
            if follows == "Q":
                end = pattern.find("\\E", at)
                run += pattern[at + 2 : end if end >= 0 else len(pattern)]
                at = (end if end >= 0 else len(pattern)) + 2
                continue
            if follows.isalnum():
                close()
            else:
                run += follows
            at += 2
        elif c in "([":
            close()
            at = _after(pattern, at)
        elif c in "?*{":
            # The character before may be missing.
            run = run[:-1]
            close()
            at = pattern.find("}", at) + 1 if c == "{" and pattern.find("}", at) >= 0 else at + 1
        elif c == "|":
            close()
            alternatives.append([])
            at += 1
        elif c in ".^$+)":
            close()
            at += 1
        else:
            run += c
            at += 1
    close()
    return alternatives


def _after(pattern: str, at: int) -> int:
    """The place behind the class or group that starts at ``at``."""
    depth, inside = 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]" or pattern[at - 1] in "[^"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        at += 1
        if depth == 0 and not inside:
            return at
    return at


def candidates(index: DataFrame, parts: Sequence[Sequence[str]]) -> DataFrame | None:
    """Values whose postings hold all trigrams of one alternative; None if an alternative has no trigram.

    The trigrams sought are literals of the plan, so only their postings are read.
    """
    spark = index.sparkSession
    sought = []
    for i, texts in enumerate(parts):
        found = set()
        for part in texts:
            fold = part.upper().lower()
            found |= {fold[k : k + GRAM] for k in range(len(fold) - GRAM + 1)}
        if not found:
            return None
        sought += [(i, gram, len(found)) for gram in sorted(found)]
    wanted = spark.createDataFrame(sought, "part INT, gram STRING, need INT")
    read = index.where(F.col("gram").isin(*sorted({gram for _, gram, _ in sought})))
    # As many rows as the pattern has trigrams.
    met = read.join(F.broadcast(wanted), "gram").groupBy("value", "part", "need").agg(F.count(F.lit(1)).alias("n"))
    return met.where("n = need").select("value").distinct()


def matching_values(values: DataFrame, column: str, index: DataFrame, pattern: str, literal: bool = False) -> DataFrame:
    """``value``: the distinct values of a column that match, ignoring case; the pattern runs on candidates only.

    A pattern without a literal of three characters in each alternative has all values as candidates.
    """
    found = candidates(index, [[pattern]] if literal else literal_parts(pattern))
    if found is None:
        found = values.select(F.col(column).cast("string").alias("value")).distinct()
    return found.where(text.contains_pattern(F.col("value"), pattern, literal))
