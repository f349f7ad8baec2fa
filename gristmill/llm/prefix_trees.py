"""Operator 3: repeated passages of words, by suffix trees in prefix-partitioned groups."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gristmill.llm.repeats import by_prefix, remove_repeats

WORDS = 35


def remove_repeated_passages(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Remove every word that a window of ``words`` words covers which also starts anywhere else.

    The suffixes are split by prefixes of variable length, about a quarter of the window, all but three words of
    it, and the whole. A prefix met once ends its branch; below the others, stretches of suffixes that go on alike
    are settled, and one stretch of each kind is split again by the longer prefix. So only branches that go on
    reach the next, deeper and finer level, a group is never held in memory (its node is a count and two extremes,
    made per task first), and the nodes at depth ``words`` with two leaves or more are the repeats.

    One row per input row: doc_id, n_words, n_removed, n_spans (maximal removed runs), kept_sha256. Null, empty
    and short texts lose nothing. Rows that are equal in doc_id and text count as two documents: each repeats the
    other. Other columns are ignored. Windows are judged on the input.
    """
    depths = (max(1, words // 4), max(1, words - 3), words)
    return remove_repeats(documents, "word", words, depths, by_prefix).withColumnRenamed("n", "n_words")
