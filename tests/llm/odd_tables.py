"""Fixtures that the tests import: a second conftest would hide the one of the other tests."""

from __future__ import annotations

import pytest

#: Extra columns whose names the operators use themselves.
EXTRA = "k1 string, n int, size string, key int, Gone string, empty int, taken string, hash string, part int"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and wordless texts, ties, repeated rows, a long text, no id, and columns that clash."""
    words = [f"w{i * 7919 % 1009}" for i in range(12_000)]
    long, edited = " ".join(words), " ".join(w if i % 997 else "other" for i, w in enumerate(words))
    page = "\n".join(" ".join(f"x{k}y{j}" for j in range(14)) for k in range(9))
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "one", "b"), (5, "one", "b"),
        (None, "a text without an id but of some words, all right", "c"), (6, long, "a"), (7, edited, "a"),
        (8, page, "é"), (9, page.replace("x3y5", "x3z5"), "é"), (10, "aa " * 300, "b"), (11, "a" * 2000, None),
        (12, "Èé ÇÀ über straße " * 40, "b"), (13, page + "\nThe end of it all, at last.", "é"),
    ]
    rows = [(i, t, s, "k", 1, "s", 2, "g", 3, "t", "h", 4) for i, t, s in texts]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, source string, {EXTRA}")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, lang string, source string, n_chars bigint, {EXTRA}")


def plain(frame):
    """Rows (doc_id, text) without an id that is missing or not the first of its kind."""
    seen, out = set(), []
    for row in frame.select("doc_id", "text").collect():
        if row["doc_id"] is not None and row["doc_id"] not in seen:
            seen.add(row["doc_id"])
            out.append((row["doc_id"], row["text"]))
    return out


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
