"""Near-duplicates, repeated passages and lines against plain Python."""

from __future__ import annotations

import brute
import pytest
from odd_tables import documents, no_documents, odd_documents, plain  # noqa: F401
from pyspark.sql import functions as F

from gristmill.llm import common, line_edits, minmax, prefix_trees, queries, repeats, suffix_order


def near(frame, size=2):
    return sorted((tuple(r) for r in minmax.near_duplicates(frame, size, 80).collect()), key=repr)


def test_near_duplicates(spark, sf_dir, documents):
    found = sorted(tuple(r) for r in queries.op1_minhash_near_dedup(spark, sf_dir).collect())
    assert found == brute.near_duplicates(plain(documents), 2, 80)
    assert any(not row[3] for row in found)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_near_duplicates_of_odd_documents(odd_documents, size):
    found = near(odd_documents, size)
    assert len(found) == odd_documents.count()
    expected = set(brute.near_duplicates(plain(odd_documents), size, 80))
    assert {row for row in found if row[0] is not None} == expected
    assert [row[2:] for row in found if row[0] is None] == [(None, True)]


def test_blocks_of_a_cluster(spark, monkeypatch):
    """A cluster cut into many blocks gives the same components."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        own = [w if (k * 31 + i * 17) % 97 > i // 6 else f"v{i}_{k}" for k, w in enumerate(words)]
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute.near_duplicates(rows, 2, 80)
    monkeypatch.setattr(minmax, "BLOCK_DOCUMENTS", 7)
    assert near(frame) == sorted(expected, key=repr)
    assert len({row[2] for row in expected}) > 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 3), (3, 5), (5, 9), (7, 7)]
    found = common.components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == [(3, 3), (5, 3), (9, 3)] + [(i, 100) for i in range(100, 141)]


def passages(frame, count, by_word, width):
    if by_word:
        found = prefix_trees.remove_repeated_passages(frame, width)
    else:
        found = suffix_order.remove_repeated_bytes(frame, width)
    return sorted((tuple(r[c] for c in ("doc_id", count, "n_removed", "n_spans", "kept_sha256")) for r in found.collect()), key=repr)


@pytest.mark.parametrize("name, count, by_word, width", [
    ("op3_substring_dedup", "n_words", True, 35), ("op10_suffix_array_dedup", "n_bytes", False, 400),
])
def test_repeated_passages(spark, sf_dir, documents, name, count, by_word, width):
    found = queries.QUERIES[name](spark, sf_dir).collect()
    found = sorted((tuple(r[c] for c in ("doc_id", count, "n_removed", "n_spans", "kept_sha256")) for r in found), key=repr)
    assert found == brute.remove_repeats(plain(documents), width, by_word)
    assert any(row[2] for row in found)


@pytest.mark.parametrize("count, by_word, width", [
    ("n_words", True, 5), ("n_words", True, 35), ("n_bytes", False, 3), ("n_bytes", False, 60), ("n_bytes", False, 1),
])
def test_repeats_in_odd_documents(odd_documents, count, by_word, width):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    assert passages(odd_documents, count, by_word, width) == brute.remove_repeats(rows, width, by_word)


def test_chunks_of_a_long_text(odd_documents, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()]
    import numpy as np

    raw = rows[7][1].encode()
    values = repeats.units(raw, "byte")
    whole = repeats.heads(values, [(0, len(values) - 50)], 50, 8)
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    cut = repeats.heads(values, [(0, len(values) - 50)], 50, 8)
    assert set(np.unique(whole[0])) == set(np.unique(cut[0]))
    assert [int(x) for x in cut[2][1:]] == [int(x) + 1 for x in cut[3][:-1]]


def lines(frame, steps=line_edits.EDITS):
    found = line_edits.repeated_lines(frame, steps)
    return sorted((r["doc_id"], r["n_lines"], list(r["removed"])) for r in found.collect() if r["doc_id"] is not None)


def test_repeated_lines(spark, sf_dir, documents):
    found = lines(documents)
    assert found == brute.repeated_lines(plain(documents), line_edits.EDITS)
    assert any(row[2] for row in found)
    # No line but an empty one stays twice.
    kept = line_edits.without_lines(documents).select(F.explode(F.split("text", "\n")).alias("line"))
    kept = kept.select(F.btrim("line", F.lit(line_edits.BLANKS)).alias("line")).where("line <> ''")
    assert kept.count() == kept.distinct().count() > 0


@pytest.mark.parametrize("steps", [(), ((16, 1),), ((4, 2),), ((8, 3),), line_edits.EDITS, ((2, 1), (6, 2), (12, 3))])
def test_lines_of_odd_documents(odd_documents, steps):
    found = line_edits.repeated_lines(odd_documents, steps)
    assert found.count() == odd_documents.count()
    ids = {i for i, _ in plain(odd_documents)}
    assert sorted(set(map(repr, lines(odd_documents, steps)))) == sorted(map(repr, brute.repeated_lines(plain(odd_documents), steps)))
    assert {r["doc_id"] for r in found.collect()} - {None} == ids


def test_a_very_long_line_and_its_edits(spark):
    """Lines of 1,500 characters with none to three characters changed, and short lines that only repeat exactly."""
    long = "".join(chr(97 + i * i % 23) for i in range(1500))
    edited = [long, long[:9] + "X" + long[10:], long[:1400] + long[1401:], "Q" + long[:700] + long[701:], "XYZ" + long[3:]]
    rows = [(i, f"{x}\nab\n{'cd' if i else 'ce'}\n") for i, x in enumerate(edited)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines(frame) == brute.repeated_lines(rows, line_edits.EDITS)
    assert [r[2] for r in lines(frame)] == [[], [0, 1], [0, 1, 2], [0, 1, 2], [1, 2]]


def test_lines_from_one_template(spark):
    """Lines that share all but a number meet only where a group of characters agrees as well; the rows stay right."""
    rows = [(i, f"This page was last changed by the editor of the day on its visit number {i * 7919 % 100_003:06d}") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines(frame) == brute.repeated_lines(rows, line_edits.EDITS)


def test_lines_edited_at_any_place(spark):
    """Under a key of many lines, those with another first letter meet the line they come from, as all others do."""
    line = "n the beginning there was one line that a careful editor changed at a single place, and at no other place"
    edited = ["I" + line] + [c + line for c in "ABCDEFGHJKLMNOPQRSTU"] + ["I" + line[:k] + "#" + line[k + 1 :] for k in range(0, 105, 15)]
    rows = list(enumerate(edited))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert lines(frame) == brute.repeated_lines(rows, line_edits.EDITS) == [(0, 1, [])] + [(i, 1, [0]) for i, _ in rows[1:]]


def test_conditions_on_lines_that_meet(spark):
    """Lines within two edits pass; two copies with a word put in at different places no longer make a pair."""
    import random

    rng = random.Random(5)
    line = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé ") for _ in range(400))
    put = [line[:k] + word + line[k:] for k, word in ((40, "iocr "), (300, "bmmg "))]
    cut = []
    for _ in range(100):
        a, b = sorted(rng.sample(range(400), 2))
        cut.append((line, line[:a] + rng.choice(["", "x"]) + line[a + 1 : b] + "Q" + line[b:]))
    frame = spark.createDataFrame([*cut, tuple(put)], "a string, b string")
    shapes = frame.select("a", "b", line_edits._shape(F.col("a")).alias("x"), line_edits._shape(F.col("b")).alias("y"))
    found = shapes.select("a", F.expr(line_edits._alike("x", "y", "2")).alias("alike")).collect()
    assert all(r["alike"] == (r["a"] == line) for r in found)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    import random

    rng = random.Random(edits)
    rows = []
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(edits + 1, 14)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "x"])
        b = "".join(b)
        if b:
            rows.append((a, b) if len(a) <= len(b) else (b, a))
    frame = spark.createDataFrame(rows, "a string, b string")
    found = frame.select("a", "b", line_edits.within(F.col("a"), F.col("b"), edits).alias("near")).collect()
    assert all(r["near"] == (brute.edit_distance(r["a"], r["b"]) <= edits) for r in found)


def test_documents_without_their_repeated_lines(odd_documents):
    before = {(r["doc_id"], r["text"]) for r in odd_documents.select("doc_id", "text").collect()}
    frame = line_edits.without_lines(odd_documents)
    assert frame.columns == odd_documents.columns
    after = [(r["doc_id"], r["text"]) for r in frame.collect()]
    gone = {i: (n, lost) for i, n, lost in brute.repeated_lines(plain(odd_documents), line_edits.EDITS)}
    for doc_id, text in before:
        n, lost = gone.get(doc_id, (0, []))
        kept = text if not lost else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in lost)
        assert ((doc_id, kept) in after) == (not lost or len(lost) < n)


def test_empty_tables(no_documents):
    assert near(no_documents) == []
    assert passages(no_documents, "n_words", True, 35) == passages(no_documents, "n_bytes", False, 400) == []
    assert lines(no_documents) == [] and line_edits.without_lines(no_documents).count() == 0
