"""Narrowest types of text columns, the text grid and hashed counts on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from conftest import in_order, rows

from gristmill.operators import classify
from gristmill.sinks import files as sinks
from gristmill.sources import inference

COLUMNS = {
    "whole": (["1", "-20", "+3", None], "int"),
    "large": (["1", "3000000000", None, None], "bigint"),
    "huge": (["1", "99999999999999999999", None, None], "double"),
    "decimal": (["1", "2.5", "-.5e3", None], "double"),
    "day": (["2024-02-29", "2023-01-01", None, None], "date"),
    "moment": (["2024-02-29", "2023-01-01 10:00:00", None, "2023-01-01T10:00:00.25"], "timestamp"),
    "no_day": (["2024-02-30", "2023-01-01", None, None], "string"),
    "flag": (["true", "False", None, "TRUE"], "boolean"),
    "mixed": (["1", "true", None, None], "string"),
    "day_or_number": (["2024-01-01", "5", None, None], "string"),
    "none": ([None] * 4, "string"),
    "words": (["a", "b", "c", "1"], "string"),
}


@pytest.fixture(scope="module")
def untyped(spark):
    schema = ", ".join(f"{name} string" for name in COLUMNS)
    return spark.createDataFrame(list(zip(*(values for values, _ in COLUMNS.values()))), schema)


def test_narrowest_types(untyped):
    found = {r["column_name"]: (r["data_type"], r["filled"]) for r in inference.inferred_types(untyped).collect()}
    assert found == {name: (kind, sum(v is not None for v in values)) for name, (values, kind) in COLUMNS.items()}


def test_no_rows(untyped):
    assert {(r["data_type"], r["filled"]) for r in inference.inferred_types(untyped.limit(0)).collect()} == {("string", 0)}


def test_values_are_read_with_their_types(spark, untyped, tmp_path):
    path = str(tmp_path / "csv")
    untyped.coalesce(1).write.csv(path, header=True)
    read = inference.read_inferred(spark, path)
    assert dict(read.dtypes) == {name: kind for name, (_, kind) in COLUMNS.items()}
    assert read.count() == 4 and read.where("whole = -20 AND decimal = 2.5").count() == 1


def test_grid_lines_are_those_of_the_preview(spark):
    frame = spark.createDataFrame([(i, None if i == 3 else "x" * i, i / 4) for i in range(9)], "n int, text string, `a long name` double")
    lines = sinks.grid_lines(frame, 5, "n")
    assert [r[0] for r in in_order(lines.orderBy("number"))] == list(range(9))
    assert [r[1] for r in in_order(lines.orderBy("number"))] == sinks.preview_lines(frame.orderBy("n"), 5)
    empty = sinks.grid_lines(frame.limit(0), 5, "n")
    assert [r[1] for r in in_order(empty.orderBy("number"))] == sinks.preview_lines(frame.limit(0), 5)


def test_hashed_counts(spark):
    texts = ["a b b c", "A; d", "", None, "the a", "e f g h i j k l m n o p q r s t"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = defaultdict(lambda: [set(), 0, set()])
    for i, text in enumerate(texts):
        for word, n in Counter(w for w in re.split(r"\W+", (text or "").lower()) if w and w != "the").items():
            messages, _, terms = expected[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 8]
            messages.add(i)
            terms.add(word)
            expected[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 8][1] += n
    plain = sorted((b, len(m), n, len(t), len(t) - 1) for b, (m, n, t) in expected.items())
    found = classify.hashed_counts(frame, ["the"], buckets=8)
    assert rows(found) == sorted(plain, key=repr) and any(r[4] for r in plain)
