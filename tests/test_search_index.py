from __future__ import annotations

import re

import pytest
from conftest import rows

from gristmill.operators import projections, search_index

PARTS = {
    "plain": [["plain"]],
    "CUSTOMER#0[1-3]|^green .*T$|nation_7": [["CUSTOMER#0"], ["green ", "T"], ["nation_7"]],
    "a(b|c)d": [["a", "d"]],
    "colou?r": [["colo", "r"]],
    "ab*c+d": [["a", "c", "d"]],
    "x{2,3}yz": [["yz"]],
    r"1\.5\d+ kg": [["1.5", " kg"]],
    r"\Qa.b\Ec": [["a.bc"]],
    "[]|]abc|[^]x]d": [["abc"], ["d"]],
    "(?:one|two) three": [[" three"]],
    "|abc": [[], ["abc"]],
}


@pytest.mark.parametrize("pattern", PARTS)
def test_literal_parts(pattern):
    assert search_index.literal_parts(pattern) == PARTS[pattern]


VALUES = ["Green tea T", "green", "NATION_7", "nation_8", "a.bc", "colour", "color", "cool", "xxyz", "abc", "ab", "straße", "STRASSE", "1.55 KG", None, ""]


@pytest.mark.parametrize("pattern", ["^green .*T$|nation_7", "colou?r", r"1\.5\d+ kg", "abc|color", "abc|b", "ß", ".", "strasse", "x{2}yz", "nothing"])
def test_same_values_as_the_pattern_alone(spark, pattern):
    frame = spark.createDataFrame([(v,) for v in VALUES] * 2, "name string")
    index = search_index.trigram_index(frame, "name")
    found = rows(search_index.matching_values(frame, "name", index, pattern))
    assert found == rows(projections.search(frame, pattern, ["name"]).distinct())


@pytest.mark.parametrize("pattern", ["NATION", ".b", "green t", "zz"])
def test_literal_search(spark, pattern):
    frame = spark.createDataFrame([(v,) for v in VALUES], "name string")
    index = search_index.trigram_index(frame, "name")
    found = rows(search_index.matching_values(frame, "name", index, pattern, literal=True))
    assert found == rows(projections.search(frame, pattern, ["name"], literal=True).distinct())


def test_only_candidates_are_tried(spark):
    """Of a thousand names the pattern sees those that hold its literal, and no others."""
    frame = spark.createDataFrame([(f"name {i:04d}",) for i in range(1000)], "name string")
    index = search_index.trigram_index(frame, "name")
    found = search_index.candidates(index, search_index.literal_parts("name 012[0-4]"))
    tried = [r["value"] for r in found.collect()]
    assert 10 <= len(tried) < 20 and all("012" in v for v in tried)
    hits = search_index.matching_values(frame, "name", index, "name 012[0-4]")
    assert sorted(r["value"] for r in hits.collect()) == [f"name 012{i}" for i in range(5)]
    assert all(re.search("name 012[0-4]", v) for (v,) in rows(hits))
