"""The pipeline's stages, one by one and in a row."""

from __future__ import annotations

import brute
import pytest
from odd_tables import no_documents, odd_documents, plain  # noqa: F401

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from gristmill.llm import line_edits, pairwise_quality, queries, spaced_seeds
from gristmill.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_a_row(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in pipeline.STAGES:
        before, rows = docs, {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, sf_dir), "test")
        kept = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns[: len(COLUMNS)] == COLUMNS and set(kept) <= set(rows) and kept
        if name == "quality classifier":
            ranker = pairwise_quality.learn(before, table(spark, sf_dir, "labels"))
            scores = {r["doc_id"]: r["score"] for r in pairwise_quality.score(before, ranker).collect()}
            assert set(kept) == {i for i, s in scores.items() if s >= pairwise_quality.CUT}
        elif name == "line dedup":
            gone = {i: lost for i, n, lost in brute.repeated_lines(plain(before), line_edits.EDITS)}
            for i, r in rows.items():
                left = [x for k, x in enumerate(r["text"].split("\n")) if k not in gone[i]]
                assert (i in kept) == bool(left) and (not left or kept[i]["text"] == "\n".join(left))
                assert not left or kept[i]["n_chars"] == len(kept[i]["text"])
        elif name == "minhash near-dedup":
            assert set(kept) == {r[0] for r in brute.near_duplicates(plain(before), 5, 80) if r[3]}
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
            found = brute.leaked(plain(before), items, spaced_seeds.STRETCH, spaced_seeds.SHARE)
            assert set(kept) == {i for i, x in found.items() if not x}
        else:
            sizes = {i: len(brute.WORD.findall(t or "")) for i, t in plain(before)}
            assert all(kept[i]["size"] == sizes[i] and 0 < kept[i]["taken"] <= 3 * sizes[i] for i in kept)
            assert abs(sum(r["taken"] for r in kept.values()) - sum(sizes.values())) < 0.01 * sum(sizes.values())
    whole = sorted(tuple(r) for r in pipeline.run(spark, sf_dir).collect())
    assert whole == sorted(tuple(r) for r in docs.collect())


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_with_odd_documents(spark, sf_dir, odd_documents, no_documents, name, stage):
    kept = stage(spark, odd_documents, sf_dir)
    assert kept.columns[: len(odd_documents.columns)] == odd_documents.columns
    assert kept.count() <= odd_documents.count()
    assert stage(spark, no_documents, sf_dir).count() == 0


def test_repeated_rows_and_rows_without_an_id(spark, sf_dir, odd_documents):
    kept = pipeline.near_dedup(spark, odd_documents, sf_dir).collect()
    assert [r["doc_id"] for r in kept].count(None) == 1
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None and r["doc_id"] in (4, 5)) == [4]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, sf_dir, name):
    from oracle import compare, database

    connection = database(sf_dir)
    assert connection.execute(queries.SQL[name]).fetchmany(1)
    assert compare(queries.QUERIES[name](spark, sf_dir), connection, queries.SQL[name]) is None


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
