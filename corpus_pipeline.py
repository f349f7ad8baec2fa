"""A training corpus from raw documents: stages that each read what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import line_edits, minmax, mixing, pairwise_quality, spaced_seeds
from gristmill.llm.common import row_key, spare, stored, table, without_rows

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the documents it is given."""
    ranker = pairwise_quality.learn(docs, table(spark, sf_dir, "labels"))
    return pairwise_quality.keep_good(docs, ranker)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; a document goes if it has no other lines."""
    return line_edits.without_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id.

    Rows that share a doc_id go together if any of them goes; of rows equal in doc_id and text one stays; rows
    without an id stay.
    """
    found = minmax.near_duplicates(docs, size=5, percent=80)
    kept = docs.join(found.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = spaced_seeds.leaks(docs, table(spark, sf_dir, "benchmark"))
    return without_rows(docs, found.where(F.size("items") > 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the words that it takes of each; those it takes nothing of go.

    Columns size, source_size, target and taken are added; a column of documents with such a name keeps its own
    values, and the new one gets an underscore.
    """
    names = [spare(docs.columns, c) for c in ("k1", "k2", "size", "source_size", "target", "taken")]
    picked = mixing.mix(docs).drop("doc_id").where("taken > 0").dropDuplicates(["k1", "k2"]).toDF(*names)
    keyed = docs.withColumns(dict(zip(names[:2], row_key())))
    return keyed.join(picked, names[:2]).drop(*names[:2])


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("source mixing", mix_sources),
]
#: Learned scores, near-duplicate groups and budget fitting are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
