"""The registered queries of the operators, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import (
    heap_centroids,
    language_model,
    html_text,
    licenses,
    line_edits,
    minmax,
    mixing,
    pairwise_quality,
    prefix_trees,
    projections,
    spaced_seeds,
    suffix_order,
    whitening,
)
from gristmill.llm.common import table
from gristmill.llm.sql import SQL  # noqa: F401  (with the queries, for the driver)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trees.remove_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")


@query
def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_order.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("repeats"))


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("k1", "k2")


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spaced_seeds.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    leak = F.size("items") > 0
    return found.select("doc_id", leak.alias("contaminated"), (~leak).alias("kept"), "items", "share")


@query
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_edits.repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heap_centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.document_scores(table(spark, sf_dir, "documents"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
