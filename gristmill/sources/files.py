"""File readers: CSV, text lines, fixed-width lines, JSON documents, key-value lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """A CSV file or folder. Without a schema the types are inferred, at the cost of one pass.

    Paths are Hadoop paths; a missing one is reported by the reader itself.
    """
    if schema is None:
        return spark.read.csv(path, header=header, inferSchema=True)
    return spark.read.csv(path, header=header, schema=schema)


def read_first_available(
    spark: SparkSession, paths: Sequence[str], schema: str, kinds: Sequence[str] | None = None
) -> DataFrame:
    """The first of ``paths`` that exists, e.g. the cleaned table, or else the raw one.

    ``kinds`` says for each path whether it is ``csv`` (all, if left out) or another format, as
    ``parquet``.
    """
    kinds = kinds or ["csv"] * len(paths)

    def read(path: str, kind: str) -> DataFrame:
        if kind == "csv":
            return read_csv(spark, path, schema)
        return spark.read.format(kind).schema(schema).load(path)

    for path, kind in zip(paths[:-1], kinds):
        try:
            return read(path, kind)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return read(paths[-1], kinds[-1])


def snake_case(frame: DataFrame) -> DataFrame:
    """Column names without blanks and hyphens, in lower case."""
    return frame.toDF(*(c.lower().replace(" ", "_").replace("-", "_") for c in frame.columns))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one per line; fields that a document lacks are null."""
    return spark.read.json(path, schema=schema)


def read_key_values(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of ``key<TAB>value``."""
    return spark.read.csv(path, sep="\t", schema=schema)


def fixed_width(lines: DataFrame, fields: dict[str, tuple[int, int, str]], column: str = "value") -> DataFrame:
    """Cut fields ``{name: (first position from 1, length, type)}`` out of each line.

    A field that does not read as its type is null, so that one bad line cannot end the job.
    """
    return lines.select(
        *(F.trim(F.substring(column, at, length)).try_cast(kind).alias(name) for name, (at, length, kind) in fields.items())
    )
