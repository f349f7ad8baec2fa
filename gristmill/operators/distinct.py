"""Exact distinct counts that merge: one table of bitmaps serves reports at every level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(frame: DataFrame, keys: Sequence[str], ids: Mapping[str, str]) -> DataFrame:
    """Per combination of ``keys``: which ids occur, as words of 64 bits in buckets of 32,768 neighbouring ids.

    ``ids`` names a measure and its column of whole numbers, which should lie close together: a word is a row,
    however few of its ids occur, and never more rows than there are ids. Rows: the keys, measure, bucket, word,
    bits. Missing ids do not count. Tasks build their words before the shuffle, so a combination with very many
    rows sends one row per word and task.
    """
    each = F.explode(
        F.array(*(F.struct(F.lit(name).alias("measure"), F.col(column).cast("long").alias("id")) for name, column in ids.items()))
    )
    rows = frame.select(*keys, each.alias("_m")).select(*keys, "_m.measure", "_m.id").where("id IS NOT NULL")
    place = F.bitmap_bit_position("id").cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))
    return rows.groupBy(
        *keys, "measure", F.bitmap_bucket_number("id").alias("bucket"), F.shiftright(place, 6).alias("word")
    ).agg(F.bit_or(bit).alias("bits"))


def distinct_report(bitmaps: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Distinct ids of every measure per combination of ``keys`` (some of those of the bitmaps, or none)."""
    merged = bitmaps.groupBy(*keys, "measure", "bucket", "word").agg(F.bit_or("bits").alias("bits"))
    counts = {m: F.sum(F.when(F.col("measure") == m, F.bit_count("bits")).otherwise(0)).alias(m) for m in measures}
    return merged.groupBy(*keys).agg(*counts.values())


def distinct_reports(bitmaps: DataFrame, levels: Mapping[str, Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """Reports of several levels under each other: level, name (the keys joined by a slash), and the measures."""
    reports = [
        distinct_report(bitmaps, keys, measures).select(
            F.lit(level).alias("level"), F.concat_ws("/", *keys).alias("name"), *measures
        )
        for level, keys in levels.items()
    ]
    return reduce(DataFrame.unionByName, reports)
