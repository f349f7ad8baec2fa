from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from gristmill.operators import distinct


def test_reports_of_all_levels_from_one_table(spark):
    """Ids that repeat within and across groups, missing ones, and ids in several buckets."""
    frame = spark.range(9000).select(
        (F.col("id") % 3).cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 1000 * 97 + 1).alias("order"), (F.col("id") % 50 + 1).alias("customer"),
    )
    bitmaps = distinct.id_bitmaps(frame, ["a", "b"], {"orders": "order", "customers": "customer"})
    assert bitmaps.where("measure = 'orders'").select("bucket").distinct().count() == 3
    for keys in (["a"], ["b"], ["a", "b"], []):
        plain = frame.groupBy(*keys).agg(F.countDistinct("order").alias("orders"), F.countDistinct("customer").alias("customers"))
        assert rows(distinct.distinct_report(bitmaps, keys, ["orders", "customers"])) == rows(plain)
    # Parts of a table are counted apart and merged.
    halves = [distinct.id_bitmaps(frame.where(f"order % 2 = {i}"), ["a"], {"orders": "order"}) for i in (0, 1)]
    merged = distinct.distinct_report(halves[0].unionByName(halves[1]), ["a"], ["orders"])
    assert rows(merged) == rows(frame.groupBy("a").agg(F.countDistinct("order").alias("orders")))


def test_no_rows(spark):
    frame = spark.range(0).select(F.lit("x").alias("a"), F.col("id").alias("order"))
    bitmaps = distinct.id_bitmaps(frame, ["a"], {"orders": "order"})
    assert distinct.distinct_report(bitmaps, ["a"], ["orders"]).count() == 0


def test_scattered_ids_take_a_few_bytes_each(spark):
    """A combination that holds one id of a bucket has one word of it, not the whole bucket; extreme ids count too."""
    frame = spark.range(4000).select(F.col("id").cast("string").alias("a"), (F.col("id") * 40_000).alias("order"))
    bitmaps = distinct.id_bitmaps(frame, ["a"], {"orders": "order"})
    assert bitmaps.count() == 4000 and dict(bitmaps.dtypes)["bits"] == "bigint"
    ids = [(i,) for i in (-(2**63), -32769, -1, 0, 1, 63, 64, 32767, 32768, 2**63 - 1)]
    extreme = spark.createDataFrame(ids * 3, "order bigint")
    found = distinct.distinct_report(distinct.id_bitmaps(extreme, [], {"orders": "order"}), [], ["orders"])
    assert rows(found) == [(len(ids),)]
