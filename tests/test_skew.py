"""Tables in which one key holds a large share of the rows."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gristmill.functions import numbers
from gristmill.operators import heavy, sales, series
from gristmill.sources import tables


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    """The small tables with two thirds of the order lines on one part and one order."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part, order = lines.agg(F.min("l_partkey"), F.min("l_orderkey")).first()
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit(3)) < 2
    lines.withColumns(
        {
            "l_partkey": F.when(hot, F.lit(part)).otherwise(F.col("l_partkey")),
            "l_orderkey": F.when(hot, F.lit(order)).otherwise(F.col("l_orderkey")),
        }
    ).repartition(8).write.parquet(f"{folder}/lineitem.parquet")  # a hot partition is split by map tasks
    for name in ("orders", "part", "customer", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def tiny_thresholds(spark):
    """Sizes at which the small tables behave like large ones: nothing is broadcast, hot partitions are split."""
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    )


def test_a_hot_part_is_split_in_the_join(spark, skewed, capsys):
    plain = rows(sales.summary(_lines(spark, skewed), ["category", "sub_category"]))
    with tiny_thresholds(spark):
        lines = _lines(spark, skewed)
        report = sales.summary(lines, ["category", "sub_category"])
        assert rows(report) == plain
        report.explain()
    assert "skew=true" in capsys.readouterr().out


def _lines(spark, folder):
    return tables.sales_lines(spark, folder, "order_id", "category", "sub_category", "sales", "profit", "quantity")


def test_a_hot_order_is_one_row_before_its_joins(spark, skewed):
    orders = tables.order_totals(spark, skewed, "order_id", "region", "sales", "lines")
    lines = tables.sales_lines(spark, skewed, "sales")
    assert orders.count() == tables.sales_lines(spark, skewed, "order_id").distinct().count()
    assert orders.agg(F.sum("sales")).first()[0] == lines.agg(numbers.total(lines, "sales")).first()[0]


def test_grains_agree_on_skewed_tables(spark, skewed):
    columns = ("order_id", "customer_id", "segment", "sales", "profit", "quantity")
    lines = sales.kpi_row(tables.sales_lines(spark, skewed, *columns))
    orders = sales.kpi_row(tables.order_totals(spark, skewed, *columns), sales.ORDER)
    customers = sales.kpi_row(
        tables.customer_totals(spark, skewed, "customer_id", "orders", "sales", "profit", "quantity"), sales.CUSTOMER
    )
    assert rows(lines) == rows(orders) == rows(customers)


def even(frame):
    """Rows of the largest and of the median partition."""
    sizes = sorted(r["count"] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().collect())
    return sizes[-1], sizes[len(sizes) // 2]


PLAIN = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__shuffle__partitions": "8"}


def test_first_and_last_of_few_series_are_dealt_evenly(spark, sf_dir):
    """Five series, of which one holds three quarters of the ticks; adaptive execution is off."""
    ticks = series.clean(tables.prices(spark, sf_dir))
    name = ticks.agg(F.min("stock")).first()[0]
    ticks = ticks.withColumn("stock", F.when(F.col("tick") % 4 < 3, F.lit(name)).otherwise(F.col("stock")))
    with settings(spark, **PLAIN):
        found = series.with_endpoints(ticks)
        top, middle = even(found)
        assert top <= 2 * middle
        plain = ticks.join(series.endpoints(ticks), "stock")
        assert rows(found.select(*plain.columns)) == rows(plain)
        worst, _ = even(plain)
        assert worst > 2 * top


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_heavy_join_gives_the_rows_of_the_plain_one(spark, how):
    """A key with two thirds of the rows, null keys, keys of one side only, and a key that stands twice in the small side."""
    large = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 9 == 2, None).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 2).alias("part"),
    )
    small = spark.createDataFrame(
        [("hot", 0, 1.0), ("hot", 0, 2.0), ("hot", 1, 3.0), (None, 0, 9.0), ("5", 1, 4.0), ("none", 0, 5.0)],
        "k STRING, part LONG, v DOUBLE",
    )
    with settings(spark, **PLAIN):
        found = heavy.join_heavy(large, small, ["k", "part"], how)
        plain = large.join(small, ["k", "part"], how)
        assert rows(found.select(*plain.columns)) == rows(plain)
        if how != "left_anti":
            top, middle = even(found)
            assert top <= 2 * middle


def test_heavy_keys_are_few(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("k"))
    assert heavy.heavy_keys(frame, ["k"], 4).count() == 0
    found = heavy.heavy_keys(frame, ["k"], 14).collect()
    assert len(found) == 7 and {r["_parts"] for r in found} == {2}
    assert heavy.heavy_keys(frame.limit(0), ["k"], 14).count() == 0
