from __future__ import annotations

from datetime import datetime

import pytest
from conftest import in_order, rows
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gristmill import session, sinks
from gristmill.functions import numbers
from gristmill.operators import reporting, storage
from gristmill.sources import files, schemas, tables
from gristmill.streaming import sliding


def test_csv_with_and_without_schema(spark, tmp_path):
    (tmp_path / "ratings.csv").write_text("userId,movieId,rating\n1,2,3.5\n")
    path = str(tmp_path / "ratings.csv")
    assert files.read_csv(spark, path, schemas.RATINGS).dtypes == files.read_csv(spark, path).dtypes
    with pytest.raises(AnalysisException):
        files.read_csv(spark, str(tmp_path / "none.csv"), schemas.RATINGS)


def test_names_become_snake_case(spark, tmp_path):
    header = "Order ID,Order Date,Ship Date,Customer ID,Customer Name,Segment,Country,City,State,Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,Discount,Profit"
    (tmp_path / "retail.csv").write_text(header + "\nO1,2021-01-01,bad,C1,Ann,Home,US,NYC,NY,,East,P1,Tech,Phones,Phone,1.5,2,0,\n")
    frame = files.snake_case(files.read_csv(spark, str(tmp_path), schemas.RETAIL_ORDERS))
    row = frame.first()
    assert (row["order_id"], row["sub_category"], row["ship_date"], row["postal_code"], row["profit"]) == (
        "O1", "Phones", "bad", None, None
    )


def test_first_available(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("userId,movieId,rating\n1,2,3.5\n")
    paths = [str(tmp_path / "cleaned.csv"), str(tmp_path / "raw.csv")]
    assert files.read_first_available(spark, paths, schemas.RATINGS).count() == 1
    (tmp_path / "cleaned.csv").write_text("userId,movieId,rating\n1,2,3.5\n4,5,1.0\n")
    assert files.read_first_available(spark, paths, schemas.RATINGS).count() == 2


def test_reports_are_single_files_in_order(spark, tmp_path):
    frame = spark.range(100).repartition(4).withColumnRenamed("id", "n")
    sinks.write_reports({"numbers": frame}, str(tmp_path), single_file=True)
    sinks.write_report(frame, str(tmp_path / "down"), order=[F.desc("n")], single_file=True)
    parts = list((tmp_path / "down").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().split()[:3] == ["n", "99", "98"]
    assert len(list((tmp_path / "numbers").glob("part-*.csv"))) == 1


def test_reports_of_any_size_are_written_in_parallel(spark, tmp_path):
    sinks.write_report(spark.range(1000).repartition(4), str(tmp_path / "large"), order=["id"])
    parts = sorted((tmp_path / "large").glob("part-*.csv"))
    ids = [int(x) for part in parts for x in part.read_text().split()[1:]]
    assert ids == list(range(1000))


def test_tables_and_previews(spark, tmp_path):
    frame = spark.range(10).withColumn("half", F.col("id") % 2)
    sinks.write_table(frame, str(tmp_path / "table"), partition_by=["half"])
    sinks.write_table(frame, str(tmp_path / "csv"), kind="csv")
    assert spark.read.parquet(str(tmp_path / "table")).filter("half = 1").count() == 5
    assert files.read_csv(spark, str(tmp_path / "csv")).count() == 10
    sinks.write_preview(frame, str(tmp_path / "preview"), "ROWS", rows=2)
    assert files.read_lines(spark, str(tmp_path / "preview")).count() == 7


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    frame = session.written(spark.range(3), "numbers")
    assert frame.inputFiles()[0].startswith(f"file://{configured}/numbers-") and frame.count() == 3


def test_partition_sizes_follow_the_input():
    assert session.shuffle_partitions(0) == 8
    assert session.shuffle_partitions(10**12) == 3726
    assert session.shuffle_partitions(10**14) == 372_530


RATINGS = [(u, m, float((u * m) % 5)) for u in range(20) for m in range(10)]


@pytest.fixture(scope="module")
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id INT, movie_id INT, rating DOUBLE")


def test_rating_reports(ratings):
    averages = {m: sum(r for _, n, r in RATINGS if n == m) / 20 for m in range(10)}
    assert {r[0]: r[1] for r in rows(storage.movie_ratings(ratings))} == pytest.approx(averages)
    best = in_order(storage.well_rated(ratings, 2.0))
    assert [b[0] for b in best] == sorted((m for m in averages if averages[m] >= 2), key=lambda m: (-averages[m], m))
    assert storage.high_ratings(ratings).first()[0] == sum(r >= 4 for *_, r in RATINGS)
    assert storage.user_range(ratings).count() == 20


def test_stored_frames_are_released(ratings):
    frame = ratings.filter("rating >= 0")
    with storage.stored(frame, StorageLevel.DISK_ONLY) as kept:
        assert kept.storageLevel == StorageLevel.DISK_ONLY
    assert frame.storageLevel == StorageLevel.NONE


def test_partitions(ratings):
    assert storage.partitions_of(ratings.repartition(6)) == 6
    assert storage.partitions_of(ratings.repartition(6).coalesce(2)) == 2
    assert storage.partition_steps(ratings) == (2, 4, 8)
    assert storage.partition_steps(ratings.repartition(40)) == (10, 20, 40)


def test_partitions_follow_the_rows(ratings, monkeypatch):
    """Few partitions of very many rows are not merged into fewer."""
    monkeypatch.setattr(storage, "TASK_ROWS", 5, raising=False)
    rows = ratings.count()
    for frame in (ratings.coalesce(1), ratings.repartition(8)):
        few, some, many = storage.partition_steps(frame)
        assert few * 5 >= rows and (some, many) == (2 * few, 4 * few)


def test_strategies(ratings):
    report = storage.strategy_report(ratings).collect()
    assert [r["strategy"] for r in report] == [
        "uncached", "cached, run 1", "cached, run 2", "repartition(2)", "repartition(4)", "repartition(8)",
        "three actions, uncached", "three actions, cached", "persist(MEMORY_ONLY)", "persist(MEMORY_AND_DISK)",
        "persist(DISK_ONLY)", "8 to 2 by repartition", "8 to 2 by coalesce",
    ]
    assert report[0]["gain_pct"] == 0.0 and all(r["seconds"] > 0 for r in report)
    assert [r["partitions"] for r in report[3:6]] == [2, 4, 8]


def test_report_facts(spark):
    frame = spark.createDataFrame([("east", 2)], "region STRING, sales INT")
    wide = spark.createDataFrame([(1, 2.5)], "a INT, b DOUBLE")
    facts = reporting.report({"region": (frame, "region", "sales"), "all": (reporting.one_row(wide), "metric", "value")})
    assert rows(facts) == [("all", "a", 1.0), ("all", "b", 2.5), ("region", "east", 2.0)]


def _write_posts(spark, folder, posts):
    frame = spark.createDataFrame([(datetime(2024, 1, 1, h, m), t) for h, m, t in posts], "ts TIMESTAMP, hashtag STRING")
    frame.coalesce(1).write.mode("append").parquet(folder)


def test_stream_drops_late_posts_and_goes_on_where_it_ended(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("posts", "out", "state"))

    def run():
        posts = sliding.read_posts(spark, folder, "ts TIMESTAMP, hashtag STRING")
        counts = sliding.sliding_counts(posts, "1 hour", "1 hour", "30 minutes")
        done = sliding.run_available(counts, spark, out, state)
        return rows(done.select(F.hour("window_start"), "hashtag", "frequency"))

    _write_posts(spark, folder, [(0, 5, "ai"), (0, 50, " #AI "), (1, 10, "x"), (1, 40, "x")])
    assert run() == [(0, "#AI", 2)]
    # 0:10 is late now and dropped; 1:20 still counts.
    _write_posts(spark, folder, [(0, 10, "ai"), (1, 20, "x"), (1, 30, " "), (4, 0, "y")])
    assert run() == [(0, "#AI", 2), (1, "#X", 3)]


def test_sliding_windows_overlap(spark):
    posts = spark.createDataFrame([(datetime(2024, 1, 1, 5), "a")], "ts TIMESTAMP, hashtag STRING")
    starts = sliding.sliding_counts(posts).select(F.hour("window_start"))
    assert rows(starts) == [(0,), (2,), (4,)]


def test_pruned_joins_and_grains_do_not_change_sales(spark, sf_dir):
    def total_of(frame, rows):
        return tuple(frame.agg(numbers.total(frame, "sales"), rows).first())

    lines = F.count(F.lit(1))
    few = total_of(tables.sales_lines(spark, sf_dir, "sales"), lines)
    wide = tables.sales_lines(spark, sf_dir, "sales", "region", "segment", "category", "status")
    assert total_of(wide, lines) == few
    assert total_of(tables.order_totals(spark, sf_dir, "order_id", "sales", "lines"), F.sum("lines")) == few
    assert total_of(tables.customer_totals(spark, sf_dir, "sales", "lines", "region"), F.sum("lines")) == few
    parts = tables.part_totals(spark, sf_dir, "product", "sales")
    assert total_of(parts, lines)[0] == few[0]


def test_small_scans_are_spread_and_others_left(spark):
    small = spark.range(10, numPartitions=1)
    assert storage.partitions_of(tables.spread(small)) == spark.sparkContext.defaultParallelism
    wide = spark.range(10, numPartitions=9)
    assert tables.spread(wide) is wide


def test_written_tables_are_released(spark):
    frame = session.written(spark.range(5), "numbers")
    path = frame.inputFiles()[0]
    assert frame.count() == 5 and session.release_written(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_a_folder_of_one_machine_is_refused_on_a_cluster():
    from gristmill.session import on_all_machines

    assert on_all_machines("file:/tmp/warehouse", "local[4]") == "file:/tmp/warehouse"
    assert on_all_machines("s3a://bucket/x", "spark://host:7077") == "s3a://bucket/x"
    for folder in ("file:/tmp/warehouse", "/tmp/warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            on_all_machines(folder, "spark://host:7077")


def test_compressed_csv(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.files.write_table(spark.range(3000).selectExpr("id", "'name' AS name"), path, kind="csv", compression="gzip")
    parts = [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    assert spark.read.csv(path, header=True, schema="id BIGINT, name STRING").distinct().count() == 3000
