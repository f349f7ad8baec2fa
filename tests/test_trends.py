from __future__ import annotations

import random

import pytest
from conftest import in_order, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from gristmill.operators import ranking, trends

# Mentions per tag of the fixture, and their categories.
MENTIONS = {
    "#CRICKET": 128, "#AI": 115, "#TECHNOLOGY": 103, "#MOVIES": 96, "#STARTUP": 92, "#IPL": 81, "#PYTHON": 73,
    "#MUSIC": 71, "#CODING": 63, "#BOLLYWOOD": 56, "#FOOTBALL": 56, "#FINANCE": 54, "#MACHINELEARNING": 53,
    "#OLYMPICS": 51, "#STOCKMARKET": 46, "#BIGDATA": 46, "#CINEMA": 44, "#CRYPTO": 36, "#HOLLYWOOD": 33,
    "#MARKETING": 28, "#TRAVEL": 28, "#FITNESS": 27, "#CYBERSECURITY": 24, "#CLOUD": 24, "#FOODIE": 21,
    "#NETFLIX": 20, "#FASHION": 15, "#ART": 6,
}
CATEGORY_COUNTS = {"Technology": 501, "Sports": 343, "Entertainment": 320, "Business": 256, "Other": 70}


@pytest.fixture(scope="module")
def mentions(spark):
    counts = spark.createDataFrame(list(MENTIONS.items()), "hashtag STRING, n INT")
    return counts.select("hashtag", F.explode(F.sequence(F.lit(1), "n")).alias("_")).drop("_")


def test_tags_agree_after_cleaning(spark):
    raw = [("#ai",), ("  #AI  ",), ("AI",), ("",), ("   ",), (None,)]
    posts = spark.createDataFrame(raw, "hashtag STRING")
    cleaned = trends.clean_posts(posts)
    assert rows(cleaned.select("hashtag")) == [("#AI",)] * 3
    assert rows(cleaned.select("hashtag_raw")) == [("  #AI  ",), ("#ai",), ("AI",)]
    assert trends.cleaning_counts(posts).first().asDict() == {
        "rows_in": 6, "rows_out": 3, "distinct_tags": 1, "rows_dropped": 3
    }


def test_frequency_and_top(mentions):
    counts = trends.tag_frequency(mentions)
    assert dict(rows(counts)) == MENTIONS
    top = in_order(ranking.most_frequent(counts, 10, "hashtag"))
    assert top == list(MENTIONS.items())[:10]  # #BOLLYWOOD comes before #FOOTBALL


def test_categories(mentions):
    assert dict(rows(trends.category_counts(mentions))) == CATEGORY_COUNTS
    shares = {r["category"]: r["share_pct"] for r in trends.category_share(mentions).collect()}
    assert shares["Technology"] == 33.6 and shares["Other"] == 4.7


def test_daily_leaders(spark):
    posts = [("d1", "#B")] * 2 + [("d1", "#A")] * 2 + [("d2", "#A")] + [("d2", "#C")] * 3
    frame = spark.createDataFrame(posts, "day STRING, hashtag STRING")
    assert rows(trends.daily_leaders(frame)) == [("d1", "#A", 2, 1), ("d2", "#C", 3, 1)]


def test_ties_share_a_rank_and_none_is_dropped(spark):
    counts = [("e", "a", 9), ("e", "b", 7), ("e", "c", 7), ("e", "d", 5), ("w", "a", 1), ("w", "b", 1)]
    frame = spark.createDataFrame(counts, "region STRING, hashtag STRING, n INT")
    found = ranking.top_n_with_ties(frame, "region", "n", 3).select("region", "hashtag", "rank")
    assert rows(found) == [("e", "a", 1), ("e", "b", 2), ("e", "c", 2), ("w", "a", 1), ("w", "b", 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("n", [1, 3, 5])
def test_ranks_equal_the_window_function(spark, seed, n):
    rng = random.Random(seed)
    counts = [(rng.choice("xxxy"), f"t{i}", rng.randrange(1, 6)) for i in range(60)]
    frame = spark.createDataFrame(counts, "region STRING, hashtag STRING, n INT")
    order = Window.partitionBy("region").orderBy(F.desc("n"))
    expected = frame.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= n)
    found = ranking.top_n_with_ties(frame, "region", "n", n).select("region", "hashtag", "n", "rank")
    assert rows(found) == rows(expected)


def test_display_keeps_exactly_n(spark):
    posts = [("e", t) for t in "aabbccd"]
    frame = spark.createDataFrame(posts, "region STRING, hashtag STRING")
    assert [r[1] for r in rows(trends.group_display(frame, "region", 2))] == ["a", "b"]


def test_a_stream_in_bounded_batches(spark, tmp_path):
    """The same windows, with two files at a time."""
    from datetime import datetime

    from pyspark.sql import functions as F

    from gristmill.streaming import sliding

    folder = str(tmp_path / "posts")
    for hour in range(6):
        post = [(datetime(2024, 1, 1, hour, 30), "a")]
        spark.createDataFrame(post, "ts TIMESTAMP, hashtag STRING").coalesce(1).write.mode("append").parquet(folder)
    counts = []
    for size in (None, 2):
        posts = sliding.read_posts(spark, folder, "ts TIMESTAMP, hashtag STRING", size)
        done = sliding.run_available(sliding.sliding_counts(posts, "1 hour", "1 hour", "2 hours"), spark)
        counts.append(rows(done.select(F.hour("window_start"), "frequency")))
    assert counts[0] == counts[1] == [(0, 1), (1, 1), (2, 1)]
