"""Tag trends: cleaning, counting, and the leaders by day, region and platform."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import projections, ranking
from gristmill.session import written

# The tags of each category, first match wins.
TAG_CATEGORIES = {
    "Technology": [
        "#AI", "#TECHNOLOGY", "#CODING", "#MACHINELEARNING", "#BIGDATA", "#PYTHON", "#CLOUD", "#CYBERSECURITY",
    ],
    "Sports": ["#CRICKET", "#IPL", "#FOOTBALL", "#OLYMPICS", "#FITNESS"],
    "Entertainment": ["#MOVIES", "#MUSIC", "#CINEMA", "#HOLLYWOOD", "#BOLLYWOOD", "#NETFLIX"],
    "Business": ["#STARTUP", "#FINANCE", "#CRYPTO", "#MARKETING", "#STOCKMARKET"],
}


def clean_posts(posts: DataFrame) -> DataFrame:
    """Posts that have a tag, with the tag in its common form and as it came in ``hashtag_raw``."""
    kept = projections.not_blank(posts, "hashtag")
    return kept.withColumn("hashtag_raw", F.col("hashtag")).withColumn(
        "hashtag", text.normalise_tag(F.col("hashtag"))
    )


def word_posts(documents: DataFrame) -> DataFrame:
    """Every word of every document as a post: its language is the region, its source the platform."""
    return documents.select(
        F.col("lang").alias("region"),
        F.col("source").alias("platform"),
        F.explode(text.tokens(F.col("text"), lower=False)).alias("hashtag"),
    )


def cleaning_counts(posts: DataFrame) -> DataFrame:
    """Posts in, posts kept, posts dropped and distinct tags, from one pass.

    Counting per raw tag first leaves one row per spelling, however often a tag occurs.
    """
    spellings = posts.groupBy("hashtag").agg(F.count(F.lit(1)).alias("n"))
    kept = ~text.is_blank(F.col("hashtag"))
    return spellings.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_in"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).cast("long").alias("rows_out"),
        F.countDistinct(F.when(kept, text.normalise_tag(F.col("hashtag")))).alias("distinct_tags"),
    ).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_out"))


def tag_frequency(posts: DataFrame) -> DataFrame:
    return ranking.frequency(posts, ["hashtag"])


def daily_leaders(posts: DataFrame) -> DataFrame:
    """The top tag of each day, equal counts in tag order."""
    daily = ranking.frequency(posts, ["day", "hashtag"], "daily_count")
    return ranking.first_n_per_group(daily, "day", "daily_count", "hashtag", 1)


def group_leaders(posts: DataFrame, group: str, n: int = 3) -> DataFrame:
    """Tags ranked 1 to ``n`` in each region or platform, ties included.

    The ranking reads the counts twice, so they are written once: the posts are read once.
    """
    counts = written(ranking.frequency(posts, [group, "hashtag"], f"{group}_count"), "tag-counts")
    return ranking.top_n_with_ties(counts, group, f"{group}_count", n)


def group_display(posts: DataFrame, group: str, n: int = 2) -> DataFrame:
    """Exactly the first ``n`` tags per group, as a report shows them."""
    counts = ranking.frequency(posts, [group, "hashtag"], f"{group}_count")
    return ranking.first_n_per_group(counts, group, f"{group}_count", "hashtag", n)


def category_counts(posts: DataFrame, rules: dict[str, list[str]] | None = None) -> DataFrame:
    """Posts per category. Tags are counted first, so the rules run once per distinct tag."""
    tags = projections.categorise(tag_frequency(posts), rules or TAG_CATEGORIES)
    return tags.groupBy("category").agg(F.sum("frequency").cast("long").alias("category_count"))


def category_share(posts: DataFrame, rules: dict[str, list[str]] | None = None) -> DataFrame:
    return ranking.share_of_total(category_counts(posts, rules), "category_count", 1)
