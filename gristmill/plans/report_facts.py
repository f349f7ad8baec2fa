"""Facts of the rating, segment and message reports, as rows ``(section, metric, value)``, with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators import reporting, segments, storage
from gristmill.plans import message_models, segment_models
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import double
from gristmill.session import written
from gristmill.sources import tables

query = Register()


def _facts(section: str, table: str, **figures: str) -> str:
    rows = (f"SELECT '{section}' AS section, '{name}' AS metric, {double(value)} AS value FROM {table}" for name, value in figures.items())
    return " UNION ALL ".join(rows)


@query(
    "rating_facts",
    f"""WITH movies AS (SELECT l_partkey, avg(l_quantity) AS mean FROM lineitem GROUP BY 1)
        {_facts('size', 'lineitem', ratings='count(*)', users='count(DISTINCT l_suppkey)', movies='count(DISTINCT l_partkey)')}
        UNION ALL {_facts('ratings', 'lineitem', high='count(*) FILTER (WHERE l_quantity >= 4)', least='min(l_quantity)', greatest='max(l_quantity)')}
        UNION ALL {_facts('movies', 'movies', well_rated='count(*) FILTER (WHERE mean >= 2.75)')}""",
)
def rating_facts(spark, sf_dir):
    """Sizes and what the timed workloads find; users and movies are counted from one row each."""
    ratings = tables.ratings(spark, sf_dir)
    movies = written(storage.movie_ratings(ratings), "movie-ratings")
    users = written(storage.user_range(ratings), "user-range")
    frames = [
        ("size", movies.agg(F.sum("total_ratings").alias("ratings"), F.count("movie_id").alias("movies"))),
        ("size", users.agg(F.count("user_id").alias("users"))),
        ("ratings", users.agg(F.min("min_rating").alias("least"), F.max("max_rating").alias("greatest"))),
        ("ratings", storage.high_ratings(ratings).withColumnRenamed("high_ratings", "high")),
        ("movies", movies.agg(F.count_if(F.col("avg_rating") >= storage.WELL_RATED).alias("well_rated"))),
    ]
    rows = [reporting.facts(section, reporting.one_row(frame), "metric", "value") for section, frame in frames]
    return reduce(DataFrame.unionByName, rows)


@query(
    "segment_facts",
    f"""WITH {segment_models.ASSIGNED}, costs AS (SELECT cluster, sum(squared_distance) AS cost FROM assigned GROUP BY 1)
        SELECT 'size' AS section, 'customers' AS metric, {double('count(*)')} AS value FROM assigned
        UNION ALL SELECT 'size', 'clusters', {double('count(*)')} FROM profiles
        UNION ALL SELECT 'customers', CAST(cluster AS VARCHAR), {double('customers')} FROM profiles
        UNION ALL SELECT 'avg_spend', CAST(cluster AS VARCHAR), avg_spend FROM profiles
        UNION ALL SELECT 'avg_purchases', CAST(cluster AS VARCHAR), avg_purchases FROM profiles
        UNION ALL SELECT 'avg_recency', CAST(cluster AS VARCHAR), avg_recency FROM profiles""",
)
def segment_facts(spark, sf_dir):
    """Size and profile of the clusters around fixed centres."""
    profiles = written(segments.profile(segment_models._assigned(spark, sf_dir)), "profiles")
    size = profiles.agg(F.sum("customers").alias("customers"), F.count("cluster").alias("clusters"))
    sections = {name: (profiles, "cluster", name) for name in ("customers", "avg_spend", "avg_purchases", "avg_recency")}
    return reporting.report({"size": (reporting.one_row(size), "metric", "value")} | sections)


@query(
    "message_facts",
    f"""WITH split AS (
          SELECT CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label,
                 CASE WHEN {message_models.PLACE.format('text')} < 0.6 THEN 'train'
                      WHEN {message_models.PLACE.format('text')} < 0.8 THEN 'validation' ELSE 'test' END AS part
          FROM documents JOIN labels USING (doc_id) WHERE length(trim(text)) > 0)
        SELECT 'class' AS section, label AS metric, {double('count(*)')} AS value FROM split GROUP BY label
        UNION ALL SELECT 'part', part, {double('count(*)')} FROM split GROUP BY part
        UNION ALL SELECT 'size', 'messages', {double('count(*)')} FROM split""",
)
def message_facts(spark, sf_dir):
    """Messages per class and per part of the split; everything follows from one small count."""
    counts = message_models._messages(spark, sf_dir).groupBy("label", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "message-counts")

    def by(column):
        return counts.groupBy(column).agg(F.sum("n").alias("n"))

    size = counts.agg(F.sum("n").alias("messages"))
    return reporting.report(
        {"class": (by("label"), "label", "n"), "part": (by("part"), "part", "n"), "size": (reporting.one_row(size), "metric", "value")}
    )
