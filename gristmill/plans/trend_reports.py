"""Tag-trend reports with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gristmill.operators import ranking, reporting, trends
from gristmill.plans.registry import Register
from gristmill.plans.sqltext import WORD_POSTS, double, half_up, long, ratio
from gristmill.sources import tables
from gristmill.streaming import sliding

query = Register()

# Categories for the tags of the event table, in place of the default lists of topics.
EVENT_CATEGORIES = {"Interest": ["#CLICK", "#VIEW"], "Business": ["#PURCHASE", "#SIGNUP"]}


def _word_posts(spark, sf_dir):
    return trends.clean_posts(trends.word_posts(tables.documents(spark, sf_dir, "lang", "source", "text")))


def _event_posts(spark, sf_dir):
    return trends.clean_posts(tables.event_posts(spark, sf_dir))


def _topic_cases() -> str:
    """The default categories as a CASE expression."""
    quoted = {name: ", ".join(f"'{tag}'" for tag in tags) for name, tags in trends.TAG_CATEGORIES.items()}
    cases = " ".join(f"WHEN hashtag IN ({tags}) THEN '{name}'" for name, tags in quoted.items())
    return f"CASE {cases} ELSE 'Other' END"


@query("tag_frequency", f"WITH {WORD_POSTS} SELECT hashtag, count(*) AS frequency FROM tagged GROUP BY 1")
def tag_frequency(spark, sf_dir):
    return trends.tag_frequency(_word_posts(spark, sf_dir))


@query(
    "tag_normalise",
    f"WITH {WORD_POSTS} SELECT raw AS hashtag_raw, hashtag, count(*) AS frequency FROM tagged GROUP BY 1, 2",
)
def tag_normalise(spark, sf_dir):
    return ranking.frequency(_word_posts(spark, sf_dir), ["hashtag_raw", "hashtag"])


@query(
    "tag_cleaning",
    r"""WITH pieces AS (SELECT unnest(regexp_split_to_array(text, '\W')) AS hashtag FROM documents)
        SELECT count(*) AS rows_in, count(*) FILTER (WHERE trim(hashtag) <> '') AS rows_out,
               count(DISTINCT CASE WHEN trim(hashtag) <> '' THEN '#' || upper(trim(hashtag)) END) AS distinct_tags,
               count(*) - count(*) FILTER (WHERE trim(hashtag) <> '') AS rows_dropped
        FROM pieces""",
)
def tag_cleaning(spark, sf_dir):
    """Counts before and after cleaning, over all pieces of all documents, the empty ones included."""
    pieces = tables.documents(spark, sf_dir, "text").select(F.explode(F.split("text", r"\W")).alias("hashtag"))
    return trends.cleaning_counts(pieces)


@query(
    "top_trends",
    f"WITH {WORD_POSTS} SELECT hashtag, count(*) AS frequency FROM tagged GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def top_trends(spark, sf_dir):
    return ranking.most_frequent(trends.tag_frequency(_word_posts(spark, sf_dir)), 10, "hashtag")


@query(
    "daily_top1",
    """WITH daily AS (
         SELECT CAST(ts AS DATE) AS day, '#' || upper(trim(event_type)) AS hashtag, count(*) AS daily_count
         FROM events GROUP BY 1, 2)
       SELECT CAST(day AS VARCHAR) AS day, hashtag, daily_count, CAST(1 AS INTEGER) AS rank FROM daily
       QUALIFY row_number() OVER (PARTITION BY day ORDER BY daily_count DESC, hashtag) = 1""",
)
def daily_top1(spark, sf_dir):
    leaders = trends.daily_leaders(_event_posts(spark, sf_dir))
    return leaders.orderBy("day").withColumn("day", F.col("day").cast("string"))


def _leaders(group: str, function: str, order: str, n: int) -> str:
    return f"""WITH {WORD_POSTS},
        counts AS (SELECT {group}, hashtag, count(*) AS {group}_count FROM tagged GROUP BY 1, 2),
        ranked AS (SELECT *, CAST({function} OVER (PARTITION BY {group} ORDER BY {order}) AS INTEGER) AS rank FROM counts)
        SELECT * FROM ranked WHERE rank <= {n}"""


@query("region_top3", _leaders("region", "rank()", "region_count DESC", 3))
def region_top3(spark, sf_dir):
    return trends.group_leaders(_word_posts(spark, sf_dir), "region").orderBy("region", "rank", "hashtag")


@query("platform_top3", _leaders("platform", "rank()", "platform_count DESC", 3))
def platform_top3(spark, sf_dir):
    return trends.group_leaders(_word_posts(spark, sf_dir), "platform").orderBy("platform", "rank", "hashtag")


@query("region_display2", _leaders("region", "row_number()", "region_count DESC, hashtag", 2))
def region_display2(spark, sf_dir):
    return trends.group_display(_word_posts(spark, sf_dir), "region")


CATEGORIES = """
tagged AS (
  SELECT CASE WHEN upper(trim(event_type)) IN ('CLICK', 'VIEW') THEN 'Interest'
              WHEN upper(trim(event_type)) IN ('PURCHASE', 'SIGNUP') THEN 'Business' ELSE 'Other' END AS category
  FROM events
),
counted AS (SELECT category, count(*) AS category_count FROM tagged GROUP BY 1)"""


@query("tag_category", f"WITH {CATEGORIES} SELECT * FROM counted")
def tag_category(spark, sf_dir):
    return trends.category_counts(_event_posts(spark, sf_dir), EVENT_CATEGORIES)


@query(
    "category_share",
    f"""WITH {CATEGORIES} SELECT *,
        {half_up(ratio('category_count', '(SELECT sum(category_count) FROM counted)') + ' * 100', 1)} AS share_pct
        FROM counted""",
)
def category_share(spark, sf_dir):
    return trends.category_share(_event_posts(spark, sf_dir), EVENT_CATEGORIES)


@query(
    "tag_topics",
    f"WITH {WORD_POSTS} SELECT {_topic_cases()} AS category, {long('count(*)')} AS category_count FROM tagged GROUP BY 1",
)
def tag_topics(spark, sf_dir):
    return trends.category_counts(_word_posts(spark, sf_dir))


@query(
    "trend_facts",
    rf"""WITH {WORD_POSTS}, counts AS (SELECT hashtag, count(*) AS frequency FROM tagged GROUP BY 1),
        best AS (SELECT * FROM counts ORDER BY frequency DESC, hashtag LIMIT 10)
        SELECT 'size' AS section, 'rows_in' AS metric, {double('count(*)')} AS value FROM posts
        UNION ALL SELECT 'size', 'rows_out', {double('count(*)')} FROM tagged
        UNION ALL SELECT 'tags', 'distinct_tags', {double('count(*)')} FROM counts
        UNION ALL SELECT 'top', hashtag, {double('frequency')} FROM best
        UNION ALL SELECT 'category', {_topic_cases()}, {double('sum(frequency)')} FROM counts GROUP BY 2""",
)
def trend_facts(spark, sf_dir):
    return reporting.trend_facts(trends.word_posts(tables.documents(spark, sf_dir, "lang", "source", "text")))


WINDOWS = """WITH spread AS (
         SELECT to_timestamp(CAST(floor(epoch(ts) / 7200) * 7200 - 7200 * k AS BIGINT)) AT TIME ZONE 'UTC' AS window_start,
                '#' || upper(trim(event_type)) AS hashtag
         FROM events CROSS JOIN generate_series(0, 2) AS steps(k)),
       counted AS (SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, hashtag, count(*) AS frequency
                   FROM spread GROUP BY 1, 2, 3)
       SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
              strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, hashtag, frequency FROM counted"""


def _shown(windows):
    return windows.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


@query("sliding_tags", f"{WINDOWS} WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")
def sliding_tags(spark, sf_dir):
    """Streamed: all windows that ended before the watermark."""
    schema = tables.table(spark, sf_dir, "events").schema
    # The brackets make a glob of the one name: a stream reads folders and globs, and the table may be a single file.
    events = sliding.read_posts(spark, f"{sf_dir}/event[s].parquet", schema)
    counts = sliding.sliding_counts(events.select("ts", F.col("event_type").alias("hashtag")))
    return _shown(sliding.run_available(counts, spark))


@query("sliding_tags_complete", WINDOWS)
def sliding_tags_complete(spark, sf_dir):
    """The same counts over the finished table: all windows, those still open at its end included."""
    posts = tables.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("hashtag"))
    return _shown(sliding.sliding_counts(posts))


BATCHES, LATE = 4, 2
ARRIVALS = f"""bounds AS (SELECT epoch_us(min(CAST(ts AS TIMESTAMP))) AS low, epoch_us(max(CAST(ts AS TIMESTAMP))) AS high FROM events),
arrivals AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, '#' || upper(trim(event_type)) AS hashtag,
         2 * (epoch_us(CAST(ts AS TIMESTAMP)) - low) // (high - low + 1) + CASE WHEN event_id % 10 = 0 THEN {LATE} ELSE 0 END AS batch
  FROM events, bounds
),
batches AS (SELECT b.batch, (SELECT max(ts) - INTERVAL 1 HOUR FROM arrivals a WHERE a.batch <= b.batch - 2) AS mark
  FROM (SELECT DISTINCT batch FROM arrivals) b),
spans AS (
  SELECT hashtag, batch, to_timestamp(CAST(floor(epoch(ts) / 7200) * 7200 - 7200 * back AS BIGINT)) AT TIME ZONE 'UTC' AS window_start
  FROM arrivals, (VALUES (0), (1), (2)) AS steps(back)
),
counted AS (
  SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, hashtag,
         count(*) FILTER (WHERE mark IS NULL OR window_start + INTERVAL 6 HOUR > mark) AS frequency, count(*) AS due
  FROM spans JOIN batches USING (batch) GROUP BY 1, 2, 3
)"""


@query(
    "late_tags",
    f"""WITH {ARRIVALS} SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
        strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, hashtag, frequency, due - frequency AS dropped
        FROM counted WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM arrivals)""",
)
def late_tags(spark, sf_dir):
    """Streamed in four batches; every tenth post comes two batches late, and what is too late is counted."""
    events = tables.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = events.agg(F.unix_micros(F.min("ts")), F.unix_micros(F.max("ts"))).first()
    posts = events.select("ts", F.col("event_type").alias("hashtag"), "event_id")
    half = F.floor(2 * (F.unix_micros("ts") - low) / ((high or 0) - (low or 0) + 1))
    batch = half + F.when(F.col("event_id") % 10 == 0, LATE).otherwise(0)
    return _shown(sliding.replay(posts, batch, BATCHES))
