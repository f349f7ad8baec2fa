"""Tag counts over sliding event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions import text
from gristmill.operators import projections
from gristmill.session import new_folder, written


def read_posts(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as a stream; new ones join as they appear. ``path`` is a folder, or a glob for single files.

    ``files_per_batch`` bounds a batch, and with it the state of a first run over a long history. The watermark
    then moves from batch to batch, oldest files first: files must not hold posts later than the delay allows.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def sliding_counts(
    posts: DataFrame, length: str = "6 hours", slide: str = "2 hours", delay: str = "1 hour"
) -> DataFrame:
    """Posts per tag and window. Posts later than ``delay`` behind the newest are dropped.

    Works on a stream and on a table; counts are added up before the shuffle, so a hot
    tag sends one row per window and task.
    """
    tagged = projections.not_blank(posts, "hashtag").select(
        F.col("ts").cast("timestamp").alias("ts"), text.normalise_tag(F.col("hashtag")).alias("hashtag")
    )
    counts = tagged.withWatermark("ts", delay).groupBy(F.window("ts", length, slide), "hashtag").count()
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "hashtag",
        F.col("count").alias("frequency"),
    )


def run_available(counts: DataFrame, spark: SparkSession, table: str | None = None, state: str | None = None) -> DataFrame:
    """Process what the source holds now, append the finished windows to a table, and read it.

    Table and progress lie in the shared folder (or where the caller says); calling again
    with the same folders goes on where the last call ended.
    """
    table = table or new_folder(spark, "windows")
    state = state or new_folder(spark, "progress")
    query = (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(counts.schema).parquet(table)


def write_batches(posts: DataFrame, batch: Column, batches: int, files: int = 1) -> str:
    """Posts as files of numbered batches, oldest batch first, and the glob that a stream reads them by.

    Every batch has ``files`` files, so ``read_posts`` with as many files per batch replays them one by one.
    """
    spark = posts.sparkSession
    folder = new_folder(spark, "batches")
    numbered = written(posts.withColumn("_batch", batch.cast("int")), "numbered-posts")
    for number in range(batches):
        # Dealt out by row, so that each file has rows and the number of files is known.
        rows = numbered.where(F.col("_batch") == number).drop("_batch").repartition(files)
        rows.write.parquet(f"{folder}/part-{number:05d}")
    return f"{folder}/part-*"


def replay(
    posts: DataFrame, batch: Column, batches: int, length: str = "6 hours", slide: str = "2 hours", delay: str = "1 hour",
    files: int = 1,
) -> DataFrame:
    """Counts of a stream in which posts come late, beside the number that was dropped for it.

    ``posts`` has ts and hashtag; ``batch`` says in which micro-batch a post arrives. One row per window that the
    stream has finished and tag: window_start, window_end, hashtag, frequency, dropped. A batch judges lateness by
    the newest post of the batches before the last one, less ``delay``: a post is dropped from each of its windows that
    had ended by then. Counts of finished windows over all posts tell what is missing.
    """
    spark = posts.sparkSession
    source = write_batches(posts, batch, batches, files)
    stream = read_posts(spark, source, posts.schema, files)
    kept = run_available(sliding_counts(stream, length, slide, delay), spark)
    newest = posts.select(F.max(F.col("ts").cast("timestamp"))).scalar()
    due = sliding_counts(posts, length, slide, delay).where(F.col("window_end") <= newest - F.expr(f"INTERVAL {delay}"))
    keys = ["window_start", "window_end", "hashtag"]
    both = due.withColumnRenamed("frequency", "_due").join(kept, keys, "left")
    frequency = F.coalesce("frequency", F.lit(0)).cast("long")
    return both.select(*keys, frequency.alias("frequency"), (F.col("_due") - frequency).alias("dropped"))
