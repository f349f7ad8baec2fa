"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
SCAN_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int = 8) -> int:
    """Shuffle partitions of about 256 MiB, no fewer than the cores; adaptive execution merges small ones."""
    return max(cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app: str = "gristmill",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 8,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators are written for.

    The number of shuffle partitions follows ``input_bytes``; without it, Spark's own setting holds.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even where that costs one more shuffle later.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.files.maxPartitionBytes": str(SCAN_BYTES),
    }
    if input_bytes is not None:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes, cores))
    chosen.update(settings or {})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, else the session's warehouse.

    On a cluster a folder of one machine's own disk is refused: the others would not see what is written there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or on_all_machines(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)


def on_all_machines(folder: str, master: str) -> str:
    if not master.startswith("local") and folder.startswith(("file:", "/")):
        raise ValueError(f"set spark.checkpoint.dir: {folder} is a folder of each machine's own")
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_WRITTEN: list[str] = []


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """Cut the lineage of ``frame`` by a parquet table in the shared folder.

    Unlike executor storage the table survives lost executors, and it is computed once
    however many later plans read it. ``release_written`` removes it.
    """
    spark = frame.sparkSession
    path = new_folder(spark, purpose)
    _WRITTEN.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release_written(spark: SparkSession) -> int:
    """Remove the tables that ``written`` has made in this process; results that read them are gone with them."""
    files, released = spark.sparkContext._jvm.org.apache.hadoop.fs, 0
    while _WRITTEN:
        path = files.Path(_WRITTEN.pop())
        released += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return released
