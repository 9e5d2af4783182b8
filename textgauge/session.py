"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "textgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` entries win."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Scoring is heavy per byte, so small partitions are worth their own task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join even if a later aggregate then needs its own shuffle.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    }
    if not (master or "").startswith("local"):
        # Shuffles begin with many partitions, which adaptive execution merges by size but does not
        # cut: at 100 TB raise it until one has 200 MB or so.
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "1000"
    settings |= conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as `--py-files` would; once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_textgauge_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="textgauge-"), "textgauge_package")
    context.addPyFile(shutil.make_archive(archive, "zip", root, os.path.basename(os.path.dirname(__file__))))
    context._textgauge_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in spark.checkpoint.dir.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    named = spark.conf.get(_CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="textgauge-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable, without replacing a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def spread(df: DataFrame) -> DataFrame:
    """A frame with at least one partition per core.

    Only inputs with fewer splits than the cluster has cores are shuffled; a large table is
    read as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
