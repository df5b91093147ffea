"""Session defaults. On a cluster, submit-time settings win; these only fill gaps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: str = "8", app: str = "cohortgraph", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    A local master with nothing set (tests) gets a fresh temporary folder; a
    cluster with nothing set is an error, since a machine-local folder would be
    lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_table(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``work_table``, in buckets of ``key``: what groups or joins the table by the key needs no further shuffle.

    There are as many buckets as ``spark.sql.shuffle.partitions``, one file each; all rows of a key are one task's work.
    """
    spark = df.sparkSession
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), work_folder(spark, name)
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    rows = df.repartition(buckets, key).write.format("parquet").option("compression", "zstd").option("path", path)
    rows.bucketBy(buckets, key).saveAsTable(table)
    return spark.table(table)
