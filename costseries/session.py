"""Session, table and workspace helpers."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "costseries", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on: UTC, ANSI and AQE with skew handling.

    Executor sizing and shuffle parallelism stay with the cluster: AQE coalesces small
    shuffle partitions and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def hadoop_path(spark: SparkSession, path: str):
    """Path and its file system, for folder listings."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder, else a temp folder in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="costseries-")
    context.setCheckpointDir(folder)
    return folder


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_workspaces(spark: SparkSession, older_than_hours: float) -> int:
    """Delete the working folders of earlier runs in the shared folder and return their number.

    Results of queries read from these folders, so choose an age that no running job or unread result
    exceeds. Only folders named as ``workspace`` names them are touched.
    """
    root, fs = hadoop_path(spark, shared_dir(spark))
    limit = (time.time() - older_than_hours * 3600) * 1000
    old = [
        s.getPath() for s in fs.listStatus(root)
        if s.isDirectory() and s.getModificationTime() < limit and re.search("-[0-9a-f]{32}$", s.getPath().getName())
    ]
    return sum(fs.delete(path, True) for path in old)


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write a table to a fresh folder and read it back: computed once, however often it is used."""
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def landed_alone(df: DataFrame, label: str) -> DataFrame:
    """``landed``, and the shuffle files of the write go with its end; else they stay until the driver's memory fills up."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return landed(df.select("*"), label)  # a frame holds to the setting under which it was made
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage on reliable storage; partition numbers of the result are stable on re-reads."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
