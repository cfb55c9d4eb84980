"""Writers. A table being read is never overwritten in place: new contents go to a fresh
version folder, and readers take the newest complete version (the one with ``_SUCCESS``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.upsert import dedup_counts, dedup_latest, insert_ignore, upsert, upsert_counts
from ..session import hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a table, oldest first (a listing of folder names, no data)."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    done = [n for n in names if n.startswith("version=") and _exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted(done)


KEPT = 2  # complete versions that stay: the current one and the one that readers may still have open


def write_overwrite(
    df: DataFrame, path: str, cols: Sequence[str], sort: Sequence[str], partition_by: Sequence[str] = ()
) -> str:
    """Replace a table with fixed column order, sorted inside each file; returns the new version's folder.

    The new contents are the table's next version (``read_latest`` finds it). A version counts once it is complete, so
    nothing is renamed, readers always find a whole table, the input may read the table itself, and a write that fails
    leaves it as it was. Versions older than the one before are deleted then. One writer at a time.

    With ``partition_by`` rows meet by partition value; the rebalance hint lets AQE split a
    large partition value over many writers and merge small ones.
    """
    out = df.select(*cols)
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    out = out.sortWithinPartitions(*partition_by, *sort)
    spark = df.sparkSession
    done = [v for v in _versions(spark, path) if v.removeprefix("version=").isdigit()]
    number = int(done[-1].removeprefix("version=")) + 1 if done else 0
    folder = f"{path.rstrip('/')}/version={number:012d}"
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    for old in done[: len(done) + 1 - KEPT]:
        p, fs = hadoop_path(spark, f"{path.rstrip('/')}/{old}")
        fs.delete(p, True)
    return folder


def write_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_if_empty(df: DataFrame, path: str) -> bool:
    """Seed a table that has no rows; says whether it wrote."""
    spark = df.sparkSession
    if _exists(spark, path) and not spark.read.schema(df.schema).parquet(path).isEmpty():
        return False
    write_append(df, path)
    return True


def write_insert_ignore(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Append only rows whose key is new."""
    target = df.sparkSession.read.schema(df.schema).parquet(path)
    write_append(insert_ignore(target, df, keys), path)


def snapshot_versions(df: DataFrame, path: str, version: str) -> str:
    """Write one version folder; versions must sort by name (for example a timestamp)."""
    folder = f"{path}/version={version}"
    df.write.mode("overwrite").parquet(folder)
    return folder


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version under {path}")
    return spark.read.parquet(f"{path}/{versions[-1]}")


def write_upsert_partitions(
    batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Upsert into a table partitioned by ``partition_by``: only partitions with rows in the batch are read and rewritten.

    The partition columns must be among the keys, so that a row never leaves its partition. The batch's partitions, a short list, prune
    the read; dynamic overwrite swaps each of them when all are written, and the files of all others stay.
    """
    spark = batch.sparkSession
    if not set(partition_by) <= set(keys):
        raise ValueError("a row that may change its partition needs a whole rewrite (write_upsert)")
    cols = [c for c in batch.columns if c not in partition_by] + list(partition_by)
    incoming = batch.select(*cols)
    touched = incoming.select(*partition_by).distinct().collect()
    if not touched:
        return
    merged = dedup_latest(incoming, keys, order)
    if _exists(spark, path):
        mine = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(r[c]).cast(incoming.schema[c].dataType)) for c in partition_by]) for r in touched]
        stored = spark.read.schema(incoming.schema).parquet(path).filter(reduce(lambda a, b: a | b, mine))
        merged = upsert(stored, incoming, keys, order)
    out = merged.hint("rebalance", *[F.col(c) for c in partition_by]).sortWithinPartitions(*partition_by)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    spark.catalog.refreshByPath(path)


def write_upsert(batch: DataFrame, path: str, keys: Sequence[str], version: str, order: Sequence[str] = ()) -> None:
    """Upsert into a versioned table: read the newest version, write the next one."""
    spark = batch.sparkSession
    if _versions(spark, path):
        batch = upsert(read_latest(spark, path), batch, keys, order)
    snapshot_versions(batch, path, version)


def sanitize_for_sink(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and infinities to NULL, dates to ISO text, fixed column order."""
    out = []
    for name in cols or df.columns:
        kind, c = df.schema[name].dataType, F.col(name)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(name))
    return df.select(*out)


def dry_run(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a dedup and an upsert would change, as one row; nothing is written."""
    counts = upsert_counts(target, batch, keys)
    duplicates = dedup_counts(target, keys).select(F.col("n_removed").alias("n_duplicates")).scalar()
    return counts.withColumn("n_duplicates", duplicates)
