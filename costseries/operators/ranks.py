"""Ordering, top-k and sequential ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import reliable


def order_by_abs(df: DataFrame, col: str, key: str, position: str | None = None) -> DataFrame:
    """Rows by magnitude, largest first, missing values last; ``position`` adds the place of each row, from 1."""
    order = [F.abs(F.col(col)).desc_nulls_last(), F.col(key)]
    return surrogate_key(df, order, position) if position else df.orderBy(*order)


def top_k(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    """k largest; each task keeps k rows (TakeOrdered), nothing is fully sorted."""
    return df.orderBy(F.col(col).desc_nulls_last(), tie).limit(k)


def bottom_k(df: DataFrame, col: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(col).asc_nulls_last(), tie).limit(k)


def head_tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First and last n rows, tagged."""
    first = df.orderBy(*order).limit(n).withColumn("part", F.lit("first"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("part", F.lit("last"))
    return first.unionByName(last)


def latest_per_group(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Values of the newest row per key, as one partial aggregate."""
    newest = F.max(F.struct(F.col(order), *[F.col(c) for c in cols])).alias("_x")
    return df.groupBy(*keys).agg(newest).select(*keys, f"_x.{order}", *[f"_x.{c}" for c in cols])


def surrogate_key(df: DataFrame, order: Sequence[str | Column], name: str = "id") -> DataFrame:
    """Dense 1..n id in the given order without a single-task window.

    The rows are range-partitioned and sorted in parallel and kept on reliable storage, so
    partition numbers and positions cannot change when an executor is lost; each partition
    then adds the row count of the partitions before it. ``order`` must be a total order for
    the ids to be reproducible.
    """
    kept = reliable(df.orderBy(*order))
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = kept.withColumns({"_part": F.spark_partition_id(), "_pos": position})
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition, hence the unpartitioned window
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_offset"))
    numbered = placed.join(offsets, "_part").withColumn(name, F.col("_pos") + F.col("_offset") + 1)
    return numbered.select(name, *df.columns)
