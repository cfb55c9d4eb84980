"""Structured Streaming forms of the incremental load.

The upsert target is a folder of per-batch deltas. A micro-batch only writes its own newest row
per key, under its batch number, so its cost does not grow with the target and a retried batch
overwrites exactly what it wrote before. Readers merge the deltas; ``compact`` folds them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators import filters, quality, upsert, windows
from ..operators.joins import null_safe_join
from ..session import hadoop_path
from ..sources.readers import SERIES_PAYLOAD, named_by_file, typed_points


def stream_series(
    spark: SparkSession,
    path: str,
    as_of: dt.date | str,
    files_per_batch: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landed payload files to typed points; unparseable, absurd and future points are dropped."""
    reader = spark.readStream.schema(SERIES_PAYLOAD).option("multiLine", multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    points = typed_points(named_by_file(reader.json(path)))
    return filters.valid_points(points, "value", "ref_date", as_of)


def run_available(writer: DataStreamWriter, timeout: int | None = None) -> None:
    """Process everything that is there, however long it takes unless a timeout is set; a failure is raised."""
    query = writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not finish in time")


def stream_upsert(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str]
) -> DataStreamWriter:
    """Write each micro-batch's newest row per key as its own delta."""

    def write_delta(batch: DataFrame, batch_id: int) -> None:
        newest = upsert.dedup_latest(batch, keys, order)
        newest.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write_delta).option("checkpointLocation", checkpoint)


def merged_view(spark: SparkSession, target: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current rows of a delta folder: newest by ``order``, later batches first on ties."""
    deltas = spark.read.parquet(target)
    return upsert.dedup_latest(deltas, keys, [*order, "batch_id"]).drop("batch_id")


def compact(spark: SparkSession, target: str, into: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Fold all deltas into a new folder that starts at batch -1."""
    merged_view(spark, target, keys, order).write.mode("overwrite").parquet(f"{into}/batch_id=-1")


def stream_dedup(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeated deliveries; a key is remembered for the delay only."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_quality(
    stream: DataFrame, series: str, time: str, value: str, window: str, delay: str, limit: float = 1e6
) -> DataFrame:
    """Counts of negative, zero and absurd values per series and event-time window."""
    v = F.col(value)
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, window), series)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(v < 0).alias("n_negative"),
            F.count_if(v == 0).alias("n_zero"),
            F.count_if(F.abs(v) > limit).alias("n_absurd"),
        )
        .select(F.col("window.start").alias("window_start"), series, "n", "n_negative", "n_zero", "n_absurd")
    )


def month_period(date: str) -> Column:
    """The usual period of the change store: year and month as one number."""
    return F.year(date) * 100 + F.month(date)


def neighbour_periods(batch_periods: DataFrame, index: DataFrame, series: str) -> DataFrame:
    """``(series, period)`` of stored rows that a batch can touch: its own periods and the stored ones next to them.

    The row before or after a new one lies in its own period or, if that has none, in the nearest that has rows
    of the series; ``index`` lists those, a row per series and period.
    """
    stored = index.select(F.col(series).alias("_s"), F.col("period").alias("_stored"))
    both = batch_periods.join(stored, F.col(series).eqNullSafe(F.col("_s")))
    at = F.col("_stored") - F.col("period")
    near = both.groupBy(series, "period").agg(
        F.max(F.when(at < 0, F.col("_stored"))).alias("_before"),
        F.max(F.when(at == 0, F.col("_stored"))).alias("_own"),
        F.min(F.when(at > 0, F.col("_stored"))).alias("_after"),
    )
    return near.select(series, F.explode(F.array_compact(F.array("_before", "_own", "_after"))).alias("period")).distinct()


def stream_changes(
    stream: DataFrame,
    store: str,
    flags: str,
    checkpoint: str,
    series: str,
    date: str,
    value: str,
    limit: float = quality.MOM_LIMIT,
    chunk: Column | None = None,
    period: Column | None = None,
) -> DataStreamWriter:
    """Judge moves against the observation before, whatever the order in which observations arrive.

    Points are stored by batch and period (``period``: a number that never decreases with the date; by default the month). A batch
    reads only the stored periods next to its own rows (``neighbour_periods``), judges its rows against the row before them and judges
    the stored row after each of them again. Verdicts are appended: a flagged new row, and for revised rows and for judged-again
    successors a row whichever way it went, so that a later one withdraws an earlier one; ``current_flags`` reads them.
    A later batch's value replaces a stored one of the same date, the largest counts within a batch, and missing values say
    nothing. The index of periods is rewritten whole per batch, and only the last two are kept.
    """
    period = period if period is not None else month_period(date)

    def index_path(batch_id: int) -> str:
        return f"{store}/index/batch_id={batch_id}"

    def stored_near(spark: SparkSession, points: DataFrame, index: DataFrame, batch_id: int) -> DataFrame:
        near = neighbour_periods(points.select(series, "period").distinct(), index, series).persist()
        periods = [r["period"] for r in near.select("period").distinct().collect()]  # a calendar's worth at most
        schema = points.select(series, date, value).schema.add("batch_id", "integer").add("period", points.schema["period"].dataType)
        rows = spark.read.schema(schema).parquet(f"{store}/points").filter(F.col("period").isin(periods) & (F.col("batch_id") < batch_id))
        rows = null_safe_join(rows, near, [series, "period"], "left_semi")
        return upsert.dedup_latest(rows, [series, date], ["batch_id"]).select(series, date, value)

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = batch.select(series, date, value).filter(F.col(value).isNotNull() & F.col(date).isNotNull())
        points = known.groupBy(series, date).agg(F.max(value).alias(value)).withColumn("period", period).persist()
        rows = points.drop("period").withColumns({"_new": F.lit(True), "_again": F.lit(False)})
        index = points.select(series, "period").distinct()
        path, fs = hadoop_path(spark, index_path(batch_id - 1))
        if batch_id > 0 and fs.exists(path):
            before = spark.read.schema(index.schema).parquet(index_path(batch_id - 1))
            stored = stored_near(spark, points, before, batch_id)
            own = stored.select(series, date, F.lit(True).alias("_stored"))
            rows = null_safe_join(rows, own, [series, date], "left").withColumn("_again", F.col("_stored").isNotNull()).drop("_stored")
            kept = null_safe_join(stored, points.select(series, date), [series, date], "left_anti")
            rows = rows.unionByName(kept.withColumns({"_new": F.lit(False), "_again": F.lit(True)}))
            index = before.unionByName(index).distinct()
        lags = {"_prev": (value, 1), "_after_new": ("_new", 1)}
        lagged = windows.with_lags(rows, lags, [series], date, chunk)
        mom = windows.growth(F.col(value), F.col("_prev"), 1.0)
        judged = lagged.withColumn("mom", mom).withColumn(
            "flagged", F.coalesce(quality.mom_flagged(F.col(value), F.col("_prev"), F.col("mom"), limit), F.lit(False))
        )
        told = judged.filter((F.col("_new") & (F.col("flagged") | F.col("_again"))) | (~F.col("_new") & F.col("_after_new")))
        told = told.withColumn("mom_abs", F.abs("mom")).drop("_new", "_again", "_prev", "_after_new")
        told.write.mode("overwrite").parquet(f"{flags}/batch_id={batch_id}")
        points.hint("rebalance", F.col("period")).write.mode("overwrite").partitionBy("period").parquet(f"{store}/points/batch_id={batch_id}")
        index.write.mode("overwrite").parquet(index_path(batch_id))
        fs.delete(hadoop_path(spark, index_path(batch_id - 2))[0], True)
        points.unpersist()

    return stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)


def current_flags(spark: SparkSession, flags: str, series: str, date: str) -> DataFrame:
    """The flagged moves as they stand: the newest verdict on every row, withdrawn ones left out."""
    verdicts = upsert.dedup_latest(spark.read.parquet(flags), [series, date], ["batch_id"])
    return verdicts.filter("flagged").drop("flagged", "batch_id")
