import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from costseries.operators import quality
from costseries.session import workspace
from costseries.streaming.streams import neighbour_periods
from costseries.streaming import (
    compact,
    current_flags,
    merged_view,
    run_available,
    stream_changes,
    stream_dedup,
    stream_quality,
    stream_series,
    stream_upsert,
)

D = dt.date
SCHEMA = "k string, ts timestamp, v double"


def land(spark, path, batches):
    for rows in batches:
        df = spark.createDataFrame([(k, dt.datetime(2024, 1, d), v) for k, d, v in rows], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(path)


def reader(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_series_drops_bad_points(spark, tmp_path):
    payload = [{"data": "01/01/2023", "valor": "13,75"}, {"data": "x", "valor": "1"}, {"data": "01/02/2023", "valor": "0"}, {"data": "01/01/2030", "valor": "1"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "selic.json").write_text(json.dumps(payload))
    points = stream_series(spark, str(tmp_path / "in"), "2024-01-01")
    out = workspace(spark, "t-series")
    run_available(points.writeStream.format("parquet").option("path", f"{out}/o").option("checkpointLocation", f"{out}/c"))
    assert [tuple(r) for r in spark.read.parquet(f"{out}/o").select("series_id", "ref_date", "value").collect()] == [("selic", D(2023, 1, 1), 13.75)]


def test_upsert_over_batches_is_idempotent(spark, rows):
    base = workspace(spark, "t-upsert")
    land(spark, f"{base}/in", [[("a", 1, 1.0), ("a", 3, 3.0), ("b", 1, 9.0)], [("a", 2, 2.0), ("b", 2, 8.0)], [("c", 1, 5.0)]])
    for _ in range(2):  # the second run finds nothing new
        run_available(stream_upsert(reader(spark, f"{base}/in"), f"{base}/t", f"{base}/c", ["k"], ["ts"]))
    want = [("a", 3.0), ("b", 8.0), ("c", 5.0)]
    assert rows(merged_view(spark, f"{base}/t", ["k"], ["ts"]), "k", "v") == want
    # a replay from the start rewrites the same deltas
    run_available(stream_upsert(reader(spark, f"{base}/in"), f"{base}/t", f"{base}/c2", ["k"], ["ts"]))
    assert rows(merged_view(spark, f"{base}/t", ["k"], ["ts"]), "k", "v") == want
    compact(spark, f"{base}/t", f"{base}/t2", ["k"], ["ts"])
    assert rows(merged_view(spark, f"{base}/t2", ["k"], ["ts"]), "k", "v") == want


def test_dedup_within_the_delay(spark, rows):
    base = workspace(spark, "t-dedup")
    land(spark, f"{base}/in", [[("a", 1, 1.0), ("b", 1, 2.0)], [("a", 1, 1.0), ("c", 2, 3.0)]])
    out = stream_dedup(reader(spark, f"{base}/in"), ["k"], "ts", "10 days")
    run_available(out.writeStream.format("parquet").option("path", f"{base}/o").option("checkpointLocation", f"{base}/c"))
    assert rows(spark.read.parquet(f"{base}/o"), "k", "v") == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_window_counts_match_the_batch_form(spark, rows):
    base = workspace(spark, "t-quality")
    land(spark, f"{base}/in", [[("a", 1, -1.0), ("a", 1, 0.0)], [("a", 2, 2e6), ("b", 2, 1.0)], [("a", 9, 1.0)]])
    out = stream_quality(reader(spark, f"{base}/in"), "k", "ts", "v", "1 day", "1 day")
    run_available(out.writeStream.format("parquet").option("path", f"{base}/o").option("checkpointLocation", f"{base}/c"))
    got = rows(spark.read.parquet(f"{base}/o").withColumn("d", F.dayofmonth("window_start")), "d", "k", "n", "n_negative", "n_zero", "n_absurd")
    assert got == [(1, "a", 2, 1, 1, 0), (2, "a", 1, 0, 0, 1), (2, "b", 1, 0, 0, 0)]


def test_changes_see_earlier_batches(spark, rows):
    base = workspace(spark, "t-changes")
    batches = [[("a", 1, 100.0), ("b", 1, 100.0)], [("a", 2, 105.0), ("b", 2, 150.0)], [("a", 6, 130.0)]]
    # late: the third day of b follows its second, not its first, and precedes nothing stored
    batches += [[("b", 9, 151.0)], [("b", 3, 149.0), ("c", 1, 1.0)], [("a", 4, 104.0)]]
    land(spark, f"{base}/in", batches)
    writer = stream_changes(reader(spark, f"{base}/in"), f"{base}/s", f"{base}/f", f"{base}/c", "k", "ts", "v")
    run_available(writer)
    flags = current_flags(spark, f"{base}/f", "k", "ts").withColumn("d", F.dayofmonth("ts"))
    assert rows(flags, "k", "d") == [("a", 6), ("b", 2)]
    assert len(list(Path(f"{base}/s/index").glob("batch_id=*"))) == 2


def test_late_and_timely_rows_of_one_batch_meet_their_own_predecessors(spark, rows):
    base = workspace(spark, "t-late")
    land(spark, f"{base}/in", [[("a", 1, 100.0), ("a", 10, 200.0)], [("a", 5, 101.0), ("a", 11, 202.0)]])
    run_available(stream_changes(reader(spark, f"{base}/in"), f"{base}/s", f"{base}/f", f"{base}/c", "k", "ts", "v"))
    flags = current_flags(spark, f"{base}/f", "k", "ts").withColumn("d", F.dayofmonth("ts"))
    assert rows(flags, "k", "d") == [("a", 10)]


@pytest.mark.parametrize("seed", range(3))
def test_any_arrival_order_gives_the_batch_result(spark, rows, seed):
    """Late rows, revisions and gaps over several months: the verdicts that stand are those over the whole table."""
    rng, base = random.Random(seed), workspace(spark, "t-order")
    arrivals = [(rng.choice("ab"), rng.randrange(150), float(rng.choice((0, 100, 105, 150)))) for _ in range(60)]
    batches = [arrivals[k : k + 12] for k in range(0, 60, 12)]
    final = {}
    for batch in batches:
        own = {}
        for k, day, v in batch:
            own[k, day] = max(v, own.get((k, day), v))
        final |= own
    for batch in batches:
        df = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(day), v) for k, day, v in batch] + [("a", None, 1.0), ("a", dt.datetime(2024, 1, 1), None)], SCHEMA)
        df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    files = sorted(Path(f"{base}/in").glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    assert len(files) == len(batches)
    run_available(stream_changes(reader(spark, f"{base}/in"), f"{base}/s", f"{base}/f", f"{base}/c", "k", "ts", "v"))
    whole = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(day), v) for (k, day), v in final.items()], SCHEMA)
    expected = quality.mom_violations(whole, ["k"], "ts", "v")
    assert rows(current_flags(spark, f"{base}/f", "k", "ts"), "k", "ts", "v", "mom") == rows(expected, "k", "ts", "v", "mom")


def test_a_late_row_reads_only_its_neighbours_periods(spark, rows):
    index = spark.createDataFrame([(k, p) for k in "ab" for p in (202301, 202303, 202304, 202309)] + [(None, 202302)], "k string, period int")
    batch = spark.createDataFrame([("a", 202305), ("b", 202303), ("c", 202301), (None, 202305)], "k string, period int")
    assert rows(neighbour_periods(batch, index, "k")) == [(None, 202302), ("a", 202304), ("a", 202309), ("b", 202301), ("b", 202303), ("b", 202304)]
