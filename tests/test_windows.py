import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from costseries.operators import windows

D = dt.date


def series(spark, values, key="a"):
    rows = [(key, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, t int, v double")


def ordered(df, *cols):
    return [tuple(r) if len(cols) > 1 else r[0] for r in df.orderBy("k", "t").select(*cols).collect()]


def test_pct_change_pads_and_nulls_a_zero_base(spark):
    df = series(spark, [1.0, None, 2.0, 0.0, 3.0])
    assert ordered(windows.pct_change(df, ["k"], "t", "v", {"c": 1}), "c") == [None, 0.0, 100.0, -100.0, None]


def test_pct_change_without_pad(spark):
    df = series(spark, [1.0, None, 2.0])
    assert ordered(windows.pct_change(df, ["k"], "t", "v", {"c": 1}, pad=False), "c") == [None, None, None]


def random_table(seed):
    rng = random.Random(seed)
    rows = []
    for key in ("hot", "cold", None):
        n = 60 if key == "hot" else 7
        stamps = sorted(rng.sample(range(200), n))
        rows += [(key, t, None if rng.random() < 0.4 else round(rng.uniform(-5, 5), 2)) for t in stamps]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_chunks_give_the_same_as_one_window(spark, rows, seed, width):
    df = spark.createDataFrame(random_table(seed), "k string, t int, v double")
    chunk = F.floor(F.col("t") / width)
    lags = {"l1": ("v", 1), "l5": ("v", 5), "t2": ("t", 2)}
    whole = windows.with_lags(df, lags, ["k"], "t")
    assert rows(windows.with_lags(df, lags, ["k"], "t", chunk)) == rows(whole)
    whole = windows.fill_forward(df, ["v"], ["k"], "t")
    assert rows(windows.fill_forward(df, ["v"], ["k"], "t", chunk)) == rows(whole)


@pytest.mark.parametrize("seed", range(3))
def test_pct_change_matches_pandas(spark, seed):
    table = [r for r in random_table(seed) if r[0]]
    df = spark.createDataFrame(table, "k string, t int, v double")
    got = windows.pct_change(df, ["k"], "t", "v", {"c": 3}, chunk=F.floor(F.col("t") / 20)).toPandas()
    got = got.sort_values(["k", "t"])["c"].to_numpy()
    pdf = pd.DataFrame(table, columns=["k", "t", "v"]).astype({"v": float}).sort_values(["k", "t"])
    padded = pdf.groupby("k")["v"].ffill()
    want = (padded.groupby(pdf["k"]).pct_change(3, fill_method=None) * 100).to_numpy()
    assert pd.Series(got).round(9).equals(pd.Series(want).round(9))


def test_variations_follow_the_frequency(spark):
    daily = [("d", i, float(i + 1), "daily") for i in range(40)]
    monthly = [("m", i, float(i + 1), "monthly") for i in range(13)]
    df = spark.createDataFrame(daily + monthly, "k string, t int, v double, freq string")
    out = {(r["k"], r["t"]): r for r in windows.variations(df, ["k"], "t", "v", "freq").collect()}
    assert out["d", 1]["var_day"] == 100.0 and out["d", 30]["var_month"] == 3000.0 and out["d", 39]["var_year"] is None
    assert out["m", 1]["var_day"] is None and out["m", 1]["var_month"] == 100.0 and out["m", 12]["var_year"] == 1200.0


def month_rows(spark, months):
    return spark.createDataFrame([("a", D(y, m, 1), v) for y, m, v in months], "k string, d date, v double")


def test_calendar_change_respects_gaps(spark):
    df = month_rows(spark, [(2023, 1, 10.0), (2023, 2, 11.0), (2023, 4, 12.0), (2024, 1, 20.0)])
    out = windows.calendar_change(df, ["k"], "d", "v", {"mom": 1, "yoy": 12}).orderBy("d").collect()
    assert [r["mom"] is None for r in out] == [True, False, True, True]
    assert out[3]["yoy"] == 100.0


def test_ytd_uses_the_previous_december(spark):
    months = [(2022, m, float(m)) for m in range(1, 13)] + [(2023, 1, 24.0), (2023, 12, 36.0), (2024, 2, 72.0)]
    out = {r["d"]: r for r in windows.ytd_12m_change(month_rows(spark, months), ["k"], "d", "v").collect()}
    assert out[D(2022, 5, 1)]["chg_ytd"] is None
    assert out[D(2023, 1, 1)]["chg_ytd"] == 100.0 and out[D(2023, 12, 1)]["chg_ytd"] == 200.0
    assert out[D(2024, 2, 1)]["chg_ytd"] == 100.0


def test_diff_days(spark):
    out = windows.diff_days(month_rows(spark, [(2023, 1, 1.0), (2023, 2, 1.0), (2023, 4, 1.0)]), ["k"], "d")
    assert [r["gap_days"] for r in out.orderBy("d").collect()] == [None, 31, 59]


@pytest.mark.parametrize("period_table", [True, False])
def test_shares_add_up(spark, period_table):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 2.0)], "k string, v double")
    out = windows.share_of_total(df, ["k"], "v", period_table=period_table)
    sums = {r["k"]: r["s"] for r in out.groupBy("k").agg(F.sum("share_pct").alias("s")).collect()}
    assert sums == {"a": 100.0, "b": 100.0, None: 100.0}


def test_zscore_needs_three_points_and_variation(spark):
    rows = [("two", 1.0), ("two", 9.0), ("flat", 1.0), ("flat", 1.0), ("flat", 1.0), ("ok", 1.0), ("ok", 2.0), ("ok", 3.0)]
    out = windows.zscore(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()
    assert {r["k"] for r in out if r["zscore"] is None} == {"two", "flat"}
    assert max(r["zscore"] for r in out if r["k"] == "ok") == pytest.approx(1.2247449)


def test_lag_growth_sql(spark):
    out = windows.lag_growth(series(spark, [10.0, 15.0, 0.0, 4.0]), "k", "t", "v")
    assert ordered(out, "growth") == [None, 50.0, -100.0, None]


@pytest.mark.parametrize("kind", ["int", "date", "timestamp_ntz"])
def test_even_chunks_are_ordered_and_balanced(spark, kind):
    expr = {"int": "id", "date": "date_add(date'2024-01-01', cast(id as int))", "timestamp_ntz": "timestampadd(MINUTE, id, timestamp_ntz'2024-01-01 00:00:00')"}
    df = spark.range(100).selectExpr(f"cast({expr[kind]} as {kind}) as t", "id")
    out = df.withColumn("c", windows.even_chunk(df, "t", rows=10)).orderBy("id").collect()
    chunks = [r["c"] for r in out]
    assert chunks == sorted(chunks) and len(set(chunks)) == 11 and max(chunks.count(c) for c in chunks) == 10
    one = df.limit(1)
    assert one.withColumn("c", windows.even_chunk(one, "t")).collect()[0]["c"] == 0


def test_chunks_follow_rows_not_the_span(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_990, F.col("id") % 5_000).otherwise(F.col("id") * 1_000_000).alias("t"))
    sizes = [r["count"] for r in df.groupBy(windows.row_chunk(df, "t", rows=100).alias("c")).count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) > 150 and max(sizes) <= 200
    rising = df.withColumn("c", windows.row_chunk(df, "t", rows=100)).groupBy("c").agg(F.min("t").alias("a"), F.max("t").alias("b")).orderBy("c").collect()
    assert all(x["b"] < y["a"] for x, y in zip(rising, rising[1:]))
    many = df.withColumn("k", F.col("t") % 500)
    assert many.select(windows.row_chunk(many, "t", rows=100, keys=["k"]).alias("c")).distinct().count() == 1
