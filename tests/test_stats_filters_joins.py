import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costseries.functions.search import count_upto
from costseries.operators import filters, joins, ranks, selection, stats

D = dt.date


@pytest.mark.parametrize("seed", range(3))
def test_large_quantiles_are_exact(spark, seed):
    rng = random.Random(seed)
    data = {"hot": [rng.lognormvariate(3, 2) for _ in range(4000)], "few": [1.0, 5.0], "one": [7.0], "ties": [3.0] * 50 + [4.0] * 49}
    data[None] = [float(i) for i in range(101)]
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs + [None]], "k string, v double")
    probs = {"q1": 0.25, "med": 0.5, "p99": 0.99}
    got = {r["k"]: r for r in stats.quantiles_large(df, ["k"], "v", probs).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12), (k, name)


@pytest.mark.parametrize("few", [10_000, 0])
def test_selection_of_hard_values(spark, monkeypatch, few):
    """Neighbouring doubles, both signs, infinities, NaN, tiny and huge values; the table joined by broadcast or by key."""
    monkeypatch.setattr(selection, "FEW", few)
    rng = random.Random(5)
    near = [1.0 + k * 2.0**-52 for k in range(300)]  # all in one cell of the first two reads
    data = {
        "near": near + [-x for x in near] + [1e308, -1e308],
        "span": [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300) for _ in range(500)],
        "edge": [float("-inf"), 5e-324, -5e-324, 0.0, -0.0, 1.0, float("inf"), float("inf")],
        None: [0.1 * k for k in range(1000)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k string, v double")
    ranks = {f"r{i}": F.floor(F.lit(i / 7) * (F.col("_n") - 1)) for i in range(8)}
    got = {r["k"]: r for r in selection.select_ranks(df, ["k"], "v", ranks).collect()}
    for k, vs in data.items():
        assert got[k]["_n"] == len(vs)
        assert [got[k][f"r{i}"] for i in range(8)] == [sorted(vs)[int(i / 7 * (len(vs) - 1))] for i in range(8)], k
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    last = selection.select_ranks(nan, [], "v", {"top": F.col("_n") - 1, "first": F.lit(0)}).first()
    assert last["_n"] == 2 and last["first"] == 1.0 and last["top"] != last["top"]
    assert selection.quantiles_exact(df.where("false"), ["k"], "v", {"q": 0.5}).count() == 0


def test_selection_spreads_one_key_over_all_tasks(spark, monkeypatch):
    """A key with all rows: tasks send histograms, and nothing that is ordered or listed grows with the rows."""
    seen, real = [], selection._runs

    def spy(rows, groups, run, cell):
        per_task = rows.groupBy(F.spark_partition_id()).count().collect()
        runs = real(rows, groups, run, cell)
        seen.append(([r["count"] for r in per_task], runs.count(), runs.agg(F.max(F.size("_cells"))).first()[0]))
        return runs

    monkeypatch.setattr(selection, "_runs", spy)
    df = spark.range(0, 200_000, numPartitions=8).select(F.lit("all").alias("k"), F.exp(F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e8).alias("v"))
    values = sorted(r["v"] for r in df.collect())
    row = selection.quantiles_exact(df, ["k"], "v", {"q": 0.3}).first()
    assert row["q"] == pytest.approx(values[int(0.3 * 199_999)], rel=1e-3)
    tasks, runs, longest = seen[0]
    assert len(tasks) == 8 and max(tasks) == 25_000
    assert runs < 30 and longest <= selection.STEPS and all(n < 100 for _, n, _ in seen[1:])


def test_fence(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 1000)], "k string, v double")
    for period_table in (True, False):
        kept = stats.within_fence(df, ["k"], "v", 10, period_table)
        assert sorted(r["v"] for r in kept.collect()) == [1.0, 2.0, 3.0, 4.0]


def test_group_stats(spark):
    df = spark.createDataFrame([("a", 1.0, D(2024, 1, 1)), ("a", 2.0, D(2024, 2, 1)), ("b", 5.0, D(2024, 1, 1))], "k string, v double, d date")
    out = {r["k"]: r for r in stats.group_stats(df, ["k"], "v", "d").collect()}
    assert out["a"]["avg_value"] == 1.5 and out["a"]["std_value"] == 0.71 and out["a"]["cv"] == 0.4733
    assert out["b"]["std_value"] is None and out["b"]["n"] == 1


def test_mode_share_ties_and_suspicion(spark):
    rows = [("a", 1.0)] * 4 + [("a", 2.0)] * 2 + [("b", 9.0)] * 2 + [("b", 1.0)] * 2 + [("b", None)]
    out = {r["k"]: r for r in stats.mode_share(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()}
    assert out["a"]["mode_value"] == 1.0 and out["a"]["suspicious"]
    assert out["b"]["mode_value"] == 1.0 and out["b"]["n"] == 4 and not out["b"]["suspicious"]


def test_constant_series(spark):
    rows = [("c", 2.0)] * 11 + [("short", 2.0)] * 10 + [("v", float(i % 2)) for i in range(20)]
    out = stats.constant_series(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").collect()
    assert [(r["k"], r["n"], r["constant_value"]) for r in out] == [("c", 11, 2.0)]


def test_series_profile_infers_frequency(spark):
    rows = [("d", D(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(30)] + [("m", D(2024, m, 1), 1.0) for m in (1, 2, 3)]
    out = stats.series_profile(spark.createDataFrame(rows, "k string, d date, v double"), ["k"], "d", "v")
    assert {r["k"]: r["freq"] for r in out.collect()} == {"d": "daily", "m": "monthly"}


def test_table_profile_and_duplicates(spark):
    df = spark.createDataFrame([("1,5", "2024-01-01"), ("2", ""), ("2", ""), (None, "x")], "n string, d string")
    out = {r["column_name"]: r for r in stats.table_profile(df).collect()}
    assert out["n"]["is_numeric"] and out["n"]["n_null"] == 1 and out["d"]["n_blank"] == 2
    assert not out["d"]["is_numeric"]
    assert stats.duplicate_rows(df).collect()[0][0] == 1
    assert stats.duplicate_rows(df.limit(0)).collect()[0][0] == 0


def test_multi_measure_skips_absent_columns(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0)], "k string, n int, w double")
    row = stats.multi_measure(df, ["k"], {"n": "sum", "w": "mean", "zzz": "sum"}).collect()[0]
    assert tuple(row) == ("a", 3, 15.0)


def test_valid_points_presets(spark):
    values = [0.0, 1e6, 1000001.0, -1000.0, -5.0, None, float("nan"), 3.0]
    rows = [(v, D(2024, 1, 1)) for v in values] + [(3.0, D(2030, 1, 1)), (3.0, None)]
    df = spark.createDataFrame(rows, "v double, d date")
    kept = lambda p: sorted(r["v"] for r in filters.valid_points(df, "v", "d", "2024-06-01", p).collect())
    assert kept("abs") == [-1000.0, -5.0, 3.0, 1e6]
    assert kept("range") == [-5.0, 3.0]
    assert kept("range_zero") == [-5.0, 0.0, 3.0]


def test_release_gate(spark):
    rows = [("daily", D(2024, 3, 14)), ("daily", D(2024, 3, 15)), ("monthly", D(2024, 2, 1)), ("monthly", D(2024, 3, 1)), ("daily", D(2022, 1, 1))]
    out = filters.release_gate(spark.createDataFrame(rows, "f string, d date"), "d", "f", "2024-03-15")
    assert sorted(r["d"] for r in out.collect()) == [D(2024, 2, 1), D(2024, 3, 14)]


def test_last_n_months_is_inclusive(spark):
    rows = [(D(2023 + m // 12, m % 12 + 1, 1),) for m in range(24)]
    assert filters.last_n_months(spark.createDataFrame(rows, "d date"), "d", 12).count() == 13


def test_sector_and_category(spark):
    by_code = spark.createDataFrame([("4120400",), ("4399101",), ("5011",)], "code string")
    assert filters.sector_filter(by_code).count() == 2
    by_letter = spark.createDataFrame([("f", "99"), ("G", "41")], "section string, code string")
    assert filters.sector_filter(by_letter).count() == 1
    assert filters.sector_filter(by_letter.drop("section", "code").withColumn("x", F.lit(1))).count() == 2
    by_class = spark.createDataFrame([("PEDREIRO SENIOR",), ("cimento",), (None,)], "category string")
    assert filters.category_filter(by_class).count() == 2
    by_kind = spark.createDataFrame([("mat", "PEDREIRO"), ("MO", "x")], "kind string, category string")
    assert filters.category_filter(by_kind).count() == 1


def test_split_is_complete(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "i int")
    parts, check = filters.split_by(df, {"low": F.col("i") < 3, "even": F.col("i") % 2 == 0})
    assert {k: v.count() for k, v in parts.items()} == {"low": 3, "even": 3, "other": 4}
    assert check.collect()[0]["complete"]


def test_code_validity(spark):
    df = spark.createDataFrame([("4205407",), ("420540",), ("3505407",), (None,)], "c string")
    assert [r[0] for r in df.select(filters.code_validity(F.col("c"), "42", 7)).collect()] == [True, False, False, False]


@pytest.mark.parametrize("seed", range(4))
def test_band_lookup_matches_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    values = [(i, rng.choice([None, rng.uniform(-50, 50), float(rng.randint(-5, 5))])) for i in range(60)]
    bands = []
    for b in range(12):
        low = rng.choice([None, float(rng.randint(-60, 60))])
        high = rng.choice([None, (low if low is not None else 0.0) + rng.choice([0.0, 0.5, 3.0, 200.0])])
        bands.append((b, low, high))
    df = spark.createDataFrame(values, "i int, v double")
    bd = spark.createDataFrame(bands, "b int, lo double, hi double")
    for closed in (False, True):
        want = []
        for i, v in values:
            hits = []
            if v is not None:
                for b, lo, hi in bands:
                    if (lo is None or v >= lo) and (hi is None or (v <= hi if closed else v < hi)):
                        hits.append(b)
            want += [(i, b) for b in hits] or [(i, None)]
        got = rows(joins.band_lookup(df, "v", bd, "lo", "hi", closed=closed), "i", "b")
        assert got == sorted(want, key=lambda r: (r[0], r[1] is not None, r[1] or 0)) or sorted(map(str, got)) == sorted(map(str, want))


def test_band_cells_stay_even(spark):
    """One outlier leaves the cells as they were; a value shared by a third of the rows is dealt over many cells."""
    bands = spark.createDataFrame([(k, float(k), float(k + 1)) for k in range(100)], "b int, lo double, hi double")
    values = spark.range(30_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 100).alias("v"))

    def largest(df):
        borders = joins.cell_borders(df, "v", bands, "lo", "hi")
        placed, listed = joins.band_cells(df, "v", bands, "lo", "hi", borders)
        sizes = [r["count"] for r in placed.groupBy("_at").count().collect()]
        return max(sizes) / (df.count() / joins.CELLS), listed.count()

    even = largest(values)
    assert even[0] <= 2
    assert largest(values.unionByName(spark.createDataFrame([(-1, 1e300)], "id long, v double")))[0] <= 2
    third = values.withColumn("v", F.when(F.col("id") % 3 == 0, F.lit(50.5)).otherwise(F.col("v")))
    assert largest(third)[0] <= 2
    missing = values.withColumn("v", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("v")))
    assert largest(missing)[0] <= 2
    joined = joins.band_lookup(third, "v", bands, "lo", "hi")
    assert joined.count() == 30_000 and joined.where("b = floor(v)").count() == 30_000


def test_count_upto(spark):
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 7, 8, 9, 100):
        borders = sorted(rng.randrange(20) / 2 for _ in range(n))
        df = spark.createDataFrame([(k / 4,) for k in range(-3, 45)] + [(None,)], "x double")
        edges = F.lit(borders).cast("array<double>")
        got = df.select("x", count_upto(edges, F.col("x"), n).alias("a"), count_upto(edges, F.col("x"), n, below=True).alias("b")).collect()
        for r in got:
            x = float("-inf") if r["x"] is None else r["x"]
            assert (r["a"], r["b"]) == (sum(e <= x for e in borders), sum(e < x for e in borders))


def test_fill_missing_from(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.0), ("c", 5.0), ("d", None), ("e", 0.0)], "k string, v double")
    ref = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("e", 0.0)], "k string, v double")
    out = {r["k"]: (r["v"], r["fill_status"]) for r in joins.fill_missing_from(df, ref, ["k"], ["v"]).collect()}
    assert out == {"a": (1.0, "updated"), "b": (2.0, "updated"), "c": (5.0, "kept"), "d": (None, "no_data"), "e": (0.0, "no_data")}


def test_list_membership_and_lookup(spark, rows):
    lists = spark.createDataFrame([("x", "s1, s2 ,,"), ("y", "s2")], "n string, l string")
    df = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "s string")
    assert rows(joins.list_membership(df, "s", lists, "l"), "s", "n") == [("s1", "x"), ("s2", "x"), ("s2", "y")]
    ref = spark.createDataFrame([("s1", 2.0)], "s string, f double")
    assert rows(joins.lookup_left(df, ref, ["s"], {"f": F.lit(1.0)})) == [("s1", 2.0), ("s2", 1.0), ("s3", 1.0)]


def test_cross_product_and_parent_code(spark, rows):
    a, b = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([("x",), ("y",), ("z",)], "b string")
    assert joins.cross_product(a, b).count() == 6
    places = spark.createDataFrame([(4205407,), (9900001,)], "code int")
    parents = spark.createDataFrame([(42, "SC")], "p int, uf string")
    assert rows(joins.parent_code_lookup(places, "code", parents, "p"), "code", "uf") == [(4205407, "SC"), (9900001, None)]


def test_surrogate_key_is_dense_and_ordered(spark):
    rng = random.Random(1)
    values = [(rng.randint(0, 50), i) for i in range(500)]
    out = ranks.surrogate_key(spark.createDataFrame(values, "a int, b int").repartition(7), ["a", "b"])
    got = [(r["a"], r["b"]) for r in out.orderBy("id").collect()]
    assert got == sorted(values) and sorted(r["id"] for r in out.collect()) == list(range(1, 501))
    assert ranks.surrogate_key(spark.createDataFrame([], "a int"), ["a"]).count() == 0


def test_top_and_ends(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(10)], "i int, v double")
    assert [r["i"] for r in ranks.top_k(df, "v", 3, "i").collect()] == [4, 9, 3]
    assert [r["i"] for r in ranks.bottom_k(df, "v", 3, "i").collect()] == [0, 5, 1]
    assert sorted(r["i"] for r in ranks.head_tail(df, ["i"], 2).collect()) == [0, 1, 8, 9]
    signed = spark.createDataFrame([(1, -3.0), (2, 2.0), (3, None)], "i int, v double")
    assert [r["i"] for r in ranks.order_by_abs(signed, "v", "i").collect()] == [1, 2, 3]


def test_coverage_and_routes(spark):
    df = spark.createDataFrame([("fact_a", "ok"), ("fact_b", "empty"), ("dim_a", "missing"), ("zz", "ok")], "n string, s string")
    out = {r["category"]: r["n"] for r in stats.coverage(df, "n", "s", {"fact_": "facts", "dim_": "dims"}).collect()}
    assert out == {"facts": 2, "dims": 1, "other": 1}
