import datetime as dt
import json
import os
import random
import time
import uuid
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from costseries import session, sources
from costseries.operators import columns, upsert, windows
from costseries.session import workspace

D = dt.date
FACT = "fact_id string, v double, created_at string"


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_dedup_keeps_the_newest(spark, rows):
    df = fact(spark, [("ipca_1", 100.0, "10:00"), ("ipca_1", 101.0, "11:00"), ("selic_1", 13.75, "10:00")])
    assert rows(upsert.dedup_latest(df, ["fact_id"], ["created_at"]), "fact_id", "v") == [("ipca_1", 101.0), ("selic_1", 13.75)]
    assert rows(upsert.dedup_latest(df, ["fact_id"], ["created_at"], "first"), "fact_id", "v")[0] == ("ipca_1", 100.0)
    assert tuple(upsert.dedup_counts(df, ["fact_id"]).collect()[0]) == (3, 2, 1)


def test_dedup_no_op_cases(spark):
    df = fact(spark, [("a", 1.0, "1"), ("b", 2.0, "1")])
    assert upsert.dedup_latest(df, ["fact_id"], ["created_at"]).count() == 2
    assert upsert.dedup_latest(df.limit(0), ["fact_id"], ["created_at"]).count() == 0
    assert upsert.dedup_latest(df, ["no_such_key"]) is df


@pytest.mark.parametrize(
    "target, batch, want",
    [
        ([], [("a", 1.0), ("b", 2.0)], [("a", 1.0), ("b", 2.0)]),
        ([("a", 1.0)], [("b", 2.0), ("c", 3.0)], [("a", 1.0), ("b", 2.0), ("c", 3.0)]),
        ([("a", 1.0), ("b", 102.0)], [("b", 102.5), ("c", 3.0)], [("a", 1.0), ("b", 102.5), ("c", 3.0)]),
    ],
)
def test_upsert(spark, rows, target, batch, want):
    t, b = spark.createDataFrame(target, "k string, v double"), spark.createDataFrame(batch, "k string, v double")
    once = upsert.upsert(t, b, ["k"])
    assert rows(once) == want
    assert rows(upsert.upsert(once, b, ["k"])) == want
    counts = upsert.upsert_counts(t, b, ["k"]).collect()[0]
    assert counts["n_final"] == len(want) and counts["n_new"] + counts["n_updated"] == len(batch)


def test_upsert_names_missing_columns(spark):
    t = spark.createDataFrame([("a", 1.0)], "k string, valor double")
    with pytest.raises(ValueError, match="valor"):
        upsert.upsert(t, t.drop("valor"), ["k"])


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keyed, keyed)
def test_upsert_properties(spark, target, batch):
    schema = "k int, v int"
    t = spark.createDataFrame(list(dict(target).items()), schema)
    b = spark.createDataFrame(batch, schema)
    once = upsert.upsert(t, b, ["k"], ["v"])
    newest = {k: max(v for kk, v in batch if kk == k) for k, _ in batch}
    want = sorted((dict(target) | newest).items(), key=str)
    assert sorted((tuple(r) for r in once.collect()), key=str) == want
    assert sorted((tuple(r) for r in upsert.upsert(once, b, ["k"], ["v"]).collect()), key=str) == want


def test_upsert_series_recomputes_over_history(spark):
    schema = "s string, d date, v double"
    stored = spark.createDataFrame([("a", D(2024, 1, 1), 100.0), ("a", D(2024, 2, 1), 110.0), ("b", D(2024, 1, 1), 7.0)], schema)
    batch = spark.createDataFrame([("a", D(2024, 2, 1), 120.0), ("a", D(2024, 3, 1), 150.0)], schema)
    full = {(r["s"], r["d"].month): r for r in upsert.upsert_series(stored, batch, "s", "d", "v").collect()}
    assert len(full) == 4 and full["a", 2]["mom"] == pytest.approx(20) and full["a", 3]["mom"] == pytest.approx(25)
    assert full["a", 3]["fact_id"] == "a_2024-03-01"
    only = {(r["s"], r["d"].month): r for r in upsert.upsert_series(stored, batch, "s", "d", "v", recompute="batch").collect()}
    assert len(only) == 4 and only["a", 2]["mom"] is None and only["a", 3]["mom"] == pytest.approx(25)


def test_registry_order_and_unknown(spark):
    t = spark.createDataFrame([(1,)], "k int")
    out = upsert.upsert_registry({"fact_x": (t, t), "dim_y": (t, t)}, {"fact_x": ["k"], "dim_y": ["k"]})
    assert list(out) == ["dim_y", "fact_x"]
    with pytest.raises(KeyError):
        upsert.upsert_registry({"other": (t, t)}, {})


def test_set_operations(spark, rows):
    a, b = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("y",), ("z",)], "k string")
    assert rows(upsert.set_diff_keys(a, b, "k")) == [("x", "missing"), ("z", "unexpected")]
    both = upsert.union_tagged({"a": a, "b": b.withColumn("extra", F.lit(1))}, "tag")
    assert both.count() == 4 and both.filter("extra IS NULL").count() == 2


def test_consolidate_cost_defaults_and_priority(spark):
    one = spark.createDataFrame([("2024-01-01", "", "1.000,50"), ("bad", "SC", "1")], "ref_date string, place string, v string")
    two = spark.createDataFrame([("01/01/2024", None, "r8-n", "2000.5"), ("2024-02", "SC", "R8-DES", "-1")], "ref_date string, place string, kind string, v string")
    out = upsert.consolidate_cost([upsert.CostSource(one, "v", "A", regime="ONEROSO"), upsert.CostSource(two, "v", "B")])
    got = {(r["ref_date"], r["place"], r["regime"]): (r["value"], r["source"]) for r in out.collect()}
    assert got == {(D(2024, 1, 1), "BR", "ONEROSO"): (2000.5, "B"), (None, "SC", "ONEROSO"): (1.0, "A")}


def test_versioned_table_lifecycle(spark, rows):
    path = workspace(spark, "test-table")
    schema = "k int, v string"
    with pytest.raises(FileNotFoundError):
        sources.read_latest(spark, path)
    sources.write_upsert(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, ["k"], "0001")
    sources.write_upsert(spark.createDataFrame([(2, "B"), (3, "c")], schema), path, ["k"], "0002")
    assert rows(sources.read_latest(spark, path)) == [(1, "a"), (2, "B"), (3, "c")]
    spark.createDataFrame([(9, "x")], schema).write.json(f"{path}/version=0003")  # another format, complete
    spark.createDataFrame([(9, "x")], schema).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/unfinished")
    assert sources.sinks._versions(spark, path)[-1] == "version=0003"


def test_seed_append_insert_ignore(spark, rows):
    path = workspace(spark, "test-seed")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sources.write_if_empty(df, path) and not sources.write_if_empty(df, path)
    sources.write_append(spark.createDataFrame([(2, "b")], "k int, v string"), path)
    sources.write_insert_ignore(spark.createDataFrame([(2, "X"), (3, "c")], "k int, v string"), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_overwrite_is_partitioned_and_ordered(spark):
    path = workspace(spark, "test-overwrite")
    df = spark.createDataFrame([(i % 3, i, "x") for i in range(30)], "p int, i int, z string")
    sources.write_overwrite(df, path, ["i", "p"], ["i"], ["p"])
    back = sources.read_latest(spark, path)
    assert back.count() == 30 and set(back.columns) == {"i", "p"}
    assert back.filter("p = 1").count() == 10


def test_overwrite_from_itself_and_failing_write(spark, rows):
    path = workspace(spark, "test-replace")
    sources.write_overwrite(spark.createDataFrame([(i, "x") for i in range(6)], "i int, z string"), path, ["i", "z"], ["i"])
    opened = sources.read_latest(spark, path)
    sources.write_overwrite(opened.filter("i < 3"), path, ["i", "z"], ["i"])
    assert rows(sources.read_latest(spark, path), "i") == [(0,), (1,), (2,)]
    assert opened.count() == 6  # a reader of the version before is not disturbed
    now = sources.read_latest(spark, path)
    broken = now.withColumn("z", F.when(F.col("i") < 2, F.col("z")).otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        sources.write_overwrite(broken, path, ["i", "z"], ["i"])
    assert rows(sources.read_latest(spark, path), "i") == [(0,), (1,), (2,)]
    for n in (2, 1):
        sources.write_overwrite(sources.read_latest(spark, path).limit(n), path, ["i", "z"], ["i"])
    assert sources.read_latest(spark, path).count() == 1 and len(sources.sinks._versions(spark, path)) == sources.sinks.KEPT


def files_by_folder(path):
    return {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in Path(path).glob("*/*.parquet")}


def test_partitioned_upsert_leaves_other_partitions_alone(spark, rows):
    path = workspace(spark, "test-partitions")
    schema = "p int, k int, v string"
    sources.write_upsert_partitions(spark.createDataFrame([(p, k, "old") for p in (1, 2, None) for k in range(3)], schema), path, ["p", "k"], ["p"])
    before = files_by_folder(path)
    batch = spark.createDataFrame([(2, 1, "new"), (2, 9, "new"), (3, 0, "new"), (2, 1, "new")], schema)
    sources.write_upsert_partitions(batch, path, ["p", "k"], ["p"])
    after = files_by_folder(path)
    assert after["p=1"] == before["p=1"] and after["p=2"] != before["p=2"] and "p=3" in after and len(after) == 4
    want = [(p, k, "old") for p in (None, 1) for k in range(3)] + [(2, 0, "old"), (2, 1, "new"), (2, 2, "old"), (2, 9, "new"), (3, 0, "new")]
    assert rows(spark.read.parquet(path), "p", "k", "v") == want
    sources.write_upsert_partitions(spark.createDataFrame([(None, 1, "n")], schema), path, ["p", "k"], ["p"])
    assert files_by_folder(path)["p=1"] == before["p=1"] and spark.read.parquet(path).filter("p IS NULL AND v = 'n'").count() == 1
    sources.write_upsert_partitions(batch.where("false"), path, ["p", "k"], ["p"])
    failing = batch.withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sources.write_upsert_partitions(failing, path, ["p", "k"], ["p"])
    assert spark.read.parquet(path).count() == 11
    with pytest.raises(ValueError):
        sources.write_upsert_partitions(batch, path, ["k"], ["p"])


@pytest.mark.parametrize("seed", range(4))
def test_series_changes_equal_a_full_recompute(spark, rows, seed):
    """Inserted, revised, repeated, missing and first rows; longer gaps of missing values than the reach."""
    rng = random.Random(seed)
    schema = "s string, d date, v double"
    day = lambda k: D(2000 + k // 12, k % 12 + 1, 1)
    pick = lambda: rng.choice((None, None, 0.0, 1.0, 2.0, 5.0, 8.0))
    stored = {(s, k): pick() if s != "gap" or k % 20 == 0 else None for s in ("a", "b", "gap", "idle", None) for k in range(60) if rng.random() < 0.8}
    batch = {(rng.choice(("a", "b", "gap", "new", None)), rng.randrange(-3 if seed else 0, 64) + 5): pick() for _ in range(rng.choice((1, 4, 12)))}
    batch |= dict(list(stored.items())[:3])  # delivered again, unchanged
    frame = lambda rows: spark.createDataFrame([(s, day(k), v) for (s, k), v in rows.items()], schema)
    target = windows.mom_yoy(frame(stored), ["s"], "d", "v")
    whole = windows.mom_yoy(frame(stored | batch), ["s"], "d", "v")
    got = upsert.upsert_series(target, frame(batch), "s", "d", "v")
    assert rows(got, "s", "d", "v", "mom", "yoy") == rows(whole, "s", "d", "v", "mom", "yoy")
    changed = upsert.series_changes(target, frame(batch), "s", "d", "v")
    assert rows(changed, "s", "d", "v", "mom", "yoy") == rows(whole.exceptAll(target), "s", "d", "v", "mom", "yoy")
    assert changed.filter("s = 'idle'").count() == 0


def test_missing_keys_meet_in_all_comparisons(spark, rows):
    t = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    b = spark.createDataFrame([(None, 9), (3, 3)], "k int, v int")
    assert upsert.upsert(t, b, ["k"]).count() == 3
    assert tuple(upsert.upsert_counts(t, b, ["k"]).collect()[0]) == (2, 1, 1, 3)
    assert rows(upsert.set_diff_keys(t, b, "k")) == [(2, "missing"), (3, "unexpected")]
    assert rows(columns.changed_rows(t, t, ["k"])) == []
    assert {r["k"]: r["status"] for r in columns.changed_rows(t, b, ["k"]).collect()} == {None: "changed", 2: "removed", 3: "added"}


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"), D(2024, 1, 2)), (float("inf"), None), (1.5, None)], "v double, d date")
    got = [tuple(r) for r in sources.sanitize_for_sink(df, ["d", "v"]).collect()]
    assert got == [("2024-01-02", None), (None, None), (None, 1.5)]


def test_series_payload_skips_nothing_silently(spark, tmp_path):
    payload = [{"data": "01/01/2023", "valor": "13,75"}, {"data": "bad", "valor": "1"}, {"data": "01/02/2023", "valor": "x"}]
    (tmp_path / "selic.json").write_text(json.dumps(payload))
    out = sources.read_series_json(spark, str(tmp_path)).collect()
    assert [(r["series_id"], r["ref_date"], r["value"]) for r in out] == [
        ("selic", D(2023, 1, 1), 13.75), ("selic", None, 1.0), ("selic", D(2023, 2, 1), None),
    ]


def test_indexed_and_nested_json(spark, tmp_path, rows):
    table = [
        {"D1C": "Município (Código)", "D1N": "Município", "D2C": "Variável", "D2N": "x", "V": "Valor"},
        {"D1C": "4205407", "D1N": "Florianópolis", "D2C": "93", "D2N": "pop", "V": "537211"},
        {"D1C": "4205407", "D1N": "Florianópolis", "D2C": "94", "D2N": "area", "V": "1"},
        {"D1C": "3550308", "D1N": "São Paulo", "D2C": "93", "D2N": "pop", "V": "..."},
    ]
    (tmp_path / "t.json").write_text(json.dumps(table))
    out = sources.read_indexed_json(spark, str(tmp_path / "t.json"), variable="93", prefix="42")
    assert rows(out, "place_code", "value") == [("4205407", 537211.0)]
    nested = [{"localidade": "1", "res": [{"periodo": "2020", "valor": "5"}, {"periodo": "2022", "valor": "7"}, {"periodo": "2023", "valor": None}]}, {"localidade": "2", "res": []}]
    (tmp_path / "n.json").write_text(json.dumps(nested))
    assert rows(sources.read_nested_observations(spark, str(tmp_path / "n.json"))) == [("1", "2022", 7.0)]


def test_corrupt_rows_are_kept_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v\n1;2,5\nx;3\n", encoding="latin-1")
    out = sources.read_delimited(spark, str(tmp_path), "k int, v string", ";", "ISO-8859-1").collect()
    assert [(r["k"], r["v"], r["_corrupt_record"]) for r in out] == [(1, "2,5", None), (None, "3", "x;3")]


def test_catalog(spark, rows):
    doc = json.dumps({"series": {"s1": {"code": "1", "category": "c"}}, "expectations": {"endpoints": {"e": {"endpoint": "/x"}}}})
    df = spark.createDataFrame([(1, doc), (2, "{}"), (3, "not json")], "i int, d string")
    out = sources.flatten_catalog(df, "d")
    assert rows(out, "i", "series_id", "category", "source_kind") == [(1, "focus_e", "expectations", "expectation"), (1, "s1", "c", "series")]


def test_columns(spark):
    assert columns.snake(" Preço (R$) m² ") == "pre_o_r_m"
    assert columns.unique_names(["a", "a", "b"]) == ["a", "a_2", "b"]
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, None, None)], "i int, a string, b string")
    assert columns.drop_empty(df).columns == ["i", "a"]
    assert columns.drop_empty(df.drop("i")).count() == 1
    changed = columns.changed_rows(df.select("i", "a"), df.filter("i < 3").select("i", F.lit("x").alias("a")), ["i"])
    assert {r["i"]: r["status"] for r in changed.collect()} == {1: "changed", 3: "removed"}


def test_clear_workspaces_removes_only_old_working_folders(spark, tmp_path, monkeypatch):
    folders = [f"run-{uuid.uuid4().hex}", f"run-{uuid.uuid4().hex}", "table"]
    for name in folders:
        (tmp_path / name).mkdir()
    past = time.time() - 7200
    for name in folders[1:]:
        os.utime(tmp_path / name, (past, past))
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    assert session.clear_workspaces(spark, 1) == 1
    assert sorted(os.listdir(tmp_path)) == sorted([folders[0], "table"])
