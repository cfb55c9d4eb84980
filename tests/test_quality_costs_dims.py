import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from costseries.operators import costs, dims, quality

D = dt.date
YEAR = [100.0, 102.0, 101.0, 103.0, 105.0, 200.0, 106.0, 107.0, 108.0, 109.0, 110.0, 111.0]


def monthly(spark, values, key="s"):
    rows = [(key, D(2023, i + 1, 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "s string, d date, v double")


def test_outlier_examples(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 100.0, 4.0, 5.0)], "s string, v double")
    out = quality.outliers_zscore(df, ["s"], "v", limit=2)
    assert [r["v"] for r in out.filter("is_outlier").collect()] == [100.0]
    short = quality.outliers_zscore(df.limit(2), ["s"], "v", limit=0.1).collect()
    assert not any(r["is_outlier"] for r in short)


@pytest.mark.parametrize("chunk", [None, "year"])
def test_quality_flags(spark, rows, chunk):
    values = YEAR[:]
    values[11] = -5.0
    df = monthly(spark, values)
    expr = None if chunk is None else F.floor(F.month("d") / 2)
    out = quality.quality_flags(df, "s", "d", "v", period_table=chunk is None, chunk=expr)
    got = rows(out, "ref_date", "flag", "severity")
    assert got == [
        (D(2023, 6, 1), "high_mom_variation", "high"),
        (D(2023, 7, 1), "high_mom_variation", "high"),
        (D(2023, 12, 1), "high_mom_variation", "high"),
        (D(2023, 12, 1), "negative_value", "high"),
    ]
    assert "change: 90.48%" in [r["details"] for r in out.collect()]


def test_severe_outlier_is_high(spark):
    df = spark.createDataFrame([("s", D(2000 + i, 1, 1), 1.0 if i < 30 else 99.0) for i in range(31)], "s string, d date, v double")
    flags = quality.quality_flags(df, "s", "d", "v", checks=[quality.OUTLIER]).collect()
    assert [(f["flag"], f["severity"]) for f in flags] == [("outlier_zscore", "high")]


def test_moves_from_zero_are_violations(spark):
    out = quality.mom_violations(monthly(spark, [0.0, 5.0, 5.2, None, 6.0]), ["s"], "d", "v").collect()
    assert sorted((r["d"].month, r["mom"]) for r in out if r["mom"] is None) == [(2, None)]
    assert sorted(r["d"].month for r in out) == [2, 5]


def test_flag_of_a_move_from_zero_says_so(spark):
    out = quality.quality_flags(monthly(spark, [0.0, 5.0, 5.2]), "s", "d", "v", checks=[quality.HIGH_MOM]).collect()
    assert [(r["ref_date"].month, r["severity"], r["details"]) for r in out] == [(2, "high", "change from zero")]


def test_negative_columns(spark):
    df = spark.createDataFrame([(1.0, -1.0), (-1.0, -2.0), (1.0, 1.0), (None, None)], "a double, b double")
    assert sorted(r["negative_columns"] for r in quality.negative_values(df, ["a", "b"]).collect()) == [["a", "b"], ["b"]]


def test_validate_series(spark):
    ok = quality.validate_series(monthly(spark, [100.0, 101.0, 102.0]), ["s"], "d", "v").collect()[0]
    assert ok["is_valid"] and ok["issues"] == ""
    bad = monthly(spark, [100.0, 101.0, -1.0, 120.0]).filter(F.month("d") != 2)
    row = quality.validate_series(bad, ["s"], "d", "v").collect()[0]
    assert (row["n_non_positive"], row["n_gaps"], row["n_abnormal"]) == (1, 1, 2)
    assert row["issues"] == "non-positive values: 1; irregular gaps: 1; abnormal changes: 2" and not row["is_valid"]


def test_clean_series_and_report(spark):
    rows = [("a", D(2024, 1, i + 1), float(v), f"k{i}", 1) for i, v in enumerate((10, 11, 12, 13, 5000))]
    rows += [("a", D(2024, 1, 1), 10.5, "k0", 2), ("a", D(2030, 1, 1), 1.0, "kf", 1), ("a", D(2024, 1, 9), None, "kn", 1)]
    df = spark.createDataFrame(rows, "s string, d date, v double, k string, o int")
    out = quality.clean_series(df, "s", "d", "v", ["k"], ["o"], "2024-06-01").collect()
    assert sorted((r["k"], r["v"]) for r in out) == [("k0", 10.5), ("k1", 11.0), ("k2", 12.0), ("k3", 13.0)]
    report = quality.clean_report(df, "s", "d", "v", ["k"], "2024-06-01").collect()[0].asDict()
    assert report == {"n_start": 8, "n_future": 1, "n_null": 1, "n_outlier": 1, "n_duplicate": 1, "n_final": 4}


def test_cleaning_counts_come_from_the_pass_that_cleans(spark, tmp_path):
    rows = [("a", D(2024, 1, 1 + i % 28), float(i % 50), f"k{i % 90}", i) for i in range(100)]
    rows += [("a", None, 1.0, "n", 1), ("a", D(2030, 1, 1), None, "f", 1), (None, D(2024, 1, 1), 7.0, "x", 1), ("b", D(2024, 1, 1), 1e9, "y", 1)]
    df = spark.createDataFrame(rows, "s string, d date, v double, k string, o int").repartition(4)
    counts = quality.CleaningCounts()
    quality.clean_series(df, "s", "d", "v", ["k"], ["o"], "2024-06-01", counts=counts).write.parquet(str(tmp_path / "clean"))
    row = counts.row()
    assert row["n_start"] == 104 == sum(n for k, n in row.items() if k != "n_start")
    assert row["n_future"] == 1 and row["n_null"] == 1 and row["n_duplicate"] == 10
    assert row["n_final"] == spark.read.parquet(str(tmp_path / "clean")).count()
    plain = quality.clean_series(df, "s", "d", "v", ["k"], ["o"], "2024-06-01")
    assert plain.exceptAll(spark.read.parquet(str(tmp_path / "clean"))).count() == 0


def test_contract_and_scaffold(spark):
    df = spark.createDataFrame([("M1", "SP", 1.0, 0.6, 0.4), ("M2", "SP", 1.2, 0.6, 0.1), ("M1", "RJ", 1.1, 0.5, 0.5), ("M2", "RJ", None, 0.5, 0.5)], "m string, u string, f double, a double, b double")
    rules = [quality.row_count(4), quality.not_null("f"), quality.in_range("f", 0.7, 1.1), quality.in_set("u", ["SP"]), quality.sums_to_one(["a", "b"])]
    got = {r["rule"]: (r["metric"], r["passed"], r["sample"]) for r in quality.contract(df, rules, "m").collect()}
    assert got["row count"] == (4.0, True, None)
    assert got["f not null"] == (1.0, False, "M2")
    assert got["f in range"] == (2.0, False, "M2")  # the missing value fails too
    assert got["u allowed"] == (2.0, False, "M1") and got["shares sum to one"] == (1.0, False, "M2")
    checks = {r["rule"]: r["passed"] for r in quality.scaffold_check(df, "m", "u", "SP", "f").collect()}
    assert checks["all pairs present"] and checks["pairs unique"] and not checks["baseline factor is one"]


def test_gate_and_log(spark):
    t = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    gate = quality.table_gate({"a": t.distinct(), "b": t, "c": t.limit(0), "d": t.distinct()}, {"a": 2, "d": 3})
    assert {r["table_name"]: r["status"] for r in gate.collect()} == {"a": "PASSED", "b": "WARNING", "c": "FAILED", "d": "WARNING"}
    assert quality.verdict(gate).collect()[0]["verdict"] == "NO-GO"
    for ok, want in ((5, "success"), (4, "partial"), (3, "error")):
        res = spark.createDataFrame([("success" if i < ok else "error", 2) for i in range(5)], "status string, n_rows int")
        assert quality.ingestion_log(res, "x").collect()[0]["run_status"] == want


def test_gate_cardinalities_and_missing_tables(spark):
    t = spark.createDataFrame([("SC", 1), ("SC", 2), ("SP", 3), (None, 4)], "uf string, n int")
    rules = {
        "exact": [quality.Cardinality(4, 4)], "few": [quality.Cardinality(3, where="uf = 'SC'")], "many": [quality.Cardinality(high=1, where="uf = 'SC'")],
        "noted": [quality.Cardinality(27, 27, severity="NOTE"), quality.Cardinality(1, where="uf = 'SP'")], "empty": [quality.Cardinality(1)],
    }
    gate = quality.table_gate({**{k: t for k in rules if k != "empty"}, "empty": t.limit(0), "gone": None}, {}, required=rules)
    got = {r["table_name"]: (r["n_rows"], r["n_broken"], r["status"]) for r in gate.collect()}
    assert got == {
        "exact": (4, 0, "PASSED"), "few": (4, 1, "WARNING"), "many": (4, 1, "WARNING"), "noted": (4, 1, "PASSED"),
        "empty": (0, 1, "FAILED"), "gone": (None, 0, "FAILED"),
    }
    assert quality.verdict(gate).first()["verdict"] == "NO-GO"


def test_redundancy_and_post_write(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    assert quality.redundancy(a.unionByName(b), [a, b]).collect()[0]["redundant_by_content"]
    row = quality.redundancy(a.unionByName(b), [a.distinct(), b]).collect()[0]
    assert row["redundant_by_count"] and not row["redundant_by_content"] and row["only_in_whole"] == 1
    assert quality.post_write_check(a, a, ["k"]).collect()[0]["ok"]
    assert not quality.post_write_check(a, b, ["k"]).collect()[0]["ok"]
    gap = spark.createDataFrame([(None,), (3,)], "k int")
    assert quality.post_write_check(gap, gap, ["k"]).collect()[0]["ok"]


def panel(spark):
    """Four regions, fourteen months; one region leaves the panel early."""
    rows = []
    for i in range(14):
        d = D(2024 + i // 12, i % 12 + 1, 1)
        rows += [("SP", d, 1000.0), ("SC", d, 1030.0 + i % 2), ("RJ", d, 900.0)]
    rows.append(("OLD", D(2020, 1, 1), 1.0))
    return spark.createDataFrame(rows, "uf string, d date, v double")


def test_factor_chain(spark):
    factors = costs.empirical_factors(panel(spark), "uf", "d", "v", "SP")
    got = {r["uf"]: r for r in factors.collect()}
    assert set(got) == {"SP", "SC", "RJ"} and got["SP"]["n"] == 13 and got["SP"]["factor"] == 1.0
    assert got["RJ"]["factor"] == 0.9 and got["RJ"]["deviation_pct"] == -10.0
    theory = spark.createDataFrame([("SP", 1.0), ("SC", 1.0), ("RJ", 1.0), ("XX", 1.0)], "uf string, expected double")
    cmp = costs.compare_factors(theory, factors.select("uf", "factor"), "uf", "expected", "factor")
    assert {r["uf"]: (r["advice"], r["significant"]) for r in cmp.collect()} == {
        "SP": ("KEEP", False), "SC": ("LIGHT_ADJUSTMENT", False), "RJ": ("REVIEW", True), "XX": ("INSUFFICIENT_DATA", False),
    }
    dim = spark.createDataFrame([(u, 1.0, 2.0) for u in ("SP", "SC", "RJ", "XX", "ZZ")], "uf string, cur double, base double")
    out = {r["uf"]: (r["final_factor"], r["factor_origin"], r["regional_cost_factor"]) for r in costs.apply_factors(dim, cmp, "uf", "cur", "base").collect()}
    assert out["RJ"] == (0.9, "EMPIRICAL", 1.8) and out["SP"] == (1.0, "THEORY_KEPT", 2.0)
    assert out["XX"][1] == "THEORY_KEPT" and out["ZZ"][1] == "UNMATCHED"


def test_jitter_is_small_and_stable(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    first = [r[0] for r in df.select(costs.stable_jitter(F.col("k"))).collect()]
    assert first == [r[0] for r in df.select(costs.stable_jitter(F.col("k"))).collect()]
    assert max(map(abs, first)) <= 0.02 and len(set(first)) > 150


def test_weighted_composite(spark):
    fact = spark.createDataFrame([("R1", 2500.0), ("R8", 2800.0), ("OFF", 1.0)], "t string, v double")
    weights = spark.createDataFrame([("R1", "Res", 0.5, True), ("R8", "Res", 0.25, True), ("GONE", "Res", 0.25, True), ("OFF", "Res", 1.0, False)], "t string, category string, weight double, is_active boolean")
    assert [tuple(r) for r in costs.weighted_composite(fact, weights, "t", [], "v").collect()] == [("Res", 1950.0)]


def test_taxes(spark):
    projects = spark.createDataFrame([("A", 100000.0, 500000.0, 100.0), ("?", 1.0, 1.0, 1.0)], "city string, land double, building double, area double")
    rates = spark.createDataFrame([("A", 2.0, 3.0)], "city string, transfer_rate double, service_rate double")
    out = {r["city"]: r for r in costs.construction_taxes(projects, rates, "city", "land", "building", "area").collect()}
    assert out["A"]["transfer_tax"] == 2000.0 and out["A"]["service_tax"] == 9000.0 and out["A"]["total_fees"] == 1150.0
    assert out["A"]["total"] == 12150.0 and out["A"]["pct_of_investment"] == pytest.approx(2.025) and out["A"]["error"] is None
    assert out["?"]["total"] is None and out["?"]["error"] == "no rates for ?"


PROGRAM_COLUMNS = "priority int, program string, yearly_rate double, months int, financed_pct double, income_limit double, price_limit double"


def first_program(table, price, income):
    """Terms of the first programme that admits an application, by looking at all of them; missing priorities never."""

    def fits(limit, x):
        return limit is None or (x is not None and x <= limit)

    def rank(row):
        return [(v is not None, v) for v in row[:5]]

    open_ = [p for p in table if p[0] is not None and fits(p[5], income) and fits(p[6], price)]
    return min(open_, key=rank)[1:5] if open_ else (None,) * 4


def check_loans(spark, table, apps):
    df = spark.createDataFrame([(k, p, e) for k, (p, e) in enumerate(apps)], "i int, price double, income double")
    out = costs.loan_assignment(df, spark.createDataFrame(table, PROGRAM_COLUMNS), "i", "price", "income", None)
    got = {r["i"]: (r["program"], r["yearly_rate"], r["months"], r["financed_pct"]) for r in out.collect()}
    assert got == {k: first_program(table, *a) for k, a in enumerate(apps)}


def test_loans(spark, rows):
    apps = [(1, 170000.0, 2640.0), (2, 170000.01, 2640.0), (3, 350000.0, 8000.0), (4, 200000.0, 9000.0), (5, 2e6, 1e5), (6, 264000.0, 4400.0)]
    df = spark.createDataFrame(apps, "i int, price double, income double")
    programs = costs.program_params(spark)
    out = costs.loan_assignment(df, programs, "i", "price", "income")
    assert rows(out, "i", "program") == [
        (1, "MCMV_FAIXA_1"), (2, "MCMV_FAIXA_2"), (3, "MCMV_FAIXA_3"), (4, "PRO_COTISTA_FGTS"), (5, "SBPE_TAXA_REFERENCIAL"), (6, "MCMV_FAIXA_2"),
    ]
    odd = spark.createDataFrame([(1, 1e5, None), (1, 5e6, 2e3), (1, 1e5, 2e3), (None, None, 3e3), (1, 1e5, 2e3)], "i int, price double, income double")
    got = rows(costs.loan_assignment(odd, programs, "i", "price", "income"), "i", "price", "program")
    assert got == [
        (None, None, "SBPE_TAXA_REFERENCIAL"), (1, 1e5, "MCMV_FAIXA_1"), (1, 1e5, "MCMV_FAIXA_1"), (1, 1e5, "PRO_COTISTA_FGTS"), (1, 5e6, "SBPE_TAXA_REFERENCIAL"),
    ]
    first = {r["i"]: r for r in out.collect()}[1]
    assert first["first_instalment"] == round(170000 / 420 + 170000 * 0.04 / 12, 2) and not first["approved"]
    none = costs.loan_assignment(df, programs.where("false"), "i", "price", "income")
    assert none.count() == 6 and none.where("program IS NOT NULL").count() == 0
    assert costs.loan_assignment(df.where("false"), programs, "i", "price", "income").count() == 0


def test_loans_with_ties_and_missing_values(spark):
    tied = [
        (1, "z", 5.0, 360, 80.0, 3e3, None), (1, "b", 6.0, 360, 80.0, 3e3, None), (1, "b", 4.0, 360, 80.0, None, 2e5), (2, None, 4.0, 360, 70.0, None, None),
        (2, "c", 4.0, 360, 70.0, None, None), (None, "a", 1.0, 1, 1.0, None, None), (0, "open_1", 3.0, 360, 80.0, None, 1e4), (0, "low", 3.0, 360, 80.0, 440.0, 2e5),
    ]
    apps = [(p, e) for p in (1e4, 1e5, 2e5, 2e5 + 1, 5e6, None) for e in (440.0, 441.0, 3e3, 4e3, None)]
    for table in (tied, tied[::-1], tied[:3], tied[5:6]):
        check_loans(spark, table, apps)


@pytest.mark.parametrize("n, values", [(10_000, 10**6), (3_000, 25)])
def test_loans_among_many_programs(spark, n, values):
    """Thousands of programmes, few or many distinct limits, none of them open."""
    rng = random.Random(n)
    limit = lambda: None if rng.random() < 0.005 else float(rng.randrange(values))
    table = [(rng.randrange(n), f"p{k % 500}", float(k % 7), 360, 80.0, limit(), limit()) for k in range(n)]
    table = [p for p in table if p[5] is not None or p[6] is not None]
    pick = lambda: None if rng.random() < 0.05 else float(rng.randrange(-1, values + 2))
    check_loans(spark, table, [(pick(), pick()) for _ in range(300)])


def test_program_filters(spark):
    assert costs.program_params(spark, kind="FGTS").count() == 1
    assert costs.program_params(spark, prefix="MCMV").count() == 3
    assert costs.program_params(spark).count() == 9


def test_rates_in_text(spark):
    texts = ["Lei: ITBI de 2,5 % sobre", "imposto de TRANSMISSÃO 3%", "1,5% na transmissão", "construção civil: 4 %", "nada", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(
        costs.extract_rate(F.col("t"), costs.TRANSFER_TAX_PATTERNS), costs.extract_rate(F.col("t"), costs.SERVICE_TAX_PATTERNS)
    )
    assert [tuple(r) for r in got.collect()] == [(2.5, None), (3.0, None), (1.5, None), (None, 4.0), (None, None), (None, None)]


def test_sector_facts(spark, rows):
    raw = spark.createDataFrame([("202401", 4205407, "F", 5, 2, 3, 100.0), ("202401", 4200000, "f", 1, 1, 0, 300.0), ("202401", 3500000, "G", 9, 9, 0, 1.0)], "competencia string, municipio int, secao_cnae string, admitidos int, desligados int, saldo int, salario double")
    states = spark.createDataFrame([("42", "SC"), ("35", "SP")], "state_code string, state string")
    assert rows(costs.employment_fact(raw, states)) == [("SC", D(2024, 1, 1), 6, 3, 3, 200.0)]
    prices = spark.createDataFrame([("1", "Cimento", "KG", "0,72", "Material"), ("2", "x", "H", "9", "MO")], "codigo string, descricao string, unidade string, preco string, tipo string")
    assert rows(costs.materials_fact(prices, "SP"), "material", "unit_price") == [("Cimento", 0.72)]
    weather = spark.createDataFrame([("A1", "2024-01-01", "1.5", "20"), ("A1", "2024-01-02", "x", "30"), ("A1", "2024-01-02", "0", "")], "CD_ESTACAO string, DT_MEDICAO string, CHUVA string, TEM_INS string")
    assert rows(costs.climate_fact(weather)) == [("A1", D(2024, 1, 1), 1.5, 1, 25.0)]


def test_reference_prices(spark):
    own, default = costs.price_tables(spark)
    places = spark.createDataFrame([("SP",), ("AC",)], "state string")
    out = {(r["state"], r["material"]): (r["price"], r["is_default"]) for r in costs.reference_prices(places, "state", own, default).collect()}
    assert len(out) == 12 and out["SP", "Tijolo cerâmico"] == (0.85, False) and out["AC", "Cimento CP II 50kg"] == (0.73, True)


def test_project_and_derived(spark, rows):
    projects = spark.createDataFrame([("m", "SP", 100.0, 10.0), ("?", "RJ", 100.0, 10.0)], "m string, u string, base double, area double")
    methods = spark.createDataFrame([("m", 1.5)], "m string, mf double")
    places = spark.createDataFrame([("SP", 1.0), ("RJ", 0.9)], "u string, uf double")
    out = costs.project_cost(projects, {"m": (methods, "mf"), "u": (places, "uf")}, "base", "area")
    assert rows(out, "m", "total_cost") == [("?", 900.0), ("m", 1500.0)]
    base, extra = spark.createDataFrame([("flat", 100.0), ("slope", 100.0)], "t string, b double"), spark.createDataFrame([("slope", 10.0), ("slope", 15.0)], "t string, e double")
    assert rows(costs.derived_factor(base, extra, "t", "b", "e"), "t", "factor") == [("flat", 1.0), ("slope", 1.25)]


def test_cost_panel(spark):
    wide = spark.createDataFrame([(D(2024, 1, 1), "100", "50,5"), (D(2024, 2, 1), "110", "n/d")], "d date, a string, b string")
    out = {(r["cost_type"], r["d"].month): r for r in costs.cost_panel(wide, "d", [], "oneroso", share_of=["d"]).collect()}
    assert len(out) == 3 and out["a", 2]["mom"] == pytest.approx(10) and out["a", 2]["share_pct"] == 100.0


def test_calendar_and_lookup(spark):
    cal = dims.calendar(spark, F.lit("2015-01-15").cast("date"), F.lit("2025-11-01").cast("date"))
    rows = cal.orderBy("ref_date").collect()
    assert len(rows) == 131 and rows[0]["ref_date"] == D(2015, 1, 1)
    assert tuple(rows[6])[1:] == (2015, 7, "julho", 3, 2, "2015-07")
    df = spark.createDataFrame([(" sc ", "Sul"), ("SP", "Sudeste")], "uf string, r string")
    assert dims.lookup(df, "uf", "SC").count() == 1


def test_dimension_builders(spark, rows):
    wide = spark.createDataFrame([("A", 2.0, None), ("B", 1.0, 5.0)], "city string, itbi double, iss double")
    assert rows(dims.municipal_fee_facts(wide, ["city"], ["itbi", "iss"])) == [("A", "itbi", 2.0), ("B", "iss", 5.0), ("B", "itbi", 1.0)]
    urls = spark.createDataFrame([("b", "u1"), ("a", "u1"), ("c", None)], "label string, url string")
    assert rows(dims.unique_sources(urls, "label", "url")) == [("u1", "a")]
    src = spark.createDataFrame([("x", D(2024, 1, 1), "quarterly")], "s string, d date, f string")
    assert dims.source_catalog(src, "s", "d", "f").collect()[0]["next_run"] == D(2024, 3, 31)
