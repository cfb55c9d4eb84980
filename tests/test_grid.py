import datetime as dt

import pytest
from pyspark.sql import functions as F

from costseries.functions.dates import MONTHS
from costseries.operators import grid

D = dt.date
SCHEMA = "source string, sheet string, row_idx bigint, cells array<string>"


def sheet(spark, lines, name="s", start=0):
    return spark.createDataFrame([("src", name, i + start, c) for i, c in enumerate(lines)], SCHEMA)


@pytest.fixture(params=[500_000, 3])
def block(request, monkeypatch):
    """Everything must hold with sheets cut into blocks of a few rows, too."""
    monkeypatch.setattr(grid, "BLOCK_ROWS", request.param)


def test_noise(spark):
    lines = [["Fonte: x", "1"], ["", " "], ["Unnamed: 3"], ["(*) nota"], ["NBR 12.721"], ["Nantes", "1"], ["2020", "1", *[""] * 9], []]
    kept = grid.drop_noise_rows(sheet(spark, lines)).orderBy("row_idx").collect()
    assert [r["cells"][0] for r in kept] == ["Nantes", "2020"]
    assert grid.drop_noise_rows(sheet(spark, lines), 0.8).count() == 1


def test_monthly_index(spark, rows, block):
    lines = [["título"], ["ANO", "MÊS"], ["1991", "JAN", "1.000,5", "1,5", "", "..."], ["", " fev", "-", "", "", "12"], ["", "MAR", "-", "..", "", ""],
             ["", "JAN", "9", "", "", ""], ["Nota: fim", "JAN", "5"], ["1992", "", ""], ["", "DEZ", "7"]]
    out = rows(grid.tidy_monthly_index(sheet(spark, lines)), "ref_date", "value", "var_month", "var_12m")
    assert out == [(D(1991, 1, 1), 1000.5, 1.5, None), (D(1991, 2, 1), None, None, 12.0), (D(1992, 12, 1), 7.0, None, None)]


def test_annual(spark, rows):
    lines = [["ANO", "x"], ["2000", "1,5", "..."], ["2001.0", "-", "-"], ["1900", "1"], ["2000", "9", "9"], ["2002", "", "3"]]
    out = grid.tidy_annual(sheet(spark, lines), {"a": 1, "b": 2})
    assert rows(out, "year", "a", "b") == [(2000, 1.5, None), (2002, None, 3.0)]


def test_region_matrix(spark, rows, block):
    lines = [["2019", "5"], ["CUB MÉDIO REGIÃO CENTRO-OESTE"], ["2020", "10", "0", "-"], ["2020", "99"], ["Fonte: y"], ["x"], ["Região Sul"], ["2020", "", "1.234,5"], ["1989", "1"], ["CUB MÉDIO BRASIL"], ["2021", "7"]]
    out = rows(grid.tidy_region_matrix(sheet(spark, lines)), "region", "ref_date", "value")
    assert out == [("BRASIL", D(2019, 1, 1), 5.0), ("BRASIL", D(2021, 1, 1), 7.0), ("CENTRO-OESTE", D(2020, 1, 1), 10.0), ("SUL", D(2020, 2, 1), 1234.5)]


def test_state_standard(spark, rows, block):
    full = [str(i) for i in range(1, 13)]
    lines = [["2019", *full], ["Mato Grosso do Sul (Padrão - R1-B)"], ["2020", *full], ["MATO GROSSO"], ["2020", *full], ["PARÁ (PADRÃO - CAL-8 )"], ["2020", *full], ["2021", "5", *[""] * 11]]
    out = grid.tidy_state_standard(sheet(spark, lines))
    got = {(r["state"], r["standard"]) for r in out.collect()}
    # a heading without a standard keeps the one above it
    assert got == {("MS", "R1-B"), ("MT", "R1-B"), ("PA", "CAL-8")} and out.count() == 36


@pytest.mark.parametrize("name, code", [("PARAÍBA", "PB"), ("Paraná", "PR"), ("Pará", "PA"), ("RIO GRANDE DO NORTE", "RN"), ("são paulo", "SP"), ("x", None)])
def test_state_code(spark, name, code):
    assert spark.createDataFrame([(name,)], "t string").select(grid.state_code(F.col("t"))).collect()[0][0] == code


def test_mixed_period(spark, rows, block):
    lines = [["2012", "JAN", "7,5"], ["", "2T", "8"], ["", "Q3", "-"], ["2013", "4º TRI", "6"], ["", "XX", "1"]]
    out = rows(grid.tidy_mixed_period(sheet(spark, lines)), "ref_date", "value")
    assert out == [(D(2012, 1, 1), 7.5), (D(2012, 5, 1), 8.0), (D(2013, 11, 1), 6.0)]


def test_place_month(spark, rows):
    lines = [["Consumo"], ["LOCALIDADE", "Jan", "fev", "TOTAL"], ["SANTA CATARINA", "1.000", "0", "9"], ["Total", "1", "1", "2"], ["Fonte: z", "1", "", ""], ["ACRE", "...", "2,5", ""]]
    out = rows(grid.tidy_place_month(sheet(spark, lines), 2024, "consumo"), "place", "ref_date", "value")
    assert out == [("Acre", D(2024, 2, 1), 2.5), ("Santa Catarina", D(2024, 1, 1), 1000.0)]


def test_state_sheets(spark, rows, block):
    lines = [["título"]] * 7 + [["2007", "FEV", "900.5", "1"], ["", "MAR", "901", ""], ["", "SOMA", "5", ""], ["2008", "jan", "n/d", "2"]]
    out = rows(grid.tidy_state_sheets(sheet(spark, lines, "SC")), "state", "ref_date", "measure", "value")
    assert out == [("SC", D(2007, 2, 1), "val_0", 900.5), ("SC", D(2007, 2, 1), "val_1", 1.0), ("SC", D(2007, 3, 1), "val_0", 901.0), ("SC", D(2008, 1, 1), "val_1", 2.0)]


def test_header3(spark, rows):
    lines = [["a"], ["b"], ["c"], ["Mês", "R8-N ", "R1-B"], ["jan/24", "1,5", "x"], ["fev/24", "", "2"]]
    out = rows(grid.tidy_header3(sheet(spark, lines), "kind"), "label", "kind", "value")
    assert out == [("fev/24", "R1-B", 2.0), ("jan/24", "R8-N", 1.5)]


def test_unpivot_then_pivot_is_identity(spark):
    lines = [["2020", *[str(i) for i in range(1, 13)]], ["2021", *[str(i * 3) for i in range(1, 13)]]]
    df = sheet(spark, lines).withColumn("year", grid.year_of(grid.cell(0), 1990, 2030))
    long = grid.unpivot_months(df, ["sheet"], "year")
    back = long.groupBy("year").pivot("ref_date").agg(F.first("value"))
    assert long.count() == 24 and len(back.columns) == 25 and len(MONTHS) == 12
    assert long.agg(F.sum("value")).collect()[0][0] == 78.0 + 234.0


def test_by_kind(spark, rows):
    df = spark.createDataFrame([(1, "título", "Valor R$", ""), (2, "Projeto", "x", "y"), (3, "R8-N", "5", None), (4, None, "6", "7")], "i int, tabela string, `Unnamed: 1` string, `Unnamed: 2` string")
    out = grid.tidy_tables_by_kind(df, "cost", "i", "src", "2024-01-31")
    assert out.columns[:4] == ["i", "label", "valor_r", "value_2"]
    assert rows(out, "i", "label", "valor_r") == [(3, "R8-N", "5"), (4, None, "6")]


def test_grid_from_text(spark):
    df = spark.createDataFrame([("s", "t", 0, "a\tb\t")], "source string, sheet string, row_idx bigint, line string")
    assert grid.grid_from_text(df).collect()[0]["cells"] == ["a", "b", ""]


def test_note_words_inside_a_cell(spark):
    lines = [["* Fonte: x", "1"], ["ver nota: y", "2"], ["Fonte: z", "3"], ["2020", "4"]]
    assert grid.drop_noise_rows(sheet(spark, lines)).count() == 3
    assert grid.drop_noise_rows(sheet(spark, lines), anywhere=True).count() == 1


def reasons(tidied, n_rows):
    """Reason by row; rows with facts and rejected rows are all rows read, each once."""
    told = {r["row_idx"]: r["reason"] for r in tidied.rejected.collect()}
    assert tidied.rejected.count() == len(told) and "row_idx" not in tidied.facts.columns
    assert tidied.rejected.columns == ["source", "sheet", "row_idx", "cells", "reason"]
    return told


def test_years_ahead_are_kept_and_absurd_ones_rejected(spark, rows, block):
    """2031 stays; 2199 neither vanishes nor takes the year above it, and ends that year's block."""
    lines = [["ANO", "MÊS"], ["2030", "JAN", "1"], ["2031", "JAN", "2"], ["", "FEV", "3"], ["2199", "JAN", "4"], ["", "FEV", "5"], ["2031", "JAN", "6"],
             ["2031", "XXX", "7"], ["", "MAR", "..."], ["Fonte: x"], ["", "ABR", "8"], []]
    out = grid.place_monthly_index(sheet(spark, lines), as_of="2024-01-31")
    assert rows(out.facts, "ref_date", "value") == [(D(2030, 1, 1), 1.0), (D(2031, 1, 1), 2.0), (D(2031, 2, 1), 3.0), (D(2031, 4, 1), 8.0)]
    told = reasons(out, len(lines))
    assert told == {0: "no year", 4: "year out of range", 5: "year out of range", 6: "repeated", 7: "no month", 8: "no value", 9: "blank or note", 11: "blank or note"}
    early = grid.place_monthly_index(sheet(spark, lines), as_of="2020-12-31")
    assert early.facts.count() == 1  # 2031 is more than ten years ahead then
    assert grid.tidy_monthly_index(sheet(spark, lines), high=2030).count() == 1
    assert grid.tidy_monthly_index(sheet(spark, lines)).count() == 4


def test_every_row_is_kept_or_rejected(spark, block):
    full = [str(i) for i in range(1, 13)]
    blocks = {
        "annual": (lambda g: grid.place_annual(g, {"a": 1}), [["x"], ["2031", "1"], ["2031", "2"], ["2199", "3"], ["2000", "-"], [" "]],
                   {0: "no year", 2: "repeated", 3: "year out of range", 4: "no value", 5: "blank or note"}),
        "region": (grid.place_region_matrix, [["2031", *full], ["REGIÃO SUL"], ["2031", "1"], ["2199", "1"], ["2020", "0", "-"], ["2031", "9"], ["texto", "1"], ["Nota: x"]],
                   {1: "heading", 3: "year out of range", 4: "no value", 5: "repeated", 6: "no year", 7: "blank or note"}),
        "state": (grid.place_state_standard, [["2020", *full], ["PARÁ (PADRÃO - R1-B)"], ["2031", *full], ["2199", *full], ["2021", *["0"] * 12], ["2022", "5", *[""] * 11]],
                  {0: "no state", 1: "heading", 3: "year out of range", 4: "no value", 5: "blank or note"}),
        "mixed": (grid.place_mixed_period, [["2031", "JAN", "1"], ["", "2T", "2"], ["2199", "1T", "3"], ["", "FEV", "4"], ["2031", "??", "1"], ["", "3T", "x"], ["2031", "JAN", "9"]],
                  {2: "year out of range", 3: "year out of range", 4: "no month or quarter", 5: "no value", 6: "repeated"}),
    }
    for name, (place, lines, expected) in blocks.items():
        out = place(sheet(spark, lines, name), as_of="2024-01-31") if name != "annual" else place(sheet(spark, lines, name))
        assert reasons(out, len(lines)) == expected, name
        assert out.facts.count() > 0
