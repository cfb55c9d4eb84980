import datetime as dt

import pytest
from pyspark.sql import functions as F

from costseries import functions as fn

D = dt.date


def apply(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("c"))).collect()]


@pytest.mark.parametrize(
    "mode, values, want",
    [
        ("auto", ["1.234,56", "1234,56", "1234.56", " 7 ", "-1,5", "1.234.567,8"], [1234.56, 1234.56, 1234.56, 7.0, -1.5, 1234567.8]),
        ("strip_dots", ["1.234,56", "1234.56", "1.000"], [1234.56, 123456.0, 1000.0]),
        ("comma_only", ["13,75", "101.25", "1.234,5"], [13.75, 101.25, None]),
        ("auto", ["", "...", "-", "nan", "None", "N/D", "n/d", "(...)", "abc", "1d", "Infinity", None], [None] * 12),
    ],
)
def test_br_number(spark, mode, values, want):
    assert apply(spark, values, lambda c: fn.br_number(c, mode)) == want


def test_unknown_mode_is_an_error():
    with pytest.raises(ValueError):
        fn.br_number(None, "other")


def test_currency(spark):
    assert apply(spark, ["R$ 1.234,56", "12,5 %", "R$", None], fn.currency_number) == [1234.56, 12.5, None, None]


def test_sentinel(spark):
    assert apply(spark, [-100.0, 1.0, None], fn.sentinel_to_null, "double") == [None, 1.0, None]


def test_null_tokens(spark):
    assert apply(spark, [" N/D ", "x ", "...", None], fn.null_tokens) == [None, "x", None, None]


def test_parse_date_multi(spark):
    texts = ["2024-02-29", "29/02/2024", "2024-02", "2024/2/9", "2024-13-01", "30/02/2024", "soon", "", None]
    assert apply(spark, texts, fn.parse_date_multi) == [
        D(2024, 2, 29), D(2024, 2, 29), D(2024, 2, 1), D(2024, 2, 9), None, None, None, None, None,
    ]


def test_parse_pt_month(spark):
    texts = ["jan/24", "Janeiro/2024", "março-99", "dez/49", "dez/50", "01/2024", "1-2024", "2024-01", "2024/1", "xyz/24", "13/2024", None]
    want = [D(2024, 1, 1), D(2024, 1, 1), D(1999, 3, 1), D(2049, 12, 1), D(1950, 12, 1)] + [D(2024, 1, 1)] * 4 + [None] * 3
    assert apply(spark, texts, fn.parse_pt_month) == want


def test_months_and_quarters(spark):
    assert apply(spark, [" jan", "DEZ ", "foo", None], fn.month_name_to_num) == [1, 12, None, None]
    labels = ["1T", "Q3", "4º TRI", "tri 2", "5", "JAN", None]
    assert apply(spark, labels, fn.quarter_to_month) == [2, 8, 11, 5, None, None, None]


def test_excel_serials(spark):
    assert apply(spark, ["45413", "45413.9", "2024-05-01", "999", "x"], fn.excel_serial_date) == [
        D(2024, 5, 1), D(2024, 5, 1), D(2024, 5, 1), None, None,
    ]
    got = apply(spark, ["45972.74425", "2025-11-11 17:51:43", "x"], fn.excel_serial_timestamp)
    assert got == [dt.datetime(2025, 11, 11, 17, 51, 43)] * 2 + [None]


def test_text_helpers(spark):
    assert apply(spark, ["São João", None], fn.strip_accents) == ["Sao Joao", None]
    assert apply(spark, ["a", "z", None], lambda c: fn.recode(c, {"a": "b"})) == ["b", "z", None]
    assert apply(spark, ["TRUE", " false", "yes", None], fn.truth) == [True, False, None, None]


def test_keys(spark):
    assert apply(spark, ["x", None], lambda c: fn.business_key("K", c, "2024")) == ["K_x_2024", None]
    prints = apply(spark, ["", None, "a"], lambda c: fn.row_checksum(c, F.lit(1)))
    assert len(set(prints)) == 3 and all(len(p) == 64 for p in prints)


def test_numerals_that_only_a_cast_would_read_are_missing(spark):
    texts = ["NaN", "1d", "0x1p3", "Infinity", "1e", ".", "+-1", " 12 ", "1e3", "-.5", "1.234,5", "1.2.3", None]
    want = [None] * 7 + [12.0, 1000.0, -0.5, 1234.5, None, None]
    assert apply(spark, texts, fn.br_number) == want
    assert apply(spark, ["R$\t1.234,56", "12,5 %", "R$", None], fn.currency_number) == [1234.56, 12.5, None, None]


def test_month_labels_with_more_text_or_too_few_digits(spark):
    texts = ["jan/2024x", "dez-245", "jan/2", "jano/24", "2024-1", "123/2024", "1/202", "13/2024", "MARÇO/49", "março/50", "", None]
    day = D
    want = [day(2024, 1, 1), day(2024, 12, 1), None, None, day(2024, 1, 1), None, None, None, day(2049, 3, 1), day(1950, 3, 1), None, None]
    assert apply(spark, texts, fn.parse_pt_month) == want


def test_row_checksum_keeps_cells_apart(spark):
    """Separators, lengths and missing cells inside the text of a cell can't imitate another row."""
    cells = ["", "a", "b", "a\u001fb", ",", "1:a", "-", "1:a,1:b", "␀", None]
    pairs = [(x, y) for x in cells for y in cells]
    df = spark.createDataFrame(pairs, "x string, y string")
    assert df.select(fn.row_checksum(F.col("x"), F.col("y"))).distinct().count() == len(pairs)


def test_row_hashes_follow_equality(spark):
    """As many different hashes as different rows, for missing cells, shifted cells, both zeros, arrays, structs and maps."""
    df = spark.sql(
        """SELECT * FROM VALUES (NULL, 'a', 0.0D, array(1.0F, NULL), array('x'), named_struct('p', NULL, 'q', 1), map('k', 1, 'l', 2)),
        ('a', NULL, -0.0D, array(NULL, 1.0F), array('x', NULL), named_struct('p', 1, 'q', NULL), map('l', 2, 'k', 1)),
        ('ab', 'c', 1D, array(), array(), NULL, NULL), ('a', 'bc', 1D, array(), array(), NULL, NULL),
        ('ab', 'c', 1D, NULL, array(), NULL, NULL), ('ab', 'c', 1D, array(), NULL, NULL, map()),
        ('ab', 'c', double('nan'), array(), array(), NULL, NULL), (NULL, 'a', -0.0D, array(1.0F, NULL), array('x'), named_struct('p', NULL, 'q', 1), map('l', 2, 'k', 1))
        AS t(a, b, c, d, e, f, g)"""
    )
    hashes = df.select(*fn.row_hashes(df.schema))
    assert hashes.distinct().count() == 7 and hashes.select("_h1").distinct().count() == 7
    zeros = spark.sql("SELECT * FROM VALUES (array(0.0D)), (array(-0.0D)) AS t(v)")
    assert zeros.select(*fn.row_hashes(zeros.schema)).distinct().count() == 1
