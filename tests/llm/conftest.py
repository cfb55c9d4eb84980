import os

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, h int, n_words long"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("sample tables are not here")
    return DATA


@pytest.fixture
def table(spark, data):
    return lambda name: spark.read.parquet(f"{data}/{name}.parquet")


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(*pairs):
        rows = [(i, t, "en", None, None if t is None else len(t), "x", 1, 2, 3) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def odd(docs):
    """Nulls in any column, empty and blank texts, repeated rows and ids, one long text."""
    long = " ".join(f"word{k % 977} and {k}" for k in range(6000))
    return docs(
        (None, None), (None, "some text without an id here"), (1, None), (2, ""), (3, " \t\n "), (4, "a"), (4, "a"), (4, "another text"),
        (5, long), (6, long), (7, long + " end"), (8, "Ünïcödé — 日本語 text 👩‍👧"), (9, "same line\nsame line\n\nsame line"),
    )


@pytest.fixture
def no_docs(docs):
    return docs((1, "x")).where("false")
