import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import oracle
import pyarrow as pa

from costseries.llm import fim


def slow(doc, text):
    """Row of one document by the definition, character by character."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def key(row):
    return tuple((v is not None, v) for v in row)


TRICKY = ["<P", "a<", "<<S", "x<M", "<P>", "some <S> tag", "<M>", "P>S>M>", "\0\n\r\t", "ÿÿ ß", "日本 語", "👩‍👧 é", "word", "<" * 9, "a <S b <P c <M d"]


def test_equals_definition_on_odd_rows(spark, odd, docs):
    tricky = docs(*[(100 * k + j, text) for k, text in enumerate(TRICKY) for j in range(30)])
    for frame in (odd, tricky):
        expected = sorted((slow(r.doc_id, r.text) for r in frame.collect()), key=key)
        rows = fim.restore(fim.transform(frame))
        got = sorted((tuple(r[:6]) for r in rows.collect()), key=key)
        assert got == expected
        texts = sorted((r.doc_id is not None, r.doc_id, r.text or "") for r in frame.collect())
        assert sorted((r.doc_id is not None, r.doc_id, r.restored) for r in rows.collect()) == texts


def test_forms_all_occur_and_rates_are_parameters(docs):
    frame = docs(*[(k, "one two three") for k in range(300)])
    forms = [r.form for r in fim.transform(frame).collect()]
    assert {"plain", "psm", "spm"} == set(forms) and 10 < forms.count("plain") < 60
    assert {r.form for r in fim.transform(frame, plain=0, spm=100).collect()} == {"spm"}
    assert {r.form for r in fim.transform(frame, plain=100).collect()} == {"plain"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aZ<>PSM \n\0é日👩", max_size=30), max_size=8), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_pieces_and_restoring(texts, first, second):
    import numpy as np

    raw = pa.array([t.encode() for t in texts], pa.binary())
    n, parts = fim.pieces(raw, np.full(len(texts), first), np.full(len(texts), second))
    for k, text in enumerate(texts):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        a, b = sorted((first % (len(units) + 1), second % (len(units) + 1)))
        assert n[k] == len(units)
        assert [p[k].as_py().decode() for p in parts] == ["".join(units[:a]), "".join(units[a:b]), "".join(units[b:])]
    h = [np.full(len(texts), x, np.int64) for x in (first, second, 0, second)]
    for spm in (0, 100):
        rows = fim._rows(raw, h, 0, spm)
        assert fim.restored(rows[4], rows[1]).to_pylist() == texts


def test_batches_are_cut_by_bytes(docs, monkeypatch):
    monkeypatch.setattr(fim, "BYTES", 50)
    frame = docs(*[(k, "word " * (k % 40)) for k in range(100)]).coalesce(1)
    assert sorted((tuple(r) for r in fim.transform(frame).collect()), key=key) == sorted((slow(k, "word " * (k % 40)) for k in range(100)), key=key)


def test_empty_table_and_names(spark, no_docs, docs):
    out = fim.transform(no_docs)
    assert out.count() == 0 and out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    named = fim.transform(docs((1, "a b")).withColumnRenamed("doc_id", "n_").withColumn("output", F.lit(1)), doc="n_")
    assert named.columns[0] == "n_" and named.count() == 1
    with pytest.raises(ValueError):
        fim.restore(fim.transform(docs((1, "a b"))), name="form")


def test_query_equals_sql(spark, data):
    from costseries.llm import queries

    assert oracle.compare(queries.op13_fill_in_middle(spark, data), fim.sql(), oracle.connect(data)) is None
