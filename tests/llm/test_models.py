"""Language identification and toxicity: held-out accuracy and defined results on odd rows."""

import os
import zlib

import numpy as np
import pytest

from costseries.llm import langid, toxicity


def test_language_of_held_out_documents(table):
    documents = table("documents")
    got = {r.doc_id: r for r in langid.identify(documents).collect()}
    held = [r for r in documents.collect() if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in documents.collect())
    right = [got[r.doc_id].lang_pred == r.lang for r in held]
    assert sum(right) >= 0.97 * len(right)


def test_language_and_other_columns_are_no_input(table):
    documents = table("documents")
    plain = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(documents).collect() if r.held_out}
    swapped = documents.selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(string(doc_id)), 3) = 1 THEN 'xx' ELSE lang END AS lang", "'s' AS source")
    assert {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(swapped).collect() if r.held_out} == plain


def test_distance_based_rejection(docs, spark, table):
    known = table("documents").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(-7, "日本語の文章はここにありますとても長い文章です", None)], known.schema)
    got = {r.doc_id: r for r in langid.identify(known.unionAll(strange)).collect()}
    assert not got[-7].accepted and sum(r.accepted for r in got.values()) > 0.9 * len(got)


def test_language_of_odd_rows(odd, no_docs, docs):
    got = langid.identify(odd).collect()
    assert len(got) == odd.count()
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3) or r.doc_id is None and r.score == 0)
    assert langid.identify(no_docs).count() == 0
    assert langid.identify(docs((0, "12 34 !"))).collect()[0].lang_pred == "und"


def test_parts_of_long_texts_count_like_the_whole(monkeypatch):
    text = "ab cd efg " * 50
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "PART", 7)
    assert np.array_equal(langid.grams(text), whole)


def test_toxic_documents(table):
    documents, labels = table("documents"), table("labels")
    got = {r.doc_id: r for r in toxicity.score(documents, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in got}
    assert sum(got[d].toxic == bool(t) for d, t in truth.items()) >= 0.97 * len(truth)
    assert all(0 <= getattr(r, f"p_{c}") <= 1 for r in got.values() for c in toxicity.CHAIN)


def test_toxic_documents_that_the_fit_has_not_seen(spark):
    """Labels split by id: a third is held out."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("sample tables are not here")
    documents, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    split = "pmod(crc32(string(doc_id)), 3) = 1"
    truth = {r.doc_id: r.toxic for r in labels.where(split).collect()}
    got = {r.doc_id: r.toxic for r in toxicity.score(documents, labels.where(f"NOT {split}")).collect() if r.doc_id in truth}
    toxic = [d for d in got if truth[d]]
    assert toxic and sum(got[d] for d in toxic) >= 0.85 * len(toxic)
    assert sum(got[d] for d in got if not truth[d]) <= 0.01 * len(got)


def test_toxicity_model_of_repeated_ids_in_any_order(spark, table):
    documents, labels = table("documents").select("doc_id", "text"), table("labels")
    first = labels.where("toxic > 0").first().doc_id
    other = spark.createDataFrame([(first, "another text of this id")] * 50, documents.schema)
    names, models = toxicity.learn(documents.unionAll(other), labels, "doc_id", "text", "toxic")
    again, same = toxicity.learn(other.unionAll(documents).repartition(5), labels, "doc_id", "text", "toxic")
    assert names == again and all(np.array_equal(a, b) for a, b in zip(models, same))


def test_kinds_are_groups_of_like_documents():
    x = np.array([[1, 1, 0, 0, 0, 0]] * 5 + [[0, 0, 1, 1, 0, 0]] * 3 + [[0, 0, 0, 0, 1, 1]] * 4, np.float32)
    assert toxicity.kinds(x).tolist() == [0] * 5 + [2] * 3 + [1] * 4
    assert toxicity.kinds(x[:2]).tolist() == [0, 0] and toxicity.kinds(np.zeros((3, 2), np.float32)).max() < toxicity.KINDS


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(2)
    x = (rng.random((400, 6)) > 0.5).astype(np.float32)
    first = (x[:, 0] * x[:, 1] > 0).astype(np.float32)
    second = first * x[:, 2]
    y = np.stack((first, second), 1)
    models = toxicity.fit_chain(x, y, np.ones(400, np.float32), np.arange(400) % toxicity.FOLDS)
    assert [len(m) for m in models] == [7, 8]  # the second model reads the first probability
    p = toxicity.predict_chain(models, x)
    assert ((p[:, 1] > 0.5) == (second > 0)).mean() > 0.85


def test_toxicity_of_odd_rows(spark, odd, no_docs, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.toxic for r in toxicity.score(odd, none).collect()} == {False}
    labels = spark.createDataFrame([(None, 1, 1), (1, 1, None), (10, 1, 1), (11, 1, 0), (11, 1, 0), (12, 0, 1), (13, 0, 0), (99, 1, 1), *[(k, 1, 0) for k in range(20, 60)]], none.schema)
    frame = docs((10, "you idiot you"), (11, "a fine day"), (12, "what an idiot"), (13, "a fine day again"), (14, None), *[(k, "calm words only") for k in range(20, 60)])
    got = {r.doc_id: r.toxic for r in toxicity.score(frame, labels, threshold=0.4).collect()}
    assert got[14] is False and len(got) == 45 and got[10] and got[12]
    assert toxicity.score(odd, labels).count() == odd.count() and toxicity.score(no_docs, labels).count() == 0


def test_six_hundred_languages_and_any_row_order(spark):
    """Every language is learned, and neither the order nor the copies of rows change the model."""
    from costseries.llm import langid

    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [letters[k % 26] + letters[k // 26 % 26] for k in range(600)]
    rows = [(10 * k + j, f"{w * 4} {w * 6} {w * (j + 3)}", f"l{k:03d}") for k, w in enumerate(words) for j in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(frame, "doc_id", "text", "lang")
    held = {r.lang for r in frame.where(~langid.held_out(frame.doc_id)).select("lang").distinct().collect()}
    assert len(held) > 590 and set(model.names) == held
    again = langid.learn(frame.unionAll(frame.where("doc_id < 100")).repartition(7), "doc_id", "text", "lang")
    assert again.names == model.names and (again.centroids == model.centroids).all()
