import corpus_pipeline
from costseries.llm import decontamination, quality


def test_stages_follow_each_other(spark, data, table):
    documents = docs = table("documents")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, data).cache()
        if name != "bpe_tokens":
            assert out.columns == documents.columns and out.schema.simpleString() == documents.schema.simpleString()
        if name == "quality_rules":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in quality.rate(docs).where("kept").collect()}
        if name == "benchmark_decontamination":
            leaked = {r.doc_id for r in decontamination.find(docs, table("benchmark")).collect()}
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()} - leaked
        kept.append(out.count())
        docs = out
    assert kept[0] > kept[1] == kept[2] > kept[3] >= kept[4] == kept[5] > 0.5 * kept[0]
    ran = {(r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, data).collect()}
    assert ran == {(r.doc_id, r.ids_sha256) for r in docs.collect()}


def test_stages_on_odd_rows(spark, data, odd, no_docs):
    for frame in (odd, no_docs):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, data)
            docs.count()


def test_all_operators_are_registered():
    import __spark_entry__ as driver

    names = driver.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
