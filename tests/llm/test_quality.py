import re
from collections import Counter

import oracle

from costseries.llm import quality, queries


def slow(text):
    body = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", body)
    lines = [x for x in body.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {k + j for k, w in enumerate(windows) if w in twice for j in range(5)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in body), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_definition(docs):
    texts = [
        None, "", "a b c d", "a b c d e", "a a a a a", "a a a a a a", "x y z p q x y z p q", "one two three four five six one two three four five",
        "l1 a\nl1 a\n\n \n l1 a", "é# *ü|\x0b\x1f <>\t\r\n", "a b c d e f a b c d e g a b c d e", "👩‍👧 日本 | |",
    ]
    got = {r.doc_id: r for r in quality.rate(docs(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow(text), text
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_query_equals_sql(spark, data):
    con = oracle.connect(data)
    assert oracle.compare(queries.op2_quality_rules(spark, data), quality.sql(), con) is None


def test_verdicts_agree_with_labels(table):
    rated = quality.rate(table("documents")).join(table("labels"), "doc_id").where("not base_failed")
    right = rated.where("kept = (quality = 1)").count()
    assert right >= 0.97 * rated.count()


def test_odd_rows(odd, no_docs):
    got = quality.rate(odd).collect()
    assert len(got) == odd.count()
    assert all(r.base_failed and r.n_words == 0 for r in got if r.doc_id in (1, 2, 3))
    assert quality.keep_good(odd).columns == odd.columns
    assert quality.rate(no_docs).count() == 0 and quality.keep_good(no_docs).count() == 0
