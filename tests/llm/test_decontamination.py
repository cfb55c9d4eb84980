import random

from costseries.llm import decontamination as d


def slow(docs, items):
    """Best similarity per pair over all windows of the item's size."""
    out = {}
    for i, text in docs:
        found = d.tokens(text)
        for k, item in items:
            words = d.tokens(item)
            windows = [found[a : a + len(words)] for a in range(len(found) - len(words) + 1)] if words else []
            best = max((d.similarity(w, words) for w in windows), default=0)
            if best >= d.SIMILARITY:
                out[i, k] = round(best, 9)
    return out


def test_near_and_exact_passages_equal_brute_force(spark, docs):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(draw(rng.randint(3, 50)))) for k in range(25)] + [(100, "one two"), (101, ""), (102, None), (103, "ab")]
    rows = []
    for i in range(120):
        words = draw(rng.randint(0, 200))
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(items)[1]
            passage = passage.split() if passage else []
            if passage and rng.random() < 0.5:
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = [p.upper() + "!!" for p in passage]
        rows.append((i, " ".join(words)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.find(docs(*rows), benchmark).collect()}
    expected = slow(rows, items)
    assert found.items() <= expected.items()
    sure = {p for p, s in expected.items() if s > 0.9}
    assert sure <= found.keys() and len(found) >= 0.97 * len(expected)
    clean = {r.doc_id for r in d.keep_clean(docs(*rows), benchmark).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in found}


def whole(docs, items):
    """Similarity of the pairs whose text is shorter than the item."""
    pairs = {(i, k): (d.tokens(text), d.tokens(item)) for i, text in docs for k, item in items}
    scores = {p: round(d.similarity(a, b), 9) for p, (a, b) in pairs.items() if len(a) < len(b)}
    return {p: s for p, s in scores.items() if s >= d.SIMILARITY}


def test_texts_shorter_than_the_item(spark, docs):
    rng = random.Random(5)
    draw = lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(n)]
    items = [(k, " ".join(draw(n))) for k, n in enumerate((3, 4, 5, 6, 15, 30, 45, 60))]
    rows = [(100 * k + 10 * cut + at, " ".join(w[at : len(w) - cut + at])) for k, t in items for w in [t.split()] for cut in range(1, 9) for at in (0, cut // 2, cut)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.find(docs(*rows), benchmark).collect()}
    expected = whole(rows, items)
    assert found.items() <= expected.items() and (750, 7) in found  # 60 words less the last 5
    assert {p for p, s in expected.items() if s > 0.9} <= found.keys()
    assert {r.doc_id for r in d.keep_clean(docs(*rows), benchmark).collect()} == {i for i, _ in rows} - {i for i, _ in found}


def test_near_copies_at_the_threshold_are_all_found():
    """Items with up to three words changed, dropped or added, in other text or alone; some repeat their own words."""
    rng = random.Random(6)
    draw = lambda n, few=600: [f"{'abcdefghij'[k % 10] * (k % 7 + 1)}{k}" for k in rng.choices(range(few), k=n)]
    items = [(k, draw(rng.randint(11, 60), rng.choice((3, 600, 600)))) for k in range(60)]
    matcher, expected, found = d.Matcher(items), {}, {}
    for i in range(1200):
        k, passage = rng.choice(items)
        words = list(passage)
        for _ in range(rng.randint(1, 3)):
            at = rng.choice((0, len(words) - 1, rng.randrange(len(words))))
            words[at : at + rng.randint(0, 1)] = ["changed"][: rng.randint(0, 1)]
        around = rng.choice((0, 0, 3, 20))
        row, item = (i, " ".join(draw(around) + words * rng.choice((1, 1, 2)) + draw(around))), (k, " ".join(passage))
        expected |= {**slow([row], [item]), **whole([row], [item])}
        found |= {(i, j): round(s, 9) for j, s, _ in matcher.leaks(row[1]) if j == k}
    assert found == expected
    assert sum(s < 0.84 for s in expected.values()) > 80


def test_all_exact_passages_of_the_samples(table):
    documents, benchmark = table("documents"), table("benchmark")
    items = [(r.item_id, f" {' '.join(d.tokens(r.text))} ") for r in benchmark.collect()]
    expected = {(r.doc_id, k) for r in documents.collect() for k, item in items if item in f" {' '.join(d.tokens(r.text))} "}
    got = {(r.doc_id, r.item_id) for r in d.find(documents, benchmark).collect()}
    assert expected <= got and expected


def test_blocks_cover_all_items(spark, monkeypatch, docs):
    monkeypatch.setattr(d, "BLOCK_WORDS", 10)
    items = [(k, f"alpha{k} beta gamma{k} delta epsilon{k} zeta") for k in range(9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(d.blocks(benchmark, "item_id", "text"))) > 2
    frame = docs(*[(k, f"so {t} it goes") for k, t in items])
    assert {(r.doc_id, r.item_id) for r in d.find(frame, benchmark).collect()} == {(k, k) for k in range(9)}
    assert d.keep_clean(frame, benchmark).count() == 0


def test_odd_rows(spark, odd, no_docs):
    benchmark = spark.createDataFrame([(1, None), (2, ""), (3, "some text without an id here")], "item_id long, text string")
    got = d.find(odd, benchmark).collect()
    assert [(r.doc_id, r.item_id, r.first_word) for r in got] == [(None, 3, 0)]
    kept = d.keep_clean(odd, benchmark)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert d.find(no_docs, benchmark).count() == 0 and d.find(odd, benchmark.where("false")).count() == 0


def test_ids_of_any_kind(spark, docs):
    frame = docs((1, "well the cat sat on the mat today ok"))
    for kind in ("int", "smallint", "bigint", "string", "decimal(10,0)"):
        benchmark = spark.sql(f"SELECT CAST(7 AS {kind}) AS item_id, 'the cat sat on the mat today' AS text")
        out = d.find(frame, benchmark)
        assert dict(out.dtypes)["item_id"] == kind and [str(r.item_id) for r in out.collect()] == ["7"]


def test_radius_finds_nearly_all_similar_windows():
    """Of windows of similarity 0.8 or more at most one in a hundred may lie beyond the radius."""
    rng = random.Random(8)
    draw = lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(n)]
    near, found = 0, 0
    for n in range(15, 75):
        items = [(k, draw(n)) for k in range(12)]
        matcher = d.Matcher(items)
        for k, words in items * 8:
            passage = list(words)
            for _ in range(rng.randint(1, 4)):
                passage[rng.randrange(n)] = draw(1)[0]
            score = d.similarity(passage, words)
            if 0.8 <= score < 0.9:
                near += 1
                found += any(j == k for j, _, _ in matcher.leaks(" ".join(passage)))
    assert near > 600 and found >= 0.99 * near
