import random

import oracle
from pyspark.sql import functions as F

from costseries.llm import linededup, queries


def slow(rows):
    """Cleaned text per row of (id, text) in order, by comparing every line with all earlier ones."""
    out, earlier = [], []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        stay = []
        for line in text.split("\n"):
            own = set(line.split())
            if not own or not any(9 * len(own & e) >= 4 * (len(own) + len(e)) for e in earlier):
                stay.append(line)
            if own:
                earlier.append(own)
        out.append("\n".join(stay))
    return out


def cleaned(frame):
    return {r["row"]["doc_id"]: r["row"]["text"] for r in linededup.dedup(frame).collect()}


def test_random_lines_equal_brute_force(docs):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    lines = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 14))) for _ in range(150)]
    for _ in range(150):  # near copies
        words = rng.choice(lines).split()
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
        lines.append(" ".join(words))
    lines += ["", "  ", "w1  w2", "w2 w1"] * 3
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[k : k + 6])) for i, k in enumerate(range(0, len(lines), 6))]
    assert cleaned(docs(*rows)) == dict(zip([i for i, _ in rows], slow(rows)))


def test_long_lines_and_large_groups(docs):
    """More words than one bitmap can tell apart, and many variants of one line."""
    rng = random.Random(12)
    long = [f"v{k}" for k in range(260)]
    rows = []
    for i in range(60):
        words = list(long)
        for k in rng.sample(range(260), rng.randint(0, 50)):
            words[k] = f"x{rng.randrange(10000)}"
        rows.append((i, " ".join(words)))
    assert cleaned(docs(*rows)) == dict(zip(range(60), slow(rows)))


def test_query_equals_sql(spark, data):
    con = oracle.connect(data)
    assert oracle.compare(queries.op1_line_dedup(spark, data), linededup.sql(), con) is None


def test_odd_rows(odd, no_docs):
    found = linededup.dedup(odd)
    got = found.collect()
    assert len(got) == odd.count() and found.schema["row"].dataType.names == odd.columns
    by_id = {r["row"]["doc_id"]: r for r in got}
    assert by_id[1]["row"]["text"] is None and by_id[2]["row"]["text"] == "" and by_id[3]["row"]["text"] == " \t\n "
    assert by_id[9]["row"]["text"] == "same line\n" and by_id[9]["n_removed"] == 2 and by_id[9]["n_lines"] == 4
    assert by_id[6]["row"]["text"] == "" and by_id[5]["n_removed"] == 0
    assert [r["row"]["text"] for r in got if r["row"]["doc_id"] == 4].count("a") == 2  # equal rows are one document
    assert linededup.dedup(no_docs).count() == 0


def test_texts_of_null_and_repeated_ids_that_share_a_hash(docs, monkeypatch):
    """All texts meet in the first hash; documents of equal or missing ids still keep their own lines."""
    from pyspark.sql import functions as F

    both = linededup.text_hashes
    monkeypatch.setattr(linededup, "text_hashes", lambda body: [F.lit(7).cast("long").alias("h"), both(body)[1]])
    rows = [(None, "one two three\nfour five six"), (None, "seven eight\none two three\nnine ten"), (3, "a b c\nd e f"), (3, "g h i\na b c"), (3, "x\ny")]
    got = linededup.dedup(docs(*rows)).collect()
    assert len(got) == 5 and all(r["n_removed"] >= 0 for r in got)
    found = sorted((r["row"]["doc_id"] is not None, r["row"]["text"]) for r in got)
    lines = [line for _, text in found for line in text.split("\n") if line]
    assert sorted(lines) == sorted({line for _, text in rows for line in text.split("\n")})
    assert sum(r["n_removed"] for r in got) == 2


def test_marks_keep_every_hash_and_few_others(spark):
    """A table that is far from full lets almost no foreign hash through; one bit per hash let 1.2 % through."""
    hashes = spark.range(0, 200_000, 1, 4).select(F.xxhash64("id").alias("l1"), (F.col("id") < 100_000).alias("own"))
    told = linededup.with_mark(hashes, linededup.marks(hashes.where("own")))
    got = {r["own"]: r["n"] for r in told.where("mark").groupBy("own").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got[True] == 100_000 and got.get(False, 0) < 200


def test_words_of_a_pair_are_split_once(spark):
    """The sets of a pair were built again at every use."""
    lines = spark.createDataFrame([(1, 1, "a b c d e"), (2, 2, "e d c b a"), (3, 3, "a b c x y")], "l1 long, l2 long, line string")
    pairs = spark.createDataFrame([(1, 1, 2, 2), (1, 1, 3, 3), (3, 3, 2, 2)], "l1 long, l2 long, m1 long, m2 long")
    found = linededup.similar(pairs, lines)
    assert [tuple(r) for r in found.collect()] == [(1, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct(") == 2


def test_rare_words_are_told_from_frequent_ones(docs):
    """Words of one frequency class each, more than a smaller table could keep apart."""
    frame = docs((1, " ".join(f"r{k}" for k in range(6000))), (2, " ".join(f"f{k % 3000}" for k in range(48000))))
    classes = linededup.rarity(frame.select("text"))
    word = frame.sparkSession.range(6000).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("w"))
    rank = word.select(F.get(classes, linededup.bucket(F.xxhash64("w"))).alias("c"))
    assert rank.where("c > 8").count() < 6000 * 0.06


def test_words_between_tabs_meet(docs):
    """Words that only ever stand between other white space than spaces count as often as they occur."""
    line = "\t".join(f"t{k}" for k in range(12))
    rows = [(1, line), (2, line + "\tone more"), (3, line.replace("\t", "\r\x0b") + "\r"), (4, "t1\tt2")]
    assert cleaned(docs(*rows)) == dict(zip([i for i, _ in rows], slow(rows)))
