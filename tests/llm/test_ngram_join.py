import random
import re
import time

import numpy as np
import pytest

import oracle
from costseries.llm import ngramjoin, queries


def slow_set(text, size=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    size = min(size, len(found))
    return frozenset(" ".join(found[k : k + size]) for k in range(len(found) - size + 1))


def slow(rows, size=5, percent=80):
    """(id, shingles, smallest id in reach, links) of all rows, all pairs compared."""
    sets = [slow_set(t, size) for _, t in rows]
    near = [
        [j for j, b in enumerate(sets) if j != i and a and b and 100 * len(a & b) >= percent * len(a | b)] for i, a in enumerate(sets)
    ]
    out = []
    for start in range(len(rows)):
        seen, todo = {start}, [start]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[start][0], len(sets[start]), min(ids, default=None), len(near[start])))
    return sorted(out, key=key)


def key(row):
    return tuple((v is not None, v) for v in row)


def got(frame, **kw):
    return sorted((tuple(r) for r in ngramjoin.join(frame, **kw).collect()), key=key)


def families(seed, families=12, members=25, length=60):
    """Texts with near copies at all distances, shared passages, copies and short texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randrange(4, length))]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(2)] = [word()] * rng.randrange(2)
            texts.append(" ".join(rng.choice(([], passage, passage[:7])) + text + rng.choice(([], [], passage[10:]))))
    texts += texts[:40] + [t.upper() for t in texts[:10]] + ["", None, "  \n", "one", "one two", "ONE\ttwo"]
    rng.shuffle(texts)
    return list(enumerate(texts))


SMALL = {"FREQUENT": 2, "HELD": 150, "CELL": 16, "SHORT": 4, "PIECE": 400, "SPREAD": 2000, "WANTED": 3}


@pytest.mark.parametrize("seed, patch", [(1, {}), (2, SMALL), (3, SMALL | {"TABLE": 20, "CELL": 5}), (4, SMALL | {"FREQUENT": 10**9})])
def test_equals_brute_force(docs, monkeypatch, seed, patch):
    """With tiny limits every way is taken: lists in cells, long lists, pieces, several buckets, texts by a shuffle."""
    for name, value in patch.items():
        monkeypatch.setattr(ngramjoin, name, value)
    rows = families(seed)
    frame = docs(*rows).repartition(3)
    expected = slow(rows)
    assert got(frame) == expected
    assert max(r[3] for r in expected) > 5


@pytest.mark.parametrize("size, percent", [(1, 50), (3, 100), (2, 67)])
def test_other_sizes_and_similarities(docs, monkeypatch, size, percent):
    monkeypatch.setattr(ngramjoin, "SHORT", 3)
    rows = families(7, 6, 12, 20)
    assert got(docs(*rows), size=size, percent=percent) == slow(rows, size, percent)


def test_blocks_of_a_list_lose_no_pair():
    """Pairs of a long list equal the pairs that pass length and position one by one."""
    rng = np.random.default_rng(3)
    n = np.sort(rng.integers(5, 40, 300))
    pos = rng.integers(0, np.maximum(1, n // 4))
    order = np.lexsort((pos, n))
    n, pos = n[order].astype(np.int64), pos[order].astype(np.int64)
    found = set()
    for one, two in ngramjoin._pairs_of_list(n, pos, 0, 300, 80):
        found |= {(min(a, b), max(a, b)) for a, b in zip(one.tolist(), two.tolist()) if a != b}
    expected = {
        (a, b) for a in range(300) for b in range(a + 1, 300) if min(n[a] - pos[a], n[b] - pos[b]) >= -(-80 * (n[a] + n[b]) // 180)
    }
    assert found == expected and len(expected) < 300 * 299 // 4
    short = {p for one, two in ngramjoin._pairs_of_short_lists(np.array([0, 5, 5]), np.array([5, 0, 3])) for p in zip(one.tolist(), two.tolist())}
    assert short == {(a, b) for a in range(5) for b in range(a + 1, 5)} | {(5, 6), (5, 7), (6, 7)}


def test_overlaps_are_derived_from_the_set_before():
    rng = np.random.default_rng(4)
    block = [np.unique(rng.integers(0, 300, 60)).astype(np.uint64) for _ in range(30)]
    verifier, x = ngramjoin.Verifier(block), block[0]
    for step in range(40):
        x = np.unique(np.r_[x[rng.random(len(x)) > 0.05], rng.integers(0, 320, 3).astype(np.uint64)]) if step % 9 else block[step % 30]
        assert verifier.of(x).tolist() == [len(np.intersect1d(x, b)) for b in block]


@pytest.mark.parametrize("percent", [80, 50, 100])
def test_bitmaps_lose_no_pair_and_few_strangers_pass(percent):
    """Sets of all sizes, so of bitmaps of all lengths, within a piece and between two."""
    rng = np.random.default_rng(5)
    sets = []
    for n in [1, 3, 40, 60, 64, 65, 70, 130, 250, 258, 500, 520, 900] * 3:
        base = rng.integers(0, 1 << 63, n).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.r_[base[rng.random(n) > 0.1], rng.integers(0, 1 << 63, n // 8 + 1).astype(np.uint64)])]
    rows = [(ngramjoin._set_key(x), len(x), ngramjoin._bitmap(x)) for x in sets]
    reach = lambda x, y: 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
    near = np.array([[a != b and reach(x, y) for b, y in enumerate(sets)] for a, x in enumerate(sets)])
    mine, theirs = ngramjoin._alike(rows, None, percent)
    assert (mine | theirs)[near.any(axis=1)].all()
    mine, theirs = ngramjoin._alike(rows[::2], rows[1::2], percent)
    assert mine[near[::2, 1::2].any(axis=1)].all() and theirs[near[::2, 1::2].any(axis=0)].all()
    strangers = [rows[k] for k in range(0, len(rows), 2) if rows[k][1] > 60]
    assert percent < 80 or not np.concatenate(ngramjoin._alike(strangers, None, percent)).any()


def test_a_chance_passage_fetches_no_text(docs, spark, monkeypatch):
    """Documents that share five words with others meet as bitmaps only; texts of partners travel without a shuffle of all texts."""
    rng, fetched, texts = random.Random(6), [], ngramjoin._texts
    passage = [" ".join(f"p{k}x{j}" for j in range(5)) for k in range(150)]
    other = [" ".join(f"d{d}w{rng.randrange(1000)}" for _ in range(8)) for d in range(60)]
    rows = [(d, " ".join(f"{p} q{d}" for p in rng.sample(passage, 30)) + " " + other[d]) for d in range(60)]
    rows += [(100, rows[0][1] + " end"), (101, rows[0][1])]
    monkeypatch.setattr(ngramjoin, "WANTED", 0)
    monkeypatch.setattr(ngramjoin, "MARKS", 1 << 12)

    def watched(documents, wanted, text):
        fetched.append(wanted.select("t").distinct().count())
        found = texts(documents, wanted, text)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert {rows[0][1], rows[60][1]} <= {r["text"] for r in found.collect()}
        return found

    monkeypatch.setattr(ngramjoin, "_texts", watched)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got(docs(*rows)) == slow(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert fetched == [2]


def test_shuffle_files_go_with_the_write(spark):
    """What a landed table was made of does not stay until the driver's memory fills up."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {n for n in (found.apply(k).getName() for k in range(found.size())) if n.startswith("shuffle_")}

    old = files()
    shuffled = spark.range(1000).repartition(4, "id")
    table = ngramjoin.landed_alone(shuffled, "t")
    for _ in range(50):
        if not any(n.endswith(".data") for n in files() - old):
            break
        time.sleep(0.2)
    assert not any(n.endswith(".data") for n in files() - old)
    assert table.count() == shuffled.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_shingles_follow_the_definition():
    for text in ("A b\tC d e F", "a b c", "x", "", None, "Ünï ÜNÏ a b c d", "a b a b a b a b", "a\x1fb c d e f"):
        assert len(ngramjoin.shingles(text)) == len(slow_set(text))
    assert ngramjoin.shingles("A b  C d\ne").tolist() == ngramjoin.shingles("a B c D e").tolist()
    assert not set(ngramjoin.shingles("a b").tolist()) & set(ngramjoin.shingles("b a").tolist())


def test_odd_rows(odd, no_docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got(odd) == slow(rows)
    out = ngramjoin.join(no_docs)
    assert out.count() == 0 and out.columns == ["doc_id", "n_shingles", "component_id", "n_links"]


def test_query_equals_sql(spark, data):
    assert oracle.compare(queries.op11_ngram_join(spark, data), ngramjoin.sql(), oracle.connect(data)) is None
