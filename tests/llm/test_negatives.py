import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from costseries.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, row string, id long, score long, v string, g int"


@pytest.fixture
def rows_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], SCHEMA)

    return make


def slow(rows, every=100):
    """All rows by the definition."""
    used = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [max(-negatives.LIMIT, min(negatives.LIMIT, math.floor(256 * float(np.float32(c))))) for c in x])
        used[i] = min(used.get(i, row), row)
    out = []
    for a, (label, v) in used.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other) for i, (other, w) in used.items() if i != a)
        for score, i, other in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(a, i, rank, s[1], -score, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out)


def got(frame, **kw):
    return sorted(tuple(r) for r in negatives.mine(frame, **kw).collect())


def random_rows(seed, n, width, ties=False):
    rng = random.Random(seed)
    draw = (lambda: rng.choice((-1.0, 0.0, 0.5, 1.0))) if ties else (lambda: rng.gauss(0, 0.3))
    return [(rng.randrange(-3 * n, 3 * n), [draw() for _ in range(width)], rng.randrange(3)) for _ in range(n)]


@pytest.mark.parametrize("seed, width, ties", [(1, 12, False), (2, 3, True), (3, 30, False), (4, 1, True)])
def test_equals_brute_force_in_small_blocks(rows_of, monkeypatch, seed, width, ties):
    monkeypatch.setattr(negatives, "ROWS", 70)
    monkeypatch.setattr(negatives, "ANCHORS", 5)
    monkeypatch.setattr(negatives, "STEP", 2)
    rows = random_rows(seed, 400, width, ties)
    assert got(rows_of(rows), every=20) == slow(rows, every=20)


def test_scan_drops_rows_before_all_dimensions_are_read():
    rng = np.random.default_rng(5)
    columns = rng.integers(-40, 40, (32, 500))
    block = negatives.Block.__new__(negatives.Block)
    block.ids, block.labels, block.columns = np.arange(500), np.zeros(500, np.int64), columns
    block.least, block.most = columns.min(axis=1), columns.max(axis=1)
    anchor, seen = np.r_[np.full(8, 60), np.ones(24, int)], []

    def keep(alive, low, high):
        exact = anchor @ columns[:, alive]
        assert (low <= exact).all() and (exact <= high).all()
        seen.append(len(alive))
        return high >= negatives._kth(low, 5)

    alive, sums = block.scan(anchor, np.arange(500), keep)
    assert (sums == anchor @ columns[:, alive]).all()
    assert seen[0] == 500 and seen[1] < 100 and len(alive) < 100
    best = np.argsort(-(anchor @ columns), kind="stable")[:5]
    assert set(best) <= set(alive)


def test_odd_rows(rows_of):
    rows = [
        (None, [1.0, 1.0], 1), (0, [1.0, 0.5], 9), (0, [1.0, 0.5], 9), (100, [0.0, 0.0], 2), (200, None, 1), (300, [1.0, None], 1), (400, [1.0, math.nan], 1),
        (500, [math.inf, 1.0], 1), (600, [1.0, 1.0], None), (700, [], 1), (800, [1.0], 2), (900, [1e30, 1.0], 3), (-100, [0.3, 0.3, 0.3], 2),
        *[(k, [k / 40, 0.5], k % 3) for k in range(1, 60)], *[(k, [k / 40, 0.5], k % 3) for k in range(1, 20)], (5, [0.25, 0.5], 7),
    ]
    assert got(rows_of(rows)) == slow(rows)
    assert any(r[0] == 0 for r in slow(rows)) and any(r[0] == -100 for r in slow(rows))


def test_negative_scores_and_empty_tables(rows_of):
    rows = [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2), (3, [0.5], 2)]
    assert got(rows_of(rows)) == slow(rows) == []
    empty = negatives.mine(rows_of(rows).where("false"))
    assert empty.count() == 0
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mine(rows_of(rows).withColumn("label", F.lit(None).cast("int"))).count() == 0


def test_query_equals_sql(spark, data):
    con = oracle.connect(data)
    con.execute("DROP VIEW embeddings")
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{data.replace('0.001', '0.01')}/embeddings.parquet')")
    assert oracle.compare(queries.op12_hard_negatives(spark, data.replace("0.001", "0.01")), negatives.sql(), con) is None
