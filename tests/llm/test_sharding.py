import itertools
import random
import zlib

from pyspark.sql import functions as F

from costseries.llm import queries, sharding


def cheapest(supply, room, cost):
    """Least cost by trying every way to deal single units."""
    units = [i for i, n in enumerate(supply) for _ in range(n)]
    best = None
    for ways in itertools.product(range(len(room)), repeat=len(units)):
        if all(ways.count(j) <= room[j] for j in range(len(room))):
            c = sum(cost[i][j] for i, j in zip(units, ways))
            best = c if best is None else min(best, c)
    return best


def test_flow_is_cheapest():
    rng = random.Random(8)
    for _ in range(60):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 3) for _ in range(n)]
        room = [rng.randint(0, 4) for _ in range(m)]
        room[0] += max(0, sum(supply) - sum(room))
        cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        flow = sharding.least_cost_flow(supply, room, cost)
        assert [sum(row) for row in flow] == supply
        assert all(sum(flow[i][j] for i in range(n)) <= room[j] for j in range(m))
        assert sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m)) == cheapest(supply, room, cost)


def test_only_what_must_move_moves():
    blocks = [sharding.Block(old, k, 10, 1) for old in range(3) for k in range((12, 6, 6)[old])]
    placed = sharding.transfers(blocks, sharding.capacities(240, 4))
    assert sum(placed[b.old, b.number] != b.old for b in blocks) == 6  # the surplus of shard 0 fills shard 3
    sizes = [sum(b.size for b in blocks if placed[b.old, b.number] == j) for j in range(4)]
    assert sizes == [60, 60, 60, 60]


def test_query_keeps_the_law(spark, data, table):
    documents = {r.doc_id: r.text for r in table("documents").collect()}
    got = queries.op10_sharding(spark, data).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    for r in got:
        body = documents[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "bytes", None)
    sizes = []
    for shard in range(24):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sizes.append(sum(r["size"] for r in own))
    largest = max(len(t.encode()) + 8 for t in documents.values())
    mean = sum(sizes) / 24
    assert max(sizes) - mean <= max(0.05 * mean, largest)


def test_files_hold_all_columns(spark, odd, tmp_path):
    placed = sharding.reshard(odd, F.lit(0), 1, f"file://{tmp_path}/out", shards=3)
    back = spark.read.parquet(f"file://{tmp_path}/out/layout")
    assert back.count() == placed.count() == odd.count()
    assert placed.schema["row"].dataType.names == odd.columns
    assert sorted(r["size"] for r in placed.where("row.text is null").collect()) == [8, 8]
    for shard in range(3):
        slots = sorted(r.slot for r in placed.where(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))


def test_rows_equal_in_id_and_text_keep_the_law(docs):
    rng = random.Random(2)
    rows = [(None, "a copy without an id")] * 1200 + [(7, "repeated")] * 300 + [(100 + k, "x" * rng.randint(5, 60)) for k in range(1500)]
    got = sharding.reshard(docs(*rows), F.lit(0), 1, shards=8).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["row"].doc_id, r["row"].text) for r in got), key=order) == sorted(rows, key=order)
    sizes = [sum(r["size"] for r in got if r.shard == k) for k in range(8)]
    assert max(sizes) - sum(sizes) / 8 <= max(0.05 * sum(sizes) / 8, 68)
    for shard in range(8):
        own = sorted(r.slot for r in got if r.shard == shard)
        assert own == list(range(len(own)))


def test_empty_table(no_docs):
    assert sharding.reshard(no_docs, F.lit(0), 1).count() == 0
