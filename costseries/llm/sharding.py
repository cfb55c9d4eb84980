"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from costseries.session import landed, workspace

BLOCKS = 1024  # blocks per old shard: the unit that moves
PIECES = 32  # pieces per new shard that a block of equal rows is cut into
FILE = 128 << 20  # bytes of text per output file, about


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def least_cost_flow(supply: list[int], room: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest amounts to send from every source to every sink; all supply is sent, no sink takes over its room.

    Successive shortest paths on reduced costs (Dijkstra). The graph has one node per shard, so its size doesn't depend on the data.
    """
    n, m = len(supply), len(room)
    if sum(supply) > sum(room):
        raise ValueError("the new shards have less room than the old ones hold")
    flow = [[0] * m for _ in range(n)]
    left, free = list(supply), list(room)
    price = [0] * (n + m)
    for source in range(n):
        while left[source]:
            far, prior, heap, done = {source: 0}, {}, [(0, source)], set()
            while heap:
                d, u = heapq.heappop(heap)
                if u in done:
                    continue
                done.add(u)
                if u < n:
                    edges = ((n + j, cost[u][j]) for j in range(m))
                else:
                    edges = ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
                for v, c in edges:
                    step = d + c + price[u] - price[v]
                    if v not in done and step < far.get(v, 1 << 62):
                        far[v], prior[v] = step, u
                        heapq.heappush(heap, (step, v))
            sink = min((n + j for j in range(m) if free[j]), key=lambda v: (far[v] + price[v], v))
            path, v = [], sink
            while v != source:
                path.append((prior[v], v))
                v = prior[v]
            amount = min([left[source], free[sink - n], *(flow[v][u - n] for u, v in path if u >= n)])
            for u, v in path:
                if u < n:
                    flow[u][v - n] += amount
                else:
                    flow[v][u - n] -= amount
            left[source] -= amount
            free[sink - n] -= amount
            for v, d in far.items():
                price[v] += min(d, far[sink])
            for v in range(n + m):
                if v not in far:
                    price[v] += far[sink]
    return flow


@dataclass(frozen=True)
class Block:
    old: int
    number: int
    size: int
    rows: int


def capacities(total: int, shards: int) -> list[int]:
    """Near-equal shares of a total."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def transfers(blocks: list[Block], room: list[int], cost: list[list[int]] | None = None) -> dict[tuple[int, int], int]:
    """New shard of every block, so that shard sizes meet ``room`` as near as whole blocks allow.

    The flow says how many bytes go from each old to each new shard at the least cost (moved bytes, unless
    ``cost`` per byte is given). Blocks of an old shard then go, largest first, to the target that is
    furthest below its amount; last, small blocks change shards while that evens out the sizes.
    """
    olds = max((b.old for b in blocks), default=-1) + 1
    supply = [0] * olds
    for b in blocks:
        supply[b.old] += b.size
    cost = cost or [[int(i != j) for j in range(len(room))] for i in range(olds)]
    wanted = least_cost_flow(supply, room, cost)
    placed, sizes = {}, [0] * len(room)
    for b in sorted(blocks, key=lambda b: (-b.size, b.old, b.number)):
        open_ = wanted[b.old]
        to = max(range(len(room)), key=lambda j: (open_[j], -cost[b.old][j], -j))
        open_[to] -= b.size
        sizes[to] += b.size
        placed[b.old, b.number] = to
    by_shard: list[list[Block]] = [[] for _ in room]
    for b in blocks:
        by_shard[placed[b.old, b.number]].append(b)
    for _ in range(20 * len(room)):  # even out what whole blocks left over
        gap = [s - r for s, r in zip(sizes, room)]
        high, low = max(range(len(room)), key=lambda j: gap[j]), min(range(len(room)), key=lambda j: gap[j])
        spare = (gap[high] - gap[low]) / 2
        fit = [b for b in by_shard[high] if 0 < b.size < 2 * spare]
        if not fit:
            break
        b = min(fit, key=lambda b: (abs(b.size - spare), b.old, b.number))
        by_shard[high].remove(b)
        by_shard[low].append(b)
        placed[b.old, b.number] = low
        sizes[high] -= b.size
        sizes[low] += b.size
    return placed


def split_heavy(rows: DataFrame, sizes: list[Row], shards: int) -> tuple[DataFrame, list[Row]]:
    """Rows and block sizes with every block of over a ``PIECES``-th of a fair shard cut into blocks of its own.

    Such a block holds rows equal in id and text hash, so its rows are told apart by a row number, which is landed
    with them: all later reads and retries see the same pieces. Their numbers start at BLOCKS. There are at most
    2 * PIECES * shards pieces, and none is asked to be smaller than the largest row.
    """
    limit = max(sum(r["size"] for r in sizes) // shards // PIECES, max((r["most"] for r in sizes), default=0))
    heavy = sorted((r["old"], r["block"], -(-r["size"] // limit)) for r in sizes if r["n"] > 1 and r["size"] > limit)
    if not heavy:
        return rows, sizes
    starts = accumulate((n for _, _, n in heavy), initial=BLOCKS)
    cuts = F.broadcast(rows.sparkSession.createDataFrame([(*h, at) for h, at in zip(heavy, starts)], "old int, block int, pieces int, start int"))
    piece = F.col("start") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("pieces"))
    cut = landed(rows.join(cuts, ["old", "block"]).withColumn("block", piece.cast("int")).select(rows.columns), "pieces")
    whole = {(old, block) for old, block, _ in heavy}
    kept = [r for r in sizes if (r["old"], r["block"]) not in whole]
    return rows.join(cuts, ["old", "block"], "left_anti").unionByName(cut), kept + block_sizes(cut)


def block_sizes(rows: DataFrame) -> list[Row]:
    return rows.groupBy("old", "block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).collect()


def reshard(
    docs: DataFrame, old: Column, olds: int, target: str | None = None, shards: int = 24, doc: str = "doc_id",
    text: str = "text", room: list[int] | None = None,
) -> DataFrame:
    """Rewrite a table into ``shards`` folders of near-equal bytes and return it as it was written.

    ``old`` is the old shard of a row (0 to olds - 1, not null). Every old shard falls into blocks by a
    hash of id and text; only their sizes (olds * BLOCKS rows at most, and those of cut blocks) reach the driver, where the
    flow is solved. A block that many equal rows make too large is cut (``split_heavy``). Each shard becomes a folder ``shard=K`` below ``target`` (a fresh folder in the shared one by default).
    Result: all columns of the table as ``row``, ``size``, ``old``, ``block``, ``shard`` and ``slot``, the
    position in the shard, without gaps from 0: the blocks of a shard follow each other, rows of a
    block are ordered by id and text hash.

    Null texts count 8 bytes; null ids sort first. Repeated rows are all kept and get slots of their own, in
    any order among themselves. An empty table gives an empty result. Table columns can't clash: they stay in ``row``.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc].alias("id"), row_size(docs[text]).alias("size"),
        old.cast("int").alias("old"), F.xxhash64(docs[text]).alias("h"),
    ).withColumn("block", F.pmod(F.xxhash64("id", "h"), F.lit(BLOCKS)).cast("int"))
    rows, found = split_heavy(rows, block_sizes(rows), shards)
    blocks = [Block(r["old"], r["block"], r["size"], r["n"]) for r in found]
    total = sum(b.size for b in blocks)
    placed = transfers(blocks, room or capacities(total, shards))
    plan, taken = [], [0] * shards
    for b in sorted(blocks, key=lambda b: (placed[b.old, b.number], b.old, b.number)):
        to = placed[b.old, b.number]
        plan.append((b.old, b.number, to, taken[to]))
        taken[to] += b.rows
    moves = spark.createDataFrame(plan, "old int, block int, shard int, first long")
    parts = min(BLOCKS, 1 + total // shards // FILE)  # tasks that write one shard; each holds whole blocks
    order = Window.partitionBy("shard", "part", "old", "block").orderBy("id", "h")
    written = (
        rows.join(F.broadcast(moves), ["old", "block"])  # as many rows as blocks
        .withColumn("part", F.pmod(F.xxhash64("old", "block"), F.lit(parts)))
        .repartition(shards * parts, "shard", "part")
        .withColumn("slot", F.col("first") + F.row_number().over(order) - 1)
        .select("row", "size", "old", "block", "slot", "shard")
    )
    folder = f"{target or workspace(spark, 'shards')}/layout"
    written.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(written.schema).parquet(folder)
