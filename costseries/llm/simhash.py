"""Near-duplicate groups by SimHash with multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costseries.llm import graph
from costseries.llm.common import fields
from costseries.session import landed

BITS = 64
SEED = 42
PART = 1 << 16  # shingles counted at a time


def fingerprint(text: str | None, size: int = 4) -> int:
    """Unsigned 64-bit SimHash over the word shingles of a text; zero without a word.

    A-Z are lower-cased, words are split at ASCII white space, shingles join ``size`` words by one
    space (a shorter text is one shingle), and a bit is set where over half the shingle hashes set it.
    """
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return 0
    body = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - size + 1)
    last = ends[-n:].tolist()
    first = starts[:n].tolist()
    h64, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, PART):
        hashes = np.array([h64(body[a:b], SEED) for a, b in zip(first[at : at + PART], last[at : at + PART])], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", size: int = 4, name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a signed long; rows and their order in a partition stay."""
    if name in docs.columns:
        raise ValueError(f"{name} is a column already")
    schema = fields("f long")
    for f in docs.schema:
        schema = schema.add(f)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            got = np.fromiter((fingerprint(t.as_py(), size) for t in column), np.uint64, len(column)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got), *batch.columns], names=["f", *batch.schema.names])

    out = docs.mapInArrow(run, schema)
    return out.select(*[F.col(c) for c in docs.columns], F.col("f").alias(name))


def _widths(parts: int) -> list[int]:
    return [BITS // parts + (i < BITS % parts) for i in range(parts)]


def _ball(width: int, radius: int) -> list[int]:
    """All masks of a segment with at most ``radius`` bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _radii(distance: int, parts: int) -> list[tuple[int, int]]:
    """Width and search radius of every segment, lowest bits first; a radius of -1 means that the segment needs no table.

    With distance = parts * q + r, two linked fingerprints differ by at most q bits in one of
    the first r + 1 segments or by at most q - 1 in one of the others.
    """
    q, r = divmod(distance, parts)
    return [(width, q if i <= r else q - 1) for i, width in enumerate(_widths(parts))]


def segments(n: int, distance: int = 4) -> int:
    """Number of segments that costs a fingerprint among ``n`` least, in lookups sent and chance matches met.

    Few wide segments need large balls, many narrow ones meet n / 2 ** width strangers per lookup. Every number
    gives the same links; the cheapest one keeps the chance matches of a fingerprint to a few hundred up to
    10 ** 9 fingerprints (at distance 4: 5 segments for 10 ** 4, 4 for 5 * 10 ** 4, 3 from 10 ** 5 to 2 * 10 ** 7, then 2).
    """

    def cost(parts: int) -> float:
        balls = [(width, sum(comb(width, k) for k in range(radius + 1))) for width, radius in _radii(distance, parts)]
        return sum(ball * (1 + n / 2**width) for width, ball in balls)

    return min(range(min(2, distance + 1), distance + 2), key=cost)


def links(prints: DataFrame, distance: int = 4, parts: int | None = None, name: str = "f") -> DataFrame:
    """All pairs ``(u, v)``, u < v, of distinct fingerprints with at most ``distance`` differing bits.

    Every fingerprint is filed in one table row per segment and looks up the ball of its radius around
    each of its segments; the whole distance is checked in the join, so chance matches are never
    written. ``parts`` segments are used, else as many as the number of rows makes cheapest.
    """
    parts = parts or segments(prints.count(), distance)
    table, probe, low = [], [], 0
    for i, (width, radius) in enumerate(_radii(distance, parts)):
        if radius >= 0:
            key = F.shiftrightunsigned(F.col(name), low).bitwiseAND(F.lit((1 << width) - 1))
            table.append(F.struct(F.lit(i).alias("part"), key.alias("key")))
            probe.append((i, key, F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])))
        low += width
    filed = prints.select(F.col(name).alias("v"), F.inline(F.array(*table)))
    asked = None
    for i, key, ball in probe:
        rows = prints.select(F.col(name).alias("u"), F.lit(i).alias("part"), key.alias("own"), F.explode(ball).alias("mask"))
        rows = rows.select("u", "part", F.col("own").bitwiseXOR(F.col("mask")).alias("key"))
        asked = rows if asked is None else asked.unionAll(rows)
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    hit = asked.join(filed, (asked.part == filed.part) & (asked.key == filed.key) & (F.col("u") < F.col("v")) & near)
    return hit.select("u", "v").distinct()


def groups(prints: DataFrame, doc: str = "doc_id", name: str = "f", distance: int = 4) -> DataFrame:
    """``(f, root, component)`` per distinct fingerprint: a name of its group and the smallest id in reach by links.

    ``prints`` has one row per document (id, fingerprint). Equal fingerprints meet in one row before
    any comparison, so copies cost one partial aggregate. Null ids count as larger than any id and
    give a null component only where a group has no other id.
    """
    classes = landed(prints.groupBy(name).agg(F.min(doc).alias("least")), "prints")
    roots = graph.components(links(classes, distance, name=name))
    rooted = classes.join(roots, classes[name] == roots.node, "left").select(
        classes[name], "least", F.coalesce("root", classes[name]).alias("root")
    )
    reach = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.join(reach, "root").select(name, "root", "component")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits) and ``component_id``.

    A null text has no words; texts without words share fingerprint zero and link like any other.
    Repeated rows give repeated results; other columns are not carried; an empty table gives an empty result.
    """
    prints = landed(with_fingerprint(docs.select(docs[doc].alias("id"), docs[text].alias("text")), size=size, name="f").select("id", "f"), "simhash")
    found = groups(prints, "id", distance=distance)
    return prints.join(found, "f").select(
        F.col("id").alias(doc), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4) -> DataFrame:
    """The document with the smallest id of every group, with all its columns.

    Of rows that repeat this id one stays (the least by a hash of the whole row). A group of null ids
    keeps one row. Columns must be of types that can be hashed (no maps). Whole rows are shuffled once.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc].alias("id"), docs[text].alias("text"),
        F.xxhash64(*[docs[c] for c in docs.columns]).alias("h"),
    )
    prints = landed(with_fingerprint(rows.select("id", "h", "text"), size=size, name="f").select("id", "h", "f"), "simhash")
    found = prints.join(groups(prints, "id", distance=distance), "f").where(F.col("id").eqNullSafe(F.col("component")))
    pick = found.groupBy("root").agg(F.min("h").alias("h"), F.first("id").alias("id")).select("h", "id")
    same = (rows.h == pick.h) & rows.id.eqNullSafe(pick.id)
    return rows.select("row", "id", "h").join(pick, same, "left_semi").dropDuplicates(["h", "id"]).select("row.*")
