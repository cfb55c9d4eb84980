"""Hard negatives by a vertical scan: columns of the vectors are read in each anchor's order of magnitude until bounds decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costseries.llm.common import fields
from costseries.session import landed

SCALE = 256
LIMIT = 1 << 24  # components are held within this, so that 90 times the sum of 256 such products fits a long
ROWS, ANCHORS = 8192, 1024  # of one block
STEP = 8  # dimensions read between two looks at the bounds
NONE = np.iinfo(np.int64).min


def vectors(table: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", relabel: int = 7, classes: int = 10) -> DataFrame:
    """``(id, label, v)``: whole-number vectors of the rows that take part, one row per id.

    Rows with a null id, label or vector, or any null, infinite or not-a-number component, take no part. Where the id is divisible by
    ``relabel`` the label first becomes ``(label + 1) % classes``. A component x becomes ``floor(256 * x)``, held
    within ``LIMIT``. Of rows that repeat an id the least by (label, vector) counts.
    """
    rows = table.select(table[key].cast("long").alias("id"), table[label].cast("long").alias("l"), table[vector].alias("x"))
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    fit = F.forall("x", lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    moved = F.when(F.col("id") % relabel == 0, (F.col("l") + 1) % classes).otherwise(F.col("l"))
    used = rows.where(F.col("id").isNotNull() & F.col("l").isNotNull() & F.col("x").isNotNull()).where(fit)
    least = used.select("id", F.struct(moved.alias("label"), whole.alias("v")).alias("r")).groupBy("id").agg(F.min("r").alias("r"))
    return least.select("id", "r.label", "r.v")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as columns, one row of the matrix per dimension; missing dimensions count as zero."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((width, len(lengths)), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[place, owner] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Block:
    """Rows of one block, a contiguous column per dimension, with the least and largest component of each."""

    def __init__(self, table: pa.Table, width: int):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.columns = _matrix(table.column("v").combine_chunks(), width)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may matter and their exact scores.

        Dimensions are read in the anchor's descending magnitude. After every few of them ``keep`` sees lower and upper bounds of the
        scores of the rows still alive (sum so far plus the least and the most that unread dimensions can add)
        and says which rows stay. Once most rows are gone the rest is read for the living ones alone.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[: np.count_nonzero(anchor)]
        low, high = np.minimum(anchor * self.least, anchor * self.most)[order], np.maximum(anchor * self.least, anchor * self.most)[order]
        rest_low, rest_high = low.sum() - np.cumsum(low), high.sum() - np.cumsum(high)
        sums = np.zeros(len(alive), np.int64)
        for start in range(0, len(order), STEP):
            dims = order[start : start + STEP]
            everyone = len(alive) == len(self.ids)
            for d in dims:
                sums += anchor[d] * (self.columns[d] if everyone else self.columns[d][alive])
            last = start + len(dims) - 1
            stay = keep(alive, sums + rest_low[last], sums + rest_high[last])
            if not stay.all():
                alive, sums = alive[stay], sums[stay]
        return alive, sums


def _kth(values: np.ndarray, k: int) -> int:
    """The k-th largest value, or the least there is if there are fewer."""
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) > k else NONE


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first rows by descending score and ascending id."""
    if len(scores) > 4 * k:
        bound = _kth(scores, k)
        some = np.flatnonzero(scores >= bound)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def positives_in(block: Block, anchor: np.ndarray, own: int, label: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k other rows of the anchor's label in one block: ids and scores."""
    alive = np.flatnonzero((block.labels == label) & (block.ids != own))
    alive, sums = block.scan(anchor, alive, lambda _, low, high: high >= _kth(low, k))
    first = _best(block.ids[alive], sums, k)
    return block.ids[alive][first], sums[first]


def window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores s with ``low * score <= 100 * s <= high * score``, as whole-number bounds."""
    return -((-low * score) // 100), (high * score) // 100


def negatives_in(block: Block, anchor: np.ndarray, label: int, bounds: tuple[np.ndarray, np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every score window of an anchor, the first k rows of another label in one block.

    A row leaves the bitmap as soon as its bounds lie outside every window, or k other rows surely inside each window
    it may fall into surely come before it.
    """
    open_ = bounds[0] <= bounds[1]
    lows, highs = bounds[0][open_], bounds[1][open_]

    def keep(_: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), bool)
        for least, most in zip(lows, highs):
            inside = low[(low >= least) & (high <= most)]
            floor = max(int(least), _kth(inside, k) if len(inside) else NONE)
            stay |= (high >= floor) & (low <= most)
        return stay

    alive = np.flatnonzero(block.labels != label)
    alive, sums = block.scan(anchor, alive, keep) if len(lows) else (alive[:0], np.zeros(0, np.int64))
    ids, out = block.ids[alive], []
    for least, most in zip(*bounds):
        at = np.flatnonzero((sums >= least) & (sums <= most))
        at = at[_best(ids[at], sums[at], k)]
        out.append((ids[at], sums[at]))
    return out


def _grid(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors dealt to the cells of a grid of blocks, so that no task holds more than a block of either."""
    g, a = -(-n_rows // ROWS) or 1, -(-n_anchors // ANCHORS) or 1
    here, there = F.pmod(F.xxhash64("id"), F.lit(g)), F.pmod(F.xxhash64("id"), F.lit(a))
    one = rows.withColumns({"g": here, "a": F.explode(F.sequence(F.lit(0), F.lit(a - 1)).cast("array<long>"))})
    other = anchors.withColumns({"a": there, "g": F.explode(F.sequence(F.lit(0), F.lit(g - 1)).cast("array<long>"))})
    return one, other


def _width(*tables: pa.Table) -> int:
    return max(pc.max(pc.list_value_length(t.column("v"))).as_py() for t in tables)


def _vectors(table: pa.Table, width: int) -> Iterator[tuple]:
    columns = _matrix(table.column("v").combine_chunks(), width)
    others = [table.column(c).to_pylist() for c in table.column_names if c in ("id", "label", "positives", "scores")]
    yield from zip(*others, columns.T.copy())


def _positives(rows: DataFrame, anchors: DataFrame, n: tuple[int, int], k: int) -> DataFrame:
    """``(anchor, label, v, positives, scores)``: every anchor with its first k other rows of the same label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            width = _width(left, right)
            block = Block(left, width)
            for own, label, vector in _vectors(right.select(["id", "label", "v"]), width):
                ids, scores = positives_in(block, vector, own, label, k)
                out += [(own, int(i), int(s)) for i, s in zip(ids, scores)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=["anchor", "id", "score"])

    one, other = _grid(rows, anchors, *n)
    found = one.groupBy("g", "a").cogroup(other.groupBy("g", "a")).applyInArrow(run, "anchor long, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    first = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    lists = first.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    joined = lists.join(anchors, lists.anchor == anchors.id)
    return joined.select("id", "label", "v", F.col("p.id").alias("positives"), F.col("p.score").alias("scores"))


def mine(
    table: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = 100, positives: int = 5,
    negatives: int = 10, low: int = 30, high: int = 90, relabel: int = 7, classes: int = 10,
) -> DataFrame:
    """Hard negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. Scores are whole-number inner products; higher ones come first,
    ties by smaller id. An anchor's positives are its first ``positives`` other rows of its label (all, if fewer). For each of them the first
    ``negatives`` rows of another label with ``low * positive_score <= 100 * negative_score <= high * positive_score`` are returned
    (a negative positive score leaves no room and gives none). Which rows take part says ``vectors``; vectors of different
    lengths are filled with zeros. Other columns are not carried; an empty table gives an empty result.

    Rows and anchors meet in a grid of blocks of bounded size, all anchors against all rows; every cell scans its rows
    column-wise (``Block.scan``) and returns the first few rows per anchor, which are merged by rank.
    """
    rows = landed(vectors(table, key, label, vector, relabel, classes), "vectors")
    anchors = rows.where(F.pmod(F.col("id"), F.lit(every)) == 0)
    n = tuple(rows.agg(F.count(F.lit(1)), F.count_if(F.pmod(F.col("id"), F.lit(every)) == 0)).first())
    asked = landed(_positives(rows, anchors, n, positives), "positives")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            width = _width(left, right)
            block = Block(left, width)
            for own, kind, ids, scores, v in _vectors(right.select(["id", "label", "positives", "scores", "v"]), width):
                bounds = window(np.array(scores, np.int64), low, high)
                for place, (found, values) in enumerate(negatives_in(block, v, kind, bounds, negatives)):
                    out += [(own, ids[place], int(i), scores[place], int(s)) for i, s in zip(found, values)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], names=schema.names)

    schema = fields("anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    one, other = _grid(rows, asked, *n)
    found = one.groupBy("g", "a").cogroup(other.groupBy("g", "a")).applyInArrow(run, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def sql() -> str:
    """The query's rows in DuckDB."""
    return """
    WITH used AS (
        SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same,
            list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
        FROM used a JOIN used b ON a.id % 100 = 0 AND a.id <> b.id),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER w <= 10"""
