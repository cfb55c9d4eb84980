"""Exact selection by rank in groups of any size, by narrowing histograms instead of sorting.

Every read of the table counts the values of a group into cells of a non-decreasing function; only the cell
that holds the wanted rank is looked at again, with finer cells. Counting is a partial aggregate, so a key with all rows is
spread over all tasks and no task orders a group. Three reads decide every double:

1. cells of equal ratio (2,048 to a doubling), which outliers cannot blunt;
2. a million equal cells inside the cell found;
3. the distinct values inside that one, of which about two million can exist.

A cell whose values are all equal is an answer at once, so prices and counts seldom need the third read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import landed
from .joins import null_safe_join

STEPS = 2048  # cells to a doubling in the first read, and cells listed together in all
OCTAVES = 2200  # doublings on either side of zero, with room
FEW = 10_000  # open targets up to which they are broadcast to the rows


def ratio_cell(v: Column) -> Column:
    """Cell of a double on a scale of equal ratios, never decreasing; zero, infinities and NaN have cells of their own."""
    size = F.floor(F.log2(F.abs(v)) * STEPS) + F.lit(1100 * STEPS)
    edge = F.lit(OCTAVES * STEPS)
    infinite = F.abs(v) == float("inf")
    return (
        F.when(F.isnan(v), edge + 1)
        .when(infinite, F.when(v > 0, edge).otherwise(-edge))
        .when(v == 0, F.lit(0))
        .otherwise(F.when(v > 0, size).otherwise(-size))
        .cast("bigint")
    )


def even_cell(v: Column, low: Column, high: Column, cells: int) -> Column:
    """Cell of a value between two others, never decreasing; halves keep their difference finite."""
    share = (v / 2 - low / 2) / (high / 2 - low / 2)
    return F.least(F.floor(share * cells), F.lit(cells - 1)).cast("bigint")


def _runs(rows: DataFrame, groups: Sequence[str], run: Column, cell: Column) -> DataFrame:
    """Count, least and largest value per cell, listed per run of cells; ``run`` never decreases with ``cell``."""
    counted = rows.groupBy(*groups, run.alias("_run"), cell.alias("_cell"))
    cells = counted.agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    listed = F.sort_array(F.collect_list(F.struct("_cell", "_c", "_low", "_high")))
    return cells.groupBy(*groups, "_run").agg(F.sum("_c").alias("_sum"), listed.alias("_cells"))


def _found(runs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The cell that holds each group's ``_rank``: its least and largest value, and the rank inside it."""
    w = Window.partitionBy(*groups).orderBy("_run").rowsBetween(Window.unboundedPreceding, 0)
    rest = F.col("_rank") - (F.sum("_sum").over(w) - F.col("_sum"))
    hit = runs.withColumn("_rest", rest).filter((F.col("_rest") >= 0) & (F.col("_rest") < F.col("_sum")))
    none = F.lit(None).cast("double")

    def state(rest: Column, low: Column, high: Column) -> Column:
        return F.struct(rest.alias("rest"), low.alias("low"), high.alias("high"))

    def walk(at: Column, cell: Column) -> Column:
        here = state(at["rest"], cell["_low"], cell["_high"])
        passed = state(at["rest"] - cell["_c"], none, none)
        return F.when(at["low"].isNotNull(), at).when(at["rest"] < cell["_c"], here).otherwise(passed)

    at = hit.withColumn("_at", F.aggregate("_cells", state(F.col("_rest"), none, none), walk))
    kept = [g for g in groups if g != "_rank"]
    return at.select(*kept, *[F.col(f"_at.{a}").alias(b) for a, b in (("rest", "_rank"), ("low", "_low"), ("high", "_high"))])


def select_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Mapping[str, Column]) -> DataFrame:
    """``(keys, _n, names…)``: per key its number of values and, for every named rank, the value at that place in ascending order.

    A rank is a column over ``_n``, counted from 0. Nulls take no part, NaN comes last; a key without values gives no row.
    Works at once: the cells found are written to the shared folder after each of at most three reads of the table. Histograms are
    shuffled, never rows, unless more than ``FEW`` targets are open and the table is joined to them by key.
    """
    values = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    cell = ratio_cell(F.col("_v"))
    runs = _runs(values, keys, F.floor(cell / F.lit(STEPS)), cell)
    sized = runs.withColumn("_n", F.sum("_sum").over(Window.partitionBy(*keys)))
    asked = sized.withColumn("_target", F.explode(F.array_distinct(F.array(*[r.cast("bigint") for r in ranks.values()]))))
    targets = [*keys, "_n", "_target"]
    known = landed(_found(asked.withColumn("_rank", F.col("_target")), [*targets, "_rank"]), "selection")
    low, high = F.col("_low"), F.col("_high")
    done = known.filter(~(low < high))
    for finer in (True, False):
        open_ = known.filter(low < high)
        n = open_.count()
        if not n:
            break
        near = null_safe_join(values, F.broadcast(open_) if n <= FEW else open_, keys).filter(F.col("_v").between(low, high))
        if finer:
            cell = even_cell(F.col("_v"), low, high, 512 * STEPS)
            runs = _runs(near, [*targets, "_rank"], F.floor(cell / F.lit(STEPS)), cell)
        else:
            runs = _runs(near, [*targets, "_rank"], even_cell(F.col("_v"), low, high, STEPS), F.col("_v"))
        known = landed(_found(runs, [*targets, "_rank"]), "selection")
        done = done.unionByName(known.filter(~(low < high)))
    picked = [F.max(F.when(F.col("_target") == r.cast("bigint"), low)).alias(name) for name, r in ranks.items()]
    return done.groupBy(*keys, "_n").agg(*picked)


def quantiles_exact(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles per key, for groups of any size (see ``select_ranks``)."""
    place = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in probs.items()}
    ranks = {f"_{side}{name}": f(r) for name, r in place.items() for side, f in (("lo", F.floor), ("hi", F.ceil))}
    out = select_ranks(df, keys, value, ranks)

    def between(name: str) -> Column:
        below, above, share = F.col(f"_lo{name}"), F.col(f"_hi{name}"), place[name] - F.floor(place[name])
        return F.when(below == above, below).otherwise(below + (above - below) * share)

    return out.select(*keys, *[between(name).alias(name) for name in probs])
