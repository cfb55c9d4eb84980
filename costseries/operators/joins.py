"""Joins. No side is force-broadcast: Catalyst and AQE broadcast a side whose measured size is
below the threshold and otherwise shuffle it, splitting skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.search import count_upto


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that matches NULL keys with each other, as grouping and dedup do (inner, left, semi or anti)."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    out = left.join(renamed, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def inner_equi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "inner")


def ratio_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], part: str, whole: str, name: str = "ratio_pct"
) -> DataFrame:
    """Join two measures on their keys and give one as percent of the other."""
    ratio = F.try_divide(F.col(part), F.col(whole)) * 100
    return left.join(right, list(keys), "inner").withColumn(name, ratio)


def full_outer_compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides on the key, unmatched rows kept."""
    return left.join(right, list(keys), "full")


def lookup_left(
    df: DataFrame, ref: DataFrame, keys: Sequence[str], defaults: Mapping[str, Column]
) -> DataFrame:
    """Left join; each reference column falls back to its default expression."""
    out = df.join(ref, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def anti_new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target does not have."""
    return batch.join(target.select(*keys), list(keys), "left_anti")


def semi_matching(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(wanted.select(*keys), list(keys), "left_semi")


def cross_product(left: DataFrame, right: DataFrame) -> DataFrame:
    """Scaffold with one row per member pair of two dimensions.

    The pairs are the requested result (for example methods by places), so the output has
    exactly |left| x |right| rows; use it on dimensions, not on facts.
    """
    return left.join(right)


def scalar_baseline(df: DataFrame, where: Column, value: str) -> Column:
    """Value of one reference row as a scalar subquery usable in any expression over ``df``.

    The row is picked inside the aggregate, not by a filter, so that the subquery shares the
    shuffles of ``df`` instead of planning its inputs a second time.
    """
    return df.agg(F.max(F.when(where, F.col(value)))).scalar()


CELLS = 512  # between quantiles of either side


def cell_borders(df: DataFrame, value: str, bands: DataFrame, low: str, high: str) -> list[float]:
    """Ascending borders at approximate quantiles of the values and of the bounds, some 1,000 numbers.

    A value that many rows share is the quantile of many marks and so appears as often among the borders.
    """
    marks = F.array(*[F.lit(i / CELLS) for i in range(CELLS + 1)])
    sides = [df.select(F.col(value), F.lit(True))] + [bands.select(F.col(c), F.lit(False)) for c in (low, high)]
    both = reduce(DataFrame.unionAll, [s.toDF("x", "row") for s in sides]).withColumn("x", F.col("x").cast("double"))
    found = both.agg(*[F.percentile_approx(F.when(side, F.col("x")), marks, F.lit(10 * CELLS)) for side in (F.col("row"), ~F.col("row"))]).first()
    return sorted(x for side in found for x in side or () if x == x)


def _spread(df: DataFrame) -> Column:
    """A number of each row that depends on its contents alone."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])


def band_cells(
    df: DataFrame, value: str, bands: DataFrame, low: str, high: str, borders: list[float]
) -> tuple[DataFrame, DataFrame]:
    """Rows with the cell ``_at`` of their value, bands once per ``_cell`` that they touch.

    Values that equal a border may go to any cell that touches it: a value shared by a third of the rows has a third of
    the borders, its rows are dealt over the empty cells between those, and the bands around it are listed under all of them.
    Rows without a value get cells that no band has.
    """
    edges, size = F.lit(borders).cast("array<double>"), len(borders)
    x, salt = F.col(value).cast("double"), _spread(df)
    first, last = count_upto(edges, x, size, below=True), count_upto(edges, x, size)
    cell = F.when(x.isNull(), -1 - F.pmod(salt, F.lit(CELLS))).otherwise(first + F.pmod(salt, last - first + 1))
    placed = df.withColumn("_at", cell.cast("bigint"))
    begin = F.coalesce(count_upto(edges, F.col(low).cast("double"), size, below=True), F.lit(0))
    end = F.when(F.col(high).isNull(), F.lit(size)).otherwise(count_upto(edges, F.col(high).cast("double"), size))
    listed = bands.withColumns({"_first": begin, "_last": end}).filter("_first <= _last")
    listed = listed.withColumn("_cell", F.explode(F.sequence(F.col("_first").cast("bigint"), F.col("_last").cast("bigint"))))
    return placed, listed.drop("_first", "_last")


def band_lookup(
    df: DataFrame, value: str, bands: DataFrame, low: str, high: str, closed: bool = False, how: str = "left"
) -> DataFrame:
    """Join rows to the bands with ``low <= value < high`` (``closed``: ``<= high``); NULL is open.

    A range condition alone would compare every pair. Here the number line is cut at quantiles of both sides
    (``cell_borders``, read at once), rows look up their own cell, bands are listed under the cells they touch, and
    the exact bounds are checked on that equi-join. Outliers and repeated values don't fill a cell.
    """
    placed, listed = band_cells(df, value, bands, low, high, cell_borders(df, value, bands, low, high))
    under = F.col(value) <= F.col(high) if closed else F.col(value) < F.col(high)
    in_band = (
        (F.col("_at") == F.col("_cell"))
        & (F.col(low).isNull() | (F.col(value) >= F.col(low)))
        & (F.col(high).isNull() | under)
    )
    return placed.join(listed, in_band, how).drop("_at", "_cell")


def explode_list(df: DataFrame, col: str, name: str, sep: str = ",") -> DataFrame:
    """One row per entry of a separated list in a cell; blank entries are dropped."""
    entry = F.explode(F.split(F.col(col), sep))
    return df.withColumn(name, entry).withColumn(name, F.trim(name)).filter(F.col(name) != "")


def list_membership(df: DataFrame, key: str, lists: DataFrame, list_col: str, sep: str = ",") -> DataFrame:
    """Rows joined to every list that names their key."""
    return df.join(explode_list(lists, list_col, "_entry", sep), F.col(key) == F.col("_entry")).drop("_entry")


def fill_missing_from(df: DataFrame, ref: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Fill only NULL or zero cells from the reference; ``fill_status`` says what happened."""
    r = ref.select(*keys, *[F.col(c).alias(f"_ref_{c}") for c in cols])
    out = df.join(r, list(keys), "left")
    missing = {c: F.col(c).isNull() | (F.col(c) == 0) for c in cols}
    usable = {c: F.coalesce(F.col(f"_ref_{c}") != 0, F.lit(False)) for c in cols}
    updated = F.lit(False)
    lacking = F.lit(False)
    for c in cols:
        updated = updated | (missing[c] & usable[c])
        lacking = lacking | (missing[c] & ~usable[c])
    status = F.when(updated, "updated").when(lacking, "no_data").otherwise("kept")
    out = out.withColumn("fill_status", status)
    out = out.withColumns({c: F.when(missing[c] & usable[c], F.col(f"_ref_{c}")).otherwise(F.col(c)) for c in cols})
    return out.select(*df.columns, "fill_status")


def parent_code_lookup(
    df: DataFrame, code: str, parents: DataFrame, parent_code: str, digits: int = 2
) -> DataFrame:
    """Join a place to its parent, whose code is the first digits of the place's code."""
    prefix = F.substring(F.col(code).cast("string"), 1, digits)
    return df.join(parents, prefix == F.col(parent_code).cast("string"), "left")
