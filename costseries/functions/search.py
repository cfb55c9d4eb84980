"""Binary search in a sorted array column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_upto(borders: Column, x: Column, size: int, below: bool = False) -> Column:
    """How many of up to ``size`` ascending borders are at most ``x`` (``below``: less than ``x``); 0 for a NULL.

    Halving steps are walked by one aggregate over a short constant array, so a row costs log2(size) comparisons and the
    expression stays small whatever the size.
    """
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(size, 1).bit_length()))])

    def walk(at: Column, step: Column) -> Column:
        border = F.get(borders, at + step - 1)
        return F.when(border < x if below else border <= x, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), walk)
