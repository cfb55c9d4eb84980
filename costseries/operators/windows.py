"""Ordered and partition-wide operators over series.

Two shapes of input are told apart:

* *period tables*: one row per key and period. A key then has at most as many rows as the
  calendar has periods, so a plain window per key is small, however skewed the raw data was.
* *raw tables*: a key may hold any number of rows. Ordered operators then take ``chunk``, a
  non-decreasing function of the order column (``row_chunk`` and ``even_chunk`` make one). Each (key, chunk) is windowed on its own; what it
  needs from earlier chunks is put in front of it as a few extra rows, found with one row (or
  ``n`` rows, for a lag of n) per chunk. The table itself is shuffled once.
  Partition-wide statistics are aggregated map-side and joined back, never windowed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.search import count_upto
from .joins import null_safe_join

CHUNK, EXTRA = "_chunk", "_extra"


ROWS_PER_CHUNK = 500_000


def _number(df: DataFrame, order: str, c: Column) -> Column:
    """Position of an order value on the number line."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    return c.cast("double")


def even_chunk(df: DataFrame, order: str, rows: int = ROWS_PER_CHUNK) -> Column:
    """Chunk number that cuts the span of ``order`` into equal parts of about ``rows`` rows.

    Count and span are one scalar subquery over the single column.
    """
    low, high = _number(df, order, F.min(order)), _number(df, order, F.max(order))
    span = df.agg(F.struct(low.alias("low"), (high - low).alias("width"), F.count(order).alias("n"))).scalar()
    position = F.try_divide(_number(df, order, F.col(order)) - span["low"], span["width"])
    return F.coalesce(F.floor(position * F.ceil(span["n"] / rows)), F.lit(0))


CELLS = 1024


def row_chunk(df: DataFrame, order: str, rows: int = ROWS_PER_CHUNK, keys: Sequence[str] = ()) -> Column:
    """Chunk number that cuts ``order`` into parts of about ``rows`` rows of the largest key.

    The cuts follow approximate quantiles of the order column, so late outliers or busy days don't fill
    one chunk; rows of the same instant stay together. Without ``keys`` all rows count as one key; with
    them, keys that all have few rows get a single chunk. The cuts, some 1,000 numbers, and the largest count are read
    at once and become constants, so the table is not read again wherever the chunk is used.
    """
    marks = F.array(*[F.lit(i / CELLS) for i in range(CELLS + 1)])
    cuts = F.percentile_approx(_number(df, order, F.col(order)), marks, F.lit(10 * CELLS))
    borders = df.agg(cuts).first()[0]
    largest = df.groupBy(*keys).agg(F.count(order).alias("n")).agg(F.max("n")).first()[0] or 0
    wanted = -(-largest // rows)
    if borders is None or wanted <= 1:
        return F.lit(0).cast("bigint")
    edges, x = F.lit(borders), _number(df, order, F.col(order))
    cell = F.greatest(count_upto(edges, x, len(borders), below=True) - 1, F.lit(0))
    low, high = F.get(edges, cell), F.get(edges, cell + 1)
    inside = F.coalesce(F.least(F.try_divide(x - low, high - low), F.lit(1.0)), F.lit(0.0))
    return F.coalesce(F.least(F.floor((cell + inside) / CELLS * wanted), F.lit(wanted - 1)), F.lit(0)).cast("bigint")


def fill_forward(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: str, chunk: Column | None = None
) -> DataFrame:
    """Carry the last non-null value of each column downwards within the key."""
    to_here = (Window.unboundedPreceding, Window.currentRow)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(*to_here)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})

    chunked = df.withColumn(CHUNK, chunk)
    ends = chunked.groupBy(*keys, CHUNK).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, CHUNK, *[F.last(c, ignorenulls=True).over(before).alias(c) for c in cols])
    rows = _in_front(chunked, carried)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(F.col(EXTRA).desc(), order).rowsBetween(*to_here)
    filled = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    return filled.filter(~F.col(EXTRA)).select(*df.columns)


def _in_front(chunked: DataFrame, extra: DataFrame) -> DataFrame:
    """Add rows that only serve the window of their chunk, marked to sort first and be dropped."""
    marked = extra.withColumn(EXTRA, F.lit(True))
    return chunked.withColumn(EXTRA, F.lit(False)).unionByName(marked, allowMissingColumns=True)


def with_lags(
    df: DataFrame,
    lags: Mapping[str, tuple[str, int]],
    keys: Sequence[str],
    order: str,
    chunk: Column | None = None,
) -> DataFrame:
    """Add ``name = value n rows earlier`` for every ``name: (column, n)``; one sort for all of them."""
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({name: F.lag(c, n).over(w) for name, (c, n) in lags.items()})

    depth = max(n for _, n in lags.values())
    sources = sorted({c for c, _ in lags.values()} - {order})
    chunked = df.withColumn(CHUNK, chunk)
    rows = _in_front(chunked, _lead_in(chunked, keys, order, sources, depth))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    lagged = rows.withColumns({name: F.lag(c, n).over(inside) for name, (c, n) in lags.items()})
    return lagged.filter(~F.col(EXTRA)).select(*df.columns, *lags)


def _lead_in(
    chunked: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], depth: int, pad: bool = False
) -> DataFrame:
    """For every chunk, the ``depth`` rows of the key before it (``pad``: their one value filled).

    Each task keeps the last rows per chunk before the shuffle, so only a few rows per chunk move.
    """
    slim = chunked.select(*keys, CHUNK, order, *cols)
    newest = Window.partitionBy(*keys, CHUNK).orderBy(F.desc(order))

    def last_rows(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")

    tails = last_rows(slim, depth)
    if pad:
        # of depth + 1 known values at least one is older than all tail rows, if there is any
        (value,) = cols
        known = last_rows(slim.filter(F.col(value).isNotNull()), depth + 1)
        both = tails.withColumn("_tail", F.lit(True)).unionByName(known.withColumn("_tail", F.lit(False)))
        unique = both.groupBy(*keys, CHUNK, order, value).agg(F.max("_tail").alias("_tail"))
        to_here = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        filled = unique.withColumn(value, F.last(value, ignorenulls=True).over(to_here))
        tails = filled.filter("_tail").drop("_tail")
    per_chunk = tails.groupBy(*keys, CHUNK).agg(F.sort_array(F.collect_list(F.struct(order, *cols))).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-depth, -1)
    listed = per_chunk.withColumn("_before", F.flatten(F.collect_list("_rows").over(earlier)))
    nearest = F.explode(F.slice(F.reverse("_before"), 1, depth)).alias("_p")
    return listed.select(*keys, CHUNK, nearest).select(*keys, CHUNK, f"_p.{order}", *[f"_p.{c}" for c in cols])


def padded_lags(
    df: DataFrame,
    value: str,
    lags: Mapping[str, int],
    keys: Sequence[str],
    order: str,
    pad: bool = True,
    chunk: Column | None = None,
    name: str = "_v",
    previous: str | None = None,
) -> DataFrame:
    """Add the value with gaps filled forward (``name``) and its lags; one shuffle and one sort.

    ``previous`` adds the order value of the row before, in the same pass.
    """
    rows = df.withColumn(name, F.col(value))
    by = list(keys)
    if chunk is not None:
        chunked = rows.withColumn(CHUNK, chunk)
        rows = _in_front(chunked, _lead_in(chunked, keys, order, [name], max(lags.values()), pad))
        by = [*keys, CHUNK]
    w = Window.partitionBy(*by).orderBy(order)
    if pad:
        rows = rows.withColumn(name, F.last(name, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumns({m: F.lag(name, n).over(w) for m, n in lags.items()})
    added = [name, *lags]
    if previous:
        rows, added = rows.withColumn(previous, F.lag(order).over(w)), [*added, previous]
    if chunk is not None:
        rows = rows.filter(~F.col(EXTRA))
    return rows.select(*df.columns, *added)


def growth(current: Column, previous: Column, scale: float = 100.0) -> Column:
    """``(current / previous - 1) * scale``; NULL when the base is NULL or zero."""
    return (F.try_divide(current, previous) - 1) * scale


def pct_change(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    periods: Mapping[str, int],
    pad: bool = True,
    scale: float = 100.0,
    chunk: Column | None = None,
    gap_days: str | None = None,
) -> DataFrame:
    """Positional change against ``n`` rows earlier for each ``name: n``.

    ``pad`` carries the last known value over missing ones first, so a gap reads as no change.
    ``gap_days`` names a column for the days since the row before.
    """
    lagged = padded_lags(
        df, value, {f"_lag_{m}": n for m, n in periods.items()}, keys, order, pad, chunk, previous="_previous" if gap_days else None
    )
    changes = {m: growth(F.col("_v"), F.col(f"_lag_{m}"), scale) for m in periods}
    if gap_days:
        changes[gap_days] = F.datediff(order, "_previous")
    return lagged.withColumns(changes).select(*df.columns, *changes)


def mom_yoy(df: DataFrame, keys: Sequence[str], order: str, value: str, **options) -> DataFrame:
    return pct_change(df, keys, order, value, {"mom": 1, "yoy": 12}, **options)


# fixed values: rows back for the daily, monthly and yearly change of each frequency
VARIATION_STEPS = {
    "daily": {"var_day": 1, "var_month": 30, "var_year": 252},
    "daily_21": {"var_day": 1, "var_month": 21, "var_year": 252},
    "monthly": {"var_month": 1, "var_year": 12},
}


def variations(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    freq: str,
    daily_preset: str = "daily",
    chunk: Column | None = None,
) -> DataFrame:
    """Daily, monthly and yearly change per row; ``freq`` holds ``daily`` or ``monthly``."""
    daily, monthly = VARIATION_STEPS[daily_preset], VARIATION_STEPS["monthly"]
    steps = sorted({*daily.values(), *monthly.values()})
    changed = pct_change(df, keys, order, value, {f"_c{n}": n for n in steps}, chunk=chunk)
    is_daily = F.col(freq) == "daily"

    def pick(name: str) -> Column:
        slow = F.col(f"_c{monthly[name]}") if name in monthly else F.lit(None).cast("double")
        return F.when(is_daily, F.col(f"_c{daily[name]}")).otherwise(slow)

    return changed.withColumns({m: pick(m) for m in daily}).select(*df.columns, *daily)


def month_index(date: str) -> Column:
    return F.year(date) * 12 + F.month(date)


def calendar_change(
    df: DataFrame, keys: Sequence[str], date: str, value: str, periods: Mapping[str, int]
) -> DataFrame:
    """Change against the row exactly ``n`` months earlier; a gap gives NULL (monthly period table).

    A one-month range frame reads the base, so all periods share one sort and nothing is joined.
    """
    w = Window.partitionBy(*keys).orderBy(month_index(date))
    return df.withColumns(
        {m: growth(F.col(value), F.max(value).over(w.rangeBetween(-n, -n))) for m, n in periods.items()}
    )


def diff_days(
    df: DataFrame, keys: Sequence[str], date: str, name: str = "gap_days", chunk: Column | None = None
) -> DataFrame:
    """Days since the previous observation of the key."""
    lagged = with_lags(df, {"_prev_date": (date, 1)}, keys, date, chunk)
    return lagged.withColumn(name, F.datediff(date, "_prev_date")).drop("_prev_date")


def lag_growth(df: DataFrame, key: str, order: str, value: str, digits: int = 2) -> DataFrame:
    """Month growth per key written with SQL ``LAG``; input is a period table."""
    return df.sparkSession.sql(
        f"""SELECT *, round((try_divide({value}, lag({value}) OVER (PARTITION BY {key} ORDER BY {order}))
                             - 1) * 100, {digits}) AS growth
            FROM {{src}}""",
        src=df,
    )


def group_stats_back(
    df: DataFrame, keys: Sequence[str], exprs: Mapping[str, Column], period_table: bool = False
) -> DataFrame:
    """Attach group aggregates to every row.

    Raw tables: aggregate (partial sums before the shuffle) and join back, so that a key with
    a third of all rows is spread by the join's skew handling. Period tables: one window.
    """
    if period_table:
        w = Window.partitionBy(*keys)
        return df.withColumns({n: e.over(w) for n, e in exprs.items()})
    stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in exprs.items()])
    return null_safe_join(df, stats, keys, "left")


def share_of_total(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "share_pct", period_table: bool = False
) -> DataFrame:
    """Value as percent of its group total."""
    out = group_stats_back(df, keys, {"_total": F.sum(value)}, period_table)
    return out.withColumn(name, F.try_divide(F.col(value), F.col("_total")) * 100).drop("_total")


def zscore(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "zscore", period_table: bool = False
) -> DataFrame:
    """Absolute population z-score; NULL below three points or without variation."""
    stats = {"_avg": F.avg(value), "_sd": F.stddev_pop(value), "_n": F.count(value)}
    out = group_stats_back(df, keys, stats, period_table)
    z = F.when(
        (F.col("_n") >= 3) & (F.col("_sd") > 0), F.abs((F.col(value) - F.col("_avg")) / F.col("_sd"))
    )
    return out.withColumn(name, z).drop("_avg", "_sd", "_n")


def ytd_12m_change(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """12-month change and change since the previous December (monthly period table).

    The twelve months before a row hold exactly one December, which is the base of the year.
    """
    w = Window.partitionBy(*keys).orderBy(month_index(date))
    december = F.max(F.when(F.month(date) == 12, F.col(value))).over(w.rangeBetween(-12, -1))
    return df.withColumns(
        {
            "chg_12m": growth(F.col(value), F.lag(value, 12).over(w)),
            "chg_ytd": growth(F.col(value), december),
        }
    )
