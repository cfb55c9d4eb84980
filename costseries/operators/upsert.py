"""Deduplication, upsert and set operations on business keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import br_number, parse_date_multi
from ..functions.keys import business_key
from . import ranks, windows
from .joins import null_safe_join


def _row_tie(df: DataFrame) -> Column:
    """Deterministic tie-breaker: hash of the row content."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "last", strict: bool = False
) -> DataFrame:
    """Newest (or oldest) row per key; a table without the key columns comes back as it is, or is refused if ``strict``.

    The rank filter lets Spark keep one row per key in each task before the shuffle, so a key
    repeated in a third of the table stays cheap.
    """
    if strict:
        require_columns(df, [*keys, *order])
    if not set(keys) <= set(df.columns):
        return df
    present = [c for c in order if c in df.columns]
    by = [F.desc(c) if keep == "last" else F.asc(c) for c in present]
    w = Window.partitionBy(*keys).orderBy(*by, _row_tie(df))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the rows a dedup would remove, without writing anything."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_removed"),
    )


def dedup_keep(df: DataFrame, keys: Sequence[str], priority: str, keep: str = "last") -> DataFrame:
    """One row per key chosen by an explicit priority (source order)."""
    return dedup_latest(df, keys, [priority], keep)


def dedup_full_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of the keys that occur more than once, with the group size."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_copies")).filter("n_copies > 1")
    return null_safe_join(df, repeated, keys)


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch's newest row per key.

    Only keys travel to the target side, and a small batch is broadcast by its measured
    size, in which case the target is not shuffled at all. Running it twice changes nothing.
    """
    require_columns(batch, target.columns)
    incoming = dedup_latest(batch.select(*target.columns), keys, order)
    kept = null_safe_join(target, batch.select(*keys), keys, "left_anti")
    return kept.unionByName(incoming)


def upsert_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing, new, updated and final row counts of an upsert (also its dry run)."""
    t = target.select(*keys, F.lit(1).alias("_t"), F.lit(0).alias("_b"))
    b = batch.select(*keys, F.lit(0).alias("_t"), F.lit(1).alias("_b"))
    both = t.unionByName(b).groupBy(*keys).agg(F.sum("_t").alias("_t"), F.sum("_b").alias("_b"))  # NULL keys meet
    in_t, in_b = F.col("_t") > 0, F.col("_b") > 0
    return both.agg(
        F.coalesce(F.sum("_t"), F.lit(0)).alias("n_existing"),
        F.count_if(in_b & ~in_t).alias("n_new"),
        F.count_if(in_b & in_t).alias("n_updated"),
        F.coalesce(F.sum(F.when(in_b, F.lit(1)).otherwise(F.col("_t"))), F.lit(0)).alias("n_final"),
    )


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows with a new key, one per key."""
    fresh = null_safe_join(batch, target.select(*keys), keys, "left_anti")
    return dedup_latest(fresh, keys)


REACH = 12  # rows back that the yearly change looks


def series_changes(target: DataFrame, batch: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """The rows that a batch of observations changes in a target with stored changes: ``fact_id``, observation, MoM and YoY.

    These are the inserted and revised rows and the up to ``REACH`` rows behind each whose base is another one now. Only series of the batch
    and, of those, rows from ``REACH`` known values before the first changed one on are read into the windows; a
    revision that repeats the stored value changes nothing.
    """
    require_columns(batch, [series, date, value])
    base = [series, date, value]
    incoming = dedup_latest(batch.select(*base), [series, date])
    stored = target.select(*base, "mom", "yoy")
    touched = null_safe_join(stored, incoming.select(series).distinct(), [series], "left_semi")
    own = touched.select(series, date, F.col(value).alias("_old"), F.col("mom").alias("_mom"), F.col("yoy").alias("_yoy"), F.lit(True).alias("_stored"))
    fresh = null_safe_join(incoming, own, [series, date], "left")
    differs = F.col("_stored").isNull() | ~F.col(value).eqNullSafe(F.col("_old"))
    fresh = fresh.withColumn("_changed", differs)
    # Bases before the first change: the last REACH known values, or all there are.
    start = fresh.filter("_changed").groupBy(series).agg(F.min(date).alias("_from"))
    before = null_safe_join(touched, start, [series])
    old = before.filter(F.col(date) < F.col("_from")).filter(F.col(value).isNotNull())
    w = Window.partitionBy(series).orderBy(F.desc(date))
    lead_in = old.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= REACH)
    edge = lead_in.groupBy(series).agg(F.min(date).alias("_edge"))
    near = null_safe_join(before, edge, [series], "left")
    near = near.filter(F.col("_edge").isNull() | (F.col(date) >= F.col("_edge")))
    kept = null_safe_join(near, incoming.select(series, date), [series, date], "left_anti")
    kept = kept.select(*base, F.col("mom").alias("_mom"), F.col("yoy").alias("_yoy"), F.lit(True).alias("_stored"), F.lit(False).alias("_changed"), "_from")
    fresh = null_safe_join(fresh, start, [series]).select(*kept.columns)
    rows = kept.unionByName(fresh)
    judged = windows.mom_yoy(rows, [series], date, value).filter(F.col(date) >= F.col("_from"))
    moved = ~F.col("mom").eqNullSafe(F.col("_mom")) | ~F.col("yoy").eqNullSafe(F.col("_yoy"))
    out = judged.filter(F.col("_changed") | moved).withColumn("fact_id", business_key(F.col(series), F.col(date)))
    return out.select("fact_id", *base, "mom", "yoy")


def upsert_series(
    target: DataFrame, batch: DataFrame, series: str, date: str, value: str, recompute: str = "full"
) -> DataFrame:
    """Upsert observations of many series and compute MoM and YoY.

    ``full`` gives the changes over the merged history, so the first row of a re-ingested window keeps its base. Where the
    target has stored changes, only what the batch reaches is computed (``series_changes``) and takes the place of the stored rows.
    ``batch`` computes them over the batch alone and leaves stored rows.
    Input has one row per series and date, so history per series is bounded by the calendar.
    """
    require_columns(batch, [series, date, value])

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("fact_id", business_key(F.col(series), F.col(date)))

    if recompute == "batch":
        fresh = windows.mom_yoy(keyed(batch), [series], date, value)
        stored = keyed(target)
        for c in ("mom", "yoy"):
            if c not in stored.columns:
                stored = stored.withColumn(c, F.lit(None).cast("double"))
        return upsert(stored.select(*fresh.columns), fresh, [series, date])
    base = [series, date, value]
    if {"mom", "yoy"} <= set(target.columns):
        changed = series_changes(target, batch, series, date, value)
        kept = null_safe_join(keyed(target).select(*changed.columns), changed.select(series, date), [series, date], "left_anti")
        return kept.unionByName(changed)
    merged = upsert(target.select(*base), batch.select(*base), [series, date])
    return windows.mom_yoy(keyed(merged), [series], date, value)


def upsert_registry(
    tables: Mapping[str, tuple[DataFrame, DataFrame]], conflict_keys: Mapping[str, Sequence[str]]
) -> dict[str, DataFrame]:
    """Upsert every registered table by its own key, dimensions before facts."""
    unknown = set(tables) - set(conflict_keys)
    if unknown:
        raise KeyError(f"no conflict key registered for: {', '.join(sorted(unknown))}")
    ordered = sorted(tables, key=lambda t: (not t.startswith("dim_"), list(conflict_keys).index(t)))
    return {t: upsert(*tables[t], conflict_keys[t]) for t in ordered}


def union_tagged(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables, each tagged with its name; absent columns become NULL."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def set_diff_keys(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys missing from or unexpected in ``found``."""
    sides = expected.select(key, F.lit(1).alias("_side")).unionByName(found.select(key, F.lit(2).alias("_side")))
    sides = sides.groupBy(key).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))  # NULL keys meet
    status = F.when(F.col("_hi") == 1, "missing").when(F.col("_lo") == 2, "unexpected")
    return sides.select(key, status.alias("status")).filter("status IS NOT NULL")


@dataclass(frozen=True)
class CostSource:
    """Where one source keeps the fields of the cost fact; ``regime=None`` reads it from the kind."""

    df: DataFrame
    value: str
    source: str
    date: str = "ref_date"
    place: str | None = "place"
    kind: str | None = "kind"
    regime: str | None = None
    default_kind: str = "R8-N"


def _text_or(df: DataFrame, col: str | None, default: str) -> Column:
    if col is None or col not in df.columns:
        return F.lit(default)
    return F.coalesce(F.nullif(F.trim(F.col(col)), F.lit("")), F.lit(default))


def consolidate_cost(sources: Sequence[CostSource], numbered: bool = True) -> DataFrame:
    """Several cost tables of text to one typed fact.

    Dates and numerals are parsed, blanks get defaults, the later source wins on equal keys,
    non-positive values are dropped, and rows are numbered in key order.
    """
    parts = []
    for i, s in enumerate(sources):
        kind = F.upper(_text_or(s.df, s.kind, s.default_kind))
        regime = F.when(kind.contains("DES"), "DESONERADO").otherwise("ONEROSO") if s.regime is None else F.lit(s.regime)
        parts.append(
            s.df.select(
                parse_date_multi(F.col(s.date)).alias("ref_date"),
                _text_or(s.df, s.place, "BR").alias("place"),
                kind.alias("kind"),
                regime.alias("regime"),
                br_number(F.col(s.value)).alias("value"),
                F.lit(s.source).alias("source"),
                F.lit(i).alias("_priority"),
            )
        )
    keys = ["ref_date", "place", "kind", "regime"]
    merged = dedup_keep(reduce(DataFrame.unionByName, parts), keys, "_priority").drop("_priority")
    fact = merged.filter(F.col("value") > 0)
    return ranks.surrogate_key(fact, keys) if numbered else fact


@dataclass(frozen=True)
class IndicatorSource:
    """One table of text: its indicator and unit, as names or as expressions over its rows, and its column names."""

    df: DataFrame
    indicator: str | Column
    unit: str | Column
    value: str = "value"
    change: str | None = "change"
    date: str = "ref_date"


def consolidate_indicators(sources: Sequence[IndicatorSource], source: str, numbered: bool = True) -> DataFrame:
    """Several indicator tables of text to one narrow fact; later rows win on (date, indicator)."""
    parts = []
    for i, s in enumerate(sources):
        change = br_number(F.col(s.change)) if s.change in s.df.columns else F.lit(None).cast("double")
        parts.append(
            s.df.select(
                parse_date_multi(F.col(s.date)).alias("ref_date"),
                (F.lit(s.indicator) if isinstance(s.indicator, str) else s.indicator).alias("indicator"),
                br_number(F.col(s.value)).alias("value"),
                (F.lit(s.unit) if isinstance(s.unit, str) else s.unit).alias("unit"),
                change.alias("change"),
                F.lit(source).alias("source"),
                F.lit(i).alias("_priority"),
            ).filter("value IS NOT NULL")
        )
    keys = ["indicator", "ref_date"]
    fact = dedup_keep(reduce(DataFrame.unionByName, parts), keys, "_priority").drop("_priority")
    return ranks.surrogate_key(fact, keys) if numbered else fact
