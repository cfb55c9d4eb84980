"""Aggregations. Every grouped aggregate is partial before the shuffle, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..functions.keys import row_hashes
from ..session import landed
from . import selection
from .joins import null_safe_join


def group_stats(
    df: DataFrame, keys: Sequence[str], value: str, date: str, digits: int = 2, even: bool = False
) -> DataFrame:
    """Mean, count, sample deviation, date span and coefficient of variation, rounded."""
    rnd = F.bround if even else F.round
    stats = df.groupBy(*keys).agg(
        rnd(F.avg(value), digits).alias("avg_value"),
        F.count(value).alias("n"),
        rnd(F.stddev_samp(value), digits).alias("std_value"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )
    return stats.withColumn("cv", rnd(F.try_divide(F.col("std_value"), F.col("avg_value")), 4))


def multi_measure(df: DataFrame, keys: Sequence[str], spec: Mapping[str, str], strict: bool = False) -> DataFrame:
    """``{column: aggregate}``; columns the table does not have are left out, or refused if ``strict``."""
    absent = sorted(set(spec) - set(df.columns))
    if strict and absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    fns = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "count": F.count}
    exprs = [fns[fn](c).alias(c) for c, fn in spec.items() if c in df.columns]
    return df.groupBy(*keys).agg(*exprs)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *keys)


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False, together: int = 8) -> DataFrame:
    """Distinct values per column; NULL does not count.

    Every cell becomes its column's number and two 64-bit hashes, so one scan and one shuffle count up to ``together``
    columns, and each task drops its own repeats first. More columns are counted in groups.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in cols])
    groups = [cols[k : k + together] for k in range(0, len(cols), together)]
    counted = []
    for own in groups:
        cells = []
        for i, c in enumerate(own):
            plain = not isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType, T.ArrayType, T.StructType, T.MapType))
            one, two = (F.xxhash64(c), F.xxhash64(F.lit(1), c)) if plain else row_hashes(df.select(c).schema)
            known = F.col(c).isNotNull()
            cells.append(F.struct(F.lit(i).alias("i"), F.when(known, one).alias("_h1"), F.when(known, two).alias("_h2")))
        distinct = df.select(F.inline(F.array(*cells))).filter("_h1 IS NOT NULL").distinct()
        counted.append(distinct.agg(*[F.count_if(F.col("i") == i).alias(f"n_{c}") for i, c in enumerate(own)]))
    first, *rest = counted
    for k, more in enumerate(rest, 1):
        first = first.withColumns({f"n_{c}": more.select(f"n_{c}").scalar() for c in groups[k]})
    return first


def series_profile(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Count, span, range, density and the frequency it implies, per series."""
    day = F.col(date).cast("date")
    out = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
    )
    span = F.datediff("last_date", "first_date")
    density = F.try_divide(F.col("n").cast("double"), F.col("span_days").cast("double"))
    return (
        out.withColumn("span_days", span)
        .withColumn("density", density)
        .withColumn("freq", F.when(F.col("density") > 0.5, "daily").otherwise("monthly"))
    )


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls, blanks, numeric share, and whether it looks numeric or date-like.

    All counters are one aggregate over one scan, turned into rows afterwards.
    """
    numeric = r"^\s*[+-]?[0-9]+([.,][0-9]+)?\s*$"
    dated = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
    exprs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        text = F.col(c).cast("string")
        blank = F.trim(text) == "" if _is_text(df, c) else F.lit(False)
        exprs += [
            F.count_if(F.col(c).isNull()).alias(f"_null{i}"),
            F.count_if(blank).alias(f"_blank{i}"),
            F.count_if(text.rlike(numeric)).alias(f"_num{i}"),
            F.count_if(text.rlike(dated)).alias(f"_date{i}"),
        ]
    counters = df.agg(*exprs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("_n").alias("n_rows"),
                F.col(f"_null{i}").alias("n_null"),
                F.col(f"_blank{i}").alias("n_blank"),
                F.col(f"_num{i}").alias("n_numeric"),
                F.col(f"_date{i}").alias("n_date_like"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    out = counters.select(F.explode(rows).alias("r")).select("r.*")
    filled = F.col("n_rows") - F.col("n_null") - F.col("n_blank")
    return out.withColumns(
        {
            "is_numeric": F.coalesce(F.col("n_numeric") > filled * 0.5, F.lit(False)),
            "is_date_like": F.coalesce(F.col("n_date_like") > filled * 0.5, F.lit(False)),
        }
    )


def duplicate_rows(df: DataFrame, name: str = "n_duplicates") -> DataFrame:
    """How many rows repeat an earlier identical row, told by two 64-bit hashes of every row."""
    per_row = df.select(*row_hashes(df.schema)).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias(name))


def mode_share(
    df: DataFrame, keys: Sequence[str], value: str, min_n: int = 5, pct: float = 50.0
) -> DataFrame:
    """Most common value per key with its share; ties go to the smallest value."""
    per_value = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = per_value.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        F.min(F.struct((-F.col("_n")).alias("neg"), F.col(value).alias("v"))).alias("_best"),
    )
    out = best.select(
        *keys,
        "n",
        F.col("_best.v").alias("mode_value"),
        (-F.col("_best.neg")).alias("mode_count"),
    ).withColumn("mode_pct", F.col("mode_count") / F.col("n") * 100)
    return out.withColumn("suspicious", (F.col("n") > min_n) & (F.col("mode_pct") > pct))


def constant_series(df: DataFrame, keys: Sequence[str], value: str, min_n: int = 10) -> DataFrame:
    """Series with more than ``min_n`` values that are all the same (min equals max)."""
    out = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("constant_value"), F.max(value).alias("_max")
    )
    return out.filter((F.col("n") > min_n) & (F.col("constant_value") == F.col("_max"))).drop("_max")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles for groups that fit a task (period tables)."""
    exprs = [F.percentile(value, F.lit(p)).alias(name) for name, p in probs.items()]
    return df.groupBy(*keys).agg(*exprs)


def quantiles_large(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles for groups of any size, by counting instead of ordering (``selection``)."""
    return selection.quantiles_exact(df, keys, value, probs)


def quartile_fence(
    df: DataFrame, keys: Sequence[str], value: str, k: float = 10.0, period_table: bool = False
) -> DataFrame:
    """Q1, Q3 and the fences k interquartile ranges outside them."""
    fn = quantiles if period_table else quantiles_large
    out = fn(df, keys, value, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return out.withColumns({"lower": F.col("q1") - iqr * k, "upper": F.col("q3") + iqr * k})


def within_fence(
    df: DataFrame, keys: Sequence[str], value: str, k: float = 10.0, period_table: bool = False
) -> DataFrame:
    """Drop values outside the quartile fence of their key."""
    fences = quartile_fence(df, keys, value, k, period_table).select(*keys, "lower", "upper")
    kept = null_safe_join(df, fences, keys).filter(F.col(value).between(F.col("lower"), F.col("upper")))
    return kept.select(*df.columns)


def arg_extremes(df: DataFrame, order: str, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Label and value of the smallest and largest row; ties go to the smallest label."""
    low = F.min(F.struct(F.col(order).alias("v"), F.col(label).alias("l")))
    high = F.min(F.struct((-F.col(order)).alias("v"), F.col(label).alias("l")))
    out = df.filter(F.col(order).isNotNull()).groupBy(*keys).agg(low.alias("_low"), high.alias("_high"))
    return out.select(
        *keys,
        F.col("_low.l").alias("min_label"),
        F.col("_low.v").alias("min_value"),
        F.col("_high.l").alias("max_label"),
        (-F.col("_high.v")).alias("max_value"),
    )


def dim_statistics(df: DataFrame, group: str, measure: str, label: str) -> DataFrame:
    """Members, total, mean and number of distinct labels per group (their list: ``dims.by_group``)."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(measure).alias("total"),
        F.avg(measure).alias("mean"),
        F.count_distinct(label).alias("n_labels"),
    )


def regional_rollup(
    df: DataFrame, group: str, theory: str, actual: str, diff: str, diff_pct: str, flag: str
) -> DataFrame:
    """Per-group comparison of two factors with a precision class."""
    out = df.groupBy(group).agg(
        *[
            fn(c).alias(f"{name}_{label}")
            for c, label in ((theory, "theory"), (actual, "actual"))
            for name, fn in (("avg", F.avg), ("min", F.min), ("max", F.max))
        ],
        F.avg(diff).alias("avg_diff"),
        F.stddev_samp(diff).alias("std_diff"),
        F.avg(diff_pct).alias("avg_diff_pct"),
        F.stddev_samp(diff_pct).alias("std_diff_pct"),
        F.count_if(F.col(flag)).alias("n_flagged"),
        F.count(F.lit(1)).alias("n"),
    )
    mean = F.round("avg_diff", 4)
    precision = (
        F.when(mean <= 0.02, "HIGH").when(mean <= 0.05, "MEDIUM").otherwise("LOW")
    )
    return out.withColumn("precision", precision)


def metric_feed(df: DataFrame, group: str, diff: str, flag: str, label: str, top: int = 5) -> DataFrame:
    """Dashboard rows (metric, value, category): overall counts, per-group figures, largest gaps.

    The four columns needed are written to the shared folder, so the input runs once; overall and group figures are grouping
    sets of one pass.
    """
    from .ranks import top_k

    rows = landed(df.select(F.col(group).alias("g"), F.col(diff).alias("d"), F.col(flag).alias("f"), F.col(label).alias("l")), "feed")
    figures = rows.groupingSets([[], ["g"]], "g").agg(
        F.grouping("g").alias("whole"), F.count(F.lit(1)).cast("double").alias("n"), F.round(F.avg("d"), 3).alias("mean"), F.count_if("f").cast("double").alias("flagged")
    )

    def row(metric: Column, value: str, category: str) -> Column:
        return F.struct(metric.alias("metric"), F.col(value).alias("value"), F.lit(category).alias("category"))

    overall = F.array(row(F.lit("rows"), "n", "overall"), row(F.lit("flagged"), "flagged", "overall"))
    grouped = F.array(*[row(F.concat_ws(" - ", "g", F.lit(m)), v, "group") for m, v in (("mean diff", "mean"), ("flagged", "flagged"))])
    told = figures.select(F.inline(F.when(F.col("whole") == 1, overall).otherwise(grouped)))
    largest = top_k(rows.withColumn("_abs", F.abs("d")), "_abs", top, tie="l").select(
        F.concat(F.lit("gap - "), F.col("l")).alias("metric"), F.round("d", 3).alias("value"), F.lit("top").alias("category")
    )
    return told.unionByName(largest)


def coverage(df: DataFrame, name: str, status: str, prefixes: Mapping[str, str], rest: str = "other") -> DataFrame:
    """Status counts per category, the category being the first matching name prefix."""
    category = F.lit(rest)
    for prefix, label in reversed(list(prefixes.items())):
        category = F.when(F.col(name).startswith(prefix), label).otherwise(category)
    return (
        df.withColumn("category", category)
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(status) == "ok").alias("n_ok"),
            F.count_if(F.col(status) == "empty").alias("n_empty"),
            F.count_if(F.col(status) == "missing").alias("n_missing"),
        )
    )


def route_profile(df: DataFrame, route: str, key: str, date: str, value: str) -> DataFrame:
    """Rows, distinct keys, period, value range and share of all rows per route."""
    figures = df.groupBy(route).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.avg(value).alias("avg_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
    # apart from the figures, whose counters would otherwise travel with every distinct key
    keys = df.groupBy(route).agg(F.count_distinct(key).alias("n_keys"))
    total = figures.agg(F.sum("n")).scalar()
    return null_safe_join(figures, keys, [route]).withColumn("share_pct", F.col("n") / total * 100)
