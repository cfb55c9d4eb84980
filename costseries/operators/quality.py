"""Validation, flags and audit tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.keys import row_hashes
from ..session import landed
from . import filters, stats, upsert, windows
from .joins import null_safe_join

# fixed values: thresholds and flag names
ZSCORE_LIMIT, ZSCORE_HIGH = 3.0, 4.0
MOM_LIMIT, MOM_HIGH = 0.10, 0.25
OUTLIER, HIGH_MOM, NEGATIVE = "outlier_zscore", "high_mom_variation", "negative_value"


def outliers_zscore(
    df: DataFrame, keys: Sequence[str], value: str, limit: float = ZSCORE_LIMIT, period_table: bool = False
) -> DataFrame:
    """Every value with its |z| and whether it passes the limit; short or flat series never do."""
    out = windows.zscore(df, keys, value, "zscore", period_table)
    return out.withColumn("is_outlier", F.coalesce(F.col("zscore") > limit, F.lit(False)))


def mom_flagged(current: Column, previous: Column, change: Column, limit: float) -> Column:
    from_zero = (previous == 0) & (current != 0)
    return F.coalesce((F.abs(change) > limit) | from_zero, from_zero, F.lit(False))


def mom_violations(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    limit: float = MOM_LIMIT,
    chunk: Column | None = None,
) -> DataFrame:
    """Rows that moved more than the limit against the row before (any move from zero counts)."""
    lagged = windows.padded_lags(df, value, {"_prev": 1}, keys, order, chunk=chunk)
    out = lagged.withColumn("mom", windows.growth(F.col("_v"), F.col("_prev"), 1.0))
    flagged = mom_flagged(F.col("_v"), F.col("_prev"), F.col("mom"), limit)
    return out.filter(flagged).withColumn("mom_abs", F.abs("mom")).drop("_v", "_prev")


def negative_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a negative in any column, and the list of those columns."""
    named = F.array(*[F.when(F.col(c) < 0, F.lit(c)) for c in cols])
    out = df.withColumn("negative_columns", F.array_compact(named))
    return out.filter(F.size("negative_columns") > 0)


def quality_flags(
    df: DataFrame,
    series: str,
    date: str,
    value: str,
    checks: Sequence[str] = (OUTLIER, HIGH_MOM, NEGATIVE),
    period_table: bool = True,
    chunk: Column | None = None,
) -> DataFrame:
    """Outlier, month-over-month and negative-value flags in one table, one row per flag."""
    stat = {
        "_avg": F.avg(value),
        "_pop": F.stddev_pop(value),
        "series_std": F.stddev_samp(value),
        "_n": F.count(value),
    }
    base = windows.padded_lags(df, value, {"_prev": 1}, [series], date, chunk=chunk)
    base = windows.group_stats_back(base, [series], stat, period_table)
    z = F.when((F.col("_n") >= 3) & (F.col("_pop") > 0), F.abs((F.col(value) - F.col("_avg")) / F.col("_pop")))
    base = base.withColumns({"_z": z, "_mom": windows.growth(F.col("_v"), F.col("_prev"), 1.0)})

    def flag(hit: Column, kind: str, severity: Column, details: Column) -> Column:
        entry = F.struct(F.lit(kind).alias("flag"), severity.alias("severity"), details.alias("details"))
        return F.when(F.coalesce(hit, F.lit(False)), entry)

    grade = lambda high: F.when(high, "high").otherwise("medium")
    flags = {
        OUTLIER: flag(
            F.col("_z") > ZSCORE_LIMIT,
            OUTLIER,
            grade(F.col("_z") > ZSCORE_HIGH),
            F.format_string("z-score: %.2f, mean: %.2f", "_z", F.col("_avg").cast("double")),
        ),
        HIGH_MOM: flag(
            mom_flagged(F.col("_v"), F.col("_prev"), F.col("_mom"), MOM_LIMIT),
            HIGH_MOM,
            grade((F.abs("_mom") > MOM_HIGH) | F.col("_mom").isNull()),
            F.when(F.col("_mom").isNull(), "change from zero").otherwise(F.format_string("change: %.2f%%", F.col("_mom") * 100)),
        ),
        NEGATIVE: flag(
            F.col(value) < 0,
            NEGATIVE,
            F.lit("high"),
            F.format_string("negative value: %.2f", F.col(value).cast("double")),
        ),
    }
    found = base.withColumn("_f", F.explode(F.array_compact(F.array(*[flags[c] for c in checks]))))
    return found.select(
        F.col(series).alias("series_id"),
        F.col(date).alias("ref_date"),
        F.col("_f.flag").alias("flag"),
        F.col("_f.severity").alias("severity"),
        F.col(value).alias("observed"),
        "series_std",
        F.col("_f.details").alias("details"),
    )


def validate_series(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    gap: tuple[int, int] = (25, 35),
    change: tuple[float, float] = (-5.0, 10.0),
    chunk: Column | None = None,
) -> DataFrame:
    """Per series: counts of non-positive values, irregular gaps and abnormal changes, with ranges."""
    lagged = windows.with_lags(df, {"_pd": (date, 1), "_pv": (value, 1)}, keys, date, chunk)
    days = F.datediff(date, "_pd")
    moved = windows.growth(F.col(value), F.col("_pv"))
    out = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(value) <= 0).alias("n_non_positive"),
        F.count_if((days < gap[0]) | (days > gap[1])).alias("n_gaps"),
        F.count_if((moved < change[0]) | (moved > change[1])).alias("n_abnormal"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
    issues = F.array_compact(
        F.array(
            *[
                F.when(F.col(c) > 0, F.concat(F.lit(f"{label}: "), F.col(c).cast("string")))
                for c, label in (
                    ("n_non_positive", "non-positive values"),
                    ("n_gaps", "irregular gaps"),
                    ("n_abnormal", "abnormal changes"),
                )
            ]
        )
    )
    return out.withColumn("issues", F.array_join(issues, "; ")).withColumn("is_valid", F.col("issues") == "")


def corruption_stats(
    df: DataFrame, value: str, date: str, as_of: dt.date | str, keys: Sequence[str] = (), limit: float = 1e6
) -> DataFrame:
    """Missing, zero, absurd and future counts, overall or per key."""
    v, day = F.col(value), F.col(date).cast("date")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(v.isNull()).alias("n_null"),
        F.count_if(v == 0).alias("n_zero"),
        F.count_if(F.abs(v) > limit).alias("n_absurd"),
        F.count_if(day > F.lit(str(as_of)).cast("date")).alias("n_future"),
    )


class CleaningCounts:
    """Counters that ride along in the pass that cleans; known once that pass has been written.

    Spark adds up what tasks report. A task repeated after the loss of an executor may report twice, so the counters
    are a report, not a gate.
    """

    def __init__(self) -> None:
        self.start, self.fenced, self.final = Observation(), Observation(), Observation()

    def row(self) -> dict[str, int]:
        """Rows at the start, removed by every step and left; the steps add up."""
        first, inside, final = self.start.get, self.fenced.get["n"], self.final.get["n"]
        usable = first["n_start"] - first["n_future"] - first["n_null"]
        return {**first, "n_outlier": usable - inside, "n_duplicate": inside - final, "n_final": final}


def clean_series(
    df: DataFrame,
    series: str,
    date: str,
    value: str,
    keys: Sequence[str],
    order: Sequence[str],
    as_of: dt.date | str,
    k: float = 10.0,
    period_table: bool = False,
    counts: CleaningCounts | None = None,
) -> DataFrame:
    """Drop future and missing points, then values outside the quartile fence, then old copies.

    ``counts`` are filled by the action that runs the result.
    """
    future = F.col(date) > F.lit(str(as_of)).cast("date")
    missing = F.col(value).isNull()
    usable = df.filter(~future & ~missing)
    fences = stats.quartile_fence(usable, [series], value, k, period_table).select(series, "lower", "upper")
    if counts:
        undated = F.col(date).isNull() | (~future & missing)
        steps = {"n_start": F.lit(True), "n_future": future, "n_null": undated}
        usable = df.observe(counts.start, *[F.count_if(c).alias(n) for n, c in steps.items()]).filter(~future & ~missing)
    inside = F.col(value).between(F.col("lower"), F.col("upper"))
    fenced = null_safe_join(usable, fences, [series]).filter(inside).select(*df.columns)
    if counts:
        fenced = fenced.observe(counts.fenced, F.count(F.lit(1)).alias("n"))
    newest = upsert.dedup_latest(fenced, keys, order)
    return newest.observe(counts.final, F.count(F.lit(1)).alias("n")) if counts else newest


def clean_report(
    df: DataFrame, series: str, date: str, value: str, keys: Sequence[str], as_of: dt.date | str, k: float = 10.0
) -> DataFrame:
    """Rows removed by each cleaning step; the steps add up to ``n_start``. ``n_null`` counts rows without a date or a value.

    The cleaned rows are written to a fresh working folder, and the counters of that one pass are the report.
    """
    counts = CleaningCounts()
    landed(clean_series(df, series, date, value, keys, (), as_of, k, counts=counts), "cleaned")
    row = counts.row()
    return df.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{n} long" for n in row))


@dataclass(frozen=True)
class Rule:
    """A named check. ``failing`` is a row predicate; ``metric``/``passes`` is a table-level one
    given as aggregate and SQL condition on ``metric``. ``distinct`` marks metrics that count
    distinct values."""

    name: str
    severity: str = "error"
    failing: Column | None = None
    metric: Column | None = None
    passes: str | None = None
    distinct: bool = False


def contract(df: DataFrame, rules: Sequence[Rule], sample_key: str | None = None) -> DataFrame:
    """One row per rule: measured figure, status, and the smallest failing key as evidence.

    All plain rules are evaluated in one aggregate over one scan. A distinct count shuffles one
    row per value, which would drag every other counter along, so those run on their own column.
    """
    plain: list[Column] = [F.count(F.lit(1)).alias("_all")]
    own: dict[str, Column] = {}
    for i, r in enumerate(rules):
        if r.distinct:
            own[f"_m{i}"] = df.agg(r.metric.cast("double")).scalar()
            plain.append(F.lit(None).cast("string").alias(f"_s{i}"))
        elif r.failing is None:
            plain += [r.metric.cast("double").alias(f"_m{i}"), F.lit(None).cast("string").alias(f"_s{i}")]
        else:
            fails = F.coalesce(r.failing, F.lit(True))
            key = F.col(sample_key).cast("string") if sample_key else F.lit(None).cast("string")
            plain += [F.count_if(fails).cast("double").alias(f"_m{i}"), F.min(F.when(fails, key)).alias(f"_s{i}")]
    measured = df.agg(*plain).withColumns(own)
    rows = []
    for i, r in enumerate(rules):
        ok = F.col(f"_m{i}") == 0 if r.failing is not None else F.expr(r.passes.replace("metric", f"_m{i}"))
        rows.append(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.severity).alias("severity"),
                F.col(f"_m{i}").alias("metric"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
                F.col(f"_s{i}").alias("sample"),
            )
        )
    return measured.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def not_null(col: str, severity: str = "error") -> Rule:
    return Rule(f"{col} not null", severity, F.col(col).isNull())


def in_range(col: str, low: float, high: float, severity: str = "warning") -> Rule:
    return Rule(f"{col} in range", severity, ~F.col(col).between(low, high))


def in_set(col: str, allowed: Sequence[object], severity: str = "error") -> Rule:
    return Rule(f"{col} allowed", severity, ~F.col(col).isin(*allowed))


def sums_to_one(cols: Sequence[str], low: float = 0.98, high: float = 1.02, severity: str = "warning") -> Rule:
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    return Rule("shares sum to one", severity, ~total.between(low, high))


def date_format_rule(col: str, severity: str = "warning") -> Rule:
    return Rule(f"{col} iso date", severity, F.try_to_date(F.col(col), "yyyy-MM-dd").isNull())


def row_count(expected: int, severity: str = "error") -> Rule:
    return Rule("row count", severity, metric=F.count(F.lit(1)), passes=f"metric = {expected}")


def unique_key(key: str, severity: str = "error") -> Rule:
    extra = F.count(F.col(key)) - F.count_distinct(key)
    return Rule(f"{key} unique", severity, metric=extra, passes="metric = 0", distinct=True)


def readiness(
    df: DataFrame,
    key: str,
    series: str,
    value: str,
    date: str,
    as_of: dt.date | str,
    name: str,
    min_rows: int = 5000,
    min_series: int = 9,
) -> DataFrame:
    """Presentation checklist; the last row says whether all critical points pass."""
    has = lambda c: F.lit(1.0 if c in df.columns else 0.0)
    rules = [
        Rule("enough rows", "critical", metric=F.count(F.lit(1)), passes=f"metric > {min_rows}"),
        Rule(
            "enough series",
            "critical",
            metric=F.count_distinct(series),
            passes=f"metric >= {min_series}",
            distinct=True,
        ),
        Rule("names present", "critical", metric=F.max(has(name)), passes="metric = 1"),
        Rule(
            "no duplicates",
            "critical",
            metric=F.count(key) - F.count_distinct(key),
            passes="metric = 0",
            distinct=True,
        ),
        Rule("no missing values", "critical", metric=F.count_if(F.col(value).isNull()), passes="metric = 0"),
        Rule(
            "no future dates",
            "critical",
            metric=F.count_if(F.col(date) > F.lit(str(as_of)).cast("date")),
            passes="metric = 0",
        ),
        Rule("mom present", "optional", metric=F.max(has("mom")), passes="metric = 1"),
        Rule("yoy present", "optional", metric=F.max(has("yoy")), passes="metric = 1"),
    ]
    checked = contract(df, rules).drop("sample")
    failed = F.count_if((F.col("severity") == "critical") & ~F.col("passed"))
    ready = checked.agg(failed.cast("double").alias("metric")).select(
        F.lit("ready").alias("rule"),
        F.lit("critical").alias("severity"),
        "metric",
        (F.col("metric") == 0).alias("passed"),
    )
    return checked.unionByName(ready)


@dataclass(frozen=True)
class Cardinality:
    """Rows that a table must have, all or those ``where`` an SQL condition holds: from ``low`` to ``high`` (NULL: open).

    A broken ``WARNING`` warns; a broken ``NOTE`` is counted only.
    """

    low: int | None = None
    high: int | None = None
    where: str = "true"
    severity: str = "WARNING"


def table_gate(
    tables: Mapping[str, DataFrame | None],
    expected: Mapping[str, int],
    tolerance: float = 0.95,
    required: Mapping[str, Sequence[Cardinality]] | None = None,
) -> DataFrame:
    """Rows, duplicates, NULL cells and broken cardinalities per table against expectations, and the resulting status.

    Duplicates are told by two 64-bit hashes of the row, taken where it is read, so wide rows are not shuffled. A table that is
    not there (``None``) or has no rows fails.
    """
    parts = []
    for name, df in tables.items():
        rules = (required or {}).get(name, ())
        if df is None:
            figures = None
        else:
            nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
            holds = [F.expr(r.where).cast("int").alias(f"_holds{i}") for i, r in enumerate(rules)]
            rows = df.select(*row_hashes(df.schema), nulls.alias("_nulls"), *holds).groupBy("_h1", "_h2")
            per_row = rows.agg(F.count(F.lit(1)).alias("_n"), F.max("_nulls").alias("_nulls"), *[F.max(f"_holds{i}").alias(f"_holds{i}") for i in range(len(rules))])
            figures = per_row.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
                F.coalesce(F.sum(F.col("_nulls") * F.col("_n")), F.lit(0)).alias("n_null_cells"),
                *[F.coalesce(F.sum(F.col(f"_holds{i}") * F.col("_n")), F.lit(0)).alias(f"_held{i}") for i in range(len(rules))],
            )
        if figures is None:
            spark = next(t for t in tables.values() if t is not None).sparkSession
            figures = spark.range(1).select(*[F.lit(None).cast("bigint").alias(c) for c in ("n_rows", "n_duplicates", "n_null_cells")])
            broken = warned = F.lit(0)
        else:
            outside = [
                (F.col(f"_held{i}") < (r.low if r.low is not None else 0)) | (F.col(f"_held{i}") > F.lit(r.high)) if r.high is not None
                else F.col(f"_held{i}") < (r.low or 0)
                for i, r in enumerate(rules)
            ]
            broken, warned = (
                reduce(lambda a, b: a + b, [o.cast("int") for o, r in zip(outside, rules) if r.severity in kinds], F.lit(0))
                for kinds in (("WARNING", "NOTE"), ("WARNING",))
            )
        parts.append(
            figures.select(
                F.lit(name).alias("table_name"), F.lit(expected.get(name)).cast("bigint").alias("n_expected"),
                "n_rows", "n_duplicates", "n_null_cells", broken.cast("int").alias("n_broken"), (warned > 0).alias("_warned"),
            )
        )
    out = reduce(DataFrame.unionByName, parts)
    short = F.coalesce(F.col("n_rows") < F.col("n_expected") * tolerance, F.lit(False))
    status = (
        F.when(F.coalesce(F.col("n_rows"), F.lit(0)) == 0, "FAILED")
        .when(short | (F.col("n_duplicates") > 0) | F.col("_warned"), "WARNING")
        .otherwise("PASSED")
    )
    return out.withColumn("status", status).drop("_warned")


def verdict(gate: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAILED")
    return gate.agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.count_if(F.col("status") == "WARNING").alias("n_warning"),
        failed.alias("n_failed"),
        F.when(failed > 0, "NO-GO").otherwise("GO").alias("verdict"),
    )


def redundancy(whole: DataFrame, parts: Sequence[DataFrame], tolerance: int = 10) -> DataFrame:
    """Is a table just the union of others? Row counts within a tolerance, and contents by two 64-bit hashes of every row."""
    stacked = reduce(DataFrame.unionByName, [p.select(*whole.columns) for p in parts])
    tagged = whole.withColumn("_d", F.lit(1)).unionByName(stacked.withColumn("_d", F.lit(-1)))
    hashed = tagged.select("_d", *row_hashes(tagged.drop("_d").schema)).groupBy("_h1", "_h2")
    per_row = hashed.agg(F.count_if(F.col("_d") == 1).alias("_w"), F.count_if(F.col("_d") == -1).alias("_p"))
    out = per_row.agg(
        F.sum("_w").alias("n_whole"),
        F.sum("_p").alias("n_parts"),
        F.sum(F.greatest(F.col("_w") - F.col("_p"), F.lit(0))).alias("only_in_whole"),
        F.sum(F.greatest(F.col("_p") - F.col("_w"), F.lit(0))).alias("only_in_parts"),
    )
    return out.withColumns(
        {
            "redundant_by_count": F.abs(F.col("n_whole") - F.col("n_parts")) <= tolerance,
            "redundant_by_content": (F.col("only_in_whole") == 0) & (F.col("only_in_parts") == 0),
        }
    )


def completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing, zero and filled counts with totals, one row per measure."""
    exprs = []
    for i, c in enumerate(cols):
        exprs += [
            F.count_if(F.col(c).isNull()).alias(f"_null{i}"),
            F.count_if(F.col(c) == 0).alias(f"_zero{i}"),
            F.count_if(F.col(c) != 0).alias(f"_full{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("measure"),
                F.col(f"_null{i}").alias("n_missing"),
                F.col(f"_zero{i}").alias("n_zero"),
                F.col(f"_full{i}").alias("n_filled"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*exprs).select(F.explode(rows).alias("r")).select("r.*")


def scaffold_check(df: DataFrame, left: str, right: str, baseline: str, factor: str) -> DataFrame:
    """Exact cardinalities of a scaffold, its baseline and its keys, as contract rows."""
    pairs = F.count_distinct(left, right)
    is_base = F.col(right) == baseline
    rules = [
        Rule("all pairs present", metric=F.count_distinct(left) * F.count_distinct(right) - pairs, passes="metric = 0"),
        Rule("pairs unique", metric=F.count(F.lit(1)) - pairs, passes="metric = 0"),
        Rule("baseline present", metric=F.count_if(is_base), passes="metric > 0"),
        Rule("baseline factor is one", failing=is_base & (F.col(factor) != 1.0)),
        Rule("keys not null", failing=F.col(left).isNull() | F.col(right).isNull()),
    ]
    return contract(df, rules, right)


def enrich_and_compare(
    df: DataFrame,
    ref: DataFrame,
    keys: Sequence[str],
    cost: tuple[str, str],
    shares: Mapping[str, str],
    cost_limit: float = 0.10,
    share_limit: float = 0.05,
) -> DataFrame:
    """Differences against a reference table that pass the limits, one row per warning."""
    own, other = cost
    joined = df.join(ref, list(keys))
    relative = F.try_divide(F.abs(F.col(other) - F.col(own)), F.col(other))

    def warning(kind: str, diff: Column, limit: float) -> Column:
        return F.when(diff > limit, F.struct(F.lit(kind).alias("kind"), diff.alias("difference")))

    found = [warning(own, relative, cost_limit)]
    found += [warning(a, F.abs(F.col(b) - F.col(a)), share_limit) for a, b in shares.items()]
    out = joined.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("w"))
    return out.select(*keys, "w.kind", "w.difference")


def post_write_check(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Header and keys after a write: same columns in order, no key lost or added."""
    same_header = expected.columns == actual.columns
    e = expected.select(*keys, F.lit(1).alias("_e"), F.lit(0).alias("_a"))
    a = actual.select(*keys, F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    both = e.unionByName(a).groupBy(*keys).agg(F.sum("_e").alias("_e"), F.sum("_a").alias("_a"))  # NULL keys meet
    return both.agg(
        F.coalesce(F.sum("_e"), F.lit(0)).alias("n_expected"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("n_actual"),
        F.count_if(F.col("_a") == 0).alias("n_lost"),
        F.count_if(F.col("_e") == 0).alias("n_added"),
    ).withColumn(
        "ok", F.lit(same_header) & (F.col("n_lost") == 0) & (F.col("n_added") == 0)
    )


def ingestion_log(results: DataFrame, exec_id: str, status: str = "status", rows: str = "n_rows") -> DataFrame:
    """One run row from per-series results: success, partial (at least 80 % ok) or error."""
    out = results.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.count_if(F.col(status) == "success").alias("n_ok"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_loaded"),
    )
    rate = F.try_divide(F.col("n_ok").cast("double"), F.col("n_series").cast("double"))
    state = F.when(rate == 1.0, "success").when(rate >= 0.8, "partial").otherwise("error")
    return out.select(
        F.lit(exec_id).alias("exec_id"), "n_series", "n_ok", "rows_loaded", state.alias("run_status")
    ).withColumn("accepted", F.col("run_status") != "error")


def valid_share(df: DataFrame, keys: Sequence[str], value: str, date: str, as_of: dt.date | str) -> DataFrame:
    """Per-series load result: rows kept and a status, input of the ingestion log."""
    ok = filters.is_valid_point(F.col(value), F.col(date), as_of)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_seen"), F.count_if(ok).alias("n_rows"))
    return out.withColumn(
        "status", F.when(F.col("n_rows") == F.col("n_seen"), "success").otherwise("partial")
    )
