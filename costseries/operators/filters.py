"""Row filters and routing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: plausibility presets (low, high, zero allowed); bounds are exclusive unless abs
POINT_PRESETS = {
    "abs": {"low": -1e6, "high": 1e6, "inclusive": True, "keep_zero": False},
    "range": {"low": -1000.0, "high": 1e6, "inclusive": False, "keep_zero": False},
    "range_zero": {"low": -1000.0, "high": 1e6, "inclusive": False, "keep_zero": True},
}


def _day(as_of: dt.date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def is_valid_point(value: Column, date: Column, as_of: dt.date | str, preset: str = "abs") -> Column:
    p = POINT_PRESETS[preset]
    if p["inclusive"]:
        in_range = (value >= p["low"]) & (value <= p["high"])
    else:
        in_range = (value > p["low"]) & (value < p["high"])
    ok = value.isNotNull() & ~F.isnan(value) & in_range & date.isNotNull() & (date <= _day(as_of))
    return ok if p["keep_zero"] else ok & (value != 0)


def valid_points(
    df: DataFrame, value: str, date: str, as_of: dt.date | str, preset: str = "abs"
) -> DataFrame:
    """Drop missing, zero, absurd and future observations."""
    return df.filter(is_valid_point(F.col(value), F.col(date), as_of, preset))


def last_safe_day(freq: Column, as_of: dt.date | str) -> Column:
    """Daily series are complete up to yesterday, monthly ones up to the end of last month."""
    today = _day(as_of)
    return F.when(freq == "daily", F.date_sub(today, 1)).otherwise(F.last_day(F.add_months(today, -1)))


def release_gate(
    df: DataFrame, date: str, freq: str, as_of: dt.date | str, start: dt.date | str | None = None
) -> DataFrame:
    """Keep observations already released; the default start is 365 days before the last safe day."""
    end = last_safe_day(F.col(freq), as_of)
    begin = F.date_sub(end, 365) if start is None else _day(start)
    return df.filter((F.col(date) <= end) & (F.col(date) >= begin))


def positive_values(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value) > 0)


def sector_filter(
    df: DataFrame,
    section: str = "section",
    code: str = "code",
    letter: str = "F",
    prefixes: Sequence[str] = ("41", "42", "43"),
) -> DataFrame:
    """Rows of one sector, by section letter or else by code prefix; all rows when neither column exists."""
    if section in df.columns:
        return df.filter(F.upper(F.col(section).cast("string")) == letter)
    if code in df.columns:
        return df.filter(F.substring(F.col(code).cast("string"), 1, 2).isin(*prefixes))
    return df


# fixed values: input kinds that are materials, and labour classes to leave out
MATERIAL_KINDS = ("MAT", "MATERIAL", "INSUMO")
LABOUR_CLASSES = ("SERVENTE", "PEDREIRO", "ELETRICISTA", "ENCANADOR", "PINTOR")


def category_filter(
    df: DataFrame,
    kind: str = "kind",
    category: str = "category",
    keep: Sequence[str] = MATERIAL_KINDS,
    exclude: Sequence[str] = LABOUR_CLASSES,
) -> DataFrame:
    """Keep the wanted kinds, or else drop rows whose category names an excluded class."""
    if kind in df.columns:
        return df.filter(F.upper(F.col(kind)).isin(*keep))
    if category in df.columns:
        named = F.coalesce(F.upper(F.col(category)).rlike("|".join(exclude)), F.lit(False))
        return df.filter(~named)
    return df


def with_route(df: DataFrame, routes: Mapping[str, Column], default: str, name: str = "route") -> DataFrame:
    """Tag each row with the first route whose predicate holds."""
    route = F.lit(default)
    for label, predicate in reversed(list(routes.items())):
        route = F.when(predicate, label).otherwise(route)
    return df.withColumn(name, route)


def split_by(
    df: DataFrame, routes: Mapping[str, Column], default: str = "other"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Disjoint outputs per route, and a one-row check that their counts add up."""
    tagged = with_route(df, routes, default)
    labels = [*routes, default]
    parts = {label: tagged.filter(F.col("route") == label).drop("route") for label in labels}
    check = tagged.agg(
        F.count(F.lit(1)).alias("n_total"),
        *[F.count_if(F.col("route") == label).alias(f"n_{label}") for label in labels],
    ).withColumn("complete", F.col("n_total") == sum(F.col(f"n_{label}") for label in labels))
    return parts, check


def code_validity(col: Column, prefix: str, length: int) -> Column:
    """Numeric code of a given length and prefix."""
    return F.coalesce(col.cast("string").rlike(f"^{prefix}[0-9]{{{length - len(prefix)}}}$"), F.lit(False))


def last_n_months(df: DataFrame, date: str, months: int, source: DataFrame | None = None) -> DataFrame:
    """Rows dated within ``months`` of the newest date, both ends included (13 months for 12).

    The bound is a scalar subquery over ``source`` (default: the table itself) of the column's
    own type, so it reaches the scan as a plain comparison.
    """
    src = source if source is not None else df
    bound = F.add_months(F.max(F.col(date)).cast("date"), -months).cast(df.schema[date].dataType)
    return df.filter(F.col(date) >= src.agg(bound).scalar())


def recent_month_rows(df: DataFrame, date: str, months: int) -> DataFrame:
    """Raw rows of the newest month and the ``months`` before it, whole months."""
    newest = F.trunc(F.max(F.col(date)).cast("date"), "month")
    bound = F.add_months(newest, -months).cast(df.schema[date].dataType)
    return df.filter(F.col(date) >= df.agg(bound).scalar())
