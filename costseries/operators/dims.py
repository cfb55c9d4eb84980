"""Dimension builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import MONTH_NAMES
from . import columns, joins, ranks, upsert


def calendar(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """One row per month from ``first`` to ``last`` (literals or scalar subqueries)."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    spine = spark.range(1).select(F.explode(months).alias("ref_date"))
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return spine.select(
        "ref_date",
        F.year("ref_date").alias("year"),
        F.month("ref_date").alias("month"),
        F.get(names, F.month("ref_date") - 1).alias("month_name"),
        F.quarter("ref_date").alias("quarter"),
        F.when(F.month("ref_date") <= 6, 1).otherwise(2).alias("semester"),
        F.date_format("ref_date", "yyyy-MM").alias("year_month"),
    )


def geo_hierarchy(
    parents: DataFrame, children: DataFrame, parent: Mapping[str, str], child: Mapping[str, str]
) -> DataFrame:
    """Two levels in one table with prefixed ids; the child points at its parent's code.

    ``parent`` names its ``code`` and ``name`` columns, ``child`` also its ``parent`` column.
    """
    top = parents.select(
        F.concat(F.lit("UF_"), F.col(parent["code"])).alias("id"),
        F.lit("UF").alias("level"),
        F.col(parent["code"]).cast("string").alias("code"),
        F.col(parent["name"]).alias("name"),
        F.lit(None).cast("string").alias("parent_code"),
    )
    low = children.select(
        F.concat(F.lit("CID_"), F.col(child["code"])).alias("id"),
        F.lit("CIDADE").alias("level"),
        F.col(child["code"]).cast("string").alias("code"),
        F.col(child["name"]).alias("name"),
        F.col(child["parent"]).cast("string").alias("parent_code"),
    )
    return top.unionByName(low)


def municipal_dim(places: DataFrame, population: DataFrame, key: str, capital: Column) -> DataFrame:
    """Place list with population and a capital flag."""
    return places.join(population, key, "left").withColumn("is_capital", F.coalesce(capital, F.lit(False)))


def method_dim(df: DataFrame, renames: Mapping[str, str], numeric: Sequence[str]) -> DataFrame:
    """Select and rename the columns that exist, and type the measures."""
    present = {old: new for old, new in renames.items() if old in df.columns}
    out = df.select(*[F.col(old).alias(new) for old, new in present.items()])
    return columns.coerce_numeric(out, [c for c in numeric if c in out.columns])


def municipal_rates_dim(df: DataFrame, numeric_pattern: str, order: Sequence[str]) -> DataFrame:
    """Snake-case headers, typed rates and a sequential id."""
    typed = columns.coerce_numeric(columns.snake_columns(df), pattern=numeric_pattern)
    return ranks.surrogate_key(typed, order)


def config_dims(tables: Mapping[str, DataFrame], numeric: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Type several small text tables by their lists of numeric columns."""
    return {name: columns.coerce_numeric(df, numeric.get(name, ())) for name, df in tables.items()}


def lookup(df: DataFrame, col: str, key: str) -> DataFrame:
    """Rows whose trimmed, upper-cased column equals the key."""
    return df.filter(F.upper(F.trim(F.col(col))) == key.strip().upper())


def by_group(df: DataFrame, group: str, key: str) -> DataFrame:
    """The distinct keys of each group as rows, with their number of occurrences."""
    return df.groupBy(group, key).agg(F.count(F.lit(1)).alias("n"))


# fixed values: days until the next run of each update frequency
UPDATE_DAYS = {"daily": 1, "weekly": 7, "monthly": 30, "quarterly": 90}


def source_catalog(df: DataFrame, source: str, date: str, freq: str) -> DataFrame:
    """One row per source: records, newest date, update frequency and next run."""
    days = F.create_map(*[F.lit(x) for pair in UPDATE_DAYS.items() for x in pair])
    out = df.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_records"), F.max(date).alias("last_date"), F.max(freq).alias("freq")
    )
    return out.withColumn("next_run", F.date_add("last_date", F.coalesce(F.try_element_at(days, "freq"), F.lit(30))))


def municipal_fee_facts(wide: DataFrame, ids: Sequence[str], fees: Sequence[str]) -> DataFrame:
    """Wide rates to one row per place and fee; missing rates dropped."""
    long = wide.unpivot([F.col(c) for c in ids], [F.col(c) for c in fees], "fee", "rate")
    return long.filter("rate IS NOT NULL")


def unique_sources(df: DataFrame, label: str, url: str) -> DataFrame:
    """One row per address; the smallest label names it."""
    return df.filter(F.col(url).isNotNull()).groupBy(url).agg(F.min(label).alias(label))


def place_dims(df: DataFrame, order: Sequence[str], foreign_keys: Sequence[str]) -> DataFrame:
    """Sequential id and empty foreign keys to be filled by a later lookup."""
    numbered = ranks.surrogate_key(df, order)
    return numbered.withColumns({k: F.lit(None).cast("bigint") for k in foreign_keys})


def resolve_foreign_key(df: DataFrame, parent: DataFrame, key: str, parent_id: str, foreign_key: str) -> DataFrame:
    """Fill an empty foreign key from the parent dimension."""
    ref = parent.select(key, F.col(parent_id).alias("_fk"))
    return joins.lookup_left(df.drop(foreign_key), ref, [key], {}).withColumnRenamed("_fk", foreign_key)


def registry(keys: Mapping[str, Sequence[str]], tables: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Upsert every registered table and report its counts."""
    parts = {t: upsert.upsert_counts(*tables[t], keys[t]) for t in upsert.upsert_registry(tables, keys)}
    return upsert.union_tagged(parts, "table_name")
