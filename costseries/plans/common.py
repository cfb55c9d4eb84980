"""Shared inputs: monthly and daily series derived from the sample tables, with their SQL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import table


def month(col: str) -> Column:
    return F.trunc(F.col(col).cast("date"), "month")


def cents(col: str | Column) -> Column:
    """Money as whole cents, so that sums are exact in any order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("bigint")


def money_sum(col: str | Column) -> Column:
    return F.sum(cents(col)).cast("double") / 100


def cents_sql(col: str) -> str:
    return f"CAST(round({col} * 100) AS BIGINT)"


def money_sql(col: str) -> str:
    return f"CAST(sum({cents_sql(col)}) AS DOUBLE) / 100"


MONTH_SQL = "CAST(date_trunc('month', l_shipdate) AS DATE)"


def supplied_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with the supplier's nation."""
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, d, "lineitem")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )


def nation_months(spark: SparkSession, d: str, *extra: str) -> DataFrame:
    """Monthly revenue per supplier nation: one row per region, ``extra`` columns and month."""
    return (
        supplied_lines(spark, d)
        .groupBy("region", *extra, month("l_shipdate").alias("ref_date"))
        .agg(money_sum("l_extendedprice").alias("value"))
    )


def nation_months_sql(*extra: str) -> str:
    cols = "".join(f"{c}, " for c in extra)
    return f"""nm AS (
  SELECT n_name AS region, {cols}{MONTH_SQL} AS ref_date, {money_sql('l_extendedprice')} AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)"""


def type_months(spark: SparkSession, d: str) -> DataFrame:
    """Monthly revenue per part type."""
    part = table(spark, d, "part").select("p_partkey", "p_type")
    return (
        table(spark, d, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type", month("l_shipdate").alias("ref_date"))
        .agg(money_sum("l_extendedprice").alias("value"))
    )


TYPE_MONTHS_SQL = f"""tm AS (
  SELECT p_type, {MONTH_SQL} AS ref_date, {money_sql('l_extendedprice')} AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def event_days(spark: SparkSession, d: str) -> DataFrame:
    """Daily event value per event type."""
    day = F.col("ts").cast("date").alias("ref_date")
    return table(spark, d, "events").groupBy("event_type", day).agg(money_sum("value").alias("value"))


EVENT_DAYS_SQL = f"""ed AS (
  SELECT event_type, CAST(ts AS DATE) AS ref_date, {money_sql('value')} AS value FROM events GROUP BY ALL)"""


def customer_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with the customer's nation and region."""
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    customer = table(spark, d, "customer")
    orders = table(spark, d, "orders")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )


CUSTOMER_ORDERS_SQL = """co AS (
  SELECT * FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def br_text(amount_cents: Column, thousands: bool = False) -> Column:
    """Whole cents as Brazilian numeral text."""
    whole = F.floor(amount_cents / 100).cast("bigint")
    rest = F.lpad((amount_cents - whole * 100).cast("string"), 2, "0")
    head = F.replace(F.format_number(whole, 0), F.lit(","), F.lit(".")) if thousands else whole.cast("string")
    return F.concat(head, F.lit(","), rest)
