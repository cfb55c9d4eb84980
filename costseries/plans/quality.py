"""Outliers, validation and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, stats, upsert, windows
from ..session import table
from .common import (
    EVENT_DAYS_SQL,
    MONTH_SQL,
    cents,
    cents_sql,
    event_days,
    nation_months,
    nation_months_sql,
    supplied_lines,
    month,
)
from .registry import query
from .series import event_points


@query(
    "q07_zscore",
    f"""WITH o AS (SELECT o_orderkey, o_orderpriority, {cents_sql('o_totalprice')} AS c FROM orders),
s AS (SELECT o_orderpriority, avg(c) AS m, stddev_pop(c) AS sd, count(*) AS n FROM o GROUP BY ALL)
SELECT o_orderkey, o_orderpriority, c, CASE WHEN n >= 3 AND sd > 0 THEN round(abs((c - m) / sd), 6) END AS zscore,
       coalesce(n >= 3 AND sd > 0 AND abs((c - m) / sd) > 1.7, false) AS is_outlier
FROM o JOIN s USING (o_orderpriority)""",
)
def zscore(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", cents("o_totalprice").alias("c"))
    out = quality.outliers_zscore(orders, ["o_orderpriority"], "c", limit=1.7)
    return out.withColumn("zscore", F.round("zscore", 6))


@query(
    "q08_mom_violations",
    f"""WITH {nation_months_sql('l_linestatus')},
g AS (SELECT *, lag(value) OVER (PARTITION BY region, l_linestatus ORDER BY ref_date) AS p FROM nm)
SELECT region, l_linestatus, ref_date, value, round(value / nullif(p, 0) - 1, 6) AS mom,
       round(abs(value / nullif(p, 0) - 1), 6) AS mom_abs
FROM g WHERE abs(value / nullif(p, 0) - 1) > 0.10 OR (p = 0 AND value <> 0)""",
)
def mom_violations(spark, d):
    fact = nation_months(spark, d, "l_linestatus")
    out = quality.mom_violations(fact, ["region", "l_linestatus"], "ref_date", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mom", "mom_abs")})


@query(
    "q09_negative_values",
    """WITH c AS (SELECT c_custkey, c_acctbal, c_acctbal - 500 AS margin FROM customer)
SELECT c_custkey, c_acctbal, margin,
       CASE WHEN c_acctbal < 0 THEN 'c_acctbal,margin' ELSE 'margin' END AS negative_columns
FROM c WHERE margin < 0""",
)
def negative_values(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal", (F.col("c_acctbal") - 500).alias("margin"))
    out = quality.negative_values(customers, ["c_acctbal", "margin"])
    return out.withColumn("negative_columns", F.array_join("negative_columns", ","))


NET_SQL = f"""net AS (
  SELECT n_name AS region, {MONTH_SQL} AS ref_date,
         CAST(sum(CASE l_returnflag WHEN 'N' THEN {cents_sql('l_extendedprice')}
                  WHEN 'R' THEN -{cents_sql('l_extendedprice')} ELSE 0 END) AS DOUBLE) / 100 AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"""


def net_months(spark, d):
    """Monthly value kept minus value returned per nation; it can be negative."""
    amount = cents("l_extendedprice")
    signed = F.when(F.col("l_returnflag") == "N", amount).when(F.col("l_returnflag") == "R", -amount).otherwise(0)
    grouped = supplied_lines(spark, d).groupBy("region", month("l_shipdate").alias("ref_date"))
    return grouped.agg((F.sum(signed).cast("double") / 100).alias("value"))


@query(
    "q10_quality_flags",
    f"""WITH {NET_SQL},
s AS (SELECT *, avg(value) OVER r AS m, stddev_pop(value) OVER r AS sp, stddev_samp(value) OVER r AS ss,
             count(*) OVER r AS n, lag(value) OVER (PARTITION BY region ORDER BY ref_date) AS p
      FROM net WINDOW r AS (PARTITION BY region)),
z AS (SELECT *, CASE WHEN n >= 3 AND sp > 0 THEN abs((value - m) / sp) END AS z, value / nullif(p, 0) - 1 AS mom FROM s),
f AS (
  SELECT *, 'outlier_zscore' AS flag, CASE WHEN z > 4 THEN 'high' ELSE 'medium' END AS severity,
         printf('z-score: %.2f, mean: %.2f', z, m) AS details FROM z WHERE z > 3
  UNION ALL SELECT *, 'high_mom_variation', CASE WHEN abs(mom) > 0.25 OR mom IS NULL THEN 'high' ELSE 'medium' END,
            CASE WHEN mom IS NULL THEN 'change from zero' ELSE printf('change: %.2f%%', mom * 100) END
            FROM z WHERE abs(mom) > 0.10 OR (p = 0 AND value <> 0)
  UNION ALL SELECT *, 'negative_value', 'high', printf('negative value: %.2f', value) FROM z WHERE value < 0)
SELECT region AS series_id, ref_date, flag, severity, value AS observed, round(ss, 2) AS series_std, details FROM f""",
)
def quality_flags(spark, d):
    out = quality.quality_flags(net_months(spark, d), "region", "ref_date", "value")
    return out.withColumn("series_std", F.round("series_std", 2))


@query(
    "q11_validate_series",
    f"""WITH {nation_months_sql('l_returnflag')},
g AS (SELECT *, lag(ref_date) OVER w AS pd, lag(value) OVER w AS pv FROM nm
      WINDOW w AS (PARTITION BY region, l_returnflag ORDER BY ref_date)),
a AS (
  SELECT region, l_returnflag, count(*) AS n, count(*) FILTER (WHERE value <= 0) AS n_non_positive,
         count(*) FILTER (WHERE ref_date - pd < 25 OR ref_date - pd > 35) AS n_gaps,
         count(*) FILTER (WHERE (value / nullif(pv, 0) - 1) * 100 < -5 OR (value / nullif(pv, 0) - 1) * 100 > 10)
           AS n_abnormal,
         min(ref_date) AS first_date, max(ref_date) AS last_date, min(value) AS min_value, max(value) AS max_value
  FROM g GROUP BY ALL)
SELECT *, concat_ws('; ', CASE WHEN n_non_positive > 0 THEN 'non-positive values: ' || n_non_positive END,
                    CASE WHEN n_gaps > 0 THEN 'irregular gaps: ' || n_gaps END,
                    CASE WHEN n_abnormal > 0 THEN 'abnormal changes: ' || n_abnormal END) AS issues,
       n_non_positive + n_gaps + n_abnormal = 0 AS is_valid FROM a""",
)
def validate_series(spark, d):
    fact = nation_months(spark, d, "l_returnflag")
    return quality.validate_series(fact, ["region", "l_returnflag"], "ref_date", "value")


@query(
    "q12_corruption_stats",
    """SELECT l_returnflag, count(*) AS n, 0::BIGINT AS n_null, count(*) FILTER (WHERE v = 0) AS n_zero,
       count(*) FILTER (WHERE abs(v) > 80000) AS n_absurd, count(*) FILTER (WHERE d > DATE '2001-01-01') AS n_future
FROM (SELECT l_returnflag, l_extendedprice * l_discount * 10 AS v, CAST(l_shipdate AS DATE) AS d FROM lineitem)
GROUP BY ALL""",
)
def corruption_stats(spark, d):
    lines = table(spark, d, "lineitem").withColumn("v", F.col("l_extendedprice") * F.col("l_discount") * 10)
    return quality.corruption_stats(lines, "v", "l_shipdate", "2001-01-01", ["l_returnflag"], limit=80000)


FENCE_K = 0.4
CLEAN_SQL = f"""src AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS ship, l_partkey, l_suppkey,
         nullif({cents_sql('l_extendedprice * l_quantity')}, 0) AS v FROM lineitem),
ok AS (SELECT * FROM src WHERE ship <= DATE '2001-06-01' AND v IS NOT NULL),
q AS (SELECT l_returnflag, quantile_cont(CAST(v AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(v AS DOUBLE), 0.75) AS q3
      FROM ok GROUP BY ALL),
j AS (SELECT ok.*, v BETWEEN q1 - (q3 - q1) * {FENCE_K}::DOUBLE AND q3 + (q3 - q1) * {FENCE_K}::DOUBLE AS inside
      FROM ok JOIN q USING (l_returnflag))"""


def lines_to_clean(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.col("l_shipdate").cast("date").alias("ship"),
        "l_partkey",
        "l_suppkey",
        F.nullif(cents(F.col("l_extendedprice") * F.col("l_quantity")), F.lit(0).cast("bigint")).alias("v"),
    )


@query(
    "q13_clean_series",
    f"""WITH {CLEAN_SQL}
SELECT l_orderkey, l_linenumber, l_returnflag, ship, l_partkey, l_suppkey, v FROM j WHERE inside
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY ship DESC, v DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def clean_series(spark, d):
    return quality.clean_series(
        lines_to_clean(spark, d),
        "l_returnflag",
        "ship",
        "v",
        ["l_orderkey", "l_linenumber"],
        ["ship", "v", "l_partkey", "l_suppkey"],
        "2001-06-01",
        k=FENCE_K,
    )


@query(
    "q100_clean_report",
    f"""WITH {CLEAN_SQL}, k AS (
  SELECT count(*) FILTER (WHERE inside) AS i, count(*) FILTER (WHERE NOT inside) AS o FROM j
  GROUP BY l_orderkey, l_linenumber)
SELECT (SELECT count(*) FROM src) AS n_start, (SELECT count(*) FROM src WHERE ship > DATE '2001-06-01') AS n_future,
       (SELECT count(*) FROM src WHERE ship <= DATE '2001-06-01' AND v IS NULL) AS n_null,
       CAST(sum(o) AS BIGINT) AS n_outlier, CAST(sum(greatest(i - 1, 0)) AS BIGINT) AS n_duplicate,
       count(*) FILTER (WHERE i > 0) AS n_final FROM k""",
)
def clean_report(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    return quality.clean_report(lines_to_clean(spark, d), "l_returnflag", "ship", "v", keys, "2001-06-01", k=FENCE_K)


@query(
    "q14_series_profile",
    f"""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, {cents_sql('o_totalprice')} AS c FROM orders),
g AS (SELECT o_custkey, count(*) AS n, min(d) AS first_date, max(d) AS last_date, min(c) AS min_value, max(c) AS max_value,
             avg(c) AS mean_value, CAST(max(d) - min(d) AS INT) AS span_days FROM o GROUP BY ALL)
SELECT *, n / nullif(span_days, 0)::DOUBLE AS density,
       CASE WHEN n / nullif(span_days, 0)::DOUBLE > 0.5 THEN 'daily' ELSE 'monthly' END AS freq FROM g""",
)
def series_profile(spark, d):
    orders = table(spark, d, "orders").withColumn("c", cents("o_totalprice"))
    return stats.series_profile(orders, ["o_custkey"], "o_orderdate", "c")


@query(
    "q101_daily_profile",
    f"""WITH {EVENT_DAYS_SQL},
g AS (SELECT event_type, count(*) AS n, min(ref_date) AS first_date, max(ref_date) AS last_date, min(value) AS min_value,
             max(value) AS max_value, round(avg(value), 4) AS mean_value,
             CAST(max(ref_date) - min(ref_date) AS INT) AS span_days FROM ed GROUP BY ALL)
SELECT *, n / span_days::DOUBLE AS density, CASE WHEN n / span_days::DOUBLE > 0.5 THEN 'daily' ELSE 'monthly' END AS freq
FROM g""",
)
def daily_profile(spark, d):
    out = stats.series_profile(event_days(spark, d), ["event_type"], "ref_date", "value")
    return out.withColumn("mean_value", F.round("mean_value", 4))


@query(
    "q15_mode_share",
    """WITH c AS (SELECT l_suppkey, l_discount, count(*) AS k FROM lineitem GROUP BY ALL),
g AS (SELECT l_suppkey, CAST(sum(k) AS BIGINT) AS n, arg_min(l_discount, (-k, l_discount)) AS mode_value,
             max(k) AS mode_count FROM c GROUP BY ALL)
SELECT *, round(mode_count / n * 100, 6) AS mode_pct, n > 5 AND mode_count / n * 100 > 10 AS suspicious FROM g""",
)
def mode_share(spark, d):
    out = stats.mode_share(table(spark, d, "lineitem"), ["l_suppkey"], "l_discount", min_n=5, pct=10.0)
    return out.withColumn("mode_pct", F.round("mode_pct", 6))


@query(
    "q16_constant_series",
    """WITH s AS (SELECT 'priority ' || o_orderpriority AS series, CAST(substr(o_orderpriority, 1, 1) AS INT) AS v FROM orders
           UNION ALL SELECT 'status ' || o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INT) FROM orders)
SELECT series, count(*) AS n, min(v) AS constant_value FROM s GROUP BY series
HAVING count(*) > 10 AND count(DISTINCT v) = 1""",
)
def constant_series(spark, d):
    first = F.substring("o_orderpriority", 1, 1).cast("int").alias("v")
    orders = table(spark, d, "orders")
    by_priority = orders.select(F.concat(F.lit("priority "), "o_orderpriority").alias("series"), first)
    by_status = orders.select(F.concat(F.lit("status "), "o_orderstatus").alias("series"), first)
    return stats.constant_series(by_priority.unionByName(by_status), ["series"], "v")


@query(
    "q17_iqr_fence",
    f"""WITH e AS (SELECT event_type, CAST({cents_sql('value')} AS DOUBLE) AS c FROM events),
q AS (SELECT event_type, quantile_cont(c, 0.25) AS q1, quantile_cont(c, 0.75) AS q3 FROM e GROUP BY ALL)
SELECT event_type, q1, q3, q1 - (q3 - q1) * 10 AS lower, q3 + (q3 - q1) * 10 AS upper FROM q""",
)
def iqr_fence(spark, d):
    events = table(spark, d, "events").select("event_type", cents("value").alias("c"))
    return stats.quartile_fence(events, ["event_type"], "c")


@query(
    "q102_within_fence",
    f"""WITH {nation_months_sql()},
q AS (SELECT region, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM nm GROUP BY ALL)
SELECT nm.* FROM nm JOIN q USING (region) WHERE value BETWEEN q1 - (q3 - q1) * 0.5 AND q3 + (q3 - q1) * 0.5""",
)
def within_fence(spark, d):
    return stats.within_fence(nation_months(spark, d), ["region"], "value", k=0.5, period_table=True)


@query(
    "q81_ingestion_log",
    """WITH s AS (
  SELECT l_suppkey, count(*) AS seen,
         count(*) FILTER (WHERE abs(l_extendedprice) <= 1e6 AND l_extendedprice <> 0
                          AND CAST(l_shipdate AS DATE) <= DATE '2001-10-15') AS ok FROM lineitem GROUP BY ALL),
r AS (SELECT count(*) AS n_series, count(*) FILTER (WHERE seen = ok) AS n_ok, CAST(sum(ok) AS BIGINT) AS rows_loaded FROM s)
SELECT 'run-1' AS exec_id, *, CASE WHEN n_ok = n_series THEN 'success' WHEN n_ok / n_series >= 0.8 THEN 'partial'
       ELSE 'error' END AS run_status, n_ok / n_series >= 0.8 AS accepted FROM r""",
)
def ingestion_log(spark, d):
    lines = table(spark, d, "lineitem").withColumn("ship", F.col("l_shipdate").cast("date"))
    results = quality.valid_share(lines, ["l_suppkey"], "l_extendedprice", "ship", "2001-10-15")
    return quality.ingestion_log(results, "run-1")


@query(
    "q103_dedup_counts",
    """WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_removed FROM k""",
)
def dedup_counts(spark, d):
    return upsert.dedup_counts(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q120_raw_quality_flags",
    f"""WITH e AS (SELECT event_type, ts, {cents_sql('value')} AS v FROM events),
s AS (SELECT *, avg(v) OVER r AS m, stddev_pop(v) OVER r AS sp, lag(v) OVER (PARTITION BY event_type ORDER BY ts) AS p
      FROM e WINDOW r AS (PARTITION BY event_type)),
z AS (SELECT *, abs((v - m) / sp) AS z, v::DOUBLE / nullif(p, 0) - 1 AS mom FROM s)
SELECT event_type AS series_id, 'outlier_zscore' AS flag, CASE WHEN z > 4 THEN 'high' ELSE 'medium' END AS severity,
       count(*) AS n, CAST(max(v) AS BIGINT) AS largest FROM z WHERE z > 3 GROUP BY ALL
UNION ALL SELECT event_type, 'high_mom_variation', CASE WHEN abs(mom) > 0.25 OR mom IS NULL THEN 'high' ELSE 'medium' END,
       count(*), CAST(max(v) AS BIGINT) FROM z WHERE abs(mom) > 0.10 OR (p = 0 AND v <> 0) GROUP BY ALL""",
)
def raw_quality_flags(spark, d):
    points = event_points(spark, d)
    chunk = windows.row_chunk(points, "ts", keys=["event_type"])
    flags = quality.quality_flags(points, "event_type", "ts", "c", period_table=False, chunk=chunk)
    return flags.groupBy("series_id", "flag", "severity").agg(
        F.count(F.lit(1)).alias("n"), F.max("observed").alias("largest")
    )
