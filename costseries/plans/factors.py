"""Regional factors: estimate, compare, apply, expand, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import costs, filters, quality, ranks, stats
from ..session import table
from .common import cents, cents_sql, money_sql, money_sum, month
from .registry import query

BASELINE = "NATION_0"


def ordered_months(spark: SparkSession, d: str) -> DataFrame:
    """Monthly revenue per customer nation, for the newest month and the twelve before it.

    The period is cut on the raw lines, before any join.
    """
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_shipdate")
    lines = filters.recent_month_rows(lines, "l_shipdate", 12)
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("region", month("l_shipdate").alias("ref_date"))
        .agg(money_sum("l_extendedprice").alias("value"))
    )


def factors(spark: SparkSession, d: str) -> DataFrame:
    fact = ordered_months(spark, d)
    out = costs.empirical_factors(fact, "region", "ref_date", "value", BASELINE, months=None, digits=6)
    return out.withColumn("std_value", F.round("std_value", 2))


FACTORS_SQL = f"""
fact AS (
  SELECT n_name AS region, CAST(date_trunc('month', l_shipdate) AS DATE) AS ref_date,
         {money_sql('l_extendedprice')} AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
means AS (
  SELECT region, round(avg(value), 6) AS avg_value, count(*) AS n, round(stddev_samp(value), 6) AS sd,
         min(ref_date) AS first_date, max(ref_date) AS last_date
  FROM fact WHERE ref_date >= (SELECT max(ref_date) FROM fact) - INTERVAL 12 MONTH GROUP BY region),
emp AS (
  SELECT region, avg_value, n, round(sd, 2) AS std_value, first_date, last_date,
         round(sd / avg_value, 4) AS cv,
         round(avg_value / (SELECT avg_value FROM means WHERE region = '{BASELINE}'), 4) AS factor
  FROM means)"""


@query("q01_empirical_factors", f"WITH {FACTORS_SQL} SELECT *, round((factor - 1) * 100, 2) AS deviation_pct FROM emp")
def empirical_factors(spark, d):
    return factors(spark, d)


def theory(spark: SparkSession, d: str) -> DataFrame:
    """Assumed factor per nation; one world region has none."""
    region = table(spark, d, "region").filter(F.col("r_name") != "MIDDLE EAST")
    assumed = F.round(F.lit(0.9) + F.pmod(F.col("n_nationkey"), F.lit(5)) * 0.05, 4)
    return (
        table(spark, d, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("region"), F.col("r_name").alias("world_region"), assumed.alias("expected"))
    )


def compared(spark: SparkSession, d: str) -> DataFrame:
    actual = factors(spark, d).select("region", "factor", "avg_value", "n")
    return costs.compare_factors(theory(spark, d), actual, "region", "expected", "factor")


THEORY_SQL = """theory AS (
  SELECT n_name AS region, r_name AS world_region,
         round(0.9::DOUBLE + (n_nationkey % 5) * 0.05::DOUBLE, 4) AS expected
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST')"""

COMPARED_SQL = f"""{FACTORS_SQL}, {THEORY_SQL},
cmp0 AS (
  SELECT coalesce(t.region, e.region) AS region, world_region, expected, factor, avg_value, n,
         round(factor - expected, 4) AS diff_abs, round((factor / expected - 1) * 100, 2) AS diff_pct
  FROM theory t FULL JOIN emp e ON t.region = e.region),
cmp AS (
  SELECT *, coalesce(abs(diff_abs) > 0.05, false) AS significant,
         CASE WHEN diff_abs IS NULL THEN 'INSUFFICIENT_DATA' WHEN abs(diff_abs) <= 0.02 THEN 'KEEP'
              WHEN abs(diff_abs) <= 0.05 THEN 'LIGHT_ADJUSTMENT' ELSE 'REVIEW' END AS advice
  FROM cmp0)"""


@query("q02_compare_factors", f"WITH {COMPARED_SQL} SELECT * FROM cmp")
def compare_factors(spark, d):
    return compared(spark, d)


@query(
    "q03_apply_factors",
    f"""WITH {COMPARED_SQL},
kinds AS (SELECT p_type AS method, round(avg(p_size) / 25, 2) AS base_factor FROM part GROUP BY ALL),
dim AS (SELECT n_name AS region, method, base_factor, 1.0::DOUBLE AS current_factor FROM nation CROSS JOIN kinds),
pick AS (
  SELECT d.*, advice,
         CASE WHEN advice IN ('LIGHT_ADJUSTMENT', 'REVIEW') THEN coalesce(factor, current_factor)
              ELSE current_factor END AS final_factor
  FROM dim d LEFT JOIN cmp USING (region))
SELECT region, method, base_factor, current_factor, final_factor,
       CASE WHEN advice IS NULL THEN 'UNMATCHED' WHEN advice IN ('LIGHT_ADJUSTMENT', 'REVIEW') THEN 'EMPIRICAL'
            ELSE 'THEORY_KEPT' END AS factor_origin,
       round(base_factor * final_factor, 6) AS regional_cost_factor
FROM pick""",
)
def apply_factors(spark, d):
    kinds = table(spark, d, "part").groupBy(F.col("p_type").alias("method")).agg(
        F.round(F.avg("p_size") / 25, 2).alias("base_factor")
    )
    places = table(spark, d, "nation").select(F.col("n_name").alias("region"))
    dim = costs.joins.cross_product(places, kinds).withColumn("current_factor", F.lit(1.0))
    applied = costs.apply_factors(dim, compared(spark, d), "region", "current_factor", "base_factor")
    product = F.round(F.col("base_factor") * F.col("final_factor"), 6)
    return applied.withColumn("regional_cost_factor", product)


@query(
    "q37_expand_regional",
    """WITH methods AS (
  SELECT p_type AS method, round(avg(p_size) / 25, 2) AS cost_base,
         round(avg(CAST(round(p_retailprice * 100) AS BIGINT)) / 150000, 2) AS time_base
  FROM part GROUP BY ALL),
places AS (
  SELECT n_name AS place, r_name AS world_region,
         CASE WHEN n_name = 'NATION_0' THEN 1.0::DOUBLE
              ELSE round(0.9::DOUBLE + n_regionkey * 0.05::DOUBLE
                         + (CAST('0x' || substr(md5(n_name), 1, 8) AS BIGINT) % 1995 - 997)
                           * (0.02::DOUBLE / 997), 3) END AS place_factor
  FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT row_number() OVER (ORDER BY method, place) AS id, method, cost_base, time_base, place, world_region, place_factor,
       round(place_factor * cost_base, 6) AS cost_factor, round(place_factor * time_base, 6) AS time_factor
FROM methods CROSS JOIN places""",
)
def expand_regional(spark, d):
    methods = table(spark, d, "part").groupBy(F.col("p_type").alias("method")).agg(
        F.round(F.avg("p_size") / 25, 2).alias("cost_base"),
        F.round(F.avg(cents("p_retailprice")) / 150000, 2).alias("time_base"),
    )
    region = table(spark, d, "region")
    places = (
        table(spark, d, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("place"), F.col("r_name").alias("world_region"))
    )
    specific = places.filter(F.col("place") == BASELINE).select("place", F.lit(1.0).alias("specific_factor"))
    regional = region.select(
        F.col("r_name").alias("world_region"), (F.lit(0.9) + F.col("r_regionkey") * 0.05).alias("region_factor")
    )
    out = costs.expand_regional(
        methods, places, specific, regional, "method", "place", "world_region", "cost_base", "time_base"
    )
    return out.withColumns(
        {
            "cost_factor": F.round(F.col("place_factor") * F.col("cost_base"), 6),
            "time_factor": F.round(F.col("place_factor") * F.col("time_base"), 6),
        }
    )


@query(
    "q55_regional_rollup",
    f"""WITH {COMPARED_SQL}
SELECT world_region, round(avg(expected), 4) AS avg_theory, min(expected) AS min_theory, max(expected) AS max_theory,
       round(avg(factor), 4) AS avg_actual, min(factor) AS min_actual, max(factor) AS max_actual,
       round(avg(diff_abs), 4) AS avg_diff, round(stddev_samp(diff_abs), 4) AS std_diff,
       round(avg(diff_pct), 4) AS avg_diff_pct, round(stddev_samp(diff_pct), 4) AS std_diff_pct,
       count(*) FILTER (WHERE significant) AS n_flagged, count(*) AS n,
       CASE WHEN round(avg(diff_abs), 4) <= 0.02 THEN 'HIGH' WHEN round(avg(diff_abs), 4) <= 0.05 THEN 'MEDIUM'
            ELSE 'LOW' END AS precision
FROM cmp GROUP BY world_region""",
)
def regional_rollup(spark, d):
    out = stats.regional_rollup(
        compared(spark, d), "world_region", "expected", "factor", "diff_abs", "diff_pct", "significant"
    )
    rounded = ("avg_theory", "avg_actual", "avg_diff", "std_diff", "avg_diff_pct", "std_diff_pct")
    return out.withColumns({c: F.round(c, 4) for c in rounded})


@query(
    "q56_metric_feed",
    f"""WITH {COMPARED_SQL},
known AS (SELECT * FROM cmp WHERE world_region IS NOT NULL)
SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value, 'overall' AS category FROM known
UNION ALL SELECT 'flagged', CAST(count_if(significant) AS DOUBLE), 'overall' FROM known
UNION ALL SELECT world_region || ' - mean diff', round(avg(diff_abs), 3), 'group' FROM known GROUP BY world_region
UNION ALL SELECT world_region || ' - flagged', CAST(count_if(significant) AS DOUBLE), 'group'
          FROM known GROUP BY world_region
UNION ALL (SELECT 'gap - ' || region, round(diff_abs, 3), 'top' FROM known
           ORDER BY abs(diff_abs) DESC NULLS LAST, region LIMIT 5)""",
)
def metric_feed(spark, d):
    known = compared(spark, d).filter("world_region IS NOT NULL")
    return stats.metric_feed(known, "world_region", "diff_abs", "significant", "region")


@query(
    "q57_arg_extremes",
    f"""SELECT p_brand, arg_min(p_partkey, (p_retailprice, p_partkey)) AS min_label, min(p_retailprice) AS min_value,
       arg_min(p_partkey, (-p_retailprice, p_partkey)) AS max_label, max(p_retailprice) AS max_value,
       count(*) AS n, CAST(sum({cents_sql('p_retailprice')}) AS BIGINT) AS total,
       avg({cents_sql('p_retailprice')}) AS mean, count(DISTINCT p_type) AS n_labels
FROM part GROUP BY p_brand""",
)
def arg_extremes(spark, d):
    part = table(spark, d, "part")
    extremes = stats.arg_extremes(part, "p_retailprice", "p_partkey", ["p_brand"])
    summary = stats.dim_statistics(part.withColumn("c", cents("p_retailprice")), "p_brand", "c", "p_type")
    return extremes.join(summary, "p_brand")


@query(
    "q58_top_k",
    """WITH o AS (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT * FROM (
  (SELECT *, 'largest' AS part FROM o ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
  UNION ALL (SELECT *, 'smallest' FROM o ORDER BY o_totalprice, o_orderkey LIMIT 5)
  UNION ALL (SELECT *, 'first' FROM o ORDER BY order_date, o_orderkey LIMIT 3)
  UNION ALL (SELECT *, 'last' FROM o ORDER BY order_date DESC, o_orderkey DESC LIMIT 3))""",
)
def top_k(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("order_date"))
    largest = ranks.top_k(o, "o_totalprice", 5, "o_orderkey").withColumn("part", F.lit("largest"))
    smallest = ranks.bottom_k(o, "o_totalprice", 5, "o_orderkey").withColumn("part", F.lit("smallest"))
    ends = ranks.head_tail(o, ["order_date", "o_orderkey"], 3)
    return largest.unionByName(smallest).unionByName(ends)


@query(
    "q92_latest_per_customer",
    """SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_order,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_key
FROM orders GROUP BY o_custkey""",
)
def latest_per_customer(spark, d):
    out = ranks.latest_per_group(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", F.col("o_orderdate").cast("date").alias("last_order"), F.col("o_orderkey").alias("last_key"))


@query(
    "q80_enrich_compare",
    f"""WITH {FACTORS_SQL}, {THEORY_SQL},
j AS (SELECT t.region, expected, factor, abs(factor - expected) / factor AS rel,
             abs(cv - 0.1::DOUBLE) AS share FROM theory t JOIN emp USING (region))
SELECT region, 'expected' AS kind, round(rel, 6) AS difference FROM j WHERE rel > 0.10
UNION ALL SELECT region, 'expected_cv', round(share, 6) FROM j WHERE share > 0.05""",
)
def enrich_compare(spark, d):
    own = theory(spark, d).withColumn("expected_cv", F.lit(0.1))
    ref = factors(spark, d).select("region", "factor", "cv")
    out = quality.enrich_and_compare(own, ref, ["region"], ("expected", "factor"), {"expected_cv": "cv"})
    return out.withColumn("difference", F.round("difference", 6))


@query(
    "q97_scaffold_check",
    """WITH f AS (
  SELECT p_type AS method, n_name AS place, CASE WHEN n_name = 'NATION_0' AND p_type NOT LIKE 'S%' THEN 1.0 ELSE 1.1 END AS factor, n_nationkey AS k
  FROM (SELECT DISTINCT p_type FROM part) CROSS JOIN nation),
s AS (SELECT method, CASE WHEN k = 3 AND method = 'PROMO' THEN NULL ELSE place END AS place, factor FROM f WHERE NOT (k = 7 AND method LIKE 'S%')
      UNION ALL SELECT method, place, factor FROM f WHERE k = 9),
m AS (SELECT count(*) AS n, count(DISTINCT method) * count(DISTINCT place) AS cells, count(DISTINCT (method, place)) FILTER (WHERE method IS NOT NULL AND place IS NOT NULL) AS pairs,
        count(*) FILTER (WHERE place = 'NATION_0') AS base, count(*) FILTER (WHERE place = 'NATION_0' AND factor <> 1.0 OR place IS NULL) AS off,
        min(place) FILTER (WHERE place = 'NATION_0' AND factor <> 1.0) AS off_sample, count(*) FILTER (WHERE method IS NULL OR place IS NULL) AS missing FROM s)
SELECT 'all pairs present' AS "rule", 'error' AS severity, CAST(cells - pairs AS DOUBLE) AS metric, cells = pairs AS passed, NULL::VARCHAR AS sample FROM m
UNION ALL SELECT 'pairs unique', 'error', CAST(n - pairs AS DOUBLE), n = pairs, NULL FROM m
UNION ALL SELECT 'baseline present', 'error', CAST(base AS DOUBLE), base > 0, NULL FROM m
UNION ALL SELECT 'baseline factor is one', 'error', CAST(off AS DOUBLE), off = 0, off_sample FROM m
UNION ALL SELECT 'keys not null', 'error', CAST(missing AS DOUBLE), missing = 0, NULL FROM m""",
)
def scaffold_check(spark, d):
    """A scaffold with pairs that are missing, repeated or without a place, and a baseline that is not one everywhere."""
    methods = table(spark, d, "part").select(F.col("p_type").alias("method")).distinct()
    places = table(spark, d, "nation").select(F.col("n_name").alias("place"), F.col("n_nationkey").alias("k"))
    special = F.col("method").startswith("S")
    factor = F.when((F.col("place") == BASELINE) & ~special, 1.0).otherwise(1.1)
    whole = costs.joins.cross_product(methods, places).withColumn("factor", factor)
    unnamed = (F.col("k") == 3) & (F.col("method") == "PROMO")
    grid = whole.filter(~((F.col("k") == 7) & special)).withColumn("place", F.when(~unnamed, F.col("place")))
    grid = grid.unionByName(whole.filter("k = 9"))
    return quality.scaffold_check(grid, "method", "place", BASELINE, "factor")


