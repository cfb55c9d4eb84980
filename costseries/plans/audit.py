"""Table profiles, contracts and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality, ranks, stats
from ..session import table, workspace
from ..sources import read_latest, write_overwrite
from .common import cents, cents_sql
from .registry import query

NUMBER, DATED = r"^\s*[+-]?[0-9]+([.,][0-9]+)?\s*$", r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4})"


def profile_sql(name: str, text_cols: list[str], other_cols: list[str]) -> str:
    parts = []
    for c in text_cols + other_cols:
        blank = f"count(*) FILTER (WHERE trim({c}) = '')" if c in text_cols else "0::BIGINT"
        parts.append(
            f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_null,
  {blank} AS n_blank, count(*) FILTER (WHERE regexp_matches({c}::VARCHAR, '{NUMBER}')) AS n_numeric,
  count(*) FILTER (WHERE regexp_matches({c}::VARCHAR, '{DATED}')) AS n_date_like FROM {name}"""
        )
    body = " UNION ALL ".join(parts)
    return f"""SELECT *, n_numeric > (n_rows - n_null - n_blank) * 0.5 AS is_numeric,
       n_date_like > (n_rows - n_null - n_blank) * 0.5 AS is_date_like FROM ({body})"""


@query(
    "q49_table_profile",
    profile_sql("orders", ["o_orderstatus", "o_orderpriority"], ["o_orderkey", "o_custkey", "o_orderdate", "cents"]).replace(
        "FROM orders", f"FROM (SELECT *, {cents_sql('o_totalprice')} AS cents FROM orders)"
    ),
)
def table_profile(spark, d):
    orders = table(spark, d, "orders")  # all columns; the price as whole cents, whose text is the same everywhere
    return stats.table_profile(orders.withColumn("cents", cents("o_totalprice")).drop("o_totalprice"))


@query(
    "q104_duplicate_rows",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS n_duplicates FROM lineitem",
)
def duplicate_rows(spark, d):
    return stats.duplicate_rows(table(spark, d, "lineitem"))


GATE_TABLES = {
    "region": "r_regionkey, r_name",
    "nation": "n_nationkey, n_name, n_regionkey",
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "part": "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate",
    "events": "event_id, ts, user_id, event_type, value, props",
    "documents": "doc_id, text, lang, source, n_chars",
    "embeddings": "vec_id, embedding, label",
    "pages": "page_id, url, html",
    "benchmark": "item_id, text",
    "labels": "doc_id, quality, toxic",
    "conversations": "conv_id, turn, role, text",
}
GATE_EXPECTED = {"region": 5, "nation": 27, "supplier": 5}
GATE_REQUIRED = {
    "region": [quality.Cardinality(5, 5)],
    "nation": [quality.Cardinality(27, 27, severity="NOTE"), quality.Cardinality(5, where="n_regionkey = 1")],
    "customer": [quality.Cardinality(1, where="c_mktsegment = 'BUILDING'"), quality.Cardinality(high=0, where="c_acctbal > 9000")],
    "part": [quality.Cardinality(10**9, where="p_size > 40", severity="NOTE")],
}


def broken_sql(rule) -> str:
    held = f"count(*) FILTER (WHERE {rule.where})"
    bounds = [f"{held} < {rule.low}"] * (rule.low is not None) + [f"{held} > {rule.high}"] * (rule.high is not None)
    return f"CAST({' OR '.join(bounds)} AS INT)"


def gate_sql() -> str:
    parts = []
    for t, cols in GATE_TABLES.items():
        expected = f"{GATE_EXPECTED[t]}::BIGINT" if t in GATE_EXPECTED else "NULL::BIGINT"
        nulls = " + ".join(f"CAST({c.strip()} IS NULL AS INT)" for c in cols.split(","))
        rules = GATE_REQUIRED.get(t, [])
        broken, warned = (
            " + ".join([broken_sql(r) for r in rules if r.severity in kinds] or ["0"]) for kinds in (("NOTE", "WARNING"), ("WARNING",))
        )
        parts.append(
            f"""SELECT '{t}' AS table_name, {expected} AS n_expected, count(*) AS n_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {t})) AS n_duplicates,
  CAST(sum({nulls}) AS BIGINT) AS n_null_cells, CAST({broken} AS INT) AS n_broken, {warned} > 0 AS warned FROM {t}"""
        )
    body = " UNION ALL ".join(parts)
    return f"""gate AS (SELECT * EXCLUDE (warned), CASE WHEN n_rows = 0 THEN 'FAILED'
  WHEN coalesce(n_rows < n_expected * 0.95, false) OR n_duplicates > 0 OR warned THEN 'WARNING' ELSE 'PASSED' END AS status
  FROM ({body}))"""


def gate(spark, d):
    tables = {t: table(spark, d, t).select(*[c.strip() for c in cols.split(",")]) for t, cols in GATE_TABLES.items()}
    return quality.table_gate(tables, GATE_EXPECTED, required=GATE_REQUIRED)


@query("q50_table_gate", f"WITH {gate_sql()} SELECT * FROM gate")
def table_gate(spark, d):
    return gate(spark, d)


@query(
    "q105_gate_verdict",
    f"""WITH {gate_sql()} SELECT count(*) AS n_tables, count(*) FILTER (WHERE status = 'WARNING') AS n_warning,
       count(*) FILTER (WHERE status = 'FAILED') AS n_failed,
       CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'NO-GO' ELSE 'GO' END AS verdict FROM gate""",
)
def gate_verdict(spark, d):
    return quality.verdict(gate(spark, d))


def rule_sql(name: str, severity: str, failing: str) -> str:
    return f"""SELECT '{name}' AS rule, '{severity}' AS severity, CAST(count(*) FILTER (WHERE {failing}) AS DOUBLE) AS metric,
  count(*) FILTER (WHERE {failing}) = 0 AS passed,
  min(CAST(c_custkey AS VARCHAR)) FILTER (WHERE {failing}) AS sample FROM c"""


@query(
    "q51_contract",
    """WITH c AS (SELECT *, c_acctbal / 10000 AS a, 1 - c_acctbal / 10000 AS b, '2024-01-' || (c_nationkey + 10) AS day
           FROM customer)
SELECT 'row count' AS rule, 'error' AS severity, CAST(count(*) AS DOUBLE) AS metric, count(*) = 1500 AS passed,
       NULL::VARCHAR AS sample FROM c
UNION ALL SELECT 'c_custkey unique', 'error', CAST(count(c_custkey) - count(DISTINCT c_custkey) AS DOUBLE),
       count(c_custkey) = count(DISTINCT c_custkey), NULL FROM c
"""
    + "".join(
        " UNION ALL " + rule_sql(*r)
        for r in (
            ("c_name not null", "error", "c_name IS NULL"),
            ("c_acctbal in range", "warning", "NOT (c_acctbal BETWEEN 0 AND 9500)"),
            ("c_mktsegment allowed", "error", "c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE', 'HOUSEHOLD')"),
            ("shares sum to one", "warning", "NOT (a + b BETWEEN 0.98 AND 1.02)"),
            ("day iso date", "warning", "try_cast(day AS DATE) IS NULL"),
        )
    ),
)
def contract(spark, d):
    share = F.col("c_acctbal") / 10000
    customers = table(spark, d, "customer").withColumns(
        {
            "a": share,
            "b": F.lit(1) - share,
            "day": F.concat(F.lit("2024-01-"), (F.col("c_nationkey") + 10).cast("string")),
        }
    )
    rules = [
        quality.row_count(1500),
        quality.unique_key("c_custkey"),
        quality.not_null("c_name"),
        quality.in_range("c_acctbal", 0, 9500),
        quality.in_set("c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE", "HOUSEHOLD"]),
        quality.sums_to_one(["a", "b"]),
        quality.date_format_rule("day"),
    ]
    return quality.contract(customers, rules, "c_custkey")


@query(
    "q52_readiness",
    """WITH m AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(DISTINCT l_suppkey) AS DOUBLE) AS s,
  CAST(count(l_orderkey) - count(DISTINCT l_orderkey) AS DOUBLE) AS dup,
  CAST(count(*) FILTER (WHERE l_extendedprice IS NULL) AS DOUBLE) AS nul,
  CAST(count(*) FILTER (WHERE CAST(l_shipdate AS DATE) > DATE '2001-01-01') AS DOUBLE) AS fut FROM lineitem),
r AS (
  SELECT 'enough rows' AS rule, 'critical' AS severity, n AS metric, n > 5000 AS passed FROM m
  UNION ALL SELECT 'enough series', 'critical', s, s >= 9 FROM m
  UNION ALL SELECT 'names present', 'critical', 1, true FROM m
  UNION ALL SELECT 'no duplicates', 'critical', dup, dup = 0 FROM m
  UNION ALL SELECT 'no missing values', 'critical', nul, nul = 0 FROM m
  UNION ALL SELECT 'no future dates', 'critical', fut, fut = 0 FROM m
  UNION ALL SELECT 'mom present', 'optional', 0, false FROM m
  UNION ALL SELECT 'yoy present', 'optional', 0, false FROM m)
SELECT * FROM r UNION ALL
SELECT 'ready', 'critical', CAST(count(*) FILTER (WHERE severity = 'critical' AND NOT passed) AS DOUBLE),
       count(*) FILTER (WHERE severity = 'critical' AND NOT passed) = 0 FROM r""",
)
def readiness(spark, d):
    lines = table(spark, d, "lineitem").withColumn("ship", F.col("l_shipdate").cast("date"))
    return quality.readiness(
        lines, "l_orderkey", "l_suppkey", "l_extendedprice", "ship", "2001-01-01", name="l_returnflag"
    )


@query(
    "q53_completeness",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
  count(*) FILTER (WHERE {c} = 0) AS n_zero, count(*) FILTER (WHERE {c} <> 0) AS n_filled FROM l"""
        for c in ("l_discount", "l_tax", "charge")
    ).replace(" FROM l", " FROM (SELECT *, nullif(l_discount, 0.05) * l_extendedprice AS charge FROM lineitem)"),
)
def completeness(spark, d):
    charge = F.nullif(F.col("l_discount"), F.lit(0.05)) * F.col("l_extendedprice")
    lines = table(spark, d, "lineitem").withColumn("charge", charge)
    return quality.completeness(lines, ["l_discount", "l_tax", "charge"])


@query(
    "q54_redundancy",
    """WITH c AS (SELECT CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN -l_quantity ELSE l_quantity END AS qty,
         l_returnflag, * EXCLUDE (l_quantity, l_returnflag) FROM lineitem WHERE l_returnflag IN ('R', 'A')),
w AS (SELECT l_quantity AS qty, l_returnflag, * EXCLUDE (l_quantity, l_returnflag) FROM lineitem)
SELECT n_whole, n_parts, only_in_whole, only_in_parts, abs(n_whole - n_parts) <= 10 AS redundant_by_count,
       only_in_whole = 0 AND only_in_parts = 0 AS redundant_by_content
FROM (SELECT (SELECT count(*) FROM w) AS n_whole, (SELECT count(*) FROM c) AS n_parts,
             (SELECT count(*) FROM (FROM w EXCEPT ALL FROM c)) AS only_in_whole,
             (SELECT count(*) FROM (FROM c EXCEPT ALL FROM w)) AS only_in_parts)""",
)
def redundancy(spark, d):
    """Two parts of a table; in one of them some quantities were changed."""
    lines = table(spark, d, "lineitem")
    changed = F.when(F.col("l_linenumber") == 1, -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    parts = [lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag = 'A'").withColumn("l_quantity", changed)]
    return quality.redundancy(lines, parts)


@query(
    "q82_post_write_check",
    """WITH e AS (SELECT nullif(o_orderkey, 1) AS k FROM orders),
a AS (SELECT CASE WHEN k % 10 = 3 THEN -k ELSE k END AS k FROM e WHERE k IS NULL OR k % 7 <> 0),
n AS (SELECT coalesce(e.c, 0) AS e, coalesce(a.c, 0) AS a FROM (SELECT k, count(*) AS c FROM e GROUP BY k) e
      FULL JOIN (SELECT k, count(*) AS c FROM a GROUP BY k) a ON e.k IS NOT DISTINCT FROM a.k)
SELECT CAST(sum(e) AS BIGINT) AS n_expected, CAST(sum(a) AS BIGINT) AS n_actual, count(*) FILTER (WHERE a = 0) AS n_lost,
       count(*) FILTER (WHERE e = 0) AS n_added, count(*) FILTER (WHERE a = 0 OR e = 0) = 0 AS ok FROM n""",
)
def post_write_check(spark, d):
    """A table replaced by a copy of itself that lost some keys and changed others; one key is missing."""
    orders = table(spark, d, "orders").withColumn("amount", cents("o_totalprice"))
    orders = orders.withColumn("o_orderkey", F.nullif(F.col("o_orderkey"), F.lit(1).cast("bigint")))
    cols = ["o_orderkey", "o_custkey", "o_orderdate", "amount"]
    path = workspace(spark, "post-write")
    write_overwrite(orders, path, cols, ["o_orderkey"])
    key = F.col("o_orderkey")
    broken = read_latest(spark, path).filter(key.isNull() | (key % 7 != 0))
    write_overwrite(broken.withColumn("o_orderkey", F.when(key % 10 == 3, -key).otherwise(key)), path, cols, ["o_orderkey"])
    return quality.post_write_check(orders.select(*cols), read_latest(spark, path), ["o_orderkey"])


@query(
    "q124_order_by_magnitude",
    """SELECT row_number() OVER (ORDER BY abs(c_acctbal) DESC NULLS LAST, c_custkey) AS position, c_custkey, c_acctbal FROM customer""",
)
def order_by_magnitude(spark, d):
    return ranks.order_by_abs(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", "position")
