"""Changes, shares, composites and period filters over series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costs, dims, filters, joins, stats, upsert, windows
from ..session import table
from .common import (
    EVENT_DAYS_SQL,
    MONTH_SQL,
    TYPE_MONTHS_SQL,
    cents,
    cents_sql,
    event_days,
    money_sql,
    money_sum,
    month,
    nation_months,
    nation_months_sql,
    type_months,
)
from .registry import query


def change_sql(value: str, lag: int, window: str = "w") -> str:
    return f"round(({value} / nullif(lag({value}, {lag}) OVER {window}, 0) - 1) * 100, 4)"


def rounded(df, *cols, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in cols})


PANEL = ("l_linestatus", "l_returnflag")


@query(
    "q04_mom_yoy",
    f"""WITH {nation_months_sql(*PANEL)}
SELECT *, {change_sql('value', 1)} AS mom, {change_sql('value', 12)} AS yoy
FROM nm WINDOW w AS (PARTITION BY region, l_linestatus, l_returnflag ORDER BY ref_date)""",
)
def mom_yoy(spark, d):
    out = windows.mom_yoy(nation_months(spark, d, *PANEL), ["region", *PANEL], "ref_date", "value")
    return rounded(out, "mom", "yoy")


@query(
    "q05_variations_by_freq",
    f"""WITH {EVENT_DAYS_SQL}, {TYPE_MONTHS_SQL},
s AS (SELECT event_type AS series, ref_date, value, 'daily' AS freq FROM ed
      UNION ALL SELECT p_type, ref_date, value, 'monthly' FROM tm)
SELECT series, ref_date, value, freq,
       CASE WHEN freq = 'daily' THEN {change_sql('value', 1)} END AS var_day,
       CASE WHEN freq = 'daily' THEN {change_sql('value', 21)} ELSE {change_sql('value', 1)} END AS var_month,
       CASE WHEN freq = 'daily' THEN {change_sql('value', 252)} ELSE {change_sql('value', 12)} END AS var_year
FROM s WINDOW w AS (PARTITION BY series ORDER BY ref_date)""",
)
def variations_by_freq(spark, d):
    daily = event_days(spark, d).withColumnRenamed("event_type", "series")
    monthly = type_months(spark, d).withColumnRenamed("p_type", "series")
    both = upsert.union_tagged({"daily": daily, "monthly": monthly}, "freq")
    out = windows.variations(both, ["series"], "ref_date", "value", "freq", daily_preset="daily_21")
    return rounded(out, "var_day", "var_month", "var_year")


@query(
    "q06_calendar_mom",
    f"""WITH {nation_months_sql(*PANEL)},
j AS (SELECT a.*, b.value AS m, c.value AS y FROM nm a
      LEFT JOIN nm b ON b.region = a.region AND b.l_linestatus = a.l_linestatus AND b.l_returnflag = a.l_returnflag
                    AND a.ref_date = b.ref_date + INTERVAL 1 MONTH
      LEFT JOIN nm c ON c.region = a.region AND c.l_linestatus = a.l_linestatus AND c.l_returnflag = a.l_returnflag
                    AND a.ref_date = c.ref_date + INTERVAL 12 MONTH)
SELECT region, l_linestatus, l_returnflag, ref_date, value, round((value / m - 1) * 100, 4) AS mom,
       round((value / y - 1) * 100, 4) AS yoy FROM j""",
)
def calendar_mom(spark, d):
    fact = nation_months(spark, d, *PANEL)
    out = windows.calendar_change(fact, ["region", *PANEL], "ref_date", "value", {"mom": 1, "yoy": 12})
    return rounded(out, "mom", "yoy")


@query(
    "q26_share_of_total",
    f"""WITH {TYPE_MONTHS_SQL}
SELECT *, round(value / sum(value) OVER (PARTITION BY ref_date) * 100, 6) AS share_pct FROM tm""",
)
def share_of_total(spark, d):
    out = windows.share_of_total(type_months(spark, d), ["ref_date"], "value", period_table=True)
    return rounded(out, "share_pct", digits=6)


@query(
    "q98_order_share",
    f"""WITH t AS (SELECT l_suppkey, sum({cents_sql('l_extendedprice')}) AS total FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_suppkey, {cents_sql('l_extendedprice')} AS amount,
       round(CAST({cents_sql('l_extendedprice')} AS DOUBLE) / CAST(total AS DOUBLE) * 100, 6) AS share_pct
FROM lineitem JOIN t USING (l_suppkey)""",
)
def line_share(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", cents("l_extendedprice").alias("amount")
    )
    return rounded(windows.share_of_total(lines, ["l_suppkey"], "amount"), "share_pct", digits=6)


@query(
    "q27_weighted_composite",
    f"""WITH {nation_months_sql()}, sizes AS (
  SELECT p_type, CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'Residential' ELSE 'Commercial' END AS category,
         p_type <> 'PROMO' AS is_active, count(*) AS n FROM part GROUP BY ALL),
weights AS (SELECT p_type, category, round(n / sum(n) OVER (PARTITION BY category), 4) AS weight, is_active FROM sizes),
fact AS (
  SELECT n_name AS region, p_type, {MONTH_SQL} AS ref_date, {money_sql('l_extendedprice')} AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
SELECT region, ref_date, category, round(sum(value * weight), 2) AS composite
FROM fact JOIN weights USING (p_type) WHERE is_active GROUP BY ALL""",
)
def weighted_composite(spark, d):
    part = table(spark, d, "part")
    residential = F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO")
    sizes = part.groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {
            "category": F.when(residential, "Residential").otherwise("Commercial"),
            "is_active": F.col("p_type") != "PROMO",
        }
    )
    weights = windows.share_of_total(sizes, ["category"], "n", "pct", period_table=True).withColumn(
        "weight", F.round(F.col("pct") / 100, 4)
    )
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    fact = (
        table(spark, d, "lineitem")
        .join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("region", "p_type", month("l_shipdate").alias("ref_date"))
        .agg(money_sum("l_extendedprice").alias("value"))
    )
    return costs.weighted_composite(fact, weights, "p_type", ["region", "ref_date"], "value")


@query(
    "q63_ytd_12m",
    f"""WITH {nation_months_sql()}
SELECT a.*, round((a.value / nullif(lag(a.value, 12) OVER (PARTITION BY a.region ORDER BY a.ref_date), 0) - 1) * 100, 4)
         AS chg_12m,
       round((a.value / nullif(dec.value, 0) - 1) * 100, 4) AS chg_ytd
FROM nm a LEFT JOIN nm dec ON dec.region = a.region AND month(dec.ref_date) = 12
     AND year(dec.ref_date) = year(a.ref_date) - 1""",
)
def ytd_12m(spark, d):
    out = windows.ytd_12m_change(nation_months(spark, d), ["region"], "ref_date", "value")
    return rounded(out, "chg_12m", "chg_ytd")


AS_OF = "2001-08-15"


@query(
    "q64_release_gate",
    f"""WITH {TYPE_MONTHS_SQL},
days AS (SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS ref_date, {money_sql('l_extendedprice')} AS value
         FROM lineitem GROUP BY ALL),
s AS (SELECT *, 'daily' AS freq FROM days UNION ALL SELECT p_type, ref_date, value, 'monthly' FROM tm),
g AS (SELECT *, CASE WHEN freq = 'daily' THEN DATE '{AS_OF}' - 1 ELSE DATE '2001-07-31' END AS last_day FROM s)
SELECT series, ref_date, value, freq FROM g WHERE ref_date <= last_day AND ref_date >= last_day - 365""",
)
def release_gate(spark, d):
    days = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_returnflag").alias("series"), F.col("l_shipdate").cast("date").alias("ref_date"))
        .agg(money_sum("l_extendedprice").alias("value"))
    )
    monthly = type_months(spark, d).withColumnRenamed("p_type", "series")
    both = upsert.union_tagged({"daily": days, "monthly": monthly}, "freq")
    return filters.release_gate(both, "ref_date", "freq", AS_OF)


@query(
    "q65_valid_points",
    f"""WITH p AS (
  SELECT 'abs' AS preset, * FROM lineitem WHERE abs(l_extendedprice) <= 1e6 AND l_extendedprice <> 0
  UNION ALL SELECT 'range', * FROM lineitem WHERE l_discount > -1000 AND l_discount < 1e6 AND l_discount <> 0
  UNION ALL SELECT 'range_zero', * FROM lineitem WHERE l_discount > -1000 AND l_discount < 1e6)
SELECT preset, l_returnflag, count(*) AS n, CAST(sum({cents_sql('l_extendedprice')}) AS BIGINT) AS total_cents,
       CAST(max(l_shipdate) AS DATE) AS last_date
FROM p WHERE CAST(l_shipdate AS DATE) <= DATE '2001-01-01' GROUP BY ALL""",
)
def valid_points(spark, d):
    lines = table(spark, d, "lineitem").withColumn("ship", F.col("l_shipdate").cast("date"))
    parts = {
        preset: filters.valid_points(lines, value, "ship", "2001-01-01", preset)
        for preset, value in (("abs", "l_extendedprice"), ("range", "l_discount"), ("range_zero", "l_discount"))
    }
    return (
        upsert.union_tagged(parts, "preset")
        .groupBy("preset", "l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents("l_extendedprice")).alias("total_cents"),
            F.max("ship").alias("last_date"),
        )
    )


ROUTES_SQL = """CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_discount > 0.05 THEN 'discounted' ELSE 'plain' END"""


def routes():
    return {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05}


@query(
    "q66_split_route",
    f"""WITH r AS (SELECT *, {ROUTES_SQL} AS route FROM lineitem)
SELECT count(*) AS n_total, count(*) FILTER (WHERE route = 'returned') AS n_returned,
       count(*) FILTER (WHERE route = 'discounted') AS n_discounted,
       count(*) FILTER (WHERE route = 'plain') AS n_plain, true AS complete,
       (SELECT count(DISTINCT l_suppkey) FROM r WHERE route = 'plain') AS plain_suppliers FROM r""",
)
def split_route(spark, d):
    parts, check = filters.split_by(table(spark, d, "lineitem"), routes(), default="plain")
    suppliers = parts["plain"].agg(F.count_distinct("l_suppkey")).scalar()
    return check.withColumn("plain_suppliers", suppliers)


@query(
    "q72_route_profile",
    f"""WITH r AS (SELECT *, {ROUTES_SQL} AS route, {cents_sql('l_extendedprice')} AS c FROM lineitem)
SELECT route, count(*) AS n, count(DISTINCT l_partkey) AS n_keys, CAST(min(l_shipdate) AS DATE) AS first_date,
       CAST(max(l_shipdate) AS DATE) AS last_date, avg(c) AS avg_value, min(c) AS min_value, max(c) AS max_value,
       round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem) * 100, 6) AS share_pct
FROM r GROUP BY route""",
)
def route_profile(spark, d):
    lines = table(spark, d, "lineitem").withColumns(
        {"c": cents("l_extendedprice"), "ship": F.col("l_shipdate").cast("date")}
    )
    tagged = filters.with_route(lines, routes(), "plain")
    return rounded(stats.route_profile(tagged, "route", "l_partkey", "ship", "c"), "share_pct", digits=6)


@query(
    "q71_cost_panel",
    f"""WITH fact AS (
  SELECT l_linestatus AS region, p_type AS cost_type, {MONTH_SQL} AS ref_date, {money_sql('l_extendedprice')} AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT region, cost_type, ref_date, value, 'oneroso' AS regime,
       {change_sql('value', 1)} AS mom, {change_sql('value', 12)} AS yoy,
       round(value / sum(value) OVER (PARTITION BY region, ref_date) * 100, 6) AS share_pct
FROM fact WINDOW w AS (PARTITION BY region, cost_type ORDER BY ref_date)""",
)
def cost_panel(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type")
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    wide = (
        table(spark, d, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_linestatus").alias("region"), month("l_shipdate").alias("ref_date"))
        .pivot("p_type", kinds)
        .agg(money_sum("l_extendedprice").cast("decimal(18,2)").cast("string"))
    )
    out = costs.cost_panel(wide, "ref_date", ["region"], "oneroso", share_of=["region", "ref_date"])
    return rounded(rounded(out, "mom", "yoy"), "share_pct", digits=6)


@query(
    "q86_group_measures",
    f"""SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS quantity,
       CAST(sum({cents_sql('l_extendedprice')}) AS BIGINT) AS price, avg({cents_sql('l_tax')}) AS tax, count(*) AS n
FROM lineitem GROUP BY ALL""",
)
def group_measures(spark, d):
    lines = table(spark, d, "lineitem").withColumns(
        {"quantity": F.col("l_quantity"), "price": cents("l_extendedprice"), "tax": cents("l_tax")}
    )
    keys = ["l_returnflag", "l_linestatus"]
    spec = {"quantity": "sum", "price": "sum", "tax": "mean", "absent": "sum"}
    return stats.multi_measure(lines, keys, spec).join(stats.count_by(lines, keys), keys)


@query(
    "q99_distinct_counts",
    """SELECT count(DISTINCT l_orderkey) AS n_l_orderkey, count(DISTINCT l_suppkey) AS n_l_suppkey,
       count(DISTINCT l_shipdate) AS n_l_shipdate FROM lineitem""",
)
def distinct_counts(spark, d):
    return stats.distinct_counts(table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey", "l_shipdate"])


@query(
    "q87_category_coverage",
    """WITH s AS (
  SELECT d.source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN d.n_chars < 200 THEN 'empty' ELSE 'ok' END AS status
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT CASE WHEN starts_with(source, 'src1') THEN 'first' WHEN starts_with(source, 'src2') THEN 'second'
            ELSE 'other' END AS category,
       count(*) AS n, count(*) FILTER (WHERE status = 'ok') AS n_ok, count(*) FILTER (WHERE status = 'empty') AS n_empty,
       count(*) FILTER (WHERE status = 'missing') AS n_missing
FROM s GROUP BY 1""",
)
def category_coverage(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.lit(True).alias("labelled"))
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars").join(labels, "doc_id", "left")
    status = F.when(F.col("labelled").isNull(), "missing").when(F.col("n_chars") < 200, "empty").otherwise("ok")
    return stats.coverage(docs.withColumn("status", status), "source", "status", {"src1": "first", "src2": "second"})


@query(
    "q88_ratio_join",
    f"""WITH {nation_months_sql('l_returnflag')},
tot AS (SELECT region, ref_date, sum(value) AS total FROM nm GROUP BY ALL),
ret AS (SELECT region, ref_date, value AS returned FROM nm WHERE l_returnflag = 'R')
SELECT region, ref_date, round(returned / total * 100, 4) AS ratio_pct,
       round((returned / nullif(lag(returned) OVER (PARTITION BY region ORDER BY ref_date), 0) - 1) * 100, 4) AS growth
FROM ret JOIN tot USING (region, ref_date)""",
)
def ratio_join(spark, d):
    by_flag = nation_months(spark, d, "l_returnflag")
    total = by_flag.groupBy("region", "ref_date").agg(F.sum("value").alias("total"))
    returned = by_flag.filter(F.col("l_returnflag") == "R").select("region", "ref_date", F.col("value").alias("returned"))
    ratio = joins.ratio_join(returned, total, ["region", "ref_date"], "returned", "total")
    out = windows.lag_growth(ratio, "region", "ref_date", "returned", digits=4)
    return out.select("region", "ref_date", F.round("ratio_pct", 4).alias("ratio_pct"), "growth")


@query(
    "q93_parent_code",
    """SELECT n_name AS parent, count(*) AS n_places,
       CAST(min(c_custkey) AS BIGINT) AS first_place FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def parent_code(spark, d):
    places = table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias(
            "code"
        ),
    )
    parents = table(spark, d, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("parent_code"), F.col("n_name").alias("parent")
    )
    out = joins.parent_code_lookup(places, "code", parents, "parent_code")
    return out.groupBy("parent").agg(F.count(F.lit(1)).alias("n_places"), F.min("c_custkey").alias("first_place"))


@query(
    "q89_sector_filter",
    f"""WITH p AS (SELECT *, 100000 + p_size * 10000 + p_partkey AS code FROM part)
SELECT p_type, count(*) AS n, count(*) FILTER (WHERE p_name NOT LIKE '%ring%') AS n_kept,
       CAST(sum(CASE WHEN p_name NOT LIKE '%ring%' THEN {cents_sql('p_retailprice')} END) AS BIGINT) AS kept_cents
FROM p WHERE substr(CAST(code AS VARCHAR), 1, 2) IN ('41', '42', '43') AND length(CAST(code AS VARCHAR)) = 6
GROUP BY ALL""",
)
def sector_filter(spark, d):
    parts = table(spark, d, "part").withColumn("code", F.lit(100000) + F.col("p_size") * 10000 + F.col("p_partkey"))
    sector = filters.sector_filter(filters.positive_values(parts, "p_retailprice"))
    valid = sector.filter(filters.code_validity(F.col("code"), "4", 6))
    kept = filters.category_filter(valid.withColumnRenamed("p_name", "category"), exclude=["RING"])
    n_all = valid.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))
    n_kept = kept.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n_kept"), F.sum(cents("p_retailprice")).alias("kept_cents")
    )
    return n_all.join(n_kept, "p_type", "left").fillna(0, ["n_kept"])


@query(
    "q59_calendar",
    f"""WITH span AS (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders),
cal AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS ref_date FROM span),
o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, count(*) AS n FROM orders GROUP BY ALL)
SELECT ref_date, CAST(year(ref_date) AS INT) AS year, CAST(month(ref_date) AS INT) AS month,
       ['janeiro', 'fevereiro', 'marco', 'abril', 'maio', 'junho', 'julho', 'agosto', 'setembro', 'outubro',
        'novembro', 'dezembro'][month(ref_date)] AS month_name,
       CAST(quarter(ref_date) AS INT) AS quarter, CASE WHEN month(ref_date) <= 6 THEN 1 ELSE 2 END AS semester,
       strftime(ref_date, '%Y-%m') AS year_month, coalesce(n, 0) AS n_orders
FROM cal LEFT JOIN o USING (ref_date)""",
)
def calendar(spark, d):
    orders = table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    spine = dims.calendar(spark, orders.agg(F.min(day)).scalar(), orders.agg(F.max(day)).scalar())
    counts = orders.groupBy(month("o_orderdate").alias("ref_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return spine.join(counts, "ref_date", "left").fillna(0, ["n_orders"])




def event_points(spark, d):
    """Raw events as points: one series per event type, any number of rows each."""
    return table(spark, d, "events").select("event_type", "ts", cents("value").alias("c"))


@query(
    "q119_raw_changes",
    f"""WITH e AS (SELECT event_type, ts, {cents_sql('value')} AS c FROM events)
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, c, round((c::DOUBLE / nullif(lag(c) OVER w, 0) - 1) * 100, 4) AS chg_1,
       round((c::DOUBLE / nullif(lag(c, 12) OVER w, 0) - 1) * 100, 4) AS chg_12,
       CAST(CAST(ts AS DATE) - CAST(lag(ts) OVER w AS DATE) AS INT) AS gap_days
FROM e WINDOW w AS (PARTITION BY event_type ORDER BY ts)""",
)
def raw_changes(spark, d):
    points = event_points(spark, d)
    chunk = windows.row_chunk(points, "ts", keys=["event_type"])
    out = windows.pct_change(points, ["event_type"], "ts", "c", {"chg_1": 1, "chg_12": 12}, chunk=chunk, gap_days="gap_days")
    return rounded(out, "chg_1", "chg_12").select(
        "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "c", "chg_1", "chg_12", "gap_days"
    )
