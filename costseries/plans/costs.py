"""Taxes, loans, project costs and sector facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costs, joins
from ..session import table
from .common import CUSTOMER_ORDERS_SQL, cents, cents_sql, customer_orders
from .registry import query

# depth bands: upper ends are open
BANDS = [("low", None, 1000.0, 1.0), ("mid", 1000.0, 100000.0, 1.1), ("high", 100000.0, 400000.0, 1.25), ("top", 400000.0, None, 1.5)]


def bands(spark):
    return spark.createDataFrame(BANDS, "band string, band_min double, band_max double, multiplier double")


@query(
    "q38_band_lookup",
    """WITH b AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice < 1000 THEN 'low' WHEN o_totalprice < 100000 THEN 'mid'
         WHEN o_totalprice < 400000 THEN 'high' ELSE 'top' END AS band FROM orders)
SELECT *, CASE band WHEN 'low' THEN 1.0 WHEN 'mid' THEN 1.1 WHEN 'high' THEN 1.25 ELSE 1.5 END::DOUBLE AS multiplier,
       round(o_totalprice * CASE band WHEN 'low' THEN 1.0 WHEN 'mid' THEN 1.1 WHEN 'high' THEN 1.25 ELSE 1.5 END::DOUBLE, 6)
       AS adjusted FROM b""",
)
def band_lookup(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    out = joins.band_lookup(orders, "o_totalprice", bands(spark), "band_min", "band_max")
    adjusted = F.round(F.col("o_totalprice") * F.col("multiplier"), 6)
    return out.withColumn("adjusted", adjusted).drop("band_min", "band_max")


@query(
    "q39_list_membership",
    """WITH m(class, entry) AS (VALUES ('fast', '1-URGENT'), ('fast', '2-HIGH'), ('slow', '3-MEDIUM'), ('slow', '4-NOT SPECIFIED'),
  ('slow', '5-LOW'), ('watched', '1-URGENT'), ('watched', '5-LOW'))
SELECT class, o_orderstatus, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders JOIN m ON o_orderpriority = entry GROUP BY ALL""",
)
def list_membership(spark, d):
    lists = spark.createDataFrame(
        [("fast", "1-URGENT,2-HIGH"), ("slow", "3-MEDIUM, 4-NOT SPECIFIED ,5-LOW"), ("watched", "1-URGENT,,5-LOW,")],
        "class string, priorities string",
    )
    out = joins.list_membership(table(spark, d, "orders"), "o_orderpriority", lists, "priorities")
    return out.groupBy("class", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("o_totalprice")).alias("total_cents")
    )


@query(
    "q40_fill_missing",
    """WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 0
             ELSE c_acctbal END AS balance FROM customer),
r AS (SELECT s_nationkey, max(s_acctbal) AS ref FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL)
SELECT c_custkey, c_nationkey, CASE WHEN (balance IS NULL OR balance = 0) AND ref <> 0 THEN ref ELSE balance END AS balance,
       CASE WHEN balance IS NULL OR balance = 0 THEN CASE WHEN ref <> 0 THEN 'updated' ELSE 'no_data' END ELSE 'kept' END
       AS fill_status FROM c LEFT JOIN r ON c_nationkey = s_nationkey""",
)
def fill_missing(spark, d):
    balance = F.when(F.col("c_acctbal") >= 0, F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0.0)).otherwise(F.col("c_acctbal")))
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey", balance.alias("balance"))
    ref = (
        table(spark, d, "supplier")
        .filter("s_acctbal > 5000")
        .groupBy(F.col("s_nationkey").alias("c_nationkey"))
        .agg(F.max("s_acctbal").alias("balance"))
    )
    return joins.fill_missing_from(customers, ref, ["c_nationkey"], ["balance"])


@query(
    "q41_taxes",
    f"""WITH {CUSTOMER_ORDERS_SQL},
p AS (SELECT o_orderkey, n_name AS city, o_totalprice AS land, o_totalprice * 2 AS building, o_totalprice / 1000 AS area,
             CASE WHEN r_name <> 'ASIA' THEN 2 + r_regionkey * 0.5::DOUBLE END AS tr,
             CASE WHEN r_name <> 'ASIA' THEN 2 + r_regionkey * 0.25::DOUBLE END AS sr FROM co),
t AS (SELECT *, land * tr / 100 AS transfer_tax, building * 0.6::DOUBLE AS base, building * 0.6::DOUBLE * sr / 100 AS service_tax,
             area * 5 + area * 3 + area * 2 + area * 1.5::DOUBLE AS fees FROM p)
SELECT o_orderkey, city, round(transfer_tax, 6) AS transfer_tax, round(base, 6) AS service_base,
       round(service_tax, 6) AS service_tax, round(fees, 6) AS total_fees, round(transfer_tax + service_tax + fees, 6) AS total,
       round((transfer_tax + service_tax + fees) / (land + building) * 100, 6) AS pct_of_investment,
       CASE WHEN tr IS NULL THEN 'no rates for ' || city END AS error FROM t""",
)
def taxes(spark, d):
    projects = customer_orders(spark, d).select(
        "o_orderkey",
        F.col("n_name").alias("city"),
        F.col("o_totalprice").alias("land"),
        (F.col("o_totalprice") * 2).alias("building"),
        (F.col("o_totalprice") / 1000).alias("area"),
    )
    region = table(spark, d, "region").filter("r_name <> 'ASIA'")
    rates = (
        table(spark, d, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("city"),
            (F.lit(2) + F.col("r_regionkey") * 0.5).alias("transfer_rate"),
            (F.lit(2) + F.col("r_regionkey") * 0.25).alias("service_rate"),
        )
    )
    out = costs.construction_taxes(projects, rates, "city", "land", "building", "area")
    money = ("transfer_tax", "service_base", "service_tax", "total_fees", "total", "pct_of_investment")
    return out.select("o_orderkey", "city", *[F.round(c, 6).alias(c) for c in money], "error")


LOAN_SQL = f"""{CUSTOMER_ORDERS_SQL},
a AS (SELECT o_orderkey, o_totalprice AS price, c_acctbal AS income,
        CASE WHEN c_acctbal <= 2640 AND o_totalprice <= 170000 THEN 'MCMV_FAIXA_1'
             WHEN c_acctbal <= 4400 AND o_totalprice <= 264000 THEN 'MCMV_FAIXA_2'
             WHEN c_acctbal <= 8000 AND o_totalprice <= 350000 THEN 'MCMV_FAIXA_3'
             WHEN o_totalprice <= 1500000 THEN 'PRO_COTISTA_FGTS' ELSE 'SBPE_TAXA_REFERENCIAL' END AS program FROM co),
t AS (SELECT *, CASE program WHEN 'MCMV_FAIXA_1' THEN 4.00 WHEN 'MCMV_FAIXA_2' THEN 4.75 WHEN 'MCMV_FAIXA_3' THEN 7.66
                  WHEN 'PRO_COTISTA_FGTS' THEN 8.66 ELSE 10.49 END::DOUBLE AS rate, 420 AS months,
        price * CASE program WHEN 'MCMV_FAIXA_1' THEN 100 WHEN 'MCMV_FAIXA_2' THEN 90 ELSE 80 END::DOUBLE / 100 AS fin FROM a),
l AS (SELECT o_orderkey, program, rate AS yearly_rate, months, fin AS financed, price - fin AS down_payment,
        fin / months + fin * (rate / 100 / 12) AS first_instalment,
        fin / months + fin / months * (rate / 100 / 12) AS last_instalment, income * 0.3::DOUBLE AS max_instalment FROM t),
loans AS (SELECT *, first_instalment <= max_instalment AS approved FROM l)"""


def applications(spark, d):
    return customer_orders(spark, d).select(
        "o_orderkey", F.col("o_totalprice").alias("price"), F.col("c_acctbal").alias("income")
    )


def _loan_view(df):
    terms = ("program", "yearly_rate", "months", "financed", "down_payment")
    return df.select("o_orderkey", *terms, "first_instalment", "last_instalment", "max_instalment", "approved")


@query("q42_loan_assignment", f"WITH {LOAN_SQL} SELECT * FROM loans")
def loan_assignment(spark, d):
    return _loan_view(costs.loan_assignment(applications(spark, d), costs.program_params(spark), "o_orderkey", "price", "income", None))


@query("q116_loan_assignment_large", f"WITH {LOAN_SQL} SELECT * FROM loans")
def loan_assignment_large(spark, d):
    """The offered programmes among one never open one per customer, which stands behind all of them."""
    offered = costs.program_params(spark)
    extra = table(spark, d, "customer").select(
        F.concat(F.lit("EXTRA_"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("program"),
        F.lit(1.0).alias("yearly_rate"),
        F.lit(12).alias("months"),
        F.lit(10.0).alias("financed_pct"),
        F.col("c_acctbal").cast("double").alias("income_limit"),
        (F.col("c_acctbal") * 40).cast("double").alias("price_limit"),
        F.lit(100).cast("bigint").alias("priority"),
    )
    programs = offered.unionByName(extra, allowMissingColumns=True)
    return _loan_view(costs.loan_assignment(applications(spark, d), programs, "o_orderkey", "price", "income", None))


@query(
    "q95_program_uptake",
    f"""WITH {LOAN_SQL} SELECT program, count(*) AS n, count(*) FILTER (WHERE approved) AS n_approved FROM loans
WHERE program LIKE 'MCMV%' GROUP BY ALL""",
)
def program_uptake(spark, d):
    loans = costs.loan_assignment(applications(spark, d), costs.program_params(spark), "o_orderkey", "price", "income", None)
    subsidised = costs.program_params(spark, kind="SUBSIDIADO", prefix="MCMV").select("program")
    counts = loans.groupBy("program").agg(F.count(F.lit(1)).alias("n"), F.count_if("approved").alias("n_approved"))
    return counts.join(subsidised, "program")


@query(
    "q43_project_cost",
    """SELECT l_orderkey, l_linenumber, p_type, s_nationkey, round(p_retailprice * l_quantity
         * CASE p_type WHEN 'PROMO' THEN 0.9 WHEN 'LARGE' THEN 1.2 ELSE 1.0 END::DOUBLE
         * CASE n_regionkey WHEN 0 THEN 1.05 WHEN 1 THEN 0.95 ELSE 1.0 END::DOUBLE, 6) AS total_cost
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def project_cost(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice")
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    projects = (
        table(spark, d, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    methods = spark.createDataFrame([("PROMO", 0.9), ("LARGE", 1.2)], "p_type string, method_factor double")
    regional = F.when(F.col("n_regionkey") == 0, 1.05).when(F.col("n_regionkey") == 1, 0.95)
    places = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), regional.alias("place_factor"))
    dims = {"p_type": (methods, "method_factor"), "s_nationkey": (places, "place_factor")}
    out = costs.project_cost(projects, dims, "p_retailprice", "l_quantity")
    return out.select("l_orderkey", "l_linenumber", "p_type", "s_nationkey", F.round("total_cost", 6).alias("total_cost"))


@query(
    "q44_derived_factor",
    f"""WITH base AS (SELECT s_nationkey AS place, CAST(sum({cents_sql('s_acctbal')}) AS DOUBLE) AS base_cost FROM supplier GROUP BY ALL),
extra AS (SELECT c_nationkey AS place, CAST(sum({cents_sql('c_acctbal')}) AS DOUBLE) AS extra_total FROM customer
          WHERE c_mktsegment = 'MACHINERY' GROUP BY ALL),
f AS (SELECT place, base_cost, coalesce(extra_total, 0) AS extra_total,
             (base_cost + coalesce(extra_total, 0)) / nullif(base_cost, 0) AS factor FROM base LEFT JOIN extra USING (place))
SELECT place, base_cost, extra_total, round(factor, 6) AS factor,
       round(base_cost / (SELECT base_cost FROM f WHERE place = 0), 6) AS base_cost_vs_base FROM f""",
)
def derived_factor(spark, d):
    base = (
        table(spark, d, "supplier")
        .groupBy(F.col("s_nationkey").alias("place"))
        .agg(F.sum(cents("s_acctbal")).cast("double").alias("base_cost"))
    )
    extras = (
        table(spark, d, "customer")
        .filter("c_mktsegment = 'MACHINERY'")
        .select(F.col("c_nationkey").alias("place"), cents("c_acctbal").cast("double").alias("extra"))
    )
    out = costs.derived_factor(base, extras, "place", "base_cost", "extra")
    out = costs.against_baseline(out, F.col("place") == 0, ["base_cost"])
    return out.withColumns({c: F.round(c, 6) for c in ("factor", "base_cost_vs_base")})


@query(
    "q45_employment_fact",
    f"""WITH e AS (SELECT event_type AS state, CAST(date_trunc('month', ts) AS DATE) AS ref_date,
             CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(floor(value) AS BIGINT) AS v, {cents_sql('value')} AS c
           FROM events WHERE value < 50)
SELECT state, ref_date, CAST(sum(k) AS BIGINT) AS admitted, CAST(sum(v) AS BIGINT) AS dismissed,
       CAST(sum(k - v) AS BIGINT) AS balance, avg(c) AS mean_wage FROM e GROUP BY ALL""",
)
def employment_fact(spark, d):
    k = F.from_json("props", "k bigint")["k"]
    v = F.floor("value").cast("bigint")
    raw = table(spark, d, "events").select(
        F.date_format("ts", "yyyyMM").alias("competencia"),
        F.col("event_type").alias("UF"),
        F.when(F.col("value") < 50, "f").otherwise("G").alias("secao_cnae"),
        k.alias("admitidos"),
        v.alias("desligados"),
        (k - v).alias("saldo"),
        cents("value").alias("salario_medio"),
    )
    return costs.employment_fact(raw, digits=None)


@query(
    "q46_materials_fact",
    """SELECT p_name AS material, 'SP' AS region, DATE '2024-05-01' AS ref_date, p_partkey AS code, p_retailprice AS unit_price,
       'UN' AS unit FROM part WHERE p_type <> 'PROMO'""",
)
def materials_fact(spark, d):
    raw = table(spark, d, "part").select(
        F.col("p_partkey").alias("codigo"),
        F.col("p_name").alias("Descricao"),
        F.lit("UN").alias("unidade"),
        F.replace(F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(",")).alias("preco"),
        F.when(F.col("p_type") == "PROMO", "MO").otherwise("mat").alias("tipo_insumo"),
    )
    return costs.materials_fact(raw, "SP", "2024-05")


@query(
    "q47_climate_fact",
    f"""WITH e AS (SELECT event_type AS station, CAST(ts AS DATE) AS day,
             CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 95 THEN {cents_sql('value')} ELSE 0 END AS rain,
             {cents_sql('value')} AS t FROM events),
dd AS (SELECT station, day, sum(rain) AS rain, sum(t) AS t, count(*) AS n FROM e GROUP BY ALL)
SELECT station, CAST(date_trunc('month', day) AS DATE) AS month, CAST(sum(rain) AS DOUBLE) / 100 AS rain_mm,
       count(*) FILTER (WHERE rain > 0) AS rainy_days, round(CAST(sum(t) AS DOUBLE) / 100 / CAST(sum(n) AS DOUBLE), 4) AS mean_temp
FROM dd GROUP BY ALL""",
)
def climate_fact(spark, d):
    value = F.col("value").cast("decimal(18,2)").cast("string")
    raw = table(spark, d, "events").select(
        F.col("event_type").alias("CD_ESTACAO"),
        F.date_format("ts", "yyyy-MM-dd").alias("DT_MEDICAO"),
        F.date_format("ts", "HHmm").alias("HR_MEDICAO"),
        F.when(F.from_json("props", "k bigint")["k"] > 95, value).otherwise("0").alias("CHUVA"),
        value.alias("TEM_INS"),
    )
    out = costs.climate_fact(raw)
    return out.withColumns({"rain_mm": F.round("rain_mm", 2), "mean_temp": F.round("mean_temp", 4)})


MARKUP_RATES = [r"(\d+(?:,\d+)?)\s*%", r"width\D*?(\d+)"]


def rate_sql(col: str, patterns) -> str:
    found = ", ".join(f"nullif(regexp_extract({col}, '(?i){p}', 1), '')" for p in patterns)
    return f"TRY_CAST(replace(coalesce({found}), ',', '.') AS DOUBLE)"


@query(
    "q48_extract_rates",
    f"""SELECT 'document' AS origin, doc_id AS id, {rate_sql('text', costs.TRANSFER_TAX_PATTERNS)} AS transfer_rate,
       {rate_sql('text', costs.SERVICE_TAX_PATTERNS)} AS service_rate, {rate_sql('text', MARKUP_RATES)} AS any_rate FROM documents
UNION ALL SELECT 'page', page_id, {rate_sql('html', costs.TRANSFER_TAX_PATTERNS)}, {rate_sql('html', costs.SERVICE_TAX_PATTERNS)},
       {rate_sql('html', MARKUP_RATES)} FROM pages""",
)
def extract_rates(spark, d):
    docs = table(spark, d, "documents").select(F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    pages = table(spark, d, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text"))
    text = F.col("text")
    return docs.unionByName(pages).select(
        "origin",
        "id",
        costs.extract_rate(text, costs.TRANSFER_TAX_PATTERNS).alias("transfer_rate"),
        costs.extract_rate(text, costs.SERVICE_TAX_PATTERNS).alias("service_rate"),
        costs.extract_rate(text, MARKUP_RATES).alias("any_rate"),
    )


@query(
    "q74_price_lookup",
    """WITH own AS (SELECT n_name AS state, p_type AS material, min(p_retailprice) AS p FROM lineitem
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY ALL),
def AS (SELECT p_type AS material, min(p_retailprice) AS q FROM part GROUP BY ALL)
SELECT n_name AS state, material, coalesce(p, q) AS price, p IS NULL AS is_default
FROM nation CROSS JOIN def LEFT JOIN own ON own.state = n_name AND own.material = def.material""".replace(
        "SELECT n_name AS state, material, coalesce", "SELECT n_name AS state, def.material, coalesce"
    ),
)
def price_lookup(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_retailprice", F.col("p_type").alias("material"))
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    region = table(spark, d, "region").filter(F.col("r_name").isin("ASIA", "EUROPE"))
    nation = table(spark, d, "nation")
    priced = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("state"))
    own = (
        table(spark, d, "lineitem")
        .select("l_partkey", "l_suppkey")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(priced, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("state", "material")
        .agg(F.min("p_retailprice").alias("price"))
    )
    default = part.groupBy("material").agg(F.min("p_retailprice").alias("price"))
    return costs.reference_prices(nation.select(F.col("n_name").alias("state")), "state", own, default)
