"""Sheets rendered from the orders, and the tidy facts read back from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import MONTHS
from ..operators import grid, upsert
from ..session import landed, table
from .common import CUSTOMER_ORDERS_SQL, br_text, cents, cents_sql, customer_orders
from .registry import query


def month_label(col: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTHS]), col - 1)


def text_or_blank(c: Column) -> Column:
    return F.coalesce(br_text(c, thousands=True), F.lit(""))


def year_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Per key and year, a row of the year and twelve monthly totals as text."""
    day = F.col("o_orderdate").cast("date")
    by_month = [
        text_or_blank(F.sum(F.when(F.month(day) == m, cents("o_totalprice")))).alias(f"m{m}") for m in range(1, 13)
    ]
    grouped = df.groupBy(*keys, F.year(day).alias("year")).agg(*by_month)
    cells = F.array(F.col("year").cast("string"), *[F.col(f"m{m}") for m in range(1, 13)])
    return grouped.select(*keys, "year", cells.alias("cells"))


def text_row(*cells: Column | str) -> Column:
    return F.array(*[F.lit(c) if isinstance(c, str) else c for c in cells])


@query(
    "q28_unpivot_months",
    f"""SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value FROM orders GROUP BY ALL""",
)
def unpivot_months(spark, d):
    rows = year_rows(table(spark, d, "orders"), "o_custkey")
    return grid.unpivot_months(rows, ["o_custkey"], "year").drop("year")


@query(
    "q110_melt",
    """SELECT o_orderpriority, 'n_' || lower(o_orderstatus) AS measure, count(*) AS n FROM orders GROUP BY ALL""",
)
def melt(spark, d):
    wide = (
        table(spark, d, "orders")
        .groupBy("o_orderpriority")
        .agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in ("F", "O", "P")])
    )
    return grid.unpivot_columns(wide, ["o_orderpriority"], "measure", "n")


def region_sheets(spark, d) -> DataFrame:
    """One sheet per market segment: a region heading, its year rows, then a source note."""
    keys = ["c_mktsegment", "r_regionkey", "r_name"]
    rows = landed(year_rows(customer_orders(spark, d), *keys), "region-years")
    base = F.col("r_regionkey") * 1000
    body = rows.select(
        F.col("c_mktsegment").alias("sheet"), (base + F.col("year") - 1980).cast("bigint").alias("row_idx"), "cells"
    )
    region = F.replace(F.col("r_name"), F.lit(" "), F.lit("-"))
    heads = rows.select(*keys).distinct()
    heading = heads.select(
        F.col("c_mktsegment").alias("sheet"),
        base.cast("bigint").alias("row_idx"),
        text_row(F.concat(F.lit("CUB Médio - Região "), F.initcap(region)), "").alias("cells"),
    )
    note = heads.select(
        F.col("c_mktsegment").alias("sheet"),
        (base + 900).cast("bigint").alias("row_idx"),
        text_row("Fonte: Banco de Dados", "").alias("cells"),
    )
    both = body.unionByName(heading).unionByName(note)
    return landed(both.select(F.lit("orders").alias("source"), "sheet", "row_idx", "cells"), "region-sheets")


@query(
    "q29_tidy_region_matrix",
    f"""WITH {CUSTOMER_ORDERS_SQL}
SELECT c_mktsegment AS sheet, replace(r_name, ' ', '-') AS region, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value FROM co GROUP BY ALL""",
)
def tidy_region_matrix(spark, d):
    return grid.tidy_region_matrix(region_sheets(spark, d)).drop("source")


def index_sheets(spark, d) -> DataFrame:
    """One sheet per customer: month rows with the year only on the first row of each year."""
    day = F.col("o_orderdate").cast("date")
    months = (
        table(spark, d, "orders")
        .groupBy("o_custkey", F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.sum(cents("o_totalprice")).alias("c"), F.count(F.lit(1)).alias("n"))
    )
    first = F.min("month").over(Window.partitionBy("o_custkey", "year"))
    year = F.when(F.col("month") == first, F.col("year").cast("string")).otherwise("")
    cells = F.array(year, F.lower(month_label(F.col("month"))), br_text(F.col("c"), True), F.col("n").cast("string"), F.lit("..."), F.lit("-"))
    rows = months.select(
        F.lit("orders").alias("source"),
        F.col("o_custkey").cast("string").alias("sheet"),
        (F.col("year") * 100 + F.col("month")).cast("bigint").alias("row_idx"),
        cells.alias("cells"),
    )
    title = rows.select("source", "sheet").distinct().select(
        "*", F.lit(0).cast("bigint").alias("row_idx"), text_row("Variações Percentuais", "MÊS", "ÍNDICE").alias("cells")
    )
    return landed(rows.unionByName(title), "index-sheets")


@query(
    "q30_tidy_monthly_index",
    f"""SELECT o_custkey::VARCHAR AS sheet, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value, count(*)::DOUBLE AS var_month,
       NULL::DOUBLE AS var_year, NULL::DOUBLE AS var_12m FROM orders GROUP BY ALL""",
)
def tidy_monthly_index(spark, d):
    return grid.tidy_monthly_index(index_sheets(spark, d)).drop("source")


@query(
    "q111_tidy_annual",
    f"""SELECT o_custkey::VARCHAR AS sheet, CAST(year(o_orderdate) AS INT) AS year,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS total, count(*)::DOUBLE AS n FROM orders GROUP BY ALL""",
)
def tidy_annual(spark, d):
    years = (
        table(spark, d, "orders")
        .groupBy("o_custkey", F.year(F.col("o_orderdate").cast("date")).alias("year"))
        .agg(F.sum(cents("o_totalprice")).alias("c"), F.count(F.lit(1)).alias("n"))
    )
    cells = F.array(F.concat(F.col("year").cast("string"), F.lit(".0")), br_text(F.col("c"), True), F.col("n").cast("string"))
    rows = years.select(
        F.lit("orders").alias("source"),
        F.col("o_custkey").cast("string").alias("sheet"),
        F.col("year").cast("bigint").alias("row_idx"),
        cells.alias("cells"),
    )
    header = rows.select("source", "sheet").distinct().select(
        "*", F.lit(0).cast("bigint").alias("row_idx"), text_row("ANO", "TOTAL", "N").alias("cells")
    )
    sheets = landed(rows.unionByName(header), "annual-sheets")
    return grid.tidy_annual(sheets, {"total": 1, "n": 2}).drop("source")


@query(
    "q127_rejected_rows",
    """WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders)
SELECT 'kept' AS reason, count(*) AS n FROM y WHERE y NOT IN (1996, 1998)
UNION ALL SELECT 'year out of range', count(*) FILTER (WHERE y = 1998) FROM y
UNION ALL SELECT 'no value', count(*) FILTER (WHERE y = 1996) FROM y
UNION ALL SELECT 'no year', count(DISTINCT o_custkey) FROM y UNION ALL SELECT 'blank or note', count(DISTINCT o_custkey) FROM y""",
)
def rejected_rows(spark, d):
    """Sheets of years as far ahead as 2031, one of them 2198 and one without values; every row is accounted for."""
    day = F.col("o_orderdate").cast("date")
    years = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("sheet"), F.year(day).alias("y")).distinct()
    shown = F.when(F.col("y") == 1998, F.lit("2198")).otherwise((F.col("y") + 30).cast("string"))
    rows = years.select("sheet", F.col("y").cast("bigint").alias("row_idx"), F.array(shown, F.when(F.col("y") == 1996, F.lit("...")).otherwise(F.lit("1,5"))).alias("cells"))
    sheets = years.select("sheet").distinct()
    for i, c in ((0, text_row("ANO", "TOTAL")), (9999, text_row("* Fonte: pedidos", ""))):
        rows = rows.unionByName(sheets.select("sheet", F.lit(i).cast("bigint").alias("row_idx"), c.alias("cells")))
    tidy = grid.place_annual(landed(rows.select(F.lit("orders").alias("source"), "*"), "reject-sheets"), {"total": 1}, as_of="2024-01-31")
    told = tidy.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return told.unionByName(tidy.facts.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("reason"), "n"))


@query(
    "q31_mixed_period",
    f"""WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS m, {cents_sql('o_totalprice')} AS c FROM orders),
p AS (SELECT o_custkey, y, CASE WHEN m <= 6 THEN m WHEN m <= 9 THEN 8 ELSE 11 END AS pm, sum(c) AS c FROM o GROUP BY ALL)
SELECT o_custkey::VARCHAR AS sheet, make_date(y, pm, 1) AS ref_date, CAST(c AS DOUBLE) / 100 AS value FROM p""",
)
def mixed_period(spark, d):
    day = F.col("o_orderdate").cast("date")
    m = F.month(day)
    label = (
        F.when(m <= 6, month_label(m)).when(m <= 9, F.lit("3T")).otherwise(F.lit("4º TRI"))
    )
    place = F.when(m <= 6, m).when(m <= 9, 8).otherwise(11)
    periods = (
        table(spark, d, "orders")
        .groupBy("o_custkey", F.year(day).alias("year"), place.alias("pos"), label.alias("label"))
        .agg(F.sum(cents("o_totalprice")).alias("c"))
    )
    first = F.min("pos").over(Window.partitionBy("o_custkey", "year"))
    year = F.when(F.col("pos") == first, F.col("year").cast("string")).otherwise("")
    rows = periods.select(
        F.lit("orders").alias("source"),
        F.col("o_custkey").cast("string").alias("sheet"),
        (F.col("year") * 100 + F.col("pos")).cast("bigint").alias("row_idx"),
        F.array(year, F.col("label"), br_text(F.col("c"))).alias("cells"),
    )
    return grid.tidy_mixed_period(landed(rows, "mixed-sheets"), low=1990).drop("source")


def text_grid(spark, d) -> DataFrame:
    """Every line of every document as a grid row of words."""
    docs = table(spark, d, "documents").select(
        "source", F.col("doc_id").cast("string").alias("sheet"), F.posexplode(F.split("text", "\n")).alias("row_idx", "line")
    )
    return grid.grid_from_text(docs.withColumn("row_idx", F.col("row_idx").cast("bigint")), "line", " ")


NOISE_SQL = "|".join([*grid.NOISE_PREFIXES, *grid.NOISE_MARKS])


@query(
    "q32_drop_noise",
    f"""WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT source, string_split(line, ' ') AS cells, line FROM l),
f AS (SELECT source, lower(trim(cells[1])) AS first, replace(line, ' ', '') = '' AS blank,
             len([x for x in cells if x = '']) / len(cells) > 0.8 AS sparse FROM c)
SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE NOT (blank OR sparse OR regexp_matches(first, '^({NOISE_SQL})')
       OR regexp_matches(first, '{"|".join(grid.NOISE_PHRASES)}'))) AS n_kept
FROM f GROUP BY source""",
)
def drop_noise(spark, d):
    lines = text_grid(spark, d)
    noise = grid.is_noise(F.col("cells"), 0.8)
    return lines.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~noise).alias("n_kept"))


def place_sheets(spark, d) -> DataFrame:
    """One sheet per order status: a title, a month header, nation rows and a total row."""
    day = F.col("o_orderdate").cast("date")
    by_month = [text_or_blank(F.sum(F.when(F.month(day) == m, cents("o_totalprice")))).alias(f"m{m}") for m in range(1, 13)]
    cube = customer_orders(spark, d).groupBy("o_orderstatus", "n_nationkey", "n_name").agg(*by_month)
    months = [F.col(f"m{m}") for m in range(1, 13)]
    rows = cube.select(
        F.col("o_orderstatus").alias("sheet"),
        (F.col("n_nationkey") + 10).cast("bigint").alias("row_idx"),
        F.array(F.upper("n_name"), *months).alias("cells"),
    )
    sheets = cube.select(F.col("o_orderstatus").alias("sheet")).distinct()
    fixed = {
        0: text_row("Consumo por localidade"),
        2: text_row("LOCALIDADE", *[m.lower() for m in MONTHS]),
        900: text_row("TOTAL", *["1"] * 12),
        901: text_row("Fonte: pedidos", *[""] * 12),
    }
    extra = [sheets.select("sheet", F.lit(i).cast("bigint").alias("row_idx"), c.alias("cells")) for i, c in fixed.items()]
    for part in extra:
        rows = rows.unionByName(part)
    return landed(rows.select(F.lit("orders").alias("source"), "sheet", "row_idx", "cells"), "place-sheets")


@query(
    "q112_tidy_place_month",
    f"""WITH {CUSTOMER_ORDERS_SQL}
SELECT o_orderstatus AS sheet, make_date(2024, month(o_orderdate), 1) AS ref_date, 'Nation_' || n_nationkey AS place,
       'orders' AS kind, CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value FROM co GROUP BY ALL""",
)
def tidy_place_month(spark, d):
    return grid.tidy_place_month(place_sheets(spark, d), 2024, "orders").drop("source")


STATE_BY_REGION = {0: "MATO GROSSO DO SUL", 1: "MATO GROSSO", 2: "PARÁ", 3: "PARANÁ", 4: "PARAÍBA"}


def state_sheets(spark, d) -> DataFrame:
    """One sheet per market segment; headings name a state and, for some, a standard."""
    keys = ["c_mktsegment", "r_regionkey", "o_orderstatus"]
    rows = landed(year_rows(customer_orders(spark, d), *keys), "state-years")
    names = F.get(F.array(*[F.lit(STATE_BY_REGION[i]) for i in range(5)]), F.col("r_regionkey"))
    standard = F.when(F.col("o_orderstatus") == "F", " (PADRÃO - R1-B)").when(F.col("o_orderstatus") == "O", " (padrão - r8-n )")
    base = F.col("r_regionkey") * 10000 + F.ascii("o_orderstatus") * 100
    body = rows.select(
        F.col("c_mktsegment").alias("sheet"), (base + F.col("year") - 1980).cast("bigint").alias("row_idx"), "cells"
    )
    heading = rows.select(*keys).distinct().select(
        F.col("c_mktsegment").alias("sheet"),
        base.cast("bigint").alias("row_idx"),
        F.array(F.concat(names, F.coalesce(standard, F.lit(" (PADRÃO - CAL-8)")))).alias("cells"),
    )
    both = body.unionByName(heading)
    return landed(both.select(F.lit("orders").alias("source"), "sheet", "row_idx", "cells"), "state-sheets")


@query(
    "q113_tidy_state_standard",
    f"""WITH {CUSTOMER_ORDERS_SQL}, f AS (
SELECT c_mktsegment AS sheet, ['MS', 'MT', 'PA', 'PR', 'PB'][r_regionkey + 1] AS state,
       CASE o_orderstatus WHEN 'F' THEN 'R1-B' WHEN 'O' THEN 'R8-N' ELSE 'CAL-8' END AS standard,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value FROM co GROUP BY ALL)
-- a year row with a single month is more than 80 % empty, hence noise
SELECT * FROM f QUALIFY count(*) OVER (PARTITION BY sheet, state, standard, year(ref_date)) > 1""",
)
def tidy_state_standard(spark, d):
    return grid.tidy_state_standard(state_sheets(spark, d)).drop("source")


@query(
    "q114_tidy_state_sheets",
    f"""SELECT o_custkey::VARCHAR AS state, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, 'val_0' AS measure,
       CAST(sum({cents_sql('o_totalprice')}) AS DOUBLE) / 100 AS value FROM orders GROUP BY ALL
UNION ALL SELECT o_custkey::VARCHAR, CAST(date_trunc('month', o_orderdate) AS DATE), 'val_1', count(*)::DOUBLE
FROM orders GROUP BY ALL""",
)
def tidy_state_sheets(spark, d):
    return grid.tidy_state_sheets(index_sheets(spark, d)).drop("source")


@query(
    "q78_tidy_generic",
    f"""SELECT p_brand AS label, lower(p_type) AS material, CAST(sum({cents_sql('p_retailprice')}) AS DOUBLE) / 100 AS value,
       'prices' AS sheet FROM part GROUP BY ALL""",
)
def tidy_generic(spark, d):
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    wide = table(spark, d, "part").groupBy("p_brand").pivot("p_type", kinds).agg(F.sum(cents("p_retailprice")))
    number = F.substring("p_brand", 7, 4).cast("bigint")
    cells = F.array(F.col("p_brand"), *[text_or_blank(F.col(k)) for k in kinds])
    rows = wide.select(F.lit("prices").alias("sheet"), (number + 3).alias("row_idx"), cells.alias("cells"))
    one = rows.limit(1).select("sheet")
    fixed = [text_row("Título"), text_row("Subtítulo"), text_row(""), text_row("Marca", *[k.lower() for k in kinds])]
    for i, c in enumerate(fixed):
        rows = rows.unionByName(one.select("sheet", F.lit(i).cast("bigint").alias("row_idx"), c.alias("cells")))
    sheets = rows.select(F.lit("part").alias("source"), "*")
    return grid.tidy_header3(sheets, "material").drop("source")


@query(
    "q79_tidy_by_kind",
    f"""SELECT p_brand AS label, count(*)::VARCHAR AS n_de_pecas, max(p_size)::VARCHAR AS maior_tamanho, 'material' AS kind,
       'prices' AS source, DATE '2024-01-31' AS extracted_on FROM part GROUP BY ALL""",
)
def tidy_by_kind(spark, d):
    brands = table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("s"))
    rows = brands.select(
        (F.substring("p_brand", 7, 4).cast("bigint") + 10).alias("row_idx"),
        F.col("p_brand").alias("tabela"),
        F.col("n").cast("string").alias("Unnamed: 1"),
        F.col("s").cast("string").alias("Unnamed: 2"),
    )
    one = brands.limit(1)
    header = one.select(
        F.lit(0).cast("bigint").alias("row_idx"), F.lit("x").alias("tabela"), F.lit("n de pecas").alias("Unnamed: 1"),
        F.lit("Maior Tamanho").alias("Unnamed: 2"),
    )
    again = one.select(
        F.lit(1).cast("bigint").alias("row_idx"), F.lit("Material").alias("tabela"), F.lit("n").alias("Unnamed: 1"),
        F.lit("t").alias("Unnamed: 2"),
    )
    sheet = rows.unionByName(header).unionByName(again)
    return grid.tidy_tables_by_kind(sheet, "material", "row_idx", "prices", "2024-01-31").drop("row_idx")


@query(
    "q115_stacked_sheets",
    """SELECT 'annual' AS origin, count(*) AS n FROM (SELECT DISTINCT o_custkey, year(o_orderdate) FROM orders)
UNION ALL SELECT 'monthly', count(*) FROM (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) FROM orders)""",
)
def stacked_sheets(spark, d):
    monthly = grid.tidy_monthly_index(index_sheets(spark, d))
    annual = monthly.select("sheet", F.trunc("ref_date", "year").alias("ref_date")).transform(upsert.dedup_full_rows)
    both = upsert.union_tagged({"monthly": monthly, "annual": annual}, "origin")
    return both.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))
