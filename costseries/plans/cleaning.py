"""Cell parsing and header repair over rendered text."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    br_number,
    business_key,
    currency_number,
    excel_serial_date,
    excel_serial_timestamp,
    month_name_to_num,
    null_tokens,
    parse_date_multi,
    parse_pt_month,
    period_to_date,
    quarter_to_month,
    recode,
    sentinel_to_null,
    truth,
)
from ..operators import columns
from ..session import table
from .common import br_text, cents, cents_sql
from .grids import month_label
from .registry import query


@query(
    "q33_br_numbers",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice AS auto, l_extendedprice AS strip_dots, l_extendedprice AS comma_only,
       l_extendedprice AS currency, CAST({cents_sql('l_extendedprice')} AS DOUBLE) AS misread,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_extendedprice END AS marked FROM lineitem""",
)
def br_numbers(spark, d):
    c = cents("l_extendedprice")
    text = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", br_text(c, True).alias("grouped"), br_text(c).alias("plain")
    )
    dotted = F.replace(F.col("plain"), F.lit(","), F.lit("."))
    flag = F.col("l_returnflag")
    return text.select(
        "l_orderkey",
        "l_linenumber",
        br_number(F.when(flag == "A", dotted).otherwise(F.col("grouped"))).alias("auto"),
        br_number(F.col("grouped"), "strip_dots").alias("strip_dots"),
        br_number(F.col("plain"), "comma_only").alias("comma_only"),
        currency_number(F.concat(F.lit("R$ "), F.col("grouped"))).alias("currency"),
        br_number(dotted, "strip_dots").alias("misread"),
        br_number(F.when(flag == "N", F.lit(" N/D ")).otherwise(F.col("plain"))).alias("marked"),
    )


@query(
    "q34_parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(date_trunc('month', o_orderdate) AS DATE)
                           ELSE CAST(o_orderdate AS DATE) END AS day,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_named, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_joined,
       make_date(year(o_orderdate), quarter(o_orderdate) * 3 - 1, 1) AS quarter_start,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(month(o_orderdate) AS INT) END AS month_no FROM orders""",
)
def parse_dates(spark, d):
    day, status = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    label = month_label(F.month(day))
    text = table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("d"),
        F.when(status == "F", F.date_format(day, "yyyy-MM-dd"))
        .when(status == "P", F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM"))
        .alias("dated"),
        F.when(status == "F", F.concat(F.lower(label), F.date_format(day, "/yy")))
        .otherwise(F.date_format(day, "MM/yyyy"))
        .alias("named"),
        F.when(status == "F", F.lit("XXX")).otherwise(F.concat(F.lit(" "), label)).alias("label"),
    )
    quarter = F.concat(F.lit("Q"), F.quarter("d").cast("string"))
    return text.select(
        "o_orderkey",
        parse_date_multi(F.col("dated")).alias("day"),
        parse_pt_month(F.col("named")).alias("month_named"),
        period_to_date(F.year("d"), F.month("d")).alias("month_joined"),
        period_to_date(F.year("d"), quarter_to_month(quarter)).alias("quarter_start"),
        month_name_to_num(F.col("label")).alias("month_no"),
    )


@query(
    "q35_excel_serial",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS created
FROM orders""",
)
def excel_serial(spark, d):
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    text = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyy-MM-dd")).otherwise(serial).alias("day"),
        F.concat(serial, F.lit(".25")).alias("created"),
    )
    created = excel_serial_timestamp(F.col("created"))
    return text.select(
        "o_orderkey",
        excel_serial_date(F.col("day")).alias("day"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("created"),
    )


@query(
    "q36_recode_null_tokens",
    f"""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'CUB-medio' WHEN '2-HIGH' THEN 'Variacao_mensal_%'
         ELSE o_orderpriority END AS kind,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS value,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status, o_orderstatus = 'O' AS is_open FROM orders""",
)
def recode_null_tokens(spark, d):
    status = F.col("o_orderstatus")
    value = F.when(status == "F", F.lit(-100.0)).otherwise(F.col("o_totalprice"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        recode(F.col("o_orderpriority"), {"1-URGENT": "CUB-medio", "2-HIGH": "Variacao_mensal_%"}).alias("kind"),
        sentinel_to_null(value).alias("value"),
        null_tokens(F.when(status == "P", F.lit("...")).otherwise(F.concat(status, F.lit(" ")))).alias("status"),
        truth(F.when(status == "O", F.lit("true ")).otherwise(F.lit("False"))).alias("is_open"),
    )


@query(
    "q76_contract_projection",
    """SELECT 'PART_' || p_partkey || '_2024-01' AS fact_id, p_partkey AS id, p_name AS name,
       CAST(CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS INT) AS size, p_retailprice AS price, 'UN' AS unit,
       NULL::DATE AS valid_from, 'run-1' AS exec_id, '2024-01-31 00:00:00' AS loaded_at, 'parts' AS source,
       '1.0.0' AS pipeline_version, 'monthly' AS freq, 'file' AS collection_method, 'ok' AS collection_status,
       'file:part' AS source_url, NULL::VARCHAR AS note FROM part""",
)
def contract_projection(spark, d):
    size = F.when(F.col("p_size") > 40, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    raw = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.col("p_name").alias("Name "),
        size.alias("Size"),
        F.col("p_retailprice").cast("string").alias("Preço R$"),
        F.lit(None).cast("string").alias("blank"),
    )
    tidy = columns.synonym_columns(raw, {"id": ["ID"], "name": ["name"], "size": ["size"], "price": ["preço r$"]})
    tidy = columns.coerce_numeric(columns.drop_empty(tidy), pattern="price")
    schema = T.StructType.fromDDL("id bigint, name string, size int, price double, unit string, valid_from date")
    typed = columns.align_schema(tidy, schema, {"size": 0, "unit": "UN"})
    stamped = columns.stamp_lineage(
        typed, "run-1", "2024-01-31 00:00:00", "parts", method="file", status="ok", url="file:part"
    )
    return stamped.withColumns(
        {
            "fact_id": business_key("PART", F.col("id"), "2024-01"),
            "loaded_at": F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"),
        }
    )


@query(
    "q77_header_repair",
    """SELECT s_name AS label, s_nationkey::VARCHAR AS nation_key, s_suppkey::VARCHAR AS value_2, s_suppkey AS row_no
FROM supplier""",
)
def header_repair(spark, d):
    supplier = table(spark, d, "supplier")
    body = supplier.select(
        (F.col("s_suppkey") + 1).alias("Row No."),
        F.col("s_name").alias("Unnamed: 0"),
        F.col("s_nationkey").cast("string").alias("Unnamed: 1"),
        F.col("s_suppkey").cast("string").alias("Unnamed: 2"),
    )
    title = spark.range(1).select(
        F.lit(0).cast("bigint").alias("Row No."),
        F.lit("Supplier").alias("Unnamed: 0"),
        F.lit(" Nation - Key").alias("Unnamed: 1"),
        F.lit("").alias("Unnamed: 2"),
    )
    sheet = columns.snake_columns(body.unionByName(title))
    out = columns.promote_header(sheet, "row_no")
    return out.withColumn("row_no", F.col("row_no") - 1)
