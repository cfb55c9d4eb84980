"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dims
from ..session import table
from ..sources import flatten_catalog
from .common import cents, cents_sql
from .registry import query


@query(
    "q60_geo_hierarchy",
    """SELECT 'UF_' || n_nationkey AS id, 'UF' AS level, n_nationkey::VARCHAR AS code, n_name AS name, NULL AS parent_code FROM nation
UNION ALL SELECT 'CID_' || s_suppkey, 'CIDADE', s_suppkey::VARCHAR, s_name, s_nationkey::VARCHAR FROM supplier""",
)
def geo_hierarchy(spark, d):
    return dims.geo_hierarchy(
        table(spark, d, "nation"),
        table(spark, d, "supplier"),
        {"code": "n_nationkey", "name": "n_name"},
        {"code": "s_suppkey", "name": "s_name", "parent": "s_nationkey"},
    )


@query(
    "q61_lookup",
    """SELECT n_regionkey, c_nationkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment = 'BUILDING' GROUP BY ALL""",
)
def lookup(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    padded = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    customers = table(spark, d, "customer").withColumn("segment", padded)
    found = dims.lookup(customers, "segment", "Building").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return dims.by_group(found, "n_regionkey", "c_nationkey")


@query(
    "q62_flatten_catalog",
    """WITH e AS (SELECT event_id, 's' || user_id AS sid, event_type, json_extract(props, '$.k')::VARCHAR AS k FROM events)
SELECT event_id, sid AS series_id, k AS code, event_type AS category, 'daily' AS freq, NULL AS endpoint, 'series' AS source_kind FROM e
UNION ALL SELECT event_id, 'focus_' || event_type, NULL, 'expectations', 'weekly', '/' || k, 'expectation' FROM e""",
)
def catalog(spark, d):
    k = F.get_json_object("props", "$.k")
    entry = F.struct(k.alias("code"), F.col("event_type").alias("category"), F.lit("daily").alias("freq"))
    focus = F.struct(F.concat(F.lit("/"), k).alias("endpoint"), F.lit("weekly").alias("freq"))
    document = F.to_json(
        F.struct(
            F.create_map(F.concat(F.lit("s"), F.col("user_id").cast("string")), entry).alias("series"),
            F.struct(F.create_map(F.col("event_type"), focus).alias("endpoints")).alias("expectations"),
        )
    )
    docs = table(spark, d, "events").select("event_id", document.alias("document"))
    out = flatten_catalog(docs, "document")
    return out.select("event_id", "series_id", "code", "category", "freq", "endpoint", "source_kind")


@query(
    "q73_place_dims",
    """SELECT row_number() OVER (ORDER BY s_nationkey, s_suppkey) AS id, s_suppkey, s_name, s_nationkey,
       n_regionkey::BIGINT AS region_id FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def place_dims(spark, d):
    stations = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    numbered = dims.place_dims(stations, ["s_nationkey", "s_suppkey"], ["region_id"])
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").cast("bigint").alias("rid"))
    return dims.resolve_foreign_key(numbered, nation, "s_nationkey", "rid", "region_id")


@query(
    "q94_municipal_dim",
    """WITH p AS (SELECT c_nationkey, count(*) AS population FROM customer GROUP BY ALL),
first AS (SELECT s_nationkey, min(s_suppkey) AS k FROM supplier GROUP BY ALL)
SELECT s.s_suppkey, s.s_nationkey, population, s.s_suppkey = k AS is_capital
FROM supplier s JOIN first f ON f.s_nationkey = s.s_nationkey LEFT JOIN p ON c_nationkey = s.s_nationkey""",
)
def municipal_dim(spark, d):
    places = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    first = places.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k"))
    population = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("s_nationkey")).agg(F.count(F.lit(1)).alias("population"))
    out = dims.municipal_dim(places.join(first, "s_nationkey"), population, "s_nationkey", F.col("s_suppkey") == F.col("k"))
    return out.drop("k")


@query(
    "q75_fee_facts",
    f"""WITH w AS (SELECT c_nationkey, min({cents_sql('c_acctbal')}) AS lowest, max({cents_sql('c_acctbal')}) AS highest,
        nullif(count(*) FILTER (WHERE c_mktsegment = 'BUILDING'), 10) AS building FROM customer GROUP BY ALL)
SELECT c_nationkey, 'lowest' AS fee, lowest AS rate FROM w UNION ALL SELECT c_nationkey, 'highest', highest FROM w
UNION ALL SELECT c_nationkey, 'building', building FROM w WHERE building IS NOT NULL""",
)
def fee_facts(spark, d):
    wide = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.min(cents("c_acctbal")).alias("lowest"),
        F.max(cents("c_acctbal")).alias("highest"),
        F.nullif(F.count_if(F.col("c_mktsegment") == "BUILDING"), F.lit(10).cast("bigint")).alias("building"),
    )
    return dims.municipal_fee_facts(wide, ["c_nationkey"], ["lowest", "highest", "building"])


@query(
    "q117_method_and_rates_dims",
    """SELECT row_number() OVER (ORDER BY p_partkey) AS id, p_partkey AS method_id, p_name AS name, p_retailprice AS rate_price,
       p_size::DOUBLE AS rate_size FROM part""",
)
def method_and_rates(spark, d):
    raw = table(spark, d, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("string"), F.col("p_size").cast("string")
    )
    method = dims.method_dim(
        raw, {"p_partkey": "Method ID", "p_name": "Name", "p_retailprice": "Rate Price", "p_size": "Rate-Size", "absent": "x"}, []
    )
    return dims.municipal_rates_dim(method, "^rate", ["method_id"])


@query(
    "q118_config_dims",
    f"""SELECT 'part' AS dim, count(*) AS n, CAST(sum({cents_sql('p_retailprice')}) AS BIGINT) AS total FROM part
UNION ALL SELECT 'supplier', count(*), CAST(sum({cents_sql('s_acctbal')}) AS BIGINT) FROM supplier""",
)
def config_dims(spark, d):
    raw = {
        "part": table(spark, d, "part").select("p_partkey", F.col("p_retailprice").cast("string").alias("amount")),
        "supplier": table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").cast("string").alias("amount")),
    }
    typed = dims.config_dims(raw, {"part": ["amount"], "supplier": ["amount"]})
    counts = [
        df.agg(F.count(F.lit(1)).alias("n"), F.sum(cents("amount")).alias("total")).select(F.lit(name).alias("dim"), "*")
        for name, df in typed.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    "q90_source_catalog",
    """WITH e AS (SELECT event_type AS source, count(*) AS n_records, CAST(max(ts) AS DATE) AS last_date,
         CASE WHEN event_type IN ('click', 'view') THEN 'daily' ELSE 'unknown' END AS freq FROM events GROUP BY event_type)
SELECT *, last_date + CASE freq WHEN 'daily' THEN 1 ELSE 30 END AS next_run FROM e""",
)
def source_catalog(spark, d):
    events = table(spark, d, "events").select(
        F.col("event_type").alias("source"),
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_type").isin("click", "view"), "daily").otherwise("unknown").alias("freq"),
    )
    return dims.source_catalog(events, "source", "day", "freq")


@query(
    "q91_unique_sources",
    r"""WITH p AS (SELECT regexp_extract(url, '^(https?://[^/]+)', 1) AS url, regexp_extract(url, '//[^/]+/([a-z]+)', 1) AS label FROM pages)
SELECT url, min(label) AS label FROM p GROUP BY ALL""",
)
def unique_sources(spark, d):
    pages = table(spark, d, "pages").select(
        F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("url"), F.regexp_extract("url", r"//[^/]+/([a-z]+)", 1).alias("label")
    )
    return dims.unique_sources(pages, "label", "url")
