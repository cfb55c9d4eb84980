"""Deduplication, upserts, consolidation, sources and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import business_key, row_checksum
from ..operators import dims, joins, upsert, windows
from ..operators.columns import changed_rows
from ..session import table, workspace
from ..sources import (
    dry_run,
    read_delimited,
    read_indexed_json,
    read_latest,
    read_nested_observations,
    read_series_json,
    sanitize_for_sink,
    snapshot_versions,
    write_append,
    write_if_empty,
    write_insert_ignore,
    write_overwrite,
    write_upsert,
    write_upsert_partitions,
)
from ..streaming import current_flags, merged_view, run_available, stream_changes, stream_dedup, stream_quality, stream_series, stream_upsert
from .common import br_text, cents, cents_sql, money_sql, month, nation_months, nation_months_sql
from .registry import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]


def order_target(spark, d):
    """Stored orders: finished and open ones."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.filter(F.col("o_orderstatus").isin("F", "O"))


def order_batch(spark, d):
    """Incoming orders: open ones repriced, pending ones new."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = orders.filter(F.col("o_orderstatus").isin("O", "P"))
    return changed.withColumn("o_totalprice", F.col("o_totalprice") + 100)


@query(
    "q18_upsert",
    """SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 100 END AS o_totalprice
FROM orders""",
)
def upsert_orders(spark, d):
    return upsert.upsert(order_target(spark, d), order_batch(spark, d), ["o_orderkey"])


@query(
    "q106_upsert_dry_run",
    """SELECT count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS n_existing,
       count(*) FILTER (WHERE o_orderstatus = 'P') AS n_new, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_updated,
       count(*) AS n_final, 0::BIGINT AS n_duplicates FROM orders
UNION ALL SELECT CAST(sum(t) AS BIGINT), 0, count(*) FILTER (WHERE b > 0), CAST(sum(CASE WHEN b > 0 THEN 1 ELSE t END) AS BIGINT), CAST(sum(t - 1) AS BIGINT)
FROM (SELECT count(*) AS t, count(*) FILTER (WHERE l_linenumber = 1) AS b FROM lineitem GROUP BY l_orderkey, l_suppkey)""",
)
def upsert_dry_run(spark, d):
    """Orders by their key, and order lines by a key that some of them share."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    orders = dry_run(order_target(spark, d), order_batch(spark, d), ["o_orderkey"])
    return orders.unionByName(dry_run(lines, lines.filter("l_linenumber = 1"), ["l_orderkey", "l_suppkey"]))


@query(
    "q19_upsert_series",
    f"""WITH {nation_months_sql()},
m AS (SELECT region, ref_date, CASE WHEN ref_date >= DATE '2000-06-01' THEN value + 100 ELSE value END AS value FROM nm)
SELECT region || '_' || ref_date AS fact_id, *,
       round((value / nullif(lag(value) OVER w, 0) - 1) * 100, 4) AS mom,
       round((value / nullif(lag(value, 12) OVER w, 0) - 1) * 100, 4) AS yoy
FROM m WINDOW w AS (PARTITION BY region ORDER BY ref_date)""",
)
def upsert_series(spark, d):
    fact = nation_months(spark, d)
    stored = fact.filter(F.col("ref_date") < "2001-01-01")
    batch = fact.filter(F.col("ref_date") >= "2000-06-01").withColumn("value", F.col("value") + 100)
    out = upsert.upsert_series(stored, batch, "region", "ref_date", "value")
    return out.withColumns({"mom": F.round("mom", 4), "yoy": F.round("yoy", 4)})


@query(
    "q125_series_changes",
    f"""WITH {nation_months_sql()},
m AS (SELECT region, ref_date, value, CASE WHEN ref_date = DATE '1997-03-01' AND region < 'NATION_2' OR region = 'NATION_5' AND ref_date >= DATE '2001-01-01'
        THEN value + 100 ELSE value END AS revised FROM nm),
g AS (SELECT region, ref_date, revised AS value, value AS old, (value / nullif(lag(value) OVER w, 0) - 1) * 100 AS mom0,
        (value / nullif(lag(value, 12) OVER w, 0) - 1) * 100 AS yoy0, (revised / nullif(lag(revised) OVER w, 0) - 1) * 100 AS mom,
        (revised / nullif(lag(revised, 12) OVER w, 0) - 1) * 100 AS yoy FROM m WINDOW w AS (PARTITION BY region ORDER BY ref_date))
SELECT region || '_' || ref_date AS fact_id, region, ref_date, value, round(mom, 4) AS mom, round(yoy, 4) AS yoy FROM g
WHERE value <> old OR mom IS DISTINCT FROM mom0 OR yoy IS DISTINCT FROM yoy0""",
)
def changed_series(spark, d):
    """A few revisions in a stored fact with changes: what has to be written."""
    stored = windows.mom_yoy(nation_months(spark, d), ["region"], "ref_date", "value")
    day, region = F.col("ref_date"), F.col("region")
    revised = ((day == "1997-03-01") & (region < "NATION_2")) | ((region == "NATION_5") & (day >= "2001-01-01"))
    same = (region == "NATION_7") & (day >= "2001-01-01")  # delivered again, unchanged
    batch = stored.filter(revised | same).withColumn("value", F.col("value") + F.when(revised, F.lit(100)).otherwise(F.lit(0)))
    out = upsert.series_changes(stored, batch, "region", "ref_date", "value")
    return out.withColumns({"mom": F.round("mom", 4), "yoy": F.round("yoy", 4)})


@query(
    "q126_partitioned_upsert",
    """SELECT year(o_orderdate)::INTEGER AS y, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT) +
         CASE WHEN year(o_orderdate) = 1997 AND o_orderstatus <> 'F' THEN 10000 ELSE 0 END) AS BIGINT) AS total_cents
FROM orders GROUP BY ALL""",
)
def partitioned_upsert(spark, d):
    """Orders by year; a batch reprices some of 1997 and adds others of that year."""
    path, key = workspace(spark, "orders-by-year"), ["y", "o_orderkey"]
    orders = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"), "o_orderkey", "o_orderstatus", cents("o_totalprice").alias("c"))
    in_year = (F.col("y") == 1997) & (F.col("o_orderstatus") != "F")
    write_upsert_partitions(orders.filter(~in_year | (F.col("o_orderstatus") != "P")), path, key, ["y"])
    write_upsert_partitions(orders.filter(in_year).withColumn("c", F.col("c") + 10000), path, key, ["y"])
    return spark.read.parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("total_cents"))


@query(
    "q20_dedup_latest",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship, l_extendedprice, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) = 1""",
)
def dedup_latest(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, *LINE_ORDER)
    out = upsert.dedup_latest(lines, LINE_KEY, LINE_ORDER)
    return out.withColumn("ship", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query(
    "q107_dedup_oldest",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship, l_extendedprice, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey) = 1""",
)
def dedup_oldest(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, *LINE_ORDER)
    out = upsert.dedup_latest(lines, LINE_KEY, LINE_ORDER, keep="first")
    return out.withColumn("ship", F.col("l_shipdate").cast("date")).drop("l_shipdate")


@query(
    "q21_find_duplicates",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n_copies FROM lineitem GROUP BY ALL HAVING count(*) > 1)
SELECT l_orderkey, l_linenumber, l_extendedprice, n_copies FROM lineitem JOIN k USING (l_orderkey, l_linenumber)""",
)
def find_duplicates(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return upsert.find_duplicates(lines, LINE_KEY)


@query(
    "q22_insert_ignore",
    "SELECT o_orderkey, o_orderstatus, o_totalprice + 100 AS o_totalprice FROM orders WHERE o_orderstatus = 'P'",
)
def insert_ignore(spark, d):
    return upsert.insert_ignore(order_target(spark, d), order_batch(spark, d), ["o_orderkey"])


@query(
    "q108_key_sets",
    """SELECT o_orderstatus, 'known' AS kind, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL
UNION ALL SELECT o_orderstatus, 'new', count(*) FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL""",
)
def key_sets(spark, d):
    target, batch = order_target(spark, d), order_batch(spark, d)
    known = joins.semi_matching(batch, target, ["o_orderkey"])
    fresh = joins.anti_new_rows(batch, target, ["o_orderkey"])
    both = upsert.union_tagged({"known": known, "new": fresh}, "kind")
    return both.groupBy("o_orderstatus", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "q23_union_tagged",
    f"""SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, {money_sql('o_totalprice')} AS value,
       NULL::VARCHAR AS event_type, 'orders' AS origin FROM orders GROUP BY ALL
UNION ALL SELECT NULL, CAST(date_trunc('month', ts) AS DATE), {money_sql('value')}, event_type, 'events' FROM events GROUP BY ALL""",
)
def union_tagged(spark, d):
    orders = (
        table(spark, d, "orders")
        .groupBy("o_orderpriority", month("o_orderdate").alias("ref_date"))
        .agg((F.sum(cents("o_totalprice")).cast("double") / 100).alias("value"))
    )
    events = (
        table(spark, d, "events")
        .groupBy("event_type", month("ts").alias("ref_date"))
        .agg((F.sum(cents("value")).cast("double") / 100).alias("value"))
    )
    return upsert.union_tagged({"orders": orders, "events": events}, "origin")


def _months_cents(spark, d):
    return nation_months(spark, d, "l_returnflag").withColumn("c", F.round(F.col("value") * 100).cast("bigint"))


@query(
    "q24_consolidate_cost",
    f"""WITH {nation_months_sql('l_returnflag')},
u AS (
  SELECT ref_date, region AS place, 'MEDIO' AS kind, 'ONEROSO' AS regime, value, 'national' AS source, 0 AS p
    FROM nm WHERE l_returnflag = 'A'
  UNION ALL SELECT ref_date, region, 'MEDIO-DES', 'DESONERADO', value, 'by_place', 1 FROM nm WHERE l_returnflag = 'N'
  UNION ALL SELECT ref_date, CASE WHEN region = 'NATION_0' THEN 'BR' ELSE region END, 'R8-N', 'ONEROSO', value, 'by_place2', 2
    FROM nm WHERE l_returnflag = 'R'
  UNION ALL SELECT ref_date, region, 'MEDIO', 'ONEROSO', value + 1, 'history', 3 FROM nm
    WHERE l_returnflag = 'A' AND ref_date < DATE '1997-01-01'),
k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY ref_date, place, kind, regime ORDER BY p DESC) = 1)
SELECT row_number() OVER (ORDER BY ref_date, place, kind, regime) AS id, ref_date, place, kind, regime, value, source
FROM k WHERE value > 0""",
)
def consolidate_cost(spark, d):
    fact = _months_cents(spark, d)
    part = lambda flag: fact.filter(F.col("l_returnflag") == flag)
    iso, br = F.date_format("ref_date", "yyyy-MM-dd"), F.date_format("ref_date", "dd/MM/yyyy")
    national = part("A").select(iso.alias("ref_date"), F.col("region").alias("place"), br_text(F.col("c"), True).alias("v"))
    place = part("N").select(
        br.alias("ref_date"), F.col("region").alias("place"), F.lit("medio-des").alias("kind"), br_text(F.col("c")).alias("v")
    )
    blank = F.when(F.col("region") == "NATION_0", " ").otherwise(F.col("region"))
    other = part("R").select(
        F.date_format("ref_date", "yyyy-MM").alias("ref_date"), blank.alias("place"), F.lit("").alias("kind"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("v"),
    )
    old = part("A").filter(F.col("ref_date") < "1997-01-01").select(
        iso.alias("ref_date"), F.col("region").alias("place"), F.lit("MEDIO").alias("kind"), br_text(F.col("c") + 100).alias("v")
    )
    return upsert.consolidate_cost(
        [
            upsert.CostSource(national, "v", "national", regime="ONEROSO", default_kind="MEDIO"),
            upsert.CostSource(place, "v", "by_place"),
            upsert.CostSource(other, "v", "by_place2"),
            upsert.CostSource(old, "v", "history", regime="ONEROSO"),
        ]
    )


@query(
    "q25_consolidate_indicators",
    f"""WITH e AS (SELECT event_type, CAST(ts AS DATE) AS ref_date, {money_sql('value')} AS value, count(*) AS n
           FROM events GROUP BY ALL),
o AS (SELECT CAST(o_orderdate AS DATE) AS ref_date, {money_sql('o_totalprice')} AS value FROM orders GROUP BY ALL),
u AS (SELECT ref_date, upper(event_type) AS indicator, value, '% a.m.' AS unit, n::DOUBLE AS change FROM e
      UNION ALL SELECT ref_date, 'ORDERS', value, 'R$', NULL FROM o)
SELECT row_number() OVER (ORDER BY indicator, ref_date) AS id, ref_date, indicator, value, unit, change, 'SGS' AS source FROM u""",
)
def consolidate_indicators(spark, d):
    events = (
        table(spark, d, "events")
        .groupBy("event_type", F.col("ts").cast("date").alias("day"))
        .agg(F.sum(cents("value")).alias("c"), F.count(F.lit(1)).alias("n"))
        .select(
            "event_type", F.date_format("day", "dd/MM/yyyy").alias("ref_date"), br_text(F.col("c")).alias("value"),
            F.col("n").cast("string").alias("change"),
        )
    )
    orders = (
        table(spark, d, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.sum(cents("o_totalprice")).alias("c"))
        .select(F.date_format("day", "yyyy-MM-dd").alias("ref_date"), br_text(F.col("c"), True).alias("amount"))
    )
    sources = [upsert.IndicatorSource(events, F.upper("event_type"), "% a.m.")]
    sources.append(upsert.IndicatorSource(orders, "ORDERS", "R$", value="amount", change=None))
    return upsert.consolidate_indicators(sources, "SGS")


@query(
    "q84_registry_upsert",
    """SELECT 'dim_nation' AS table_name, count(*) AS n_existing, 0::BIGINT AS n_new,
       count(*) FILTER (WHERE n_regionkey = 2) AS n_updated, count(*) AS n_final FROM nation
UNION ALL SELECT 'dim_region', count(*) FILTER (WHERE r_name <> 'ASIA'), count(*) FILTER (WHERE r_name = 'ASIA'),
       count(*) FILTER (WHERE r_name <> 'ASIA'), count(*) FROM region
UNION ALL SELECT 'fact_part', count(*) FILTER (WHERE p_size <= 25), count(*) FILTER (WHERE p_size > 25),
       count(*) FILTER (WHERE p_size BETWEEN 21 AND 25), count(*) FROM part""",
)
def registry_upsert(spark, d):
    region, nation, part = (table(spark, d, t) for t in ("region", "nation", "part"))
    tables = {
        "fact_part": (part.filter("p_size <= 25"), part.filter("p_size > 20").withColumn("p_retailprice", F.col("p_retailprice") + 1)),
        "dim_region": (region.filter("r_name <> 'ASIA'"), region),
        "dim_nation": (nation, nation.filter("n_regionkey = 2").withColumn("n_name", F.lower("n_name"))),
    }
    keys = {"dim_region": ["r_regionkey"], "dim_nation": ["n_nationkey"], "fact_part": ["p_partkey"]}
    return dims.registry(keys, tables)


@query(
    "q85_key_diff",
    """SELECT o_custkey AS custkey, 'missing' AS status FROM (SELECT DISTINCT o_custkey FROM orders) o
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)
UNION ALL SELECT c_custkey, 'unexpected' FROM customer WHERE c_acctbal > 0
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
)
def key_diff(spark, d):
    expected = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    found = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"))
    return upsert.set_diff_keys(expected, found, "custkey")


@query(
    "q70_row_checksum",
    """SELECT o_orderkey, 'O_' || o_orderstatus || '_' || strftime(o_orderdate, '%Y-%m') AS fact_id,
       sha256(concat_ws(',', length(o_custkey::VARCHAR) || ':' || o_custkey, length(o_orderstatus) || ':' || o_orderstatus,
                        length(CAST(o_orderdate AS DATE)::VARCHAR) || ':' || CAST(o_orderdate AS DATE), length(o_orderpriority) || ':' || o_orderpriority))
       AS checksum FROM orders""",
)
def checksum(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey",
        business_key("O", F.col("o_orderstatus"), F.date_format(day, "yyyy-MM")).alias("fact_id"),
        row_checksum(F.col("o_custkey"), F.col("o_orderstatus"), day, F.col("o_orderpriority")).alias("checksum"),
    )


@query(
    "q109_changed_rows",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'removed' WHEN 'P' THEN 'added' ELSE 'changed' END AS status FROM orders""",
)
def snapshot_changes(spark, d):
    return changed_rows(order_target(spark, d), order_batch(spark, d), ["o_orderkey"])


@query(
    "q83_source_roundtrip",
    " UNION ALL ".join(
        f"""SELECT '{fmt}' AS origin, count(*) AS n, CAST(sum({cents_sql('o_totalprice')}) AS BIGINT) AS total_cents,
  CAST(min(o_orderdate) AS DATE) AS first_date, count(DISTINCT o_orderstatus) AS n_series FROM orders"""
        for fmt in ("csv", "latin", "tsv", "json", "versioned")
    ),
)
def source_roundtrip(spark, d):
    base = workspace(spark, "roundtrip")
    orders = table(spark, d, "orders").withColumns(
        {"day": F.col("o_orderdate").cast("date"), "amount": F.col("o_totalprice")}
    )
    text = sanitize_for_sink(orders, ["o_orderkey", "o_orderstatus", "day", "amount"])
    formats = {"csv": (",", "UTF-8"), "latin": (";", "ISO-8859-1"), "tsv": ("\t", "UTF-8")}
    parts = {}
    schema = "o_orderkey bigint, o_orderstatus string, day date, amount double"
    for name, (sep, encoding) in formats.items():
        path = f"{base}/{name}"
        text.write.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
        parts[name] = read_delimited(spark, path, schema, sep, encoding)
    payload = orders.select(
        F.col("o_orderstatus").alias("series_id"),
        F.date_format("day", "dd/MM/yyyy").alias("data"),
        br_text(cents("amount")).alias("valor"),
    )
    payload.write.partitionBy("series_id").json(f"{base}/json")
    points = read_series_json(spark, f"{base}/json", multi_line=False)
    parts["json"] = points.select(
        F.col("series_id").alias("o_orderstatus"), F.col("ref_date").alias("day"), F.col("value").alias("amount")
    )
    # seeded with the finished orders, then open ones appended, then new ones, then all upserted
    typed = orders.select("o_orderkey", "o_orderstatus", "day", "amount")
    seed = f"{base}/seed"
    write_if_empty(typed.filter("o_orderstatus = 'F'"), seed)
    write_append(typed.filter("o_orderstatus = 'O'"), seed)
    write_insert_ignore(typed.filter("o_orderstatus <> 'F'"), seed, ["o_orderkey"])
    snapshot_versions(spark.read.parquet(seed), f"{base}/table", "0001")
    write_upsert(typed, f"{base}/table", ["o_orderkey"], "0002")
    parts["versioned"] = read_latest(spark, f"{base}/table")
    return (
        upsert.union_tagged(parts, "origin")
        .groupBy("origin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(cents("amount")).alias("total_cents"),
            F.min("day").alias("first_date"),
            F.count_distinct("o_orderstatus").alias("n_series"),
        )
    )


@query(
    "q122_indexed_json",
    """SELECT lpad(c_custkey::VARCHAR, 7, '0') AS place_code, c_name AS place, c_mktsegment AS variable, c_acctbal AS value
FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def indexed_json(spark, d):
    path = f"{workspace(spark, 'indexed')}/table"
    records = table(spark, d, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 7, "0").alias("D1C"),
        F.col("c_name").alias("D1N"),
        F.col("c_mktsegment").alias("D2C"),
        F.lit("balance").alias("D2N"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("V"),
    )
    labels = spark.range(1).select(
        *[F.lit(text).alias(c) for c, text in (("D1C", "Code"), ("D1N", "Place"), ("D2C", "Variable"), ("D2N", "x"), ("V", "Value"))]
    )
    labels.unionByName(records).write.json(path)
    return read_indexed_json(spark, path, variable="BUILDING", multi_line=False)


@query(
    "q123_nested_json",
    f"""WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y%m') AS period, {money_sql('o_totalprice')} AS value
           FROM orders GROUP BY ALL)
SELECT o_custkey::VARCHAR AS place, max(period) AS period, arg_max(value, period) AS value FROM m GROUP BY ALL""",
)
def nested_json(spark, d):
    path = f"{workspace(spark, 'nested')}/observations"
    monthly = (
        table(spark, d, "orders")
        .groupBy("o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("periodo"))
        .agg((F.sum(cents("o_totalprice")) / 100).cast("decimal(18,2)").cast("string").alias("valor"))
    )
    missing = F.struct(F.lit("999912").alias("periodo"), F.lit(None).cast("string").alias("valor"))
    record = F.array(F.struct("periodo", "valor"), missing).alias("res")
    monthly.select(F.col("o_custkey").cast("string").alias("localidade"), record).write.json(path)
    return read_nested_observations(spark, path, multi_line=False)


SLICES = 3


def run_in_slices(spark, d, base, start, close=False):
    """Land ``events`` in slices of time, one after the other, and resume the stream ``start(rows)`` after each.

    ``close``: the last landing also holds a mark far behind the newest event, which closes all windows.
    """
    events = table(spark, d, "events")
    edges = events.agg(F.struct(F.min("ts").alias("low"), F.max("ts").alias("high"))).scalar()
    seconds = lambda c: c.cast("timestamp").cast("double")
    place = F.try_divide(seconds(F.col("ts")) - seconds(edges["low"]), seconds(edges["high"]) - seconds(edges["low"]))
    cut = events.withColumn("_slice", F.least(F.coalesce(F.floor(place * SLICES), F.lit(0)), F.lit(SLICES - 1)))
    mark = events.agg((F.max("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"))
    for i in range(SLICES):
        part = cut.filter(F.col("_slice") == i).drop("_slice")
        if close and i == SLICES - 1:
            part = part.unionByName(mark, allowMissingColumns=True)
        part.write.mode("append").parquet(f"{base}/landing")
        run_available(start(spark.readStream.schema(events.schema).parquet(f"{base}/landing")))


@query(
    "q67_stream_upsert",
    """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def streamed_upsert(spark, d):
    base = workspace(spark, "stream-upsert")
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]

    def start(events):
        rows = events.select(*keys, *order, "value")
        return stream_upsert(rows, f"{base}/target", f"{base}/progress", keys, order)

    run_in_slices(spark, d, base, start)
    return merged_view(spark, f"{base}/target", keys, order).drop("ts")


@query("q68_stream_dedup", "SELECT DISTINCT event_id, user_id, event_type, value FROM events")
def streamed_dedup(spark, d):
    base = workspace(spark, "stream-dedup")

    def start(events):
        rows = events.select("event_id", "ts", "user_id", "event_type", "value")
        rows = rows.withColumn("ts", F.col("ts").cast("timestamp"))
        twice = rows.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
        unique = stream_dedup(twice, ["event_id"], "ts", "40 days")
        writer = unique.writeStream.format("parquet").option("path", f"{base}/out")
        return writer.option("checkpointLocation", f"{base}/progress")

    run_in_slices(spark, d, base, start)
    return spark.read.parquet(f"{base}/out").drop("ts")


@query(
    "q69_stream_quality",
    """WITH w AS (SELECT CAST(ts AS DATE) AS day, event_type, value FROM events)
SELECT CAST(day AS DATE) AS window_start, event_type, count(*) AS n, count(*) FILTER (WHERE value < 0) AS n_negative,
       count(*) FILTER (WHERE value = 0) AS n_zero, count(*) FILTER (WHERE abs(value) > 250) AS n_absurd
FROM w GROUP BY ALL""",
)
def streamed_quality(spark, d):
    base = workspace(spark, "stream-quality")

    def start(events):
        rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
        counts = stream_quality(rows, "event_type", "ts", "value", "1 day", "1 hour", limit=250.0)
        writer = counts.writeStream.format("parquet").option("path", f"{base}/out")
        return writer.option("checkpointLocation", f"{base}/progress")

    run_in_slices(spark, d, base, start, close=True)
    out = spark.read.parquet(f"{base}/out")
    return out.withColumn("window_start", F.col("window_start").cast("date"))


@query(
    "q96_stream_series",
    f"""SELECT o_orderpriority AS series_id, count(*) AS n, CAST(sum({cents_sql('o_totalprice')}) AS BIGINT) AS total_cents,
       CAST(max(o_orderdate) AS DATE) AS last_date
FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2000-12-31' GROUP BY ALL""",
)
def streamed_series(spark, d):
    base = workspace(spark, "stream-series")
    payload = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("data"),
        br_text(cents("o_totalprice")).alias("valor"),
    )
    payload.write.json(f"{base}/landing")
    points = stream_series(spark, f"{base}/landing", "2000-12-31", multi_line=False)
    writer = points.writeStream.format("parquet").option("path", f"{base}/out")
    run_available(writer.option("checkpointLocation", f"{base}/progress"))
    return (
        spark.read.parquet(f"{base}/out")
        .groupBy("series_id")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("total_cents"), F.max("ref_date").alias("last_date")
        )
    )


@query(
    "q121_stream_changes",
    f"""WITH e AS (SELECT event_type, ts, max({cents_sql('value')}) AS c FROM events GROUP BY ALL),
g AS (SELECT *, c::DOUBLE / nullif(lag(c) OVER (PARTITION BY event_type ORDER BY ts), 0) - 1 AS mom,
             lag(c) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM e)
SELECT event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, c, round(mom, 6) AS mom FROM g
WHERE abs(mom) > 0.5 OR (p = 0 AND c <> 0)""",
)
def streamed_changes(spark, d):
    base = workspace(spark, "stream-changes")

    def start(events):
        points = events.select("event_type", "ts", cents("value").alias("c"))
        by_day = F.col("ts").cast("date")
        return stream_changes(points, f"{base}/store", f"{base}/flags", f"{base}/progress", "event_type", "ts", "c", 0.5, by_day)

    run_in_slices(spark, d, base, start)
    return current_flags(spark, f"{base}/flags", "event_type", "ts").select(
        "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "c", F.round("mom", 6).alias("mom")
    )
