"""Landed files to DataFrames. Schemas are explicit; nothing is inferred by scanning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions import br_number


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
) -> DataFrame:
    """CSV, TSV or semicolon files; unreadable rows keep their text in ``_corrupt_record``."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    full = T.StructType([*struct.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )


SERIES_PAYLOAD = "series_id string, data string, valor string"


def typed_points(df: DataFrame) -> DataFrame:
    """``data`` (dd/MM/yyyy) and ``valor`` (comma decimal) to date and double; bad rows give NULLs."""
    return df.withColumns(
        {"ref_date": F.try_to_date("data", "d/M/yyyy"), "value": br_number(F.col("valor"), "comma_only")}
    ).drop("data", "valor")


def named_by_file(df: DataFrame) -> DataFrame:
    """Payloads without a series id take the name of their file."""
    file_name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    return df.withColumn("series_id", F.coalesce("series_id", file_name))


def read_series_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Series payloads ``[{data, valor}]``, one file per series, or JSON lines with a ``series_id``."""
    raw = spark.read.schema(SERIES_PAYLOAD).option("multiLine", multi_line).json(path)
    return typed_points(named_by_file(raw))


def read_indexed_json(
    spark: SparkSession,
    path: str,
    variable: str | None = None,
    prefix: str = "",
    code_length: int = 7,
    multi_line: bool = True,
) -> DataFrame:
    """Statistics table whose first record holds the labels: keep real records of one variable
    whose place code has the wanted length and prefix."""
    schema = "D1C string, D1N string, D2C string, D2N string, V string"
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    body = raw.filter(F.col("D1C").rlike(f"^{prefix}[0-9]{{{code_length - len(prefix)}}}$"))
    if variable is not None:
        body = body.filter(F.col("D2C") == variable)
    return body.select(
        F.col("D1C").alias("place_code"),
        F.col("D1N").alias("place"),
        F.col("D2C").alias("variable"),
        br_number(F.col("V"), "comma_only").alias("value"),
    )


def newest_observation(df: DataFrame) -> DataFrame:
    """``localidade`` and an array ``res`` of ``{periodo, valor}`` to the newest value per place."""
    obs = F.filter("res", lambda r: r["valor"].isNotNull())
    per_row = df.select("localidade", F.array_max(obs).alias("_o"))
    newest = per_row.groupBy("localidade").agg(F.max("_o").alias("_o"))
    return newest.filter("_o IS NOT NULL").select(
        F.col("localidade").alias("place"),
        F.col("_o.periodo").alias("period"),
        F.col("_o.valor").try_cast("double").alias("value"),
    )


def read_nested_observations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``[{localidade, res: [{periodo, valor}]}]`` files, newest observation per place."""
    schema = "localidade string, res array<struct<periodo:string, valor:string>>"
    return newest_observation(spark.read.schema(schema).option("multiLine", multi_line).json(path))


CATALOG_ENTRY = (
    "struct<code:string, name:string, category:string, unit:string, freq:string, "
    "relevance:string, usage:string, endpoint:string>"
)


def flatten_catalog(df: DataFrame, document: str, entry: str = CATALOG_ENTRY) -> DataFrame:
    """Catalogue documents to one row per series: the ``series`` sub-tree and, prefixed
    ``focus_``, the endpoints of the ``expectations`` sub-tree. Each document is parsed once."""
    tree = f"map<string,{entry}>"
    schema = f"struct<series:{tree}, expectations:struct<endpoints:{tree}>>"
    ids = [c for c in df.columns if c != document]

    def listed(entries: Column, kind: str, prefix: str) -> Column:
        tagged = F.transform(
            F.map_entries(entries),
            lambda e: F.struct(
                F.concat(F.lit(prefix), e["key"]).alias("series_id"),
                e["value"].alias("entry"),
                F.lit(kind).alias("source_kind"),
            ),
        )
        return F.coalesce(tagged, F.array())

    parsed = df.select(*ids, F.from_json(document, schema).alias("_d"))
    both = F.concat(
        listed(F.col("_d.series"), "series", ""),
        listed(F.col("_d.expectations.endpoints"), "expectation", "focus_"),
    )
    out = parsed.select(*ids, F.explode(both).alias("_s")).select(
        *ids, "_s.series_id", "_s.entry.*", "_s.source_kind"
    )
    category = F.when(F.col("source_kind") == "expectation", "expectations").otherwise(F.col("category"))
    return out.withColumn("category", category)
