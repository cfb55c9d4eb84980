"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Words are runs of anything but space and the ASCII controls tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; none for a null or blank text.

    Splitting at a plain space needs no regular expression, so only texts with other white space than
    spaces and line ends pay for one.
    """
    flat = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    parts = F.when(flat.rlike(r"[\x09-\x0D]"), F.split(flat, GAP)).otherwise(F.split(flat, " "))
    return F.array_remove(parts, "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also inside one expression."""
    return F.transform(F.array(value), body)[0]


def packed(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns an operator works on beside the whole row, so that no name of the row can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[docs[c].alias(f"_{c}") for c in keep])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fields(text: str) -> StructType:
    return StructType.fromDDL(text)
