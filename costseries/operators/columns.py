"""Header, schema and lineage operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.keys import row_checksum
from ..functions.numbers import to_double


def snake(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def unique_names(names: Sequence[str]) -> list[str]:
    """Number repeated names so that a header can always be applied."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names([snake(c) for c in df.columns]))


def synonym_columns(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rename header variants to the canonical name (case and all blanks ignored)."""
    def plain(header: str) -> str:
        return "".join(header.lower().split())

    canonical = {plain(v): name for name, variants in synonyms.items() for v in variants}
    renames: dict[str, str] = {}
    for c in df.columns:  # the first of several variants takes the name
        name = canonical.get(plain(c))
        if name and name not in renames.values() and (name == c or name not in df.columns):
            renames[c] = name
    return df.withColumnsRenamed(renames)


def promote_header(df: DataFrame, order: str, first: str = "label") -> DataFrame:
    """Name the ``unnamed`` columns from the first data row and drop that row.

    Reads one row to the driver, since names are metadata.
    """
    cols = [c for c in df.columns if c != order]
    found = df.orderBy(order).limit(1).collect()
    if not found:
        return df.toDF(*unique_names([order, first, *[snake(c) if "unnamed" not in c.lower() else f"value_{i}" for i, c in enumerate(cols[1:], 1)]])) if df.columns[0] == order else df
    head = found[0]
    names = [first]
    for i, c in enumerate(cols[1:], 1):
        text = str(head[c]).strip() if head[c] is not None else ""
        if "unnamed" not in c.lower():
            names.append(snake(c))
        else:
            names.append(snake(text) if text and text != "nan" else f"value_{i}")
    renamed = df.filter(F.col(order) > F.lit(head[order])).select(order, *cols)
    return renamed.toDF(order, *unique_names(names))


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Text to double, bad cells NULL, for listed columns or those whose name matches."""
    chosen = list(cols or [])
    if pattern:
        chosen += [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]
    return df.withColumns({c: to_double(F.col(c)) for c in chosen if c in df.columns})


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop all-null rows and all-null columns (one counting aggregate decides the columns)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).collect()[0]
    return df.dropna("all").select(*[c for c in df.columns if counts[c] > 0])


def align_schema(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Force a column contract: order, types, and defaults for absent or NULL cells."""
    defaults = defaults or {}

    def cell(field: T.StructField) -> Column:
        default = F.lit(defaults.get(field.name)).cast(field.dataType)
        if field.name not in df.columns:
            return default.alias(field.name)
        value = F.col(field.name).try_cast(field.dataType)
        return (F.coalesce(value, default) if field.name in defaults else value).alias(field.name)

    return df.select(*[cell(f) for f in schema.fields])


def stamp_lineage(
    df: DataFrame, exec_id: str, as_of: str, source: str, version: str = "1.0.0", freq: str = "monthly",
    method: str | None = None, status: str | None = None, url: str | None = None, note: str | None = None,
) -> DataFrame:
    """Run id, load time, source, pipeline version and frequency, and how, from where and with what outcome the
    rows were collected; all are arguments, so reruns agree."""
    return df.withColumns(
        {
            "exec_id": F.lit(exec_id),
            "loaded_at": F.lit(as_of).cast("timestamp_ntz"),
            "source": F.lit(source),
            "pipeline_version": F.lit(version),
            "freq": F.lit(freq),
            "collection_method": F.lit(method).cast("string"),
            "collection_status": F.lit(status).cast("string"),
            "source_url": F.lit(url).cast("string"),
            "note": F.lit(note).cast("string"),
        }
    )


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare two snapshots by row fingerprint: added, removed or changed keys."""
    def prints(df: DataFrame, is_new: bool) -> DataFrame:
        rest = [F.col(c) for c in sorted(df.columns) if c not in keys]
        return df.select(*keys, F.lit(is_new).alias("_new"), F.xxhash64(row_checksum(*rest)).cast("decimal(38,0)").alias("_print"))

    def total(is_new: bool) -> Column:
        own = F.col("_new") == is_new
        return F.struct(F.count_if(own).alias("n"), F.sum(F.when(own, F.col("_print"))).alias("s"))

    both = prints(old, False).unionByName(prints(new, True)).groupBy(*keys)  # NULL keys meet
    both = both.agg(total(False).alias("_before"), total(True).alias("_after"))
    status = (
        F.when(F.col("_before.n") == 0, "added")
        .when(F.col("_after.n") == 0, "removed")
        .when(F.col("_before") != F.col("_after"), "changed")
    )
    return both.withColumn("status", status).filter("status IS NOT NULL").drop("_before", "_after")
