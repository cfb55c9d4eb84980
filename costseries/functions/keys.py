"""Key and fingerprint expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def business_key(*parts: Column | str, sep: str = "_") -> Column:
    """Readable id made of literals (plain strings) and columns; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.lit(part) if isinstance(part, str) else part.cast("string"))
    return F.concat(*pieces)


def row_checksum(*cols: Column) -> Column:
    """SHA-256 of the row content.

    Every cell is written with its length in front, a missing one as ``-``, so neither separators inside cells nor
    the difference of NULL and empty text can make two rows look alike.
    """
    cells = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in cols]
    return F.sha2(F.concat_ws(",", *cells), 256)


def _hashable(c: Column, kind: T.DataType) -> list[Column]:
    """What to hash of a column, so that equal cells have equal hashes and nothing can slip into a neighbour."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return [c + F.lit(0.0)]  # one zero only
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.MapType)):
        number = isinstance(kind.elementType, (T.DoubleType, T.FloatType))
        items = F.transform(c, lambda x: x + F.lit(0.0)) if number else c
        return [items, F.size(c)] + ([F.transform(c, lambda x: x.isNull())] if kind.containsNull else [])
    if isinstance(kind, T.MapType):
        return [F.to_json(F.array_sort(F.map_entries(c)), {"ignoreNullFields": "false"})]
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return [F.to_json(c, {"ignoreNullFields": "false"})]
    return [c]


def row_hashes(schema: T.StructType) -> list[Column]:
    """Two independent 64-bit hashes ``_h1``, ``_h2`` of whole rows: 16 bytes that stand for a row in a shuffle."""
    parts = [part for f in schema for part in _hashable(F.col(f.name), f.dataType)]
    parts.append(F.array(*[F.col(f.name).isNull() for f in schema]))
    return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *parts).alias("_h2")]
