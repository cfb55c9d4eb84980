"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"


def strip_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def recode(col: Column, mapping: dict[str, str]) -> Column:
    """Replace known codes, pass every other value through."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), col), col)


def truth(col: Column) -> Column:
    """``TRUE``/``FALSE`` text to boolean, anything else NULL."""
    text = F.upper(F.trim(col.cast("string")))
    return F.when(text.isin("TRUE", "FALSE"), text.try_cast("boolean"))
