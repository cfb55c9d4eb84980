"""Numeric cell parsers. All return NULL for text that is not a number (ANSI-safe)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# fixed values: cell texts that mean "missing"
NULL_TOKENS = ("", "...", "-", "nan", "None", "N/D", "n/d", "(...)")

# Characters of a decimal numeral; the cast rejects what is no numeral, this what only the cast would read (``NaN``, ``1d``).
DECIMAL_CHARS = r"^[ \t\n\x0B\f\r0-9.eE+-]++$"
CURRENCY_MARKS = ("R", "$", "%", " ", "\t", "\n", "\x0b", "\f", "\r")


def null_tokens(col: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Trimmed text, NULL where it is one of the missing markers."""
    text = F.trim(col)
    return F.when(~text.isin(*tokens), text)


def to_double(col: Column) -> Column:
    """Plain decimal text to double; anything else (also ``NaN``, ``1d``, missing markers) is NULL."""
    text = col.cast("string")
    return F.when(text.rlike(DECIMAL_CHARS), text.try_cast("double"))


def br_number(col: Column, mode: str = "auto") -> Column:
    """Brazilian numeral to double; missing markers are NULL.

    ``auto`` treats dots as thousands marks only when a comma is present, ``strip_dots``
    always does, ``comma_only`` just turns the comma into a decimal point.
    """
    if mode == "auto":
        digits = F.when(F.contains(col, F.lit(",")), F.replace(col, F.lit("."), F.lit(""))).otherwise(col)
    elif mode == "strip_dots":
        digits = F.replace(col, F.lit("."), F.lit(""))
    elif mode == "comma_only":
        digits = col
    else:
        raise ValueError(f"unknown numeral mode: {mode}")
    return to_double(F.replace(digits, F.lit(","), F.lit(".")))


def currency_number(col: Column) -> Column:
    """``R$ 1.234,56`` or ``12,5 %`` to double."""
    return br_number(reduce(lambda c, mark: F.replace(c, F.lit(mark), F.lit("")), CURRENCY_MARKS, col), mode="strip_dots")


def sentinel_to_null(col: Column, value: float = -100.0) -> Column:
    return F.nullif(col, F.lit(value))
