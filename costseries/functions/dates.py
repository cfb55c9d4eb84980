"""Date and period parsers; unparseable input gives NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import strip_accents

# fixed values: month labels in calendar order
MONTHS = ("JAN", "FEV", "MAR", "ABR", "MAI", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ")
MONTH_NAMES = (
    "janeiro",
    "fevereiro",
    "marco",
    "abril",
    "maio",
    "junho",
    "julho",
    "agosto",
    "setembro",
    "outubro",
    "novembro",
    "dezembro",
)

DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "yyyy-M", "yyyy/M/d")

EXCEL_EPOCH = "1899-12-30"
LAST_SERIAL = 2958466  # fixed value: the day after 9999-12-31


def _shape(fmt: str) -> str:
    """Regular expression of the texts a numeric date format accepts."""
    digits = lambda m: "[0-9]{%s}" % (len(m[0]) if len(m[0]) > 1 else "1,2")
    return "^" + re.sub(r"y+|M+|d+", digits, fmt) + "$"


def parse_date_multi(col: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that parses wins.

    Each parser only sees texts of its own shape: a failed parse costs an exception per row.
    """
    text = F.trim(col)
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in formats])


def _month_number(name: Column, names: tuple[str, ...]) -> Column:
    """Number of a month by its first three letters; NULL unless the whole name is one of ``names``."""
    labels = "".join(n[:3] for n in names[:12])
    place = F.instr(F.lit(labels), F.substring(name, 1, 3))
    return F.when(name.isin(*names), F.floor((place + 2) / 3).cast("int"))


def month_name_to_num(col: Column) -> Column:
    """``JAN``..``DEZ`` (any case, padded) to 1..12."""
    return _month_number(F.upper(F.trim(col)), MONTHS)


def period_to_date(year: Column, month: Column | int = 1) -> Column:
    """First day of the month; NULL when either part is missing or out of range."""
    y = year.try_cast("int")
    m = F.lit(month) if isinstance(month, int) else month.try_cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def parse_pt_month(col: Column) -> Column:
    """``jan/24``, ``janeiro/2024``, ``01/2024`` or ``2024-01`` to the month start (pivot year 50)."""
    raw = F.lower(F.trim(col))
    text = F.when(F.substring(raw, 1, 1).between("0", "9"), raw).otherwise(strip_accents(raw))
    parts = r"^([a-z]+|[0-9]{1,4})[/-]([0-9]{1,4})"
    first, second = (F.regexp_extract(text, parts, i) for i in (1, 2))
    month = _month_number(first, (*[m.lower() for m in MONTHS], *MONTH_NAMES))
    short = F.substring(second, 1, 2).try_cast("int")
    century = F.when(short < 50, short + 2000).otherwise(short + 1900)
    year = F.when(F.length(second) == 4, second.try_cast("int")).when(F.length(second) >= 2, century)
    return (
        F.when(first >= "a", period_to_date(year, month))
        .when(F.length(first) == 4, period_to_date(first, F.substring(second, 1, 2)))
        .when((F.length(first) <= 2) & (F.length(second) == 4), period_to_date(second, first))
    )


def quarter_to_month(col: Column) -> Column:
    """Central month of a quarter label such as ``1T``, ``Q3`` or ``2 TRI``; lowest digit present wins."""
    text = F.upper(F.trim(col))
    is_quarter = text.rlike(r"TRI|[1-4]T|Q[1-4]")
    month = (
        F.when(text.contains("1"), 2)
        .when(text.contains("2"), 5)
        .when(text.contains("3"), 8)
        .when(text.contains("4"), 11)
    )
    return F.when(is_quarter, month)


def _serial(col: Column) -> Column:
    number = F.trim(col.cast("string")).try_cast("double")
    return F.when((number > 1000) & (number < LAST_SERIAL), number)


def excel_serial_date(col: Column) -> Column:
    """Serial day number (> 1000) or ISO date text to DATE."""
    serial = F.date_add(F.lit(EXCEL_EPOCH).cast("date"), F.floor(_serial(col)).cast("int"))
    return F.coalesce(serial, parse_date_multi(col.cast("string"), ("yyyy-MM-dd",)))


def excel_serial_timestamp(col: Column) -> Column:
    """Serial day number with a day fraction (seconds truncated) or ISO text to TIMESTAMP_NTZ."""
    serial = _serial(col)
    days = F.floor(serial)
    seconds = F.floor((serial - days) * 86400)
    start = F.lit(f"{EXCEL_EPOCH} 00:00:00").cast("timestamp_ntz")
    shifted = F.timestamp_add("SECOND", (days * 86400 + seconds).cast("bigint"), start)
    text = F.trim(col.cast("string"))
    iso = F.when(text.rlike(r"^[0-9]{4}-"), text.try_cast("timestamp_ntz"))
    return F.coalesce(shifted, iso)
