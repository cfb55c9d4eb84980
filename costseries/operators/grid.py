"""Spreadsheet-shaped rows to tidy facts.

A grid is ``source, sheet, row_idx, cells``: row order is data, cells are texts. A sheet may be
of any length, so values are carried downwards in blocks of rows (see ``windows.fill_forward``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    br_number,
    month_name_to_num,
    null_tokens,
    period_to_date,
    quarter_to_month,
    strip_accents,
)
from ..functions.dates import MONTHS
from ..functions.text import ACCENTED, PLAIN
from . import upsert, windows
from .joins import null_safe_join

SHEET = ("source", "sheet")
BLOCK_ROWS = 500_000

# fixed values: first-cell texts of rows that carry no data
NOISE_PREFIXES = ("fonte:", "elaboração:", "nota:", "observação:", "obs:", "unnamed")
NOISE_PHRASES = (
    "nbr 12",
    "banco de dados",
    "variações percentuais",
    "nova metodologia",
    "preços correntes",
    "dado não disponível",
    "caderneta_de_poupança",
    "taxa_referencial",
    "indicadores_do_pib",
    "valor_adicionado",
    "custo_unitário",
)
NOISE_MARKS = (r"\(\*\)", r"\(\.\.\.\)")
TOTAL_LABELS = ("TOTAL", "BRASIL", "LOCALIDADE")

# fixed values: state name to code
STATES = {
    "ACRE": "AC",
    "ALAGOAS": "AL",
    "AMAPÁ": "AP",
    "AMAZONAS": "AM",
    "BAHIA": "BA",
    "CEARÁ": "CE",
    "DISTRITO FEDERAL": "DF",
    "ESPÍRITO SANTO": "ES",
    "GOIÁS": "GO",
    "MARANHÃO": "MA",
    "MATO GROSSO": "MT",
    "MATO GROSSO DO SUL": "MS",
    "MINAS GERAIS": "MG",
    "PARÁ": "PA",
    "PARAÍBA": "PB",
    "PARANÁ": "PR",
    "PERNAMBUCO": "PE",
    "PIAUÍ": "PI",
    "RIO DE JANEIRO": "RJ",
    "RIO GRANDE DO NORTE": "RN",
    "RIO GRANDE DO SUL": "RS",
    "RONDÔNIA": "RO",
    "RORAIMA": "RR",
    "SANTA CATARINA": "SC",
    "SÃO PAULO": "SP",
    "SERGIPE": "SE",
    "TOCANTINS": "TO",
}


def grid_from_text(df: DataFrame, line: str = "line", sep: str = "\t") -> DataFrame:
    """Landed sheet rows to ordered cell arrays; ``source``, ``sheet`` and ``row_idx`` are kept."""
    return df.select(*SHEET, "row_idx", F.split(F.col(line), sep, -1).alias("cells"))


def cell(i: int) -> Column:
    """Trimmed text of the i-th cell (0-based), NULL when the row is shorter or the cell blank."""
    return F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit(""))


def is_noise(cells: Column, max_empty: float | None = None, anywhere: bool = False) -> Column:
    """Blank rows, source notes and titles, told by the first cell; ``anywhere``: note words count inside it, too."""
    first = F.lower(F.trim(F.coalesce(F.get(cells, F.lit(0)), F.lit(""))))
    empty = F.size(F.filter(cells, lambda c: F.coalesce(F.trim(c), F.lit("")) == ""))
    starts = "|".join(NOISE_MARKS if anywhere else [*NOISE_PREFIXES, *NOISE_MARKS])
    inside = "|".join([*NOISE_PREFIXES, *NOISE_PHRASES] if anywhere else NOISE_PHRASES)
    noise = (empty == F.size(cells)) | first.rlike(f"^({starts})") | first.rlike(inside)
    if max_empty is not None:
        noise = noise | (empty / F.size(cells) > max_empty)
    return noise


def drop_noise_rows(grid: DataFrame, max_empty: float | None = None, anywhere: bool = False) -> DataFrame:
    """Remove blank rows, source notes and titles; optionally rows that are mostly empty."""
    return grid.filter((F.size("cells") > 0) & ~is_noise(F.col("cells"), max_empty, anywhere))


@dataclass(frozen=True)
class Tidied:
    """What a grid gave: its facts, and every row that gave none with the reason (``source, sheet, row_idx, cells, reason``)."""

    facts: DataFrame
    rejected: DataFrame


def _tidied(rows: DataFrame, facts: DataFrame, reasons: Mapping[str, Column]) -> Tidied:
    """``rows`` are all rows of the grid; the first reason that holds is told, else the row repeats an earlier one."""
    reason = F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in reasons.items()], F.lit("repeated"))
    key = [*SHEET, "row_idx"]
    left = null_safe_join(rows.select(*key, "cells", reason.alias("reason")), facts.select(*key).distinct(), key, "left_anti")
    return Tidied(facts.drop("row_idx"), left)


def _block() -> Column:
    return F.floor(F.col("row_idx") / BLOCK_ROWS)


def fill_down(grid: DataFrame, cols: Sequence[str]) -> DataFrame:
    return windows.fill_forward(grid, cols, SHEET, "row_idx", _block())


def section_fill(grid: DataFrame, headings: Mapping[str, Column], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Carry section headings to the rows below them and remove the heading rows.

    Each heading expression is NULL on ordinary rows.
    """
    marked = grid.withColumns(dict(headings))
    is_heading = F.coalesce(*[F.col(h) for h in headings]).isNotNull()
    filled = fill_down(marked.withColumn("_heading", is_heading), list(headings)).filter(~F.col("_heading"))
    out = {h: F.coalesce(F.col(h), F.lit((defaults or {}).get(h))) for h in headings}
    return filled.withColumns(out).drop("_heading")


def year_of(text: Column, low: int, high: int) -> Column:
    """Cell text as a year inside a plausible span, else NULL."""
    number = F.when(text.rlike(r"^[0-9]{4}(\.0+)?$"), F.substring(text, 1, 4).try_cast("int"))
    return F.when(number.between(low, high), number)


YEARS_AHEAD, LAST_YEAR = 10, 2100


def last_year(as_of: dt.date | str | None, high: int | None) -> int:
    """The last plausible year: ``high``, else ten years after the day of the run, else 2100."""
    if high is not None:
        return high
    return int(str(as_of)[:4]) + YEARS_AHEAD if as_of else LAST_YEAR


def detect_header(grid: DataFrame, labels: Sequence[str] = MONTHS) -> DataFrame:
    """Per sheet, the first row that contains any of the labels (``header_idx``, ``header``)."""
    wanted = F.array(*[F.lit(m) for m in labels])
    upper = F.transform("cells", lambda c: F.upper(F.trim(c)))
    found = grid.withColumn("_up", upper).filter(F.arrays_overlap("_up", wanted))
    best = found.groupBy(*SHEET).agg(F.min(F.struct("row_idx", "_up")).alias("h"))
    return best.select(*SHEET, F.col("h.row_idx").alias("header_idx"), F.col("h._up").alias("header"))


def unpivot_months(df: DataFrame, ids: Sequence[str], year: str, first_cell: int = 1, mode: str = "strip_dots") -> DataFrame:
    """Year rows with twelve month cells to one row per month start; positive values kept."""
    months = F.posexplode(F.slice("cells", first_cell + 1, 12)).alias("_m", "_text")
    long = df.select(*ids, year, months)
    return (
        long.withColumn("ref_date", period_to_date(F.col(year), F.col("_m") + 1))
        .withColumn("value", br_number(F.col("_text"), mode))
        .filter((F.col("value") > 0) & F.col("ref_date").isNotNull())
        .drop("_m", "_text")
    )


def unpivot_columns(df: DataFrame, ids: Sequence[str], var: str, val: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Generic melt."""
    cols = list(cols or [c for c in df.columns if c not in ids])
    return df.unpivot([F.col(c) for c in ids], [F.col(c) for c in cols], var, val)


def _first_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return upsert.dedup_latest(df, keys, ["row_idx"], keep="first")


def _marked(grid: DataFrame, max_empty: float | None = None) -> DataFrame:
    """All rows, with ``_noise`` and, on the others, the number of a four-digit first cell (``_number``)."""
    noise = F.coalesce((F.size("cells") <= 0) | is_noise(F.col("cells"), max_empty, anywhere=True), F.lit(True))
    return grid.withColumn("_noise", noise).withColumn("_number", F.when(~F.col("_noise"), year_of(cell(0), 0, 9999)))


def _year_filled(grid: DataFrame, low: int, high: int) -> DataFrame:
    """All rows with the year written once per block of rows and carried down; an implausible year ends a block as well."""
    filled = fill_down(_marked(grid), ["_number"])
    return filled.withColumn("year", F.when(~F.col("_noise") & F.col("_number").between(low, high), F.col("_number")))


def _year_reasons() -> dict[str, Column]:
    return {
        "blank or note": F.col("_noise"),
        "no year": F.col("_number").isNull(),
        "year out of range": F.col("year").isNull(),
    }


def place_monthly_index(
    grid: DataFrame, mode: str = "strip_dots", low: int = 1980, high: int | None = None, as_of: dt.date | str | None = None
) -> Tidied:
    """``YEAR, MONTH, INDEX, VAR_MONTH, VAR_YEAR, VAR_12M`` rows; one row per date, and the rows that gave none."""
    measures = {"value": 2, "var_month": 3, "var_year": 4, "var_12m": 5}
    rows = _year_filled(grid, low, last_year(as_of, high)).withColumn("month", month_name_to_num(cell(1)))
    rows = rows.withColumns({m: br_number(cell(i), mode) for m, i in measures.items()})
    some = F.coalesce(*[F.col(m) for m in measures]).isNotNull()
    kept = rows.filter(F.col("year").isNotNull() & F.col("month").isNotNull() & some)
    dated = kept.withColumn("ref_date", period_to_date(F.col("year"), F.col("month")))
    facts = _first_per(dated.select(*SHEET, "row_idx", "ref_date", *measures), [*SHEET, "ref_date"])
    return _tidied(rows, facts, _year_reasons() | {"no month": F.col("month").isNull(), "no value": ~some})


def tidy_monthly_index(
    grid: DataFrame, mode: str = "strip_dots", low: int = 1980, high: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    return place_monthly_index(grid, mode, low, high, as_of).facts


def place_annual(
    grid: DataFrame, colmap: Mapping[str, int], mode: str = "strip_dots", low: int = 1950, high: int | None = None, as_of: dt.date | str | None = None
) -> Tidied:
    """Year rows to named measures; one row per year, at least one value; and the rows that gave none."""
    rows = _marked(grid).withColumn("year", F.when(F.col("_number").between(low, last_year(as_of, high)), F.col("_number")))
    rows = rows.withColumns({m: br_number(cell(i), mode) for m, i in colmap.items()})
    some = F.coalesce(*[F.col(m) for m in colmap]).isNotNull()
    kept = rows.filter(F.col("year").isNotNull() & some)
    facts = _first_per(kept.select(*SHEET, "row_idx", "year", *colmap), [*SHEET, "year"])
    return _tidied(rows, facts, _year_reasons() | {"no value": ~some})


def tidy_annual(
    grid: DataFrame, colmap: Mapping[str, int], mode: str = "strip_dots", low: int = 1950, high: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    return place_annual(grid, colmap, mode, low, high, as_of).facts


def tidy_place_month(grid: DataFrame, year: int, kind: str, mode: str = "strip_dots") -> DataFrame:
    """Place rows under a month header to one row per place and month; totals left out."""
    below = grid.join(detect_header(grid), list(SHEET)).filter(F.col("row_idx") > F.col("header_idx"))
    rows = drop_noise_rows(below).withColumn("place", cell(0))
    rows = rows.filter(F.col("place").isNotNull() & ~F.upper("place").isin(*TOTAL_LABELS))
    pairs = rows.select(
        *SHEET, F.initcap("place").alias("place"), F.explode(F.arrays_zip("header", "cells")).alias("p")
    )
    out = pairs.select(
        *SHEET,
        period_to_date(F.lit(year), month_name_to_num(F.col("p.header"))).alias("ref_date"),
        "place",
        F.lit(kind).alias("kind"),
        br_number(F.col("p.cells"), mode).alias("value"),
    )
    return out.filter(F.col("ref_date").isNotNull() & (F.col("value") > 0)).dropDuplicates()


def _sectioned(rows: DataFrame, headings: Mapping[str, Column], defaults: Mapping[str, str]) -> DataFrame:
    """All rows with the section headings above them (``_heading`` marks the headings themselves)."""
    marked = rows.withColumns({h: F.when(~F.col("_noise"), c) for h, c in headings.items()})
    marked = marked.withColumn("_heading", F.coalesce(*[F.col(h) for h in headings]).isNotNull())
    return fill_down(marked, list(headings)).withColumns({h: F.coalesce(F.col(h), F.lit(d)) for h, d in defaults.items()})


def _month_cells(rows: DataFrame, ids: Sequence[str], mode: str) -> tuple[DataFrame, Column]:
    """Month cells of the year rows to facts, and whether a row has none with a positive value."""
    kept = rows.filter(F.col("year").isNotNull() & ~F.col("_heading") & F.coalesce(*[F.col(i) for i in ids]).isNotNull())
    for i in ids:
        kept = kept.filter(F.col(i).isNotNull())
    long = unpivot_months(kept, [*SHEET, "row_idx", *ids], "year", mode=mode).drop("year")
    worthless = ~F.coalesce(F.exists(F.slice("cells", 2, 12), lambda c: F.coalesce(br_number(c, mode) > 0, F.lit(False))), F.lit(False))
    return _first_per(long, [*SHEET, *ids, "ref_date"]), worthless


def place_region_matrix(
    grid: DataFrame, mode: str = "strip_dots", default: str = "BRASIL", low: int = 1990, high: int | None = None, as_of: dt.date | str | None = None
) -> Tidied:
    """Region headings over year rows with twelve month cells to a region panel, and the rows that gave nothing.

    Rows before the first heading belong to the default region; hyphenated names stay whole.
    """
    plain = strip_accents(F.upper(cell(0)))
    is_heading = plain.rlike("CUB MEDIO|REGIAO")
    named = F.nullif(F.regexp_extract(plain, r"REGIAO\s+([A-Z-]+)", 1), F.lit(""))
    region = F.when(is_heading, F.coalesce(named, F.lit(default)))
    rows = _sectioned(_marked(grid), {"region": region}, {"region": default})
    rows = rows.withColumn("year", F.when(F.col("_number").between(low, last_year(as_of, high)), F.col("_number")))
    facts, worthless = _month_cells(rows, ["region"], mode)
    noise, *years = _year_reasons().items()
    return _tidied(rows, facts, dict([noise, ("heading", F.col("_heading")), *years, ("no value", worthless)]))


def tidy_region_matrix(
    grid: DataFrame, mode: str = "strip_dots", default: str = "BRASIL", low: int = 1990, high: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    return place_region_matrix(grid, mode, default, low, high, as_of).facts


def state_code(text: Column) -> Column:
    """Code of the state named in a heading; of names that start alike the longest wins."""
    codes = {name.translate(str.maketrans(ACCENTED, PLAIN)): code for name, code in STATES.items()}
    named = "|".join(sorted(codes, key=lambda n: (-len(n), n)))
    name = F.regexp_extract(strip_accents(F.upper(text)), f"({named})", 1)
    entries = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), name)


def place_state_standard(
    grid: DataFrame, mode: str = "strip_dots", default: str = "R8-N", low: int = 1990, high: int | None = None, as_of: dt.date | str | None = None
) -> Tidied:
    """``STATE (PADRÃO - x)`` headings over year rows to a state by standard panel, and the rows that gave nothing."""
    first = F.upper(cell(0))
    state = state_code(first)
    standard = F.nullif(F.trim(F.regexp_extract(first, r"\(PADRÃO\s*-\s*([^)]+)\)", 1)), F.lit(""))
    headings = {"state": state, "standard": F.when(state.isNotNull(), standard)}
    rows = _sectioned(_marked(grid, 0.8), headings, {"standard": default})
    rows = rows.withColumn("year", F.when(F.col("_number").between(low, last_year(as_of, high)), F.col("_number")))
    facts, worthless = _month_cells(rows, ["state", "standard"], mode)
    noise, *years = _year_reasons().items()
    reasons = [noise, ("heading", F.col("_heading")), *years, ("no state", F.col("state").isNull()), ("no value", worthless)]
    return _tidied(rows, facts, dict(reasons))


def tidy_state_standard(
    grid: DataFrame, mode: str = "strip_dots", default: str = "R8-N", low: int = 1990, high: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    return place_state_standard(grid, mode, default, low, high, as_of).facts


def place_mixed_period(
    grid: DataFrame, mode: str = "strip_dots", low: int = 2000, high: int | None = None, as_of: dt.date | str | None = None
) -> Tidied:
    """``YEAR, MONTH or QUARTER, RATE`` rows to one series, and the rows that gave nothing; quarters sit on their central month."""
    rows = _year_filled(grid, low, last_year(as_of, high))
    month = F.coalesce(month_name_to_num(cell(1)), quarter_to_month(cell(1)))
    rows = rows.withColumns({"month": month, "value": br_number(cell(2), mode)})
    kept = rows.filter("year IS NOT NULL AND month IS NOT NULL AND value IS NOT NULL")
    dated = kept.withColumn("ref_date", period_to_date(F.col("year"), F.col("month")))
    facts = _first_per(dated.select(*SHEET, "row_idx", "ref_date", "value"), [*SHEET, "ref_date"])
    return _tidied(rows, facts, _year_reasons() | {"no month or quarter": F.col("month").isNull(), "no value": F.col("value").isNull()})


def tidy_mixed_period(
    grid: DataFrame, mode: str = "strip_dots", low: int = 2000, high: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    return place_mixed_period(grid, mode, low, high, as_of).facts


def tidy_state_sheets(grid: DataFrame, skip: int = 7, mode: str = "auto") -> DataFrame:
    """One sheet per state: skip the title rows, carry the year down, melt the value cells."""
    body = grid.filter(F.col("row_idx") >= skip)
    body = body.withColumn("year", year_of(cell(0), 1900, 2100))
    rows = fill_down(body, ["year"]).withColumn("month", month_name_to_num(cell(1)))
    dated = rows.withColumn("ref_date", period_to_date(F.col("year"), F.col("month")))
    values = F.posexplode(F.slice("cells", 3, F.greatest(F.size("cells") - 2, F.lit(0)))).alias("_i", "_text")
    long = dated.filter("ref_date IS NOT NULL").select(*SHEET, "ref_date", values)
    typed = long.select(
        "source",
        F.col("sheet").alias("state"),
        "ref_date",
        F.concat(F.lit("val_"), F.col("_i")).alias("measure"),
        br_number(F.col("_text"), mode).alias("value"),
    )
    return typed.filter("value IS NOT NULL")


def tidy_header3(grid: DataFrame, var: str, skip: int = 3, mode: str = "auto") -> DataFrame:
    """Skip the title rows, take the next row as header, melt, coerce and drop missing values."""
    header = grid.filter(F.col("row_idx") == skip).select(*SHEET, F.col("cells").alias("header"))
    body = grid.filter(F.col("row_idx") > skip).join(header, list(SHEET))
    pairs = body.select(
        *SHEET, cell(0).alias("label"), F.posexplode(F.arrays_zip("header", "cells")).alias("_i", "p")
    )
    out = pairs.filter(F.col("_i") > 0).select(
        *SHEET, "label", F.trim(F.col("p.header")).alias(var), br_number(F.col("p.cells"), mode).alias("value")
    )
    return out.filter(F.col("label").isNotNull() & F.col("value").isNotNull())


# fixed values: first-cell texts of repeated header rows, per table kind
REPEATED_HEADERS = {
    "cost": "projeto|tipo|unnamed",
    "gdp": "unnamed|valor|total",
    "material": "material|produto|unnamed",
    "indicator": "indicador|unnamed",
}


def tidy_tables_by_kind(df: DataFrame, kind: str, order: str, source: str, as_of: str) -> DataFrame:
    """Repair the header, drop repeated header rows and add the table's metadata."""
    from .columns import promote_header

    named = promote_header(df, order, first="label")
    repeated = F.coalesce(F.lower("label").rlike(REPEATED_HEADERS[kind]), F.lit(False))
    return named.filter(~repeated).withColumns(
        {
            "kind": F.lit(kind),
            "source": F.lit(source),
            "extracted_on": F.lit(as_of).cast("date"),
            "label": null_tokens(F.col("label")),
        }
    )
