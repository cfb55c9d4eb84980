from .dates import (
    excel_serial_date,
    excel_serial_timestamp,
    month_name_to_num,
    parse_date_multi,
    parse_pt_month,
    period_to_date,
    quarter_to_month,
)
from .keys import business_key, row_checksum, row_hashes
from .numbers import br_number, currency_number, null_tokens, sentinel_to_null, to_double
from .text import recode, strip_accents, truth

__all__ = [
    "br_number",
    "business_key",
    "currency_number",
    "excel_serial_date",
    "excel_serial_timestamp",
    "month_name_to_num",
    "null_tokens",
    "parse_date_multi",
    "parse_pt_month",
    "period_to_date",
    "quarter_to_month",
    "recode",
    "row_checksum",
    "row_hashes",
    "sentinel_to_null",
    "strip_accents",
    "to_double",
    "truth",
]
