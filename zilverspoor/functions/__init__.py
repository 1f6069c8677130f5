"""Column expressions. Everything here is built from JVM-side functions."""

from zilverspoor.functions.dates import (
    begin_date,
    begin_number,
    date_minus_one,
    format_date,
    incomplete_date_to_date,
    local_date,
    yesterday_number,
    yyyymmdd_to_date,
)
from zilverspoor.functions.text import (
    address_line,
    code_label,
    concat_propagate,
    concat_skip_null,
    format_bsn,
    pair_key,
    right_chars,
    strip_nul,
    suffixed_key,
    zero_pad,
)

__all__ = [
    "address_line",
    "begin_date",
    "begin_number",
    "code_label",
    "concat_propagate",
    "concat_skip_null",
    "date_minus_one",
    "format_bsn",
    "format_date",
    "incomplete_date_to_date",
    "local_date",
    "pair_key",
    "right_chars",
    "strip_nul",
    "suffixed_key",
    "yesterday_number",
    "yyyymmdd_to_date",
    "zero_pad",
]
