"""Scalar column functions: every one is a native Catalyst expression."""

from stellate.functions.columns import (  # noqa: F401
    VISA_CATEGORIES, code_label, fill_zero_long, to_int, upper_text, visa_category,
)
from stellate.functions.dates import (  # noqa: F401
    SAS_EPOCH, calendar_columns, parse_date, register_sql_functions, sas_to_date,
)
