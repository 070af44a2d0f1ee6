"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from .expr import (  # noqa: F401
    nan_to_null, normalize_ticker, normalize_company_name, date_key,
    monday0_weekday, month_name, day_name, pct_diff, is_flagged, to_decimal,
)
