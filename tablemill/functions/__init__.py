"""Column expressions: every function takes and returns a ``Column``."""

from .columns import (
    as_column,
    columns_of,
    is_missing,
    missing_count,
    numeric_columns,
    present,
    string_columns,
    timestamp_columns,
)
from .dates import (
    calendar_date,
    day_of_week,
    duration_minutes,
    is_weekend,
    parse_timestamp,
)
from .numbers import log1p_value, reciprocal, rounded, sqrt_value, tip_rate
from .text import (
    label_text,
    normalize_phone,
    normalize_status,
    normalize_whitespace,
    route_label,
    standard_id,
    strip_special,
    strip_whitespace,
)

__all__ = [
    "as_column",
    "calendar_date",
    "columns_of",
    "day_of_week",
    "duration_minutes",
    "is_missing",
    "is_weekend",
    "label_text",
    "log1p_value",
    "missing_count",
    "present",
    "normalize_phone",
    "normalize_status",
    "normalize_whitespace",
    "numeric_columns",
    "parse_timestamp",
    "reciprocal",
    "rounded",
    "route_label",
    "sqrt_value",
    "standard_id",
    "string_columns",
    "strip_special",
    "strip_whitespace",
    "timestamp_columns",
    "tip_rate",
]
