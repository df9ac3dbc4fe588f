"""Column expressions (SCL-*): built-in Spark functions only, no Python UDF."""

from bourse.functions.scalar import (
    INF_PATTERN,
    NUMBER_PATTERN,
    add_years,
    cast_columns,
    conform,
    direction,
    format_date,
    json_field,
    has_json_key,
    limit_text,
    nan_to_null,
    parse_date,
    parse_timestamp,
    pct_diff,
    text_too_long,
    to_numeric,
    zfill,
)

__all__ = [
    "INF_PATTERN", "NUMBER_PATTERN", "add_years", "cast_columns", "conform", "direction",
    "format_date", "json_field", "has_json_key", "limit_text", "nan_to_null",
    "parse_date", "parse_timestamp", "pct_diff", "text_too_long", "to_numeric",
    "zfill",
]
