"""Column expressions (all built-in Spark functions, codegen-friendly)."""

from tickerlake.functions.exprs import (
    NUMBER_PATTERN,
    iso_date,
    leading_capitals,
    parse_iso_or_us_date,
    parse_us_date,
    round_half_even,
    strip_amount,
    strip_whitespace,
    to_number,
    underscore_name,
    volume_number,
)

__all__ = [
    "NUMBER_PATTERN",
    "iso_date",
    "leading_capitals",
    "parse_iso_or_us_date",
    "parse_us_date",
    "round_half_even",
    "strip_amount",
    "strip_whitespace",
    "to_number",
    "underscore_name",
    "volume_number",
]
