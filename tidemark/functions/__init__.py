"""Column expressions shared by the operators."""

from tidemark.functions.columns import (
    days_after,
    exact_decimal,
    iso_date,
    iso_text,
    or_default,
    safe_symbol,
    spread,
    whole_number,
)

__all__ = [
    "days_after",
    "exact_decimal",
    "iso_date",
    "iso_text",
    "or_default",
    "safe_symbol",
    "spread",
    "whole_number",
]
