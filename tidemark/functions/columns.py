"""Column -> Column helpers. All are built-in expressions that stay in codegen, and
none raises on bad text under ANSI mode: an unreadable value becomes NULL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import SPREAD_TYPE

# Characters a symbol may hold and what stands for them in a name.
SYMBOL_REPLACEMENTS = (("^", "IDX_"), ("=", "FUT_"), ("-", "_"))


def iso_date(value: Column) -> Column:
    """Date of ISO text, a timestamp or a date; a trailing time part is dropped."""
    return value.try_cast("date")


def iso_text(day: Column) -> Column:
    """ISO text of a date or timestamp, as the cast writes it: no formatter runs."""
    return day.cast("date").cast("string")


def exact_decimal(value: Column, kind: T.DecimalType) -> Column:
    """Half-up rounding to ``kind``; NULL for unreadable or overflowing values."""
    return value.try_cast(kind)


def whole_number(value: Column, kind: T.DataType) -> Column:
    """bigint of a column of the given type, fractions cut off, NaN as NULL.

    Text goes through a decimal, which reads ``"1200.0"``: the cast of text to bigint
    refuses it, and by an exception for each such row.
    """
    if isinstance(kind, T.StringType):
        value = value.try_cast("decimal(38,6)")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.nanvl(value, F.lit(None))
    return value.try_cast("bigint")


def spread(bid: Column, ask: Column) -> Column:
    """Ask less bid. The difference of two prices of scale 4 is exact at that scale, so
    rounding it would change nothing."""
    return (ask - bid).cast(SPREAD_TYPE)


def days_after(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def or_default(value: Column, default: date) -> Column:
    return F.coalesce(value, F.lit(default))


def safe_symbol(symbol: Column) -> Column:
    """Symbol as it may appear in a file or folder name."""
    for old, new in SYMBOL_REPLACEMENTS:
        symbol = F.replace(symbol, F.lit(old), F.lit(new))
    return symbol
