"""Landed documents and bar rows to the typed columns of the fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import exact_decimal, iso_date, spread, whole_number
from tidemark.operators.scale import lookup_join
from tidemark.schemas import (
    API_BARS,
    GOLD_CODE,
    GOLD_TYPE,
    PRICE_TYPE,
    RATE_TYPE,
    BarLayout,
)

BAR_VALUES = ("open_price", "high_price", "low_price", "close_price", "volume")


def flatten_rates(documents: DataFrame) -> DataFrame:
    """One row per observation of a rate document; documents without any vanish."""
    entries = documents.select("code", F.explode("rates").alias("r"))
    return entries.select(
        F.col("code").alias("currency_code"),
        iso_date(F.col("r.effectiveDate")).alias("exchange_date"),
        exact_decimal(F.col("r.mid"), RATE_TYPE).alias("rate_value"),
    )


def flatten_spreads(documents: DataFrame) -> DataFrame:
    """One row per bid/ask observation, with the spread between the rounded prices."""
    entries = documents.select("code", F.explode("rates").alias("r"))
    prices = entries.select(
        F.col("code").alias("currency_code"),
        iso_date(F.col("r.effectiveDate")).alias("exchange_date"),
        exact_decimal(F.col("r.bid"), RATE_TYPE).alias("bid_price"),
        exact_decimal(F.col("r.ask"), RATE_TYPE).alias("ask_price"),
    )
    return with_spread(prices)


def with_spread(prices: DataFrame) -> DataFrame:
    return prices.withColumn("spread_value", spread(F.col("bid_price"), F.col("ask_price")))


def normalise_gold(quotes: DataFrame) -> DataFrame:
    """Gold quotes in the shape of a rate table, under the code of gold."""
    return quotes.select(
        F.lit(GOLD_CODE).alias("currency_code"),
        iso_date(F.col("data")).alias("exchange_date"),
        exact_decimal(F.col("cena"), GOLD_TYPE).alias("rate_value"),
    )


def sample_rates(entries: DataFrame, code: str | Column) -> DataFrame:
    """Recent observations of one currency as floats, for a quick look."""
    return entries.select(
        (F.lit(code) if isinstance(code, str) else code).alias("currency"),
        iso_date(F.col("effectiveDate")).alias("date"),
        F.col("mid").cast("float").alias("rate"),
    )


def type_bars(
    rows: DataFrame, layout: BarLayout = API_BARS, price: T.DecimalType = PRICE_TYPE
) -> DataFrame:
    """Bar columns by name, as the types of the fact table."""
    return rows.select(
        F.col(layout.ticker).alias("ticker"),
        iso_date(F.col(layout.date)).alias("trade_date"),
        *(
            exact_decimal(F.col(column), price).alias(f"{field}_price")
            for field, column in (
                ("open", layout.open),
                ("high", layout.high),
                ("low", layout.low),
                ("close", layout.close),
            )
        ),
        whole_number(F.col(layout.volume), rows.schema[layout.volume].dataType).alias("volume"),
    )


def valid_bars(bars: DataFrame) -> DataFrame:
    """Bars with a ticker, a date and a positive close. The test sees the typed close:
    a price that rounds to zero is dropped, so pass a finer type to keep it."""
    return bars.filter(
        (F.col("close_price") > 0)
        & F.col("ticker").isNotNull()
        & F.col("trade_date").isNotNull()
    )


def clean_bars(
    rows: DataFrame, layout: BarLayout = API_BARS, price: T.DecimalType = PRICE_TYPE
) -> DataFrame:
    """Typed, valid bars. Header lines repeated inside a file have no readable date
    and go with the invalid rows."""
    return valid_bars(type_bars(rows, layout, price))


# Names of a vendor bar and of a fact column.
API_TO_FACT = {
    "symbol": "ticker",
    "date": "trade_date",
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
}


def rename_bars(bars: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    return bars.withColumnsRenamed(dict(API_TO_FACT if names is None else names))


def wide_to_long(
    wide: DataFrame,
    index: Sequence[str],
    series: Mapping[str, Mapping[str, str]],
    name: str = "ticker",
) -> DataFrame:
    """Rows of (index, series, fields) from one column per (series, field).

    ``series`` maps each series to ``{field: wide column}``. A field that a series
    lacks is NULL; a row whose fields are all NULL is dropped.
    """
    fields = list(dict.fromkeys(f for columns in series.values() for f in columns))
    kinds = {
        field: next(wide.schema[c[field]].dataType for c in series.values() if field in c)
        for field in fields
    }
    cells = F.array(
        *(
            F.struct(
                F.lit(label).alias(name),
                *(
                    (F.col(columns[f]) if f in columns else F.lit(None)).cast(kinds[f]).alias(f)
                    for f in fields
                ),
            )
            for label, columns in series.items()
        )
    )
    long = wide.select(*index, F.inline(cells))
    return drop_empty(long, fields)


def drop_empty(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Drop rows in which every one of ``values`` is NULL (or NaN)."""
    return df.dropna(how="all", subset=list(values))


def with_group(bars: DataFrame, instruments: DataFrame) -> DataFrame:
    """Bars with the group of their ticker."""
    return lookup_join(bars, instruments, "ticker")


def union_by_name(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by column name, missing columns as NULL."""
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole
