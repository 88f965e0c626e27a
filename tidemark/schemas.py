"""Bronze document shapes and silver fact tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RATE_TYPE = T.DecimalType(10, 4)
SPREAD_TYPE = T.DecimalType(11, 4)
GOLD_TYPE = T.DecimalType(10, 2)
PRICE_TYPE = T.DecimalType(12, 2)
FINE_PRICE_TYPE = T.DecimalType(14, 4)

GOLD_CODE = "XAU"


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Bronze. Numbers are read as double whatever else is in the same scan; fields
# the facts do not use are left out, which is the only way to prune nested JSON.
RATE_DOCUMENT = _fields(
    code=T.StringType(),
    rates=T.ArrayType(_fields(effectiveDate=T.StringType(), mid=T.DoubleType())),
)
SPREAD_DOCUMENT = _fields(
    code=T.StringType(),
    rates=T.ArrayType(
        _fields(effectiveDate=T.StringType(), bid=T.DoubleType(), ask=T.DoubleType())
    ),
)
GOLD_DOCUMENT = _fields(data=T.StringType(), cena=T.DoubleType())
TABLE_SNAPSHOT = _fields(effectiveDate=T.StringType())
RATE_ENTRY = _fields(effectiveDate=T.StringType(), mid=T.DoubleType())
API_BAR = _fields(
    symbol=T.StringType(),
    date=T.DateType(),
    open=T.DoubleType(),
    high=T.DoubleType(),
    low=T.DoubleType(),
    close=T.DoubleType(),
    volume=T.DoubleType(),
)


@dataclass(frozen=True)
class BarLayout:
    """Which column of a landed bar file holds which bar field."""

    columns: tuple[str, ...]
    ticker: str
    date: str
    open: str = "Open"
    high: str = "High"
    low: str = "Low"
    close: str = "Close"
    volume: str = "Volume"

    @property
    def schema(self) -> T.StructType:
        return _fields(**{name: T.StringType() for name in self.columns})

    @property
    def needed(self) -> tuple[str, ...]:
        return (self.ticker, self.date, self.open, self.high, self.low, self.close, self.volume)


# In the history files the date column carries the header "Price".
HISTORY_BARS = BarLayout(
    columns=("Price", "Close", "High", "Low", "Open", "Volume", "Ticker"),
    ticker="Ticker",
    date="Price",
)
INCREMENT_BARS = BarLayout(
    columns=("Date", "Open", "High", "Low", "Close", "Volume", "ticker", "group_name"),
    ticker="ticker",
    date="Date",
)
API_BARS = BarLayout(
    columns=("symbol", "date", "open", "high", "low", "close", "volume"),
    ticker="symbol",
    date="date",
    open="open",
    high="high",
    low="low",
    close="close",
    volume="volume",
)


@dataclass(frozen=True)
class FactTable:
    """A silver table: its columns, its key, and the date it is partitioned by."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    date_column: str

    @property
    def series(self) -> str:
        """The key column that names the instrument."""
        return self.keys[0]

    @property
    def partition_column(self) -> str:
        return f"{self.date_column}_year"


RATES = FactTable(
    "f_currency_rates",
    _fields(currency_code=T.StringType(), exchange_date=T.DateType(), rate_value=RATE_TYPE),
    ("currency_code", "exchange_date"),
    "exchange_date",
)
SPREADS = FactTable(
    "f_currency_spreads",
    _fields(
        currency_code=T.StringType(),
        exchange_date=T.DateType(),
        bid_price=RATE_TYPE,
        ask_price=RATE_TYPE,
        spread_value=SPREAD_TYPE,
    ),
    ("currency_code", "exchange_date"),
    "exchange_date",
)
GOLD = FactTable(
    "f_gold_prices",
    _fields(currency_code=T.StringType(), exchange_date=T.DateType(), rate_value=GOLD_TYPE),
    ("currency_code", "exchange_date"),
    "exchange_date",
)
BARS = FactTable(
    "f_stock_prices",
    _fields(
        ticker=T.StringType(),
        trade_date=T.DateType(),
        open_price=PRICE_TYPE,
        high_price=PRICE_TYPE,
        low_price=PRICE_TYPE,
        close_price=PRICE_TYPE,
        volume=T.LongType(),
    ),
    ("ticker", "trade_date"),
    "trade_date",
)
RATE_SAMPLE = FactTable(
    "test_nbp_rates",
    _fields(currency=T.StringType(), date=T.DateType(), rate=T.FloatType()),
    ("currency", "date"),
    "date",
)
