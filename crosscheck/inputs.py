"""The given tables seen as rates, bars and documents.

An order is a rate: its priority is the currency, its total price the rate. A line
item is a bar: its supplier is the ticker, its extended price the close. Dates are
cast after filters, which therefore reach the scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exact_decimal, iso_date, iso_text, whole_number
from tidemark.operators.scale import lookup_side
from tidemark.schemas import PRICE_TYPE, RATE_DOCUMENT, RATE_TYPE
from tidemark.sources.bronze import parse_documents

# Last stored date of each currency. The fifth, 5-LOW, is not stored at all.
STORED_UNTIL = {
    "1-URGENT": date(1998, 1, 1),
    "2-HIGH": date(1999, 1, 1),
    "3-MEDIUM": date(2000, 1, 1),
    "4-NOT SPECIFIED": date(2001, 1, 1),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rates_of(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("currency_code"),
        iso_date(F.col("o_orderdate")).alias("exchange_date"),
        exact_decimal(F.col("o_totalprice"), RATE_TYPE).alias("rate_value"),
    )


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates_of(table(spark, sf_dir, "orders"))


def stored_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the rates that earlier loads have stored."""
    until: Column = F.lit(None).cast("date")
    for code, day in STORED_UNTIL.items():
        until = F.when(F.col("o_orderpriority") == code, F.lit(day)).otherwise(until)
    return rates_of(table(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= until))


def rate_documents(orders: DataFrame, spread: bool = False) -> DataFrame:
    """One JSON text per order: its rate on the day and, unchanged, on the next day. With
    ``spread`` two of three texts go over several lines.

    Documents stay one per order: one per currency would gather a fifth of all rows
    into a single text.
    """
    day = iso_date(F.col("o_orderdate"))
    entries = F.array(
        *(
            F.struct(
                iso_text(d).alias("effectiveDate"), F.col("o_totalprice").alias("mid")
            )
            for d in (day, F.date_add(day, 1))
        )
    )
    document = F.struct(F.col("o_orderpriority").alias("code"), entries.alias("rates"))
    text = F.to_json(document)
    if spread:
        text = F.when(F.col("o_orderkey") % 3 == 0, text).otherwise(F.to_json(document, {"pretty": "true"}))
    return orders.select(text.alias("document"))


def parsed_rates(documents: DataFrame) -> DataFrame:
    return parse_documents(documents, "document", RATE_DOCUMENT)


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per line item, with its bid and ask."""
    ask = F.col("l_extendedprice")
    entry = F.struct(
        iso_text(F.col("l_shipdate")).alias("effectiveDate"),
        (ask * (1 - F.col("l_discount"))).alias("bid"),
        ask.alias("ask"),
    )
    document = F.struct(
        F.col("l_suppkey").cast("string").alias("code"), F.array(entry).alias("rates")
    )
    return table(spark, sf_dir, "lineitem").select(F.to_json(document).alias("document"))


def gold_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        iso_text(F.col("o_orderdate")).alias("data"), F.col("o_totalprice").alias("cena")
    )


def bid_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ask is the list price of a line, bid the price after its discount."""
    ask = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("currency_code"),
        iso_date(F.col("l_shipdate")).alias("exchange_date"),
        exact_decimal(ask * (1 - F.col("l_discount")), RATE_TYPE).alias("bid_price"),
        exact_decimal(ask, RATE_TYPE).alias("ask_price"),
    )


def api_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the column names of a vendor's bars."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.col("l_shipdate").alias("date"),
        F.col("l_discount").alias("open"),
        F.col("l_extendedprice").alias("high"),
        F.col("l_tax").alias("low"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
    )


def text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars as text with flaws: where the discount is 0.1 the line is a
    repeated header, where the tax is 0.08 the ticker is missing, and a quantity of 1
    comes with a close that rounds to zero."""
    header = F.col("open") == 0.1
    bars = api_bars(spark, sf_dir)
    return bars.select(
        F.when(F.col("low") != 0.08, F.col("symbol")).alias("symbol"),
        F.when(header, "Date").otherwise(iso_text(F.col("date"))).alias("date"),
        F.col("open").cast("string").alias("open"),
        F.col("high").cast("string").alias("high"),
        F.col("low").cast("string").alias("low"),
        F.when(F.col("volume") == 1, "0.001")
        .otherwise(F.col("close").cast("string"))
        .alias("close"),
        F.col("volume").cast("string").alias("volume"),
    )


def bars_of(lineitem: DataFrame, volume: str = "l_quantity") -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"),
        iso_date(F.col("l_shipdate")).alias("trade_date"),
        exact_decimal(F.col("l_extendedprice"), PRICE_TYPE).alias("close_price"),
        whole_number(F.col(volume), lineitem.schema[volume].dataType).alias("volume"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_of(table(spark, sf_dir, "lineitem"))



def grouped_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with the name of their nation, the group."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("group_name")
    )
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.join(lookup_side(nations), "s_nationkey")
