"""What to fetch next: packages of instruments with a start date, and gaps in the
landed history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_after, or_default
from tidemark.operators.incremental import BARS_START
from tidemark.operators.scale import with_ordinal

PACKAGE_SIZE = 30


def chunk_keys(
    instruments: DataFrame, order: Sequence[str | Column], size: int = PACKAGE_SIZE
) -> DataFrame:
    """Instruments with ``chunk_id``: consecutive packages of ``size`` in ``order``."""
    placed = with_ordinal(instruments, order, "_place")
    return placed.withColumn("chunk_id", F.expr(f"_place div {int(size)}")).drop("_place")


def fetch_plan(
    instruments: DataFrame,
    marks: DataFrame,
    key: str,
    as_of: date,
    order: Sequence[str | Column] = (),
    size: int = PACKAGE_SIZE,
    default: date = BARS_START,
) -> DataFrame:
    """One row per package that lags: its keys, the day after its least watermark, and
    ``as_of``. The request covers [start_date, end_date)."""
    known = instruments.join(marks, key, "left").withColumn(
        "watermark", or_default(F.col("watermark"), default)
    )
    packages = chunk_keys(known, order or [key], size).groupBy("chunk_id")
    plan = packages.agg(
        F.count("*").alias("n_keys"),
        # At most ``size`` names per package.
        F.sort_array(F.collect_list(key)).alias("keys"),
        days_after(F.min("watermark"), 1).alias("start_date"),
    )
    return plan.withColumn("end_date", F.lit(as_of)).filter(F.col("start_date") < F.lit(as_of))


def closed_fetch_plan(
    known: DataFrame, marks: DataFrame, key: str, source_date: date, default: date
) -> DataFrame:
    """(key, start_date, end_date) for each key that lags behind its source: the day after
    its watermark, or after the default, to the date of the source. Both ends are asked
    for."""
    placed = known.select(key).distinct().join(marks.select(key, "watermark"), key, "left")
    start = days_after(or_default(F.col("watermark"), default), 1)
    plan = placed.select(key, start.alias("start_date"), F.lit(source_date).alias("end_date"))
    return plan.filter(F.col("start_date") <= F.col("end_date"))


def backfill_plan(
    instruments: DataFrame, landed: DataFrame, key: str, first_year: int, last_year: int
) -> DataFrame:
    """(key, year, start_date, end_date) for each year that has not landed. The range
    [start_date, end_date] is closed."""
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year")
    wanted = instruments.select(key).distinct().select(key, years)
    missing = wanted.join(landed.select(key, "year").distinct(), [key, "year"], "left_anti")
    return missing.select(
        key,
        "year",
        F.make_date("year", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("end_date"),
    )


def landed_years(facts: DataFrame, key: str, date_column: str) -> DataFrame:
    """(key, year) pairs that have at least one row."""
    return facts.select(key, F.year(date_column).alias("year")).distinct()


def in_range(
    facts: DataFrame, column: str, start: date, end: date, closed: bool = False
) -> DataFrame:
    """Rows dated in [start, end), or in [start, end] when closed. ``column`` is
    compared as it is stored, so the test reaches the scan for dates and timestamps."""
    after = F.col(column) >= F.lit(start)
    if not closed:
        return facts.filter(after & (F.col(column) < F.lit(end)))
    return facts.filter(after & (F.col(column) < F.date_add(F.lit(end), 1)))


def on_date(facts: DataFrame, column: str, day: date) -> DataFrame:
    return in_range(facts, column, day, day, closed=True)


def symbol_subset(facts: DataFrame, key: str, symbols: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the given symbols: a list is tested in the scan, a table by a semi join."""
    if isinstance(symbols, DataFrame):
        return facts.join(symbols.select(key), key, "left_semi")
    return facts.filter(F.col(key).isin(list(symbols)))
