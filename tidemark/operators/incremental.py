"""High watermarks (the newest stored date) and what is newer than them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_after, or_default
from tidemark.operators.dedup import one_per_key
from tidemark.operators.scale import lookup_join
from tidemark.operators.silver import union_by_name
from tidemark.session import settle

RATES_START = date(2020, 1, 1)
BARS_START = date(2024, 1, 1)
PROXY_START = date(2025, 1, 1)


def watermark(facts: DataFrame, date_column: str, default: date = RATES_START) -> DataFrame:
    """One row, ``watermark``: the newest date, or the default for an empty table."""
    return facts.agg(or_default(F.max(date_column), default).alias("watermark"))


def watermark_per_key(facts: DataFrame, key: str, date_column: str) -> DataFrame:
    """(key, watermark). Each map task sends one row per key it saw."""
    return facts.groupBy(key).agg(F.max(date_column).alias("watermark"))


def proxy_watermark(
    facts: DataFrame, key: str, value: object, date_column: str, default: date = PROXY_START
) -> DataFrame:
    """The watermark of one key that stands for the whole table."""
    return watermark(facts.filter(F.col(key) == value), date_column, default)


def least_watermark(watermarks: Mapping[str, DataFrame]) -> DataFrame:
    """One row, ``watermark``: the least of several one-row watermarks. Each must have
    its default already, since a NULL would be passed over."""
    return union_by_name(*watermarks.values()).agg(F.min("watermark").alias("watermark"))


def _after(batch: DataFrame, mark: DataFrame, date_column: str) -> DataFrame:
    """Rows dated after the day of the one-row ``mark``.

    The mark is a scalar subquery that yields the next day in the type of the column,
    so the comparison reaches the scan once the subquery has run.
    """
    kind = batch.schema[date_column].dataType
    next_day = mark.select(days_after(F.col("watermark"), 1).cast(kind))
    return batch.filter(F.col(date_column) >= next_day.scalar())


def newer_than_table(batch: DataFrame, mark: DataFrame, date_column: str) -> DataFrame:
    """Rows dated after the one-row ``mark``; the column may hold dates or timestamps."""
    return _after(batch, mark, date_column)


def newer_than_per_key(
    batch: DataFrame, marks: DataFrame, key: str, date_column: str, default: date = BARS_START
) -> DataFrame:
    """Rows dated after the watermark of their own key, or after the default for a key
    without one."""
    marks = settle(marks.select(key, F.col("watermark").alias("_mark")))
    # No row up to the least mark can pass, and that much is known to the scan.
    least = marks.agg(F.least(F.min("_mark"), F.lit(default)).alias("watermark"))
    mark = or_default(F.col("_mark"), default)
    candidates = lookup_join(_after(batch, least, date_column), marks, key)
    newer = candidates.filter(F.col(date_column) >= days_after(mark, 1))
    return newer.select(*batch.columns)


def unseen_rows(
    batch: DataFrame, facts: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``batch`` whose key the facts do not hold yet, one per key.

    Both sides are reduced to one row per key before they meet, so the join moves no
    repeated key.
    """
    held = facts.select(*keys).distinct()
    single = one_per_key(batch, keys, prefer)
    return single.join(held, list(keys), "left_anti").select(*batch.columns)


def appended(facts: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The facts after an idempotent append of ``batch``."""
    return union_by_name(facts, unseen_rows(batch, facts, keys))
