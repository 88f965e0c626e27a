"""Rates, spreads and gold: history rebuild, backfill, and the incremental load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import iso_date, or_default
from tidemark.operators.checks import latest_date, load_gate
from tidemark.operators.dedup import distinct_rows
from tidemark.operators.incremental import (
    RATES_START,
    least_watermark,
    newer_than_per_key,
    newer_than_table,
)
from tidemark.operators.planning import backfill_plan, closed_fetch_plan
from tidemark.operators.silver import (
    flatten_rates,
    flatten_spreads,
    normalise_gold,
    union_by_name,
)
from tidemark.plans.runs import run_isolated
from tidemark.schemas import (
    GOLD,
    GOLD_DOCUMENT,
    RATE_DOCUMENT,
    RATES,
    SPREAD_DOCUMENT,
    SPREADS,
    FactTable,
)
from tidemark.sources.bronze import (
    Paths,
    read_batch,
    read_documents,
    read_gold,
    read_rates,
    read_snapshot,
    read_spreads,
)
from tidemark.sources.landing import GOLD_KEY, manifest
from tidemark.sources.stores import FactStore, LoadResult, append_new
from tidemark.sources.universe import CURRENCIES, SPREAD_CURRENCIES, currencies


@dataclass(frozen=True)
class RatesLanding:
    """Landed documents of one run, all of them or those of a batch. ``codes`` are the
    currencies that a load has to bring up to date; without them, those that are stored."""

    rates: Paths
    spreads: Paths
    gold: Paths
    snapshot: Paths | None = None
    batch: str | None = None
    codes: Sequence[str] | None = None

    def read(
        self, spark: SparkSession, paths: Paths, schema: T.StructType, prefix: str
    ) -> DataFrame:
        if self.batch is not None:
            return read_batch(spark, paths, schema, prefix, self.batch)
        return read_documents(spark, paths, schema)


def rebuild_rates(
    store: FactStore, paths: Paths, multiline: bool | None = None
) -> LoadResult:
    """The whole history from all landed documents, replacing the table."""
    history = flatten_rates(read_rates(store.spark, paths, multiline=multiline))
    return store.overwrite(distinct_rows(history), RATES)


def backfill_gold(store: FactStore, paths: Paths, multiline: bool | None = None) -> LoadResult:
    quotes = read_gold(store.spark, paths, multiline=multiline)
    return append_new(store, normalise_gold(quotes), GOLD)


def backfill_spreads(store: FactStore, paths: Paths, multiline: bool | None = None) -> LoadResult:
    documents = read_spreads(store.spark, paths, multiline=multiline)
    return append_new(store, flatten_spreads(documents), SPREADS)


def newer_rows(store: FactStore, batch: DataFrame, fact: FactTable, scope: str) -> DataFrame:
    """Rows past the watermark of their own key, or of the whole table.

    With one watermark for the table a currency that lags behind another loses rows.
    """
    if scope == "table":
        mark = store.watermark(fact, RATES_START)
        return newer_than_table(batch, mark, fact.date_column)
    if scope != "key":
        raise ValueError(f"scope is 'key' or 'table', not {scope!r}")
    marks = store.watermark_per_key(fact)
    return newer_than_per_key(batch, marks, fact.series, fact.date_column, RATES_START)


def least_mark(
    store: FactStore, fact: FactTable, scope: str, codes: Sequence[str] | None = None
) -> DataFrame:
    """One row, ``watermark``: how far the table is complete in the scope of the load. By
    key, the currency that lags most decides, and one without rows counts as the start."""
    if scope == "table":
        return store.watermark(fact, RATES_START)
    marks = store.watermark_per_key(fact)
    if codes is not None and fact is not GOLD:
        marks = currencies(store.spark, codes).join(
            marks.withColumnRenamed(fact.series, "currency_code"), "currency_code", "left"
        )
    return marks.agg(or_default(F.min(or_default(F.col("watermark"), RATES_START)), RATES_START).alias("watermark"))


def rates_need_load(store: FactStore, landing: RatesLanding, scope: str = "key") -> bool:
    """Whether the newest snapshot is newer than the least of the three watermarks, each
    taken in the scope of the load: what the load would bring must not be held back."""
    if landing.snapshot is None:
        return True
    snapshot = read_snapshot(store.spark, landing.snapshot).select(
        iso_date(F.col("effectiveDate")).alias("day")
    )
    marks = {f.name: least_mark(store, f, scope, landing.codes) for f in (RATES, SPREADS, GOLD)}
    return load_gate(latest_date(snapshot, "day"), least_watermark(marks)).first()["needs_load"]


def plan_rate_fetch(
    store: FactStore,
    source_date: date,
    rates: Sequence[str] = tuple(CURRENCIES),
    spreads: Sequence[str] = tuple(SPREAD_CURRENCIES),
) -> DataFrame:
    """(dataset, code, start_date, end_date): what to request of rates, spreads and gold up
    to the date of the source, the end included."""
    wanted = {RATES: rates, SPREADS: spreads, GOLD: ("XAU",)}
    return union_by_name(
        *(
            closed_fetch_plan(
                currencies(store.spark, codes),
                store.watermark_per_key(fact).select(F.col(fact.series).alias("currency_code"), "watermark"),
                "currency_code",
                source_date,
                RATES_START,
            ).select(F.lit(fact.name).alias("dataset"), F.col("currency_code").alias("code"), "start_date", "end_date")
            for fact, codes in wanted.items()
        )
    )


def _backfill(wanted: DataFrame, present: DataFrame, first_year: int, last_year: int) -> DataFrame:
    years = present.select(F.col("key").alias("currency_code"), F.col("period").try_cast("int").alias("year"))
    return backfill_plan(wanted, years, "currency_code", first_year, last_year)


def plan_rate_backfill(
    spark: SparkSession, codes: Sequence[str] | DataFrame, path: str, first_year: int, last_year: int
) -> DataFrame:
    """(currency_code, year, start_date, end_date) of the years that have not landed under
    ``path``, where the period of a document is its year. ``codes`` is a list, or a table
    with ``currency_code``."""
    wanted = codes if isinstance(codes, DataFrame) else currencies(spark, codes)
    return _backfill(wanted, manifest(spark, path), first_year, last_year)


def plan_gold_backfill(spark: SparkSession, path: str, first_year: int, last_year: int) -> DataFrame:
    """``plan_rate_backfill`` of gold, whose documents name no code."""
    return _backfill(currencies(spark, [GOLD_KEY]), manifest(spark, path), first_year, last_year)


def load_rates(store: FactStore, landing: RatesLanding, scope: str = "key") -> list[LoadResult]:
    """The incremental load of all three tables, each on its own. A batch of which nothing
    has landed is a failure, not an empty load."""
    read = partial(landing.read, store.spark)
    batches: dict[FactTable, Callable[[], DataFrame]] = {
        RATES: lambda: flatten_rates(read(landing.rates, RATE_DOCUMENT, "rate_*_")),
        SPREADS: lambda: flatten_spreads(read(landing.spreads, SPREAD_DOCUMENT, "spread_*_")),
        GOLD: lambda: normalise_gold(read(landing.gold, GOLD_DOCUMENT, "gold_")),
    }
    if not rates_need_load(store, landing, scope):
        return [LoadResult(fact.name, "UP_TO_DATE") for fact in batches]

    def load(fact: FactTable, batch: Callable[[], DataFrame]) -> LoadResult:
        return append_new(store, newer_rows(store, batch(), fact, scope), fact)

    return run_isolated({fact.name: partial(load, fact, batch) for fact, batch in batches.items()})
