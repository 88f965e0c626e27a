"""The incremental loads as available-now streams over the landing folders.

The stream's checkpoint remembers which files were read, so a run picks up just the
new ones. A batch that is replayed after a failure adds nothing, because keys that the
table holds are skipped, or compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.silver import clean_bars, flatten_rates, flatten_spreads, normalise_gold
from tidemark.schemas import (
    GOLD_DOCUMENT,
    HISTORY_BARS,
    RATE_DOCUMENT,
    SPREAD_DOCUMENT,
    BarLayout,
    FactTable,
)
from tidemark.sources.bronze import json_options
from tidemark.sources.stores import FactStore, LoadResult, append_new, upsert_greatest

Transform = Callable[[DataFrame], DataFrame]


def _reader(spark: SparkSession, files: int | None):
    """``files`` bounds a micro-batch; without it, one takes whatever has landed."""
    return spark.readStream.option("maxFilesPerTrigger", files) if files else spark.readStream


def _json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    only: str | None,
    multiline: bool,
    files: int | None,
) -> DataFrame:
    """A stream reads files of one form. Documents over several lines in a stream of
    one a line are an error; the other way round all but the first would be lost, so that
    form has to be asked for."""
    return json_options(_reader(spark, files), schema, only, multiline).json(path)


def rate_stream(
    spark: SparkSession,
    path: str,
    only: str | None = None,
    multiline: bool = False,
    files: int | None = None,
) -> DataFrame:
    return flatten_rates(_json_stream(spark, path, RATE_DOCUMENT, only, multiline, files))


def spread_stream(
    spark: SparkSession,
    path: str,
    only: str | None = None,
    multiline: bool = False,
    files: int | None = None,
) -> DataFrame:
    return flatten_spreads(_json_stream(spark, path, SPREAD_DOCUMENT, only, multiline, files))


def gold_stream(
    spark: SparkSession,
    path: str,
    only: str | None = None,
    multiline: bool = False,
    files: int | None = None,
) -> DataFrame:
    return normalise_gold(_json_stream(spark, path, GOLD_DOCUMENT, only, multiline, files))


def bar_stream(
    spark: SparkSession,
    path: str,
    layout: BarLayout = HISTORY_BARS,
    files: int | None = None,
) -> DataFrame:
    rows = (
        _reader(spark, files)
        .schema(layout.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    return clean_bars(rows, layout)


def run_available(
    stream: DataFrame,
    store: FactStore,
    fact: FactTable,
    checkpoint: str,
    newer: Transform | None = None,
    survivor: str = "stored",
) -> list[LoadResult]:
    """Load everything that has landed since the last run, then stop.

    ``newer`` may drop rows at or before a watermark; it sees each batch after the
    earlier ones are stored. Of rows with one key the ``stored`` one stays, which depends
    on how the files were cut into batches, or the ``greatest`` under any cut.
    """
    results: list[LoadResult] = []
    store_rows = {"stored": append_new, "greatest": upsert_greatest}[survivor]

    def load(batch: DataFrame, _: int) -> None:
        rows = batch if newer is None else newer(batch)
        results.append(store_rows(store, rows, fact))

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return results
