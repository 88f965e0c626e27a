"""Freshness, gates and audits: what is there, what is missing, whether to load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_after
from tidemark.operators.silver import union_by_name

# Hour from which the bars of the running day are complete.
CLOSING_HOUR = 22


def latest_date(source: DataFrame, date_column: str) -> DataFrame:
    """One row, ``latest_date``: the newest date of a landed source."""
    return source.agg(F.max(date_column).cast("date").alias("latest_date"))


def freshness(sources: Mapping[str, tuple[DataFrame, str]], as_of: date) -> DataFrame:
    """(dataset, latest_date, status): AVAILABLE when the data of ``as_of`` is in."""
    latest = union_by_name(
        *(
            latest_date(df, column).select(F.lit(name).alias("dataset"), "latest_date")
            for name, (df, column) in sources.items()
        )
    )
    there = F.col("latest_date") == F.lit(as_of)
    return latest.withColumn("status", F.when(there, "AVAILABLE").otherwise("NOT YET"))


def load_gate(source: DataFrame, least: DataFrame) -> DataFrame:
    """One row: load only if the source is newer than the least watermark.

    ``source`` holds ``latest_date`` and ``least`` holds ``watermark``, one row each.
    """
    both = source.select("latest_date").withColumn(
        "watermark", least.select("watermark").scalar()
    )
    newer = F.coalesce(F.col("latest_date") > F.col("watermark"), F.lit(False))
    return both.withColumn("needs_load", newer)


def session_gate(mark: DataFrame, as_of: Sequence[datetime]) -> DataFrame:
    """(as_of, start_date, status) for each moment: UP_TO_DATE when nothing is missing,
    WAIT while the only missing session still runs, else RUN."""
    moments = mark.select(
        F.explode(F.array(*(_moment(m) for m in as_of))).alias("as_of"),
        days_after(F.col("watermark"), 1).alias("start_date"),
    )
    today = F.to_date("as_of")
    status = (
        F.when(F.col("start_date") > today, "UP_TO_DATE")
        .when(
            (F.col("start_date") == today) & (F.hour("as_of") < CLOSING_HOUR),
            "WAIT",
        )
        .otherwise("RUN")
    )
    return moments.withColumn("status", status)


def closed_sessions(bars: DataFrame, column: str, as_of: datetime) -> DataFrame:
    """Drop the rows of the running day (and later) until its session has closed."""
    if as_of.hour >= CLOSING_HOUR:
        return bars
    return bars.filter(F.col(column) < F.lit(as_of.date()))


def _moment(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def load_audit(datasets: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dataset, n_rows, min_date, max_date, status), one row per dataset."""
    audit = union_by_name(
        *(
            df.agg(
                F.count("*").alias("n_rows"),
                F.min(column).cast("date").alias("min_date"),
                F.max(column).cast("date").alias("max_date"),
            ).select(F.lit(name).alias("dataset"), "n_rows", "min_date", "max_date")
            for name, (df, column) in datasets.items()
        )
    )
    return audit.withColumn("status", F.when(F.col("n_rows") > 0, "LOADED").otherwise("EMPTY"))


def rows_per_key(facts: DataFrame, key: str) -> DataFrame:
    return facts.groupBy(key).agg(F.count("*").alias("n_rows"))


def top_keys(facts: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with most rows; ties go to the key that sorts first."""
    return rows_per_key(facts, key).orderBy(F.desc("n_rows"), F.asc(key)).limit(n)


def preview(facts: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return facts.orderBy(*order).limit(n)
