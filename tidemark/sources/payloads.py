"""Single API answers already on the driver: a list of entries or a pandas frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.schemas import API_BAR, GOLD_DOCUMENT, RATE_DOCUMENT, RATE_ENTRY, SPREAD_DOCUMENT

if TYPE_CHECKING:
    import pandas as pd


def _double(value: Any) -> float | None:
    return None if value is None else float(value)


def _entries(rows: Iterable[Mapping[str, Any]], numbers: tuple[str, ...], day: str) -> list[dict]:
    # A JSON integer is a Python int, which a double column would refuse.
    return [{day: r[day], **{n: _double(r.get(n)) for n in numbers}} for r in rows]


def rate_entries(spark: SparkSession, payload: Mapping[str, Any]) -> DataFrame:
    """(effectiveDate, mid) rows of one rate answer."""
    return spark.createDataFrame(_entries(payload["rates"], ("mid",), "effectiveDate"), RATE_ENTRY)


def rate_document(spark: SparkSession, payload: Mapping[str, Any]) -> DataFrame:
    rates = _entries(payload["rates"], ("mid",), "effectiveDate")
    return spark.createDataFrame([{"code": payload["code"], "rates": rates}], RATE_DOCUMENT)


def spread_document(spark: SparkSession, payload: Mapping[str, Any]) -> DataFrame:
    rates = _entries(payload["rates"], ("bid", "ask"), "effectiveDate")
    return spark.createDataFrame([{"code": payload["code"], "rates": rates}], SPREAD_DOCUMENT)


def gold_quotes(spark: SparkSession, payload: Iterable[Mapping[str, Any]]) -> DataFrame:
    return spark.createDataFrame(_entries(payload, ("cena",), "data"), GOLD_DOCUMENT)


def bars_from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    """Vendor bars of a pandas frame; other columns of the frame are left behind."""
    names = API_BAR.fieldNames()
    typed = frame[names].astype({n: "float64" for n in names[2:]})
    return spark.createDataFrame(typed, API_BAR)
