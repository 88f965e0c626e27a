"""Price bars: history rebuild, the incremental load, and what to fetch for it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators.checks import closed_sessions, session_gate
from tidemark.operators.incremental import BARS_START, PROXY_START, newer_than_per_key
from tidemark.operators.planning import PACKAGE_SIZE, fetch_plan
from tidemark.operators.silver import clean_bars
from tidemark.schemas import API_BARS, BARS, HISTORY_BARS, INCREMENT_BARS, PRICE_TYPE, BarLayout
from tidemark.sources.bronze import Paths, read_bars, read_mixed_bars
from tidemark.sources.stores import FactStore, LoadResult, append_new
from tidemark.sources.universe import scheduled

# Instrument whose last bar tells whether a session is complete.
PROXY_TICKER = "AAPL"


def rebuild_bars(
    store: FactStore, paths: Paths, layout: BarLayout | None = HISTORY_BARS
) -> LoadResult:
    """The whole history from bar files, replacing the table. Without a layout every
    file is read by its own header."""
    if layout is None:
        return store.overwrite(clean_bars(read_mixed_bars(store.spark, paths)), BARS)
    return store.overwrite(clean_bars(read_bars(store.spark, paths, layout), layout), BARS)


def bars_session(store: FactStore, as_of: datetime, proxy: str = PROXY_TICKER) -> DataFrame:
    """One row: UP_TO_DATE, WAIT or RUN, judged by the bars of one instrument."""
    mark = store.proxy_watermark(BARS, proxy, PROXY_START)
    return session_gate(mark, [as_of])


def new_bars(
    store: FactStore,
    rows: DataFrame,
    layout: BarLayout,
    as_of: datetime,
    price: T.DecimalType = PRICE_TYPE,
) -> DataFrame:
    """Valid bars of closed sessions, newer than the watermark of their ticker."""
    bars = closed_sessions(clean_bars(rows, layout, price), "trade_date", as_of)
    marks = store.watermark_per_key(BARS)
    return newer_than_per_key(bars, marks, "ticker", "trade_date", BARS_START)


def load_bars(
    store: FactStore, rows: DataFrame, as_of: datetime, layout: BarLayout = API_BARS
) -> LoadResult:
    """The incremental load of bars in any layout."""
    return append_new(store, new_bars(store, rows, layout, as_of), BARS)


def load_bar_files(
    store: FactStore,
    paths: Paths,
    as_of: datetime,
    layout: BarLayout = INCREMENT_BARS,
    proxy: str | None = PROXY_TICKER,
) -> LoadResult:
    """``load_bars`` of landed files, once the session gate says RUN."""
    if proxy is not None:
        status = bars_session(store, as_of, proxy).first()["status"]
        if status != "RUN":
            return LoadResult(BARS.name, status)
    return load_bars(store, read_bars(store.spark, paths, layout), as_of, layout)


def plan_bar_fetch(
    store: FactStore,
    as_of: date,
    universe: DataFrame | None = None,
    size: int = PACKAGE_SIZE,
) -> DataFrame:
    """Packages of the scheduled universe that lag, with the range to request. Packages
    follow the column ``position``; a universe without one is taken by ticker."""
    known = scheduled(store.spark) if universe is None else universe
    placed = [c for c in ("position", "ticker") if c in known.columns]
    return fetch_plan(
        known.select(*placed),
        store.watermark_per_key(BARS),
        "ticker",
        as_of,
        order=placed,
        size=size,
    )
