"""The available-now streams give what the batch transforms give, once."""

from datetime import date

import pytest

from landing import HISTORY_HEADER, gold, put_json, put_text, rates_a, rates_c, rows_of
from tidemark import streaming
from tidemark.operators import silver
from tidemark.plans.rates import newer_rows
from tidemark.schemas import BARS, GOLD, HISTORY_BARS, RATES, SPREADS
from tidemark.sources import bronze
from tidemark.sources.stores import ParquetStore, append_new


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "warehouse"))


def test_stream_equals_batch_and_second_run_adds_nothing(spark, store, tmp_path):
    folder = put_json(tmp_path / "in", "usd.json", rates_a("USD", **{"2025-01-02": 4.1}))
    put_json(folder, "eur.json", rates_a("EUR", **{"2025-01-02": 4.2, "2025-01-03": 4.3}))
    checkpoint = str(tmp_path / "checkpoint")

    def run():
        stream = streaming.rate_stream(spark, folder, multiline=True)
        return sum(r.n_rows for r in streaming.run_available(stream, store, RATES, checkpoint))

    assert run() == 3
    batch = silver.flatten_rates(bronze.read_rates(spark, folder))
    assert rows_of(store.read(RATES)) == rows_of(batch)
    assert run() == 0
    put_json(folder, "gbp.json", rates_a("GBP", **{"2025-01-03": 5.0}))
    assert run() == 1
    assert store.read(RATES).count() == 4


def test_replayed_files_add_nothing(spark, store, tmp_path):
    folder = put_json(tmp_path / "in", "usd.json", rates_a("USD", **{"2025-01-02": 4.1}))
    for n in range(2):
        stream = streaming.rate_stream(spark, folder, multiline=True)
        results = streaming.run_available(stream, store, RATES, str(tmp_path / f"lost{n}"))
        assert sum(r.n_rows for r in results) == (1 if n == 0 else 0)


def test_stream_behind_a_watermark(spark, store, tmp_path):
    stored = spark.createDataFrame([("USD", date(2025, 1, 2), None)], RATES.schema)
    append_new(store, stored, RATES)
    days = {"2025-01-01": 4.0, "2025-01-03": 4.1}
    folder = put_json(tmp_path / "in", "usd.json", rates_a("USD", **days))
    streaming.run_available(
        streaming.rate_stream(spark, folder, multiline=True),
        store,
        RATES,
        str(tmp_path / "checkpoint"),
        newer=lambda batch: newer_rows(store, batch, RATES, "key"),
    )
    dates = [str(r.exchange_date) for r in store.read(RATES).orderBy("exchange_date").collect()]
    assert dates == ["2025-01-02", "2025-01-03"]


def test_the_other_streams(spark, store, tmp_path):
    mixed = put_json(tmp_path / "in", "spread_USD.json", rates_c("USD", **{"2025-01-02": (4, 4.1)}))
    put_json(mixed, "gold_1.json", gold(**{"2025-01-02": 345.5, "2025-01-03": 346}))
    bars = put_text(
        tmp_path / "bars", "a.csv", HISTORY_HEADER, "2025-01-02,1.5,2,1,1.25,70,AAPL",
        "2025-01-03,0,2,1,1.25,70,AAPL",
    )
    streams = {
        SPREADS: streaming.spread_stream(spark, mixed, only="spread_*.json", multiline=True),
        GOLD: streaming.gold_stream(spark, mixed, only="gold_*.json", multiline=True),
        BARS: streaming.bar_stream(spark, bars, HISTORY_BARS),
    }
    counts = {}
    for fact, stream in streams.items():
        results = streaming.run_available(stream, store, fact, str(tmp_path / fact.name))
        counts[fact.name] = sum(r.n_rows for r in results)
    assert counts == {"f_currency_spreads": 1, "f_gold_prices": 2, "f_stock_prices": 1}
