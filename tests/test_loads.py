"""Whole loads against Parquet stores: rebuild, incremental, idempotence, isolation."""

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landing import (
    HISTORY_HEADER,
    INCREMENT_HEADER,
    day,
    gold,
    put_json,
    put_text,
    rate,
    rates_a,
    rates_c,
    rows_of,
)
from tidemark.operators.silver import clean_bars, flatten_rates
from tidemark.plans import bars as bar_plans
from tidemark.plans import rates as rate_plans
from tidemark.plans.runs import LoadFailed, raise_failures, run_isolated
from tidemark.schemas import BARS, FINE_PRICE_TYPE, GOLD, RATE_SAMPLE, RATES, SPREADS
from tidemark.sources.bronze import read_rates
from tidemark.sources.stores import LoadResult, ParquetStore, append_new, audit_frame


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "warehouse"))


def rate_rows(spark, *rows):
    return spark.createDataFrame([rate(*r) for r in rows], RATES.schema)


def bar_rows(spark, *rows):
    """(ticker, date, close, volume) as vendor bars."""
    return spark.createDataFrame(
        [(t, d, c, c, c, c, v) for t, d, c, v in rows],
        "symbol string, date string, open double, high double, low double, close double, "
        "volume double",
    )


def test_rebuild_joins_folders_and_drops_repeated_rows(spark, store, tmp_path):
    older = put_json(tmp_path / "pre", "USD.json", rates_a("USD", **{"2024-12-31": 4.1}))
    put_json(tmp_path / "pre", "USD_again.json", rates_a("USD", **{"2024-12-31": 4.1}))
    newer = put_json(tmp_path / "now", "USD.json", rates_a("USD", **{"2025-01-02": 4.2}))
    for _ in range(2):
        result = rate_plans.rebuild_rates(store, [older, newer])
        assert result == LoadResult(
            "f_currency_rates", "LOADED", 2, day("2024-12-31"), day("2025-01-02")
        )
    assert store.read(RATES).schema == RATES.schema
    assert rows_of(store.read(RATES)) == [
        rate("USD", "2024-12-31", "4.1000"),
        rate("USD", "2025-01-02", "4.2000"),
    ]


def test_missing_table_reads_as_empty_and_gives_the_default(store):
    assert store.read(RATES).isEmpty()
    assert store.read(RATES).schema == RATES.schema
    assert store.watermark(RATES).first()[0] == date(2020, 1, 1)


def test_h8_append_new_twice_adds_nothing(spark, store):
    batch = rate_rows(spark, ("USD", "2025-01-02", "4.1"), ("EUR", "2024-12-31", "4.2"))
    assert append_new(store, batch, RATES).n_rows == 2
    again = append_new(store, batch, RATES)
    assert (again.status, again.n_rows) == ("EMPTY", 0)
    assert store.read(RATES).count() == 2


def test_append_new_keeps_old_rows_out_of_a_batch_that_spans_years(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2023-06-01", "4.0")), RATES)
    batch = rate_rows(
        spark,
        ("USD", "2022-12-30", "1.0"),
        ("USD", "2023-06-01", "2.0"),
        ("USD", "2024-01-02", "3.0"),
        ("USD", "2024-01-02", "3.5"),
    )
    assert append_new(store, batch, RATES).n_rows == 2
    assert rows_of(store.read(RATES)) == [
        rate("USD", "2022-12-30", "1.0000"),
        rate("USD", "2023-06-01", "4.0000"),
        rate("USD", "2024-01-02", "3.5000"),
    ]


def test_rows_without_a_key_are_not_appended(spark, store):
    batch = spark.createDataFrame(
        [("USD", None, Decimal("1")), (None, day("2025-01-02"), Decimal("1"))], RATES.schema
    )
    assert append_new(store, batch, RATES).status == "EMPTY"


def test_read_with_dates_prunes_year_partitions(spark, store):
    rows = [("USD", f"{y}-06-01", "1") for y in range(2019, 2025)]
    append_new(store, rate_rows(spark, *rows), RATES)
    part = store.read(RATES, since=day("2021-01-01"), until=day("2022-12-31"))
    assert [r.exchange_date.year for r in part.orderBy("exchange_date").collect()] == [2021, 2022]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "exchange_date_year" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(exchange_date" in plan


def test_table_watermark_reads_dates_of_the_newest_year_only(spark, store):
    rows = [("USD", f"{y}-06-01", "1") for y in range(2019, 2025)]
    append_new(store, rate_rows(spark, *rows), RATES)
    mark = store.watermark(RATES)
    assert mark.first()[0] == day("2024-06-01")
    scans = re.findall(
        r"PartitionFilters: \[(.*?)\], PushedFilters: .*?ReadSchema: struct<(.*?)>",
        mark._jdf.queryExecution().executedPlan().toString(),
    )
    for filters, columns in scans:
        assert ("Subquery" in filters) is (columns == "exchange_date:date")
    assert {columns for _, columns in scans} == {"exchange_date:date", ""}


def test_h10_a_load_scans_its_batch_once(spark, store):
    seen = spark.sparkContext.accumulator(0)
    batch = rate_rows(spark, *(("USD", f"2025-01-{n:02d}", "1") for n in range(1, 11)))

    def counting(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    counted = batch.mapInPandas(counting, batch.schema)
    assert append_new(store, counted, RATES).n_rows == 10
    assert seen.value == 10


def test_h12_finer_prices_are_cast_to_the_table(spark, store):
    rows = clean_bars(bar_rows(spark, ("A", "2025-01-02", 1.2345, 5.0)), price=FINE_PRICE_TYPE)
    append_new(store, rows, BARS)
    assert store.read(BARS).schema == BARS.schema
    assert store.read(BARS).first()["close_price"] == Decimal("1.23")


def test_sample_table(spark, store):
    rows = spark.createDataFrame([("EUR", day("2025-01-02"), 4.25)], RATE_SAMPLE.schema)
    for _ in range(2):
        assert store.overwrite(rows, RATE_SAMPLE).n_rows == 1
    assert store.read(RATE_SAMPLE).collect() == rows.collect()


# Rates


def rates_landing(tmp_path, end, **kwargs):
    put_json(tmp_path / "in", f"rate_USD_{end}.json", rates_a("USD", **{end: 4.1}))
    put_json(tmp_path / "in", f"spread_USD_{end}.json", rates_c("USD", **{end: (4.0, 4.2)}))
    put_json(tmp_path / "in", f"gold_{end}.json", gold(**{end: 345.5}))
    put_json(tmp_path / "snap", "a.json", [{"effectiveDate": end}])
    folder = str(tmp_path / "in")
    return rate_plans.RatesLanding(
        folder, folder, folder, snapshot=str(tmp_path / "snap"), batch=end, **kwargs
    )


def test_incremental_rates_then_up_to_date(spark, store, tmp_path):
    landing = rates_landing(tmp_path, "2025-01-02")
    first = rate_plans.load_rates(store, landing)
    assert [(r.dataset, r.status, r.n_rows) for r in first] == [
        ("f_currency_rates", "LOADED", 1),
        ("f_currency_spreads", "LOADED", 1),
        ("f_gold_prices", "LOADED", 1),
    ]
    assert {r.status for r in rate_plans.load_rates(store, landing)} == {"UP_TO_DATE"}
    second = rate_plans.load_rates(store, rates_landing(tmp_path, "2025-01-03"), scope="table")
    assert [r.n_rows for r in second] == [1, 1, 1]
    assert store.read(RATES).count() == store.read(GOLD).count() == 2
    assert str(store.read(SPREADS).first()["spread_value"]) == "0.2000"
    assert audit_frame(spark, first + second).count() == 6


@pytest.mark.parametrize("scope, expected", [("key", 2), ("table", 0)])
def test_h6_lagging_currency(spark, store, tmp_path, scope, expected):
    append_new(
        store, rate_rows(spark, ("USD", "2025-01-03", "4"), ("EUR", "2025-01-01", "4")), RATES
    )
    for code in ("USD", "EUR"):
        days = {f"2025-01-0{n}": 4.5 for n in (1, 2, 3)}
        put_json(tmp_path / "in", f"{code}.json", rates_a(code, **days))
    batch = flatten_rates(read_rates(spark, str(tmp_path / "in")))
    newer = rate_plans.newer_rows(store, batch, RATES, scope)
    assert append_new(store, newer, RATES).n_rows == expected


def test_watermark_never_decreases(spark, store, tmp_path):
    marks = []
    for end in ("2025-01-03", "2025-01-02", "2025-01-06"):
        folder = put_json(tmp_path / end, "a.json", rates_a("USD", **{end: 4.1}))
        batch = flatten_rates(read_rates(spark, folder))
        append_new(store, rate_plans.newer_rows(store, batch, RATES, "key"), RATES)
        marks.append(store.watermark(RATES).first()[0])
    assert marks == sorted(marks) and store.read(RATES).count() == 2


def test_unknown_scope(spark, store):
    with pytest.raises(ValueError, match="scope"):
        rate_plans.newer_rows(store, rate_rows(spark), RATES, "none")


def test_backfills_are_idempotent(store, tmp_path):
    metal = put_json(tmp_path / "g", "gold_2024.json", gold(**{"2024-01-02": 260.1}))
    quotes = put_json(tmp_path / "s", "a.json", rates_c("USD", **{"2024-01-02": (3.9, 4.0)}))
    for expected in (1, 0):
        assert rate_plans.backfill_gold(store, metal).n_rows == expected
        assert rate_plans.backfill_spreads(store, quotes).n_rows == expected


def test_h11_one_broken_dataset_does_not_stop_the_others(store, tmp_path):
    landing = rates_landing(tmp_path, "2025-01-02")
    put_text(tmp_path / "in", "spread_USD_2025-01-02.json", '{"code": ')
    results = rate_plans.load_rates(store, landing)
    assert [r.status for r in results] == ["LOADED", "FAILED", "LOADED"]
    with pytest.raises(LoadFailed, match="f_currency_spreads"):
        raise_failures(results)


def test_isolation_reports_the_error():
    def broken():
        raise OSError("no disk")

    results = run_isolated({"a": lambda: LoadResult("a", "LOADED", 1), "b": broken})
    assert [(r.dataset, r.status, r.error) for r in results] == [
        ("a", "LOADED", None),
        ("b", "FAILED", "no disk"),
    ]
    assert raise_failures(results[:1]) == results[:1]


# Bars


def test_history_and_increment_of_bars(spark, store, tmp_path):
    history = put_text(
        tmp_path / "h",
        "AAPL.csv",
        HISTORY_HEADER,
        "Ticker,AAPL,AAPL,AAPL,AAPL,AAPL,",
        "2025-01-02,243.85,249.1,241.82,248.93,55740700,AAPL",
    )
    assert bar_plans.rebuild_bars(store, history).n_rows == 1
    assert bar_plans.rebuild_bars(store, history, layout=None).n_rows == 1
    increment = put_text(
        tmp_path / "i",
        "AAPL.csv",
        INCREMENT_HEADER,
        "2025-01-02,1,1,1,1,1,AAPL,USA",
        "2025-01-03,2,2,2,2,2,AAPL,USA",
        "2025-01-06,3,3,3,3,3,AAPL,USA",
    )
    early = datetime(2025, 1, 2, 23, 0)
    assert bar_plans.load_bar_files(store, increment, early).status == "UP_TO_DATE"
    running = datetime(2025, 1, 6, 15, 0)
    assert bar_plans.load_bar_files(store, increment, running).max_date == day("2025-01-03")
    closed = datetime(2025, 1, 6, 22, 0)
    assert bar_plans.load_bar_files(store, increment, closed).n_rows == 1
    assert [str(r.close_price) for r in store.read(BARS).orderBy("trade_date").collect()] == [
        "243.85",
        "2.00",
        "3.00",
    ]


def test_h7_ticker_ahead_of_its_package_is_not_loaded_twice(spark, store):
    now = datetime(2025, 1, 10, 23, 0)
    ahead = bar_rows(spark, *(("A", f"2025-01-0{n}", 1.0, 1.0) for n in (2, 3, 6)))
    behind = bar_rows(spark, ("B", "2025-01-02", 1.0, 1.0))
    bar_plans.load_bars(store, ahead.union(behind), now)
    # The package starts at the least watermark, so A comes again from the 3rd.
    package = bar_rows(
        spark, *((t, f"2025-01-0{n}", 2.0, 2.0) for t in "AB" for n in (3, 6, 7))
    )
    assert bar_plans.load_bars(store, package.union(package), now).n_rows == 4
    per_key = store.read(BARS).groupBy("ticker", "trade_date").count()
    assert per_key.filter("count > 1").isEmpty() and per_key.count() == 8


def test_fetch_plan_of_the_scheduled_universe(spark, store):
    now = datetime(2025, 1, 10, 23, 0)
    bar_plans.load_bars(store, bar_rows(spark, ("AAPL", "2025-01-09", 1.0, 1.0)), now)
    plan = bar_plans.plan_bar_fetch(store, now.date()).orderBy("chunk_id").collect()
    assert [r.n_keys for r in plan] == [30, 30, 30, 30, 6]
    assert {str(r.start_date) for r in plan} == {"2024-01-02"}
    assert plan[0]["keys"][:3] == ["11B.WA", "AAPL", "ABBV"]


def test_rows_on_a_date_reach_the_scan(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2025-01-02", "4"), ("USD", "2025-01-03", "4")), RATES)
    rows = store.read(RATES, day("2025-01-03"), day("2025-01-03"))
    assert rows.count() == 1
    chosen = store.read(RATES).filter(F.expr("exchange_date = '2025-01-02'"))
    assert chosen.count() == 1


def test_rejects_are_counted(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "facts"))
    rows = [("EUR", "2025-01-02", 4.0), ("EUR", "2025-01-03", 1e9), ("EUR", "no date", 4.0), (None, "2025-01-02", 4.0), ("USD", "2025-01-02", None)]
    batch = spark.createDataFrame(rows, "currency_code string, exchange_date string, rate_value double")
    for stored in (3, 0):
        result = append_new(store, batch, RATES)
        assert (result.n_rows, result.n_no_key, result.n_misfit) == (stored, 2, 1)
    audit = audit_frame(spark, [result]).first()
    assert (audit.n_no_key, audit.n_misfit) == (2, 1)


def test_the_gate_follows_the_currency_that_lags(spark, tmp_path):
    store = ParquetStore(spark, str(tmp_path / "facts"))
    mid = [("EUR", "2025-01-01", 4.0), ("USD", "2025-01-03", 4.0)]
    append_new(store, spark.createDataFrame(mid, "currency_code string, exchange_date string, rate_value double"), RATES)
    table_gate = rate_plans.least_mark(store, RATES, "table").first().watermark
    key_gate = rate_plans.least_mark(store, RATES, "key").first().watermark
    assert (str(table_gate), str(key_gate)) == ("2025-01-03", "2025-01-01")
    assert str(rate_plans.least_mark(store, RATES, "key", ["EUR", "CHF"]).first().watermark) == "2020-01-01"


def files_of(df):
    return [f for f in df.inputFiles() if "_marks" not in f]


def test_marks_are_kept_and_no_fact_file_is_read_for_them(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1"), ("EUR", "2023-01-01", "2")), RATES)
    for step in range(3):
        marks = store.watermark_per_key(RATES)
        assert marks.inputFiles() and not files_of(marks)
        assert not files_of(store.proxy_watermark(RATES, "USD", date(2020, 1, 1)))
        plain = store.read(RATES).groupBy("currency_code").agg(F.max("exchange_date"))
        assert rows_of(marks) == rows_of(plain)
        assert store.proxy_watermark(RATES, "USD", date(2020, 1, 1)).first()[0] == day(f"202{4 + step}-06-01")
        append_new(store, rate_rows(spark, ("USD", f"202{5 + step}-06-01", "1"), (f"N{step}", "2022-01-01", "2")), RATES)
    store.overwrite(rate_rows(spark, ("CHF", "2021-01-01", "1")), RATES)
    assert rows_of(store.watermark_per_key(RATES)) == [("CHF", day("2021-01-01"))]


def test_marks_are_rebuilt_where_they_lack(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1")), RATES)
    from tidemark.sources.files import remove

    remove(spark, f"{store.root}/_marks")
    assert rows_of(store.watermark_per_key(RATES)) == [("USD", day("2024-06-01"))]
    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1"), ("EUR", "2020-06-01", "1")), RATES)
    marks = store.watermark_per_key(RATES)
    assert not files_of(marks) and rows_of(marks) == [("EUR", day("2020-06-01")), ("USD", day("2024-06-01"))]


def test_a_failing_rebuild_leaves_the_table(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1")), RATES)
    broken = rate_rows(spark, ("EUR", "2024-06-01", "1")).withColumn("rate_value", F.raise_error(F.lit("no")).cast("decimal(10,4)"))
    with pytest.raises(Exception, match="no"):
        store.overwrite(broken, RATES)
    assert rows_of(store.read(RATES)) == [rate("USD", "2024-06-01", "1.0000")]
    assert rows_of(store.watermark_per_key(RATES)) == [("USD", day("2024-06-01"))]
    # A replacement may read the table that it replaces.
    store.overwrite(store.read(RATES).unionByName(rate_rows(spark, ("EUR", "2023-06-01", "1"))), RATES)
    assert store.read(RATES).count() == 2


def test_a_replacement_that_was_cut_off_is_taken_back(spark, store):
    from tidemark.sources.files import move

    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1")), RATES)
    move(spark, store.path(RATES), store._replaced(RATES))
    assert store.read(RATES).count() == 1 and store.exists(RATES)
    store.overwrite(rate_rows(spark, ("EUR", "2024-06-01", "1")), RATES)
    assert [r.currency_code for r in store.read(RATES).collect()] == ["EUR"]


def test_upserts_keep_the_greatest_row_under_any_cut(spark, tmp_path):
    from tidemark.sources.stores import upsert_greatest

    rows = [("USD", "2024-06-01", "1"), ("USD", "2024-06-01", "3"), ("USD", "2024-06-01", "2"), ("EUR", "2023-01-01", "5"),
            ("EUR", "2022-01-01", "7"), ("EUR", "2023-01-01", "4")]
    tables = []
    for size in (1, 2, 6):
        own = ParquetStore(spark, str(tmp_path / f"w{size}"))
        results = [upsert_greatest(own, rate_rows(spark, *rows[i : i + size]), RATES) for i in range(0, 6, size)]
        assert all(r.status in ("LOADED", "EMPTY") for r in results)
        tables.append(rows_of(own.read(RATES)))
        assert rows_of(own.watermark_per_key(RATES)) == [("EUR", day("2023-01-01")), ("USD", day("2024-06-01"))]
    assert tables[0] == tables[1] == tables[2] == [
        rate("EUR", "2022-01-01", "7.0000"), rate("EUR", "2023-01-01", "5.0000"), rate("USD", "2024-06-01", "3.0000")
    ]
    again = upsert_greatest(own, rate_rows(spark, *rows), RATES)
    assert (again.status, again.n_rows) == ("EMPTY", 0)


def test_every_row_is_stored_or_kept_with_a_reason(spark, store):
    append_new(store, rate_rows(spark, ("USD", "2024-06-01", "1")), RATES)
    batch = spark.createDataFrame(
        [("USD", "2024-06-01", "9", 1), ("USD", "2024-06-02", "1", 2), ("USD", "2024-06-02", "1", 3), ("USD", "2024-06-02", "2", 4),
         (None, "2024-06-01", "1", 5), ("EUR", "no date", "1", 6), ("EUR", "2024-06-01", "n/a", 7)],
        "currency_code string, exchange_date string, rate_value string, extra int",
    )
    result = append_new(store, batch, RATES, keep_rejected=True)
    assert (result.n_rows, result.n_no_key, result.n_misfit) == (2, 2, 1)
    kept = store.rejected(RATES)
    told = sorted((r.reason, r.stored, int(re.search(r'"extra":(\d)', r.row)[1])) for r in kept.collect())
    assert [t for t in told if t[0] != "repeated"] == [("held", False, 1), ("misfit", True, 7), ("no key", False, 5), ("no key", False, 6)]
    assert sorted(t[2] for t in told if t[0] == "repeated") == [2, 3]
    assert kept.filter("NOT stored").count() + result.n_rows == batch.count()
    again = append_new(store, batch, RATES, keep_rejected=True)
    assert (again.status, again.n_rows) == ("EMPTY", 0) and store.rejected(RATES).filter("reason = 'held'").count() == 6
