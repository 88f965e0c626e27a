"""Reading landed files (hazards H2 to H5, H11)."""

import json

import pandas as pd
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
from tidemark.operators import silver
from tidemark.plans import bars as bar_plans
from tidemark.plans import rates as rate_plans
from tidemark.schemas import BARS, GOLD_DOCUMENT, HISTORY_BARS, INCREMENT_BARS, RATE_DOCUMENT, RATES, SPREADS
from tidemark.sources import bronze, landing, payloads, records
from tidemark.sources.stores import ParquetStore


def test_rate_documents_become_typed_rows(spark, tmp_path):
    put_json(tmp_path, "a.json", rates_a("USD", **{"2025-01-02": 4.12345, "2025-01-03": 4.0}))
    result = silver.flatten_rates(bronze.read_rates(spark, f"{tmp_path}/*.json"))
    assert result.schema == RATES.schema
    assert rows_of(result) == [
        rate("USD", "2025-01-02", "4.1235"),
        rate("USD", "2025-01-03", "4.0000"),
    ]


def test_h3_integer_number_keeps_the_rate_type(spark, tmp_path):
    put_json(tmp_path, "a.json", rates_a("EUR", **{"2025-01-02": 4}))
    result = silver.flatten_rates(bronze.read_rates(spark, str(tmp_path)))
    assert rows_of(result) == [rate("EUR", "2025-01-02", "4.0000")]


def test_h5_documents_without_observations_give_no_rows(spark, tmp_path):
    put_json(tmp_path, "a.json", {"code": "BAD", "rates": []})
    put_json(tmp_path, "b.json", {"code": "NUL", "rates": None})
    put_json(tmp_path, "c.json", {"code": "NON"})
    assert silver.flatten_rates(bronze.read_rates(spark, str(tmp_path))).isEmpty()


def test_only_the_files_of_one_batch_are_read(spark, tmp_path):
    for end in ("2025-01-02", "2025-01-03"):
        put_json(tmp_path, f"rate_USD_{end}.json", rates_a("USD", **{end: 4.0}))
        put_json(tmp_path, f"spread_USD_{end}.json", rates_c("USD", **{end: (4.0, 4.1)}))
    batch = bronze.read_rates(spark, str(tmp_path), only="rate_*_2025-01-03.json")
    assert rows_of(silver.flatten_rates(batch)) == [rate("USD", "2025-01-03", "4.0000")]


def test_several_folders_are_one_relation(spark, tmp_path):
    first = put_json(tmp_path / "old", "a.json", rates_a("USD", **{"2024-12-31": 4.1}))
    second = put_json(tmp_path / "new", "a.json", rates_a("USD", **{"2025-01-02": 4.2}))
    result = silver.flatten_rates(bronze.read_rates(spark, [first, second]))
    assert [r[1] for r in rows_of(result)] == [day("2024-12-31"), day("2025-01-02")]


def test_h11_malformed_document_is_an_error(spark, tmp_path):
    put_text(tmp_path, "a.json", '{"code": "USD", "rates": [')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        silver.flatten_rates(bronze.read_rates(spark, str(tmp_path))).collect()


def test_spread_documents(spark, tmp_path):
    put_json(tmp_path, "c.json", rates_c("USD", **{"2025-01-02": (4.0, 4.1)}))
    result = silver.flatten_spreads(bronze.read_spreads(spark, str(tmp_path)))
    assert result.schema == SPREADS.schema
    assert [str(v) for v in result.first()] == ["USD", "2025-01-02", "4.0000", "4.1000", "0.1000"]


def test_gold_and_snapshot(spark, tmp_path):
    put_json(tmp_path / "g", "gold.json", gold(**{"2025-01-02": 345.678, "2025-01-03": 346}))
    result = silver.normalise_gold(bronze.read_gold(spark, str(tmp_path / "g")))
    assert rows_of(result) == [
        rate("XAU", "2025-01-02", "345.68"),
        rate("XAU", "2025-01-03", "346.00"),
    ]
    put_json(tmp_path / "s", "a.json", [{"table": "A", "effectiveDate": "2025-01-03", "rates": []}])
    assert bronze.read_snapshot(spark, str(tmp_path / "s")).first()[0] == "2025-01-03"


def test_text_documents_are_parsed_once(spark):
    text = '{"code": "USD", "rates": [{"effectiveDate": "2025-01-02", "mid": 4.5}]}'
    texts = spark.createDataFrame([(text,)], "document string")
    result = silver.flatten_rates(bronze.parse_documents(texts, "document", RATE_DOCUMENT))
    assert rows_of(result) == [rate("USD", "2025-01-02", "4.5000")]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_h4_repeated_header_lines_vanish(spark, tmp_path):
    put_text(
        tmp_path,
        "AAPL.csv",
        HISTORY_HEADER,
        "Ticker,AAPL,AAPL,AAPL,AAPL,AAPL,",
        "Date,,,,,,",
        "2025-01-02,243.85,249.1,241.82,248.93,55740700,AAPL",
        "2025-01-03,243.36,244.18,241.89,243.36,40244100.0,AAPL",
    )
    result = silver.clean_bars(bronze.read_bars(spark, str(tmp_path), HISTORY_BARS), HISTORY_BARS)
    assert result.schema == BARS.schema
    assert [[str(v) for v in r] for r in rows_of(result)] == [
        ["AAPL", "2025-01-02", "248.93", "249.10", "241.82", "243.85", "55740700"],
        ["AAPL", "2025-01-03", "243.36", "244.18", "241.89", "243.36", "40244100"],
    ]


def test_h2_other_header_is_refused_by_a_fixed_layout(spark, tmp_path):
    put_text(
        tmp_path,
        "a.csv",
        "Price,Adj Close,Close,High,Low,Open,Volume,Ticker",
        "2025-01-02,1,2,3,4,5,66,AAPL",
    )
    with pytest.raises(Exception, match="header"):
        silver.clean_bars(
            bronze.read_bars(spark, str(tmp_path), HISTORY_BARS), HISTORY_BARS
        ).collect()


def test_h2_mixed_headers_are_read_by_name(spark, tmp_path):
    put_text(
        tmp_path,
        "a.csv",
        "Price,Adj Close,Close,High,Low,Open,Volume,Ticker",
        "Ticker,AAPL,AAPL,AAPL,AAPL,AAPL,AAPL,",
        "2025-01-02,1,2,3,4,5,66,AAPL",
    )
    put_text(tmp_path, "b.csv", HISTORY_HEADER, "2025-01-02,12,13,14,15,70,MSFT")
    put_text(tmp_path, "c.csv", INCREMENT_HEADER, '2025-01-03,21,22,23,24,80,"GC=F",METALS')
    result = silver.clean_bars(bronze.read_mixed_bars(spark, str(tmp_path)))
    assert [[str(v) for v in r] for r in rows_of(result)] == [
        ["AAPL", "2025-01-02", "5.00", "3.00", "4.00", "2.00", "66"],
        ["GC=F", "2025-01-03", "21.00", "22.00", "23.00", "24.00", "80"],
        ["MSFT", "2025-01-02", "15.00", "13.00", "14.00", "12.00", "70"],
    ]


def test_mixed_bars_of_files_without_header_are_refused_by_name(spark, tmp_path):
    put_text(tmp_path, "good.csv", HISTORY_HEADER, "2025-01-02,12,13,14,15,70,MSFT")
    put_text(tmp_path, "bad.csv", "2025-01-02,1,2,3")
    with pytest.raises(ValueError, match="bad.csv") as error:
        bronze.read_mixed_bars(spark, str(tmp_path))
    assert "good.csv" not in str(error.value)


def test_mixed_bars_with_quotes_blanks_and_a_ticker_named_close(spark, tmp_path):
    put_text(tmp_path, "a.csv", "", '"Date","Open","Close","Volume","Ticker"', '2025-01-02,"1","2,5",3,"A ""B"""')
    put_text(tmp_path, "b.csv", "Date, Open, High, Low, Close, Volume, Ticker", "2025-01-02, 1, 2, 3, 4, 5, CLOSE")
    put_text(tmp_path, "c.csv", HISTORY_HEADER, "0001-01-01,4,3,2,1,5,close", "2025-01-03,4,3,2,1,5,close")
    rows = sorted((r.symbol, r.date, r.open, r.close, r.high) for r in bronze.read_mixed_bars(spark, str(tmp_path)).collect())
    assert rows == [
        ('A "B"', "2025-01-02", "1", "2,5", None),
        ("CLOSE", "2025-01-02", "1", "4", "2"),
        ("close", "0001-01-01", "1", "4", "3"),
        ("close", "2025-01-03", "1", "4", "3"),
    ]


def test_any_number_of_header_shapes(spark, tmp_path):
    for i in range(40):
        extra = ",".join(f"x{k}" for k in range(i))
        put_text(tmp_path, f"{i}.csv", f"Date,Close,Ticker,{extra}", f"2025-01-02,{i + 1},T{i},{extra}")
    rows = bronze.read_mixed_bars(spark, str(tmp_path)).collect()
    assert sorted((r.symbol, r.close) for r in rows) == sorted((f"T{i}", str(i + 1)) for i in range(40))


def test_both_forms_of_documents_side_by_side(spark, tmp_path):
    put_json(tmp_path, "a.json", rates_a("USD", **{"2025-01-02": 4.0}))
    one_a_line = [json.dumps(rates_a(c, **{"2025-01-02": 5.0})) for c in ("EUR", "CHF", "GBP")]
    put_text(tmp_path, "b.json", "", *one_a_line)
    put_json(tmp_path, "empty.json", "")
    (tmp_path / "nothing.json").write_text("")
    (tmp_path / "empty.json").write_text("\n \n")
    found = rows_of(silver.flatten_rates(bronze.read_rates(spark, str(tmp_path))))
    assert [r[0] for r in found] == ["CHF", "EUR", "GBP", "USD"]
    only_lines = silver.flatten_rates(bronze.read_rates(spark, f"{tmp_path}/b.json", multiline=False))
    assert only_lines.count() == 3


def test_landed_documents_load_by_batch(spark, tmp_path):
    path = str(tmp_path / "landing")
    for code, end in (("EUR", "2025-01-02"), ("USD", "2025-01-02"), ("EUR", "2025-01-03")):
        document = payloads.rate_document(spark, {"code": code, "rates": [{"effectiveDate": end, "mid": 4.0}] * 2})
        landing.land_documents(document.union(document), path, end)
    assert silver.flatten_rates(bronze.read_rates(spark, path)).count() == 12
    batch = silver.flatten_rates(bronze.read_batch(spark, path, RATE_DOCUMENT, "rate_*_", "2025-01-02"))
    assert sorted({(r.currency_code, str(r.exchange_date)) for r in batch.collect()}) == [("EUR", "2025-01-02"), ("USD", "2025-01-02")]
    assert batch.count() == 8
    with pytest.raises(FileNotFoundError, match="2025-01-09"):
        bronze.read_batch(spark, path, RATE_DOCUMENT, "rate_*_", "2025-01-09")


def test_increment_layout(spark, tmp_path):
    put_text(tmp_path, "a.csv", INCREMENT_HEADER, "2025-01-03 00:00:00,21,22,23,24,80,JO,X")
    rows = bronze.read_bars(spark, str(tmp_path), INCREMENT_BARS)
    assert silver.clean_bars(rows, INCREMENT_BARS).first()["trade_date"] == day("2025-01-03")


def test_payloads(spark):
    answer = {"code": "EUR", "rates": [{"no": "1", "effectiveDate": "2025-01-02", "mid": 4}]}
    sample = silver.sample_rates(payloads.rate_entries(spark, answer), "EUR")
    assert sample.dtypes == [("currency", "string"), ("date", "date"), ("rate", "float")]
    assert rows_of(sample) == [("EUR", day("2025-01-02"), 4.0)]
    assert rows_of(silver.flatten_rates(payloads.rate_document(spark, answer))) == [
        rate("EUR", "2025-01-02", "4.0000")
    ]
    quotes = {"code": "EUR", "rates": [{"effectiveDate": "2025-01-02", "bid": 4, "ask": 4.5}]}
    spread = silver.flatten_spreads(payloads.spread_document(spark, quotes)).first()
    assert str(spread["spread_value"]) == "0.5000"
    prices = payloads.gold_quotes(spark, gold(**{"2025-01-02": 345}))
    assert rows_of(silver.normalise_gold(prices)) == [rate("XAU", "2025-01-02", "345.00")]


def test_bars_from_pandas(spark):
    frame = pd.DataFrame(
        {
            "symbol": ["A", "A", "B"],
            "date": [day("2025-01-02"), day("2025-01-03"), day("2025-01-02")],
            "open": [1.0, None, 2.0],
            "high": [1.5, None, 2.5],
            "low": [0.5, None, 1.5],
            "close": [1.25, None, 2.25],
            "volume": [100, None, None],
            "adjclose": [9.0, 9.0, 9.0],
        }
    )
    rows = payloads.bars_from_pandas(spark, frame)
    kept = silver.drop_empty(rows, ["open", "high", "low", "close", "volume"])
    assert kept.count() == 2
    assert [(r.ticker, str(r.close_price), r.volume) for r in silver.clean_bars(rows).collect()] == [
        ("A", "1.25", 100),
        ("B", "2.25", None),
    ]


def test_landing_round_trip(spark, tmp_path):
    answer = {"code": "EUR", "rates": [{"effectiveDate": "2025-01-02", "mid": 4.25}]}
    path = str(tmp_path / "landing")
    landing.land_documents(payloads.rate_document(spark, answer), path, "2025")
    back = silver.flatten_rates(bronze.read_rates(spark, path, multiline=False))
    assert rows_of(back) == [rate("EUR", "2025-01-02", "4.2500")]

    present = landing.landed(spark, path, ["code", "period"])
    wanted = spark.createDataFrame([("EUR", "2024"), ("EUR", "2025")], "code string, period string")
    missing = landing.not_landed(wanted, present, ["code", "period"])
    assert rows_of(missing) == [("EUR", "2024")]
    assert landing.landed(spark, str(tmp_path / "none"), ["code", "period"]).isEmpty()


def test_h14_landed_bars_have_safe_folders(spark, tmp_path):
    bars = spark.createDataFrame(
        [("^GSPC", "2025-01-02", "1"), ("GC=F", "2025-01-02", "2"), ("BRK-B", "2025-01-02", "3")],
        "ticker string, Date string, Close string",
    )
    path = tmp_path / "bars"
    landing.land_bars(bars, str(path))
    folders = sorted(p.name for p in path.iterdir() if p.is_dir())
    assert folders == ["folder=BRK_B", "folder=GCFUT_F", "folder=IDX_GSPC"]
    back = silver.clean_bars(
        bronze.read_mixed_bars(spark, str(path / "*")).withColumn(
            "close", F.col("close").cast("double")
        )
    )
    assert sorted(r.ticker for r in back.collect()) == ["BRK-B", "GC=F", "^GSPC"]


def test_documents_of_any_form_in_one_file(spark, tmp_path):
    spread = json.dumps(rates_a("USD", **{"2025-01-02": 1.5}), indent=1)
    second = json.dumps(rates_a("EUR", **{"2025-01-03": 2.5}), indent=2)
    line = json.dumps(rates_a("CHF", **{"2025-01-04": 3.5}))
    brackets = json.dumps({"code": "a{[\"}\\", "rates": [{"effectiveDate": "2025-01-05", "mid": 4.5}]})
    array = json.dumps([rates_a("GBP", **{"2025-01-06": 5.5}), rates_a("NOK", **{"2025-01-07": 6.5})], indent=1)
    put_text(tmp_path, "a.json", spread, second, line, "", brackets, array, line + " " + brackets)
    put_text(tmp_path, "b.json", line, line.replace("CHF", "SEK"))
    put_text(tmp_path, "c.json", array.replace("\n", " "))
    got = sorted((r.code, len(r.rates), r.rates[0].mid) for r in bronze.read_rates(spark, str(tmp_path)).collect())
    assert [g[0] for g in got] == sorted(
        ["USD", "EUR", "CHF", 'a{["}\\', "GBP", "NOK", "CHF", 'a{["}\\', "CHF", "SEK", "GBP", "NOK"]
    )
    assert all(n == 1 for _, n, _ in got)
    forced = bronze.read_rates(spark, str(tmp_path), multiline=True)
    assert forced.count() == len(got)


def test_two_spread_documents_are_both_loaded(spark, tmp_path):
    documents = [json.dumps(rates_a(c, **{"2025-01-02": 1.5}), indent=1) for c in ("USD", "EUR")]
    put_text(tmp_path / "in", "a.json", *documents)
    store = ParquetStore(spark, str(tmp_path / "facts"))
    result = rate_plans.rebuild_rates(store, str(tmp_path / "in"))
    assert (result.status, result.n_rows) == ("LOADED", 2)


def test_documents_over_many_blocks_of_a_file(spark, tmp_path):
    documents = [rates_a(f"C{i}", **{"2025-01-02": i + 0.5}) for i in range(300)]
    texts = [json.dumps(d, indent=1 if i % 3 else None) for i, d in enumerate(documents)]
    put_text(tmp_path, "a.json", *texts)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "2000")
        lines = bronze.json_lines(spark, [str(tmp_path)])
        assert lines.select("block").distinct().count() > 5
        got = {r.code: r.rates[0].mid for r in bronze.read_rates(spark, str(tmp_path)).collect()}
    finally:
        for n, value in zip(names, old):
            spark.conf.set(n, value)
    assert got == {d["code"]: i + 0.5 for i, d in enumerate(documents)}


def test_a_document_that_never_ends_is_an_error(spark, tmp_path):
    put_text(tmp_path, "a.json", json.dumps(rates_a("USD", **{"2025-01-02": 1.5})), '{"code": "EUR", "rates": [')
    with pytest.raises(Exception, match="(?i)malformed"):
        bronze.read_rates(spark, str(tmp_path)).collect()


def test_a_batch_of_many_codes_is_one_scan(spark, tmp_path):
    codes = [f"{i:03d}" for i in range(30)]
    for code in codes:
        put_text(tmp_path / f"code={code}" / "period=2025", "part.json", json.dumps({"rates": [{"effectiveDate": "2025-01-02", "mid": 1.0}]}))
        put_text(tmp_path / f"code={code}" / "period=2024", "part.json", "broken")
    batch = bronze.read_batch(spark, str(tmp_path), RATE_DOCUMENT, "rate_*_", "2025")
    assert sorted(r.code for r in batch.collect()) == codes
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_cells_with_line_breaks_keep_their_rows(spark, tmp_path):
    put_text(tmp_path, "a.csv", "Date,Close,Note,Symbol,Open,High,Low,Volume", '2025-01-02,1,"two', 'lines, and ""more""', '",AAPL,1,1,1,5', "2025-01-03,2,,AAPL,1,1,1,6")
    put_text(tmp_path, "b.csv", "Date,Close,Symbol,Open,High,Low,Volume", "2025-01-02,3,MSFT,1,1,1,7")
    store = ParquetStore(spark, str(tmp_path / "facts"))
    (tmp_path / "in").mkdir()
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).rename(tmp_path / "in" / name)
    result = bar_plans.rebuild_bars(store, str(tmp_path / "in"), layout=None)
    assert (result.status, result.n_rows) == ("LOADED", 3)
    assert sorted((r.ticker, str(r.close_price)) for r in store.read(BARS).collect()) == [("AAPL", "1.00"), ("AAPL", "2.00"), ("MSFT", "3.00")]


def files_below(folder):
    return sorted(str(p) for p in folder.rglob("part-*") if landing.MANIFEST not in str(p))


@pytest.mark.parametrize("dataset", ["rates", "spreads", "gold", "bars"])
def test_a_second_landing_adds_nothing(spark, tmp_path, dataset):
    path = tmp_path / "in"
    tables = {
        "rates": ([("USD", 1.0), ("EUR/X", 2.0)], "code string, mid double"),
        "spreads": ([("USD", 1.0), ("EUR/X", 2.0)], "code string, bid double"),
        "gold": ([("2025-01-02", 1.0)], "data string, cena double"),
        "bars": ([("GC=F", 1.0), ("AAPL", 2.0)], "ticker string, Close double"),
    }
    df = spark.createDataFrame(*tables[dataset])
    land = landing.land_new_bars if dataset == "bars" else landing.land_new_documents
    land(df, str(path), "2024")
    first = files_below(path)
    land(df, str(path), "2024")
    assert first and files_below(path) == first
    land(df, str(path), "2025")
    assert len(files_below(path)) == 2 * len(first)
    told = landing.manifest(spark, str(path))
    assert told.count() == 2 * df.count() and told.columns == ["key", "period", "folder"]
    # What was never noted down is told by the files.
    assert rows_of(landing._lying(spark, str(path)).select("key", "period")) == rows_of(told.select("key", "period"))


def test_new_keys_of_a_landed_period_land(spark, tmp_path):
    rows = spark.createDataFrame([("USD", 1.0), ("EUR", 2.0)], "code string, mid double")
    landing.land_documents(rows.filter("code = 'USD'"), str(tmp_path / "in"), "2024")
    landing.land_new_documents(rows, str(tmp_path / "in"), "2024")
    assert len(files_below(tmp_path / "in")) == 2
    more = spark.createDataFrame([("EUR", 3.0)], "code string, mid double")
    landing.land_documents(more, str(tmp_path / "in"), "2023")
    landing.land_new_documents(more, str(tmp_path / "in"), "2023")
    assert len(files_below(tmp_path / "in")) == 3
    plan = rate_plans.plan_rate_backfill(spark, ["USD", "EUR", "CHF"], str(tmp_path / "in"), 2024, 2025)
    assert sorted((r.currency_code, r.year) for r in plan.collect()) == [("CHF", 2024), ("CHF", 2025), ("EUR", 2025), ("USD", 2025)]


def test_gold_lands_loads_and_is_planned(spark, tmp_path):
    quotes = spark.createDataFrame([("2024-01-02", 250.5)], "data string, cena double")
    landing.land_new_documents(quotes, str(tmp_path / "in"), "2024")
    batch = bronze.read_batch(spark, str(tmp_path / "in"), GOLD_DOCUMENT, "gold_", "2024")
    assert [(r.data, r.cena) for r in batch.collect()] == [("2024-01-02", 250.5)]
    plan = rate_plans.plan_gold_backfill(spark, str(tmp_path / "in"), 2023, 2024)
    assert [(r.currency_code, r.year) for r in plan.collect()] == [("XAU", 2023)]
    assert [r.year for r in rate_plans.plan_gold_backfill(spark, str(tmp_path / "none"), 2024, 2024).collect()] == [2024]


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_f1_records_of_several_lines_are_joined_where_they_are_read(spark, tmp_path):
    lines = [f'2025-01-02,{i},"late,\n""amended""",T{i}' if i % 3 else f"2025-01-02,{i},none,T{i}" for i in range(1, 50)]
    put_text(tmp_path, "a.csv", "Date,Close,Remark,Ticker", *lines)
    rows = bronze.read_mixed_bars(spark, str(tmp_path))
    assert "Exchange hashpartitioning" not in plan_of(rows)
    assert sorted((r.symbol, r.close) for r in rows.collect()) == sorted((f"T{i}", str(i)) for i in range(1, 50))


def test_f2_documents_of_several_lines_are_joined_where_they_are_read(spark, tmp_path):
    documents = [rates_a(f"C{i}", **{"2025-01-02": i + 0.5}) for i in range(50)]
    put_text(tmp_path, "a.json", *(json.dumps(d, indent=1 if i % 3 else None) for i, d in enumerate(documents)))
    rows = bronze.read_rates(spark, str(tmp_path))
    assert not any(step in plan_of(rows) for step in ("Window", "Sort", "Exchange hashpartitioning"))
    assert {r.code: r.rates[0].mid for r in rows.collect()} == {f"C{i}": i + 0.5 for i in range(50)}


def test_f3_f4_names_are_looked_up_once_a_file(spark, tmp_path):
    put_text(tmp_path, "a.csv", '"Date"," Close ","Ticker"', '"2025-01-02","1","A"')
    put_text(tmp_path, "b.csv", "Ticker,Close,Price", "B,2,2025-01-03")
    rows = bronze.read_mixed_bars(spark, str(tmp_path))
    assert "array_position" not in plan_of(rows)
    assert sorted((r.symbol, r.date, r.close) for r in rows.collect()) == [("A", "2025-01-02", "1"), ("B", "2025-01-03", "2")]


def test_records_over_blocks_and_batches_are_those_of_the_file(spark, tmp_path):
    """Some go over several blocks, a file ends in an open one, another has no odd line."""
    remarks = ["none", 'late,\n"amended"', "\n".join(["long"] * 300), 'a "b", c', "x\n\ny"]
    for name, n in (("a.csv", 120), ("b.csv", 70)):
        cells = [(f"{name}{i}", remarks[i % 5].replace('"', '""')) for i in range(n)]
        put_text(tmp_path, name, "Date,Remark,Close,Ticker", *(f'2025-01-02,"{r}",{i + 1},{t}' for i, (t, r) in enumerate(cells)))
    put_text(tmp_path, "c.csv", "", "Date,Close,Ticker", *(f"2025-01-02,{i + 1},c{i}" for i in range(200)))
    with open(tmp_path / "b.csv", "a") as file:
        file.write('2025-01-02,none,71,end,"open\nwith,2025-01-02,9,9\n')
    settings = {
        "spark.sql.files.maxPartitionBytes": "1000",
        "spark.sql.files.openCostInBytes": "1000",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "7",
    }
    old = {n: spark.conf.get(n) for n in settings}
    try:
        for n, value in settings.items():
            spark.conf.set(n, value)
        lines = bronze.file_lines(spark, [str(tmp_path)])
        assert lines.select("file", "block").distinct().count() > 10
        got = sorted((r.symbol, r.close) for r in bronze.read_mixed_bars(spark, str(tmp_path)).collect())
    finally:
        for n, value in old.items():
            spark.conf.set(n, value)
    wanted = [(f"{f}{i}", str(i + 1)) for f, n in (("a.csv", 120), ("b.csv", 70), ("c", 200)) for i in range(n)]
    assert got == sorted([*wanted, ("end", "71")])


def test_cells_with_and_without_commas_in_quotes(spark):
    lines = ["a,b,", '"a","b"', ' "a" , "b,c"', '"a,b",c', '"a""b",c', '"a"",b",c', 'a"b,c"d', 'a"b"c,d', '"a"b,"c"', '""', '","', '"",""""', '"a,', '"a"x"b,c"']
    # The expression without the shortcut.
    every = F.expr(r"""regexp_extract_all(concat(value, ','), r'("(?:[^"]|"")*+"|[^,]*),', 1)""")
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    for line, fast, slow in rows.select("value", bronze._raw_cells(F.col("value")), every).collect():
        assert fast == slow, line


def test_records_of_more_blocks_than_can_be_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "BROADCAST_BYTES", 0)
    documents = [rates_a(f"C{i}", **{"2025-01-02": i + 0.5}) for i in range(60)]
    put_text(tmp_path, "a.json", *(json.dumps(d, indent=1 if i % 3 else None) for i, d in enumerate(documents)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        got = {r.code: r.rates[0].mid for r in bronze.read_rates(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {f"C{i}": i + 0.5 for i in range(60)}
