"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosscheck.inputs import (
    api_bars,
    bars,
    bars_of,
    bid_ask,
    gold_quotes,
    grouped_suppliers,
    parsed_rates,
    rate_documents,
    rates,
    rates_of,
    spread_documents,
    stored_rates,
    table,
    text_bars,
)
from tidemark.functions import iso_date, iso_text, safe_symbol
from tidemark.operators import checks, dedup, incremental, planning, silver
from tidemark.plans import bars as bar_plans
from tidemark.plans import rates as rate_plans
from tidemark.schemas import (
    API_BARS,
    BARS,
    FINE_PRICE_TYPE,
    GOLD,
    PRICE_TYPE,
    RATE_DOCUMENT,
    RATES,
    SPREADS,
)
from tidemark.session import scratch_path
from tidemark.sources.bronze import read_rates
from tidemark.sources.landing import land_documents, land_new_documents
from tidemark.sources.stores import ParquetStore, append_new
from tidemark.sources.universe import flatten_groups
from tidemark.streaming import rate_stream, run_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Projections


@query
def rates_flatten(spark, sf_dir):
    documents = rate_documents(table(spark, sf_dir, "orders"))
    return silver.flatten_rates(parsed_rates(documents))


@query
def rates_float(spark, sf_dir):
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("code"),
        iso_text(F.col("o_orderdate")).alias("effectiveDate"),
        F.col("o_totalprice").alias("mid"),
    )
    return silver.sample_rates(entries, F.col("code"))


@query
def gold_normalise(spark, sf_dir):
    return silver.normalise_gold(gold_quotes(spark, sf_dir))


@query
def spread_calc(spark, sf_dir):
    return silver.with_spread(bid_ask(spark, sf_dir))


@query
def clean_bars(spark, sf_dir):
    return silver.clean_bars(text_bars(spark, sf_dir))


@query
def bars_hiprec(spark, sf_dir):
    return silver.type_bars(api_bars(spark, sf_dir), price=FINE_PRICE_TYPE)


@query
def bars_rename(spark, sf_dir):
    return silver.rename_bars(api_bars(spark, sf_dir)).withColumn(
        "trade_date", iso_date(F.col("trade_date"))
    )


@query
def bars_with_group(spark, sf_dir):
    groups = grouped_suppliers(spark, sf_dir).select(
        F.col("s_suppkey").cast("string").alias("ticker"), "group_name"
    )
    return silver.with_group(bars(spark, sf_dir), groups)


@query
def instrument_dim(spark, sf_dir):
    """Each supplier is listed in its group under its number and under its name."""
    groups = grouped_suppliers(spark, sf_dir).select(
        "group_name", F.array(F.col("s_suppkey").cast("string"), "s_name").alias("tickers")
    )
    return flatten_groups(groups)


@query
def date_text_roundtrip(spark, sf_dir):
    text = iso_text(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("date_text"), iso_date(text).alias("date_value")
    )


@query
def safe_name(spark, sf_dir):
    symbol = F.concat(
        F.lit("^"), "c_mktsegment", F.lit("-"), F.col("c_custkey").cast("string"), F.lit("=F")
    )
    return table(spark, sf_dir, "customer").select(
        symbol.alias("symbol"), safe_symbol(symbol).alias("name")
    )


@query
def wide_to_long(spark, sf_dir):
    """Return flags are the tickers; together they cover every line item."""
    flags = ["A", "N", "R"]
    wide = (
        table(spark, sf_dir, "lineitem")
        .groupBy(iso_date(F.col("l_shipdate")).alias("trade_date"))
        .pivot("l_returnflag", flags)
        .agg(
            F.max(F.col("l_extendedprice").cast(PRICE_TYPE)).alias("close"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
        )
    )
    columns = {f: {"close_price": f"{f}_close", "volume": f"{f}_volume"} for f in flags}
    return silver.wide_to_long(wide, ["trade_date"], columns)


@query
def drop_all_null(spark, sf_dir):
    """Values under 10 and the properties of views and clicks count as missing."""
    sparse = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
        F.when(~F.col("event_type").isin("view", "click"), F.col("props")).alias("props"),
    )
    return silver.drop_empty(sparse, ["value", "props"])


@query
def valid_prices(spark, sf_dir):
    accounts = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("ticker"),
        F.lit(date(2025, 1, 2)).alias("trade_date"),
        F.col("c_acctbal").cast(PRICE_TYPE).alias("close_price"),
    )
    return silver.valid_bars(accounts)


@query
def json_field(spark, sf_dir):
    parsed = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


# Filters


@query
def rows_on_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return rates_of(planning.on_date(orders, "o_orderdate", date(1998, 10, 3)))


@query
def date_range(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    chosen = planning.in_range(lineitem, "l_shipdate", date(1996, 1, 1), date(1999, 1, 1))
    return bars_of(chosen)


@query
def symbol_subset(spark, sf_dir):
    return planning.symbol_subset(rates(spark, sf_dir), "currency_code", ["1-URGENT", "5-LOW"])


@query
def closed_sessions(spark, sf_dir):
    """Events at 15:00 on the 20th: that day is still running."""
    events = table(spark, sf_dir, "events")
    closed = checks.closed_sessions(events, "ts", datetime(2024, 1, 20, 15, 0))
    return closed.select("event_id", "event_type", iso_date(F.col("ts")).alias("day"), "value")


# Watermarks and loads


@query
def watermark_table(spark, sf_dir):
    return incremental.watermark(rates(spark, sf_dir), "exchange_date")


@query
def watermark_per_key(spark, sf_dir):
    return incremental.watermark_per_key(bars(spark, sf_dir), "ticker", "trade_date")


@query
def watermark_proxy_key(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    dated = lineitem.select("l_suppkey", iso_date(F.col("l_shipdate")).alias("trade_date"))
    return incremental.proxy_watermark(dated, "l_suppkey", 7, "trade_date")


def _watermarks(spark, sf_dir):
    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return {
        name: incremental.watermark(
            table(spark, sf_dir, name).select(iso_date(F.col(column)).alias("day")), "day"
        )
        for name, column in columns.items()
    }


@query
def watermark_min(spark, sf_dir):
    return incremental.least_watermark(_watermarks(spark, sf_dir))


@query
def append_new_table(spark, sf_dir):
    mark = incremental.watermark(stored_rates(spark, sf_dir), "exchange_date")
    orders = table(spark, sf_dir, "orders")
    return rates_of(incremental.newer_than_table(orders, mark, "o_orderdate"))


@query
def append_new_per_key(spark, sf_dir):
    marks = incremental.watermark_per_key(
        stored_rates(spark, sf_dir), "currency_code", "exchange_date"
    ).withColumnRenamed("currency_code", "o_orderpriority")
    orders = table(spark, sf_dir, "orders")
    newer = incremental.newer_than_per_key(
        orders, marks, "o_orderpriority", "o_orderdate", default=date(1995, 6, 1)
    )
    return rates_of(newer)


@query
def append_idempotent(spark, sf_dir):
    """Bars to 1998 are stored; the batch repeats 1998 with other volumes and goes on."""
    lineitem = table(spark, sf_dir, "lineitem")
    keys = ["ticker", "trade_date"]
    stored = bars_of(lineitem.filter(F.col("l_shipdate") < F.lit(date(1999, 1, 1))))
    batch = bars_of(
        lineitem.filter(F.col("l_shipdate") >= F.lit(date(1998, 1, 1))), volume="l_linenumber"
    )
    return incremental.appended(dedup.one_per_key(stored, keys), batch, keys)


# Duplicates, order, unions


@query
def rates_distinct(spark, sf_dir):
    return dedup.distinct_rows(rates(spark, sf_dir))


@query
def dedup_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
        iso_date(F.col("l_shipdate")).alias("ship_date"),
    )
    return dedup.one_per_key(lines, ["l_orderkey", "l_linenumber"], prefer=["ship_date"])


@query
def rows_per_key(spark, sf_dir):
    return checks.rows_per_key(rates(spark, sf_dir), "currency_code")


@query
def topk_keys(spark, sf_dir):
    return checks.top_keys(bars(spark, sf_dir), "ticker", 10)


@query
def preview_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return checks.preview(customers, ["c_custkey"], 5)


@query
def last_n_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("currency_code"),
        iso_date(F.col("o_orderdate")).alias("exchange_date"),
        "o_orderkey",
        "o_totalprice",
    )
    newest = ["exchange_date", "o_orderkey", "o_totalprice"]
    return dedup.last_n_per_key(orders, "currency_code", newest, 30)


@query
def last_many_per_key(spark, sf_dir):
    """More rows than are ranked: all from a day on, and the greatest of that day."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", iso_date(F.col("l_shipdate")).alias("ship_date"), "l_orderkey", "l_linenumber"
    )
    return dedup.last_n_per_key(lines, "l_returnflag", ["ship_date", "l_orderkey", "l_linenumber"], 5000)


@query
def multi_source_union(spark, sf_dir):
    """Orders before 1998 come in one column order, the others in another."""
    orders = table(spark, sf_dir, "orders")
    cut = F.lit(date(1998, 1, 1))
    early = rates_of(orders.filter(F.col("o_orderdate") < cut))
    late = rates_of(orders.filter(F.col("o_orderdate") >= cut))
    late = late.select("rate_value", "currency_code", "exchange_date")
    return silver.union_by_name(early, late)


@query
def history_rebuild(spark, sf_dir):
    """Two sets of documents that both cover 2000."""
    orders = table(spark, sf_dir, "orders")
    older = orders.filter(F.col("o_orderdate") < F.lit(date(2001, 1, 1)))
    newer = orders.filter(F.col("o_orderdate") >= F.lit(date(2000, 1, 1)))
    documents = silver.union_by_name(rate_documents(older), rate_documents(newer))
    return dedup.distinct_rows(silver.flatten_rates(parsed_rates(documents)))


# Plans, gates, audits


@query
def fetch_plan(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ticker")
    )
    marks = incremental.watermark_per_key(bars(spark, sf_dir), "ticker", "trade_date")
    plan = planning.fetch_plan(suppliers, marks, "ticker", date(2001, 10, 26))
    return plan.withColumn("keys", F.array_join("keys", ","))


@query
def backfill_plan(spark, sf_dir):
    codes = rates(spark, sf_dir)
    landed = planning.landed_years(stored_rates(spark, sf_dir), "currency_code", "exchange_date")
    return planning.backfill_plan(codes, landed, "currency_code", 1995, 2002)


@query
def freshness(spark, sf_dir):
    sources = {
        "orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf_dir, "events"), "ts"),
    }
    return checks.freshness(sources, date(2024, 1, 30))


@query
def load_gate(spark, sf_dir):
    source = checks.latest_date(table(spark, sf_dir, "events"), "ts")
    return checks.load_gate(source, incremental.least_watermark(_watermarks(spark, sf_dir)))


@query
def session_gate(spark, sf_dir):
    mark = incremental.watermark(bars(spark, sf_dir), "trade_date")
    moments = [
        datetime(2001, 11, 3, 23, 0),
        datetime(2001, 11, 5, 15, 0),
        datetime(2001, 11, 5, 22, 0),
        datetime(2001, 12, 1, 9, 30),
    ]
    gate = checks.session_gate(mark, moments)
    return gate.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd HH:mm"))


@query
def load_audit(spark, sf_dir):
    datasets = {
        "orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
        "events": (table(spark, sf_dir, "events"), "ts"),
    }
    return checks.load_audit(datasets)


# Whole loads: the tables are landed as files below the checkpoint folder, loaded into
# Parquet facts there, and the facts are the result.


def _store(spark) -> ParquetStore:
    return ParquetStore(spark, scratch_path(spark, "facts"))


def _landed_text(documents: DataFrame, name: str) -> str:
    path = scratch_path(documents.sparkSession, name)
    documents.write.text(path)
    return path


@query
def landed_rates_rebuild(spark, sf_dir):
    """Two folders of documents that both cover 2000."""
    orders = table(spark, sf_dir, "orders")
    older = orders.filter(F.col("o_orderdate") < F.lit(date(2001, 1, 1)))
    newer = orders.filter(F.col("o_orderdate") >= F.lit(date(2000, 1, 1)))
    folders = [_landed_text(rate_documents(part), "rates") for part in (older, newer)]
    store = _store(spark)
    rate_plans.rebuild_rates(store, folders, multiline=False)
    return store.read(RATES)


@query
def landed_rates_multiline(spark, sf_dir):
    """Documents of which two of three go over several lines, many of them in each file."""
    texts = rate_documents(table(spark, sf_dir, "orders"), spread=True)
    store = _store(spark)
    rate_plans.rebuild_rates(store, _landed_text(texts, "rates"))
    return store.read(RATES)


@query
def landed_spreads_append(spark, sf_dir):
    folder = _landed_text(spread_documents(spark, sf_dir), "spreads")
    store = _store(spark)
    rate_plans.backfill_spreads(store, folder, multiline=False)
    return store.read(SPREADS)


@query
def landed_gold_append_twice(spark, sf_dir):
    quotes = gold_quotes(spark, sf_dir).select(F.to_json(F.struct("data", "cena")))
    folder = _landed_text(quotes, "gold")
    store = _store(spark)
    for _ in range(2):
        rate_plans.backfill_gold(store, folder, multiline=False)
    return store.read(GOLD)


@query
def landed_bars_rebuild(spark, sf_dir):
    folder = scratch_path(spark, "bars")
    text_bars(spark, sf_dir).write.option("header", True).csv(folder)
    store = _store(spark)
    bar_plans.rebuild_bars(store, folder, API_BARS)
    return store.read(BARS)


@query
def landed_bars_mixed_headers(spark, sf_dir):
    """Bars of heavy and of light lines lie in files with different column orders."""
    rows = text_bars(spark, sf_dir).withColumn("adj_close", F.lit("-1"))
    heavy = F.col("volume").cast("double") > 25
    orders = {
        "heavy": (heavy, ["date", "adj_close", "close", "high", "low", "open", "volume", "symbol"]),
        "light": (~heavy, ["symbol", "volume", "open", "high", "low", "close", "date"]),
    }
    folders = []
    for name, (chosen, columns) in orders.items():
        folders.append(scratch_path(spark, name))
        rows.filter(chosen).select(*columns).write.option("header", True).csv(folders[-1])
    store = _store(spark)
    bar_plans.rebuild_bars(store, folders, layout=None)
    return store.read(BARS)


@query
def landed_rates_batch(spark, sf_dir):
    """Documents landed by order year, of which the batch of one year is loaded."""
    orders = table(spark, sf_dir, "orders")
    folder = scratch_path(spark, "landing")
    for year in (1999, 2000):
        chosen = orders.filter(F.year("o_orderdate") == year)
        land_documents(parsed_rates(rate_documents(chosen)), folder, str(year))
    store = _store(spark)
    landing = rate_plans.RatesLanding(folder, folder, folder, batch="2000")
    rows = silver.flatten_rates(landing.read(spark, folder, RATE_DOCUMENT, "rate_*_"))
    append_new(store, rows, RATES)
    return store.read(RATES)


@query
def landed_backfill_plan(spark, sf_dir):
    """The years from 1998 to 2001 of which a priority has nothing landed, after two
    landings of the same documents."""
    orders = table(spark, sf_dir, "orders")
    folder = scratch_path(spark, "landing")
    for year in (1999, 2001, 1999):
        chosen = orders.filter((F.year("o_orderdate") == year) & (F.col("o_orderpriority") < "3"))
        land_new_documents(parsed_rates(rate_documents(chosen)), folder, str(year))
    codes = orders.select(F.col("o_orderpriority").alias("currency_code"))
    return rate_plans.plan_rate_backfill(spark, codes, folder, 1998, 2001)


@query
def landed_bars_quoted_headers(spark, sf_dir):
    """Bars in files whose headers and values stand in quotes, after blanks."""
    folder = scratch_path(spark, "bars")
    rows = text_bars(spark, sf_dir).withColumnRenamed("close", " Close ").withColumnRenamed("date", "Date")
    rows.write.option("header", True).option("quoteAll", True).csv(folder)
    store = _store(spark)
    bar_plans.rebuild_bars(store, folder, layout=None)
    return store.read(BARS)


@query
def landed_bars_line_breaks(spark, sf_dir):
    """Bars with a quoted remark that goes over two lines, on every third of them."""
    folder = scratch_path(spark, "bars")
    remark = F.when(F.col("volume").cast("double") % 3 == 0, 'late,\n"amended"').otherwise("none")
    text_bars(spark, sf_dir).withColumn("remark", remark).write.option("header", True).option("escape", '"').csv(folder)
    store = _store(spark)
    bar_plans.rebuild_bars(store, folder, layout=None)
    return store.read(BARS)


@query
def load_gate_per_key(spark, sf_dir):
    """Whether the newest event is past the stored rate of the priority that lags most."""
    store = _store(spark)
    append_new(store, stored_rates(spark, sf_dir), RATES)
    least = rate_plans.least_mark(store, RATES, "key")
    return checks.load_gate(checks.latest_date(table(spark, sf_dir, "events"), "ts"), least)


@query
def rates_fetch_plan(spark, sf_dir):
    """What to request of each priority since its last stored rate."""
    known = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code")).distinct()
    stored = stored_rates(spark, sf_dir)
    marks = incremental.watermark_per_key(stored, "currency_code", "exchange_date")
    marks = marks.withColumnRenamed("currency_code", "code")
    return planning.closed_fetch_plan(known, marks, "code", date(2001, 11, 1), incremental.RATES_START)


@query
def landed_rates_per_key(spark, sf_dir):
    """Stored rates, then a load of all documents past the watermark of each currency."""
    store = _store(spark)
    append_new(store, stored_rates(spark, sf_dir), RATES)
    folder = _landed_text(rate_documents(table(spark, sf_dir, "orders")), "rates")
    documents = read_rates(spark, folder, multiline=False)
    newer = rate_plans.newer_rows(store, silver.flatten_rates(documents), RATES, "key")
    append_new(store, newer, RATES)
    return store.read(RATES)


@query
def landed_rates_stream(spark, sf_dir):
    """The documents as a file stream, run twice."""
    folder = _landed_text(rate_documents(table(spark, sf_dir, "orders")), "rates")
    store = _store(spark)
    progress = scratch_path(spark, "progress")
    for _ in range(2):
        run_available(rate_stream(spark, folder, multiline=False), store, RATES, progress)
    return store.read(RATES)


@query
def landed_rates_stream_cut(spark, sf_dir):
    """The stream in batches of one file each, of which the greatest row of a key stays."""
    texts = rate_documents(table(spark, sf_dir, "orders")).repartition(4)
    folder = _landed_text(texts, "rates")
    store = _store(spark)
    stream = rate_stream(spark, folder, multiline=False, files=1)
    run_available(stream, store, RATES, scratch_path(spark, "progress"), survivor="greatest")
    return store.read(RATES)


@query
def rejected_rows(spark, sf_dir):
    """What becomes of all rates, some without a code or a value, after a part of them was
    stored: rows that are stored, and those that are kept with a reason."""
    store = _store(spark)
    append_new(store, stored_rates(spark, sf_dir), RATES)
    before = store.read(RATES).count()
    batch = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderpriority")).alias("currency_code"),
        iso_text(F.col("o_orderdate")).alias("exchange_date"),
        F.when(F.col("o_custkey") % 11 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("rate_value"),
    )
    append_new(store, batch, RATES, keep_rejected=True)
    added = store.read(RATES).agg((F.count("*") - before).alias("n_rows"))
    added = added.select(F.lit("stored").alias("reason"), F.lit(True).alias("stored"), "n_rows")
    kept = store.rejected(RATES).groupBy("reason", "stored").agg(F.count("*").alias("n_rows"))
    return silver.union_by_name(added, kept)
