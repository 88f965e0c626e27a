"""What is asked of a database, without one: options and query texts."""

from datetime import date

import pytest

from tidemark.schemas import BARS, RATES
from tidemark.sources.stores import JdbcStore, max_date_query, table_missing

OPTIONS = {"url": "jdbc:postgresql://host/db", "user": "u", "password": "p", "driver": "d"}


@pytest.fixture
def store(spark):
    return JdbcStore(spark, OPTIONS, partitions=4, column_types={BARS.name: "ticker VARCHAR(32)"})


def test_a_dated_read_is_split_by_date(store):
    options = store.read_options(BARS, date(2020, 1, 1), date(2025, 1, 1))
    assert options == {
        **OPTIONS,
        "dbtable": "f_stock_prices",
        "partitionColumn": "trade_date",
        "lowerBound": "2020-01-01",
        "upperBound": "2025-01-01",
        "numPartitions": "4",
    }


@pytest.mark.parametrize("dates", [(), (date(2025, 1, 1),), (date(2025, 1, 1), date(2025, 1, 1))])
def test_other_reads_are_not_split(store, dates):
    assert store.read_options(RATES, *dates) == {**OPTIONS, "dbtable": "f_currency_rates"}


def test_write_options(store):
    options = store.write_options(BARS)
    assert options["batchsize"] == "10000" and options["numPartitions"] == "4"
    assert options["createTableColumnTypes"] == "ticker VARCHAR(32)"
    assert "createTableColumnTypes" not in store.write_options(RATES)


def test_watermark_queries_are_valid_sql(spark):
    """Run as Spark SQL over a view of the table's name."""
    rows = [("A'B", date(2025, 1, 2)), ("A'B", date(2025, 1, 5)), ("C", date(2025, 1, 3))]
    spark.createDataFrame(rows, "ticker string, trade_date date").createOrReplaceTempView("bars_v")

    def ask(*args):
        return sorted(map(tuple, spark.sql(f"SELECT * FROM {max_date_query('bars_v', *args)}").collect()))

    assert ask("trade_date") == [(date(2025, 1, 5),)]
    assert ask("trade_date", "ticker", "C") == [(date(2025, 1, 3),)]
    assert ask("trade_date", "ticker") == [("A'B", date(2025, 1, 5)), ("C", date(2025, 1, 3))]
    assert max_date_query("t", "d", "k", "A'B").endswith("WHERE k = 'A''B') sub")


@pytest.mark.parametrize(
    ("state", "missing"), [("42P01", True), ("42S02", True), ("28000", False), (None, False)]
)
def test_a_missing_table_is_told_by_the_sql_error_however_deep(spark, state, missing):
    class Raised(Exception):
        def __init__(self, cause):
            self.java_exception = cause

    jvm = spark.sparkContext._jvm
    error = jvm.java.sql.SQLException("no such table", state)
    assert table_missing(spark, Raised(error)) is missing
    wrapped = jvm.java.lang.RuntimeException("outer", jvm.java.lang.IllegalStateException("inner", error))
    assert table_missing(spark, Raised(wrapped)) is missing
    assert table_missing(spark, Raised(jvm.java.lang.RuntimeException("no sql"))) is False


def test_an_undated_read_asks_for_its_bounds(spark, store, monkeypatch):
    from datetime import date as day

    from tidemark.sources import stores

    asked = []

    def answer(self, options):
        asked.append(dict(options))
        if "MIN(" in options["dbtable"]:
            return spark.createDataFrame([(day(2020, 1, 2), day(2024, 5, 6))], "low date, high date")
        return spark.createDataFrame([], RATES.schema)

    monkeypatch.setattr(stores.JdbcStore, "_stored", answer)
    assert store.read(RATES).isEmpty()
    assert asked[0]["dbtable"] == "(SELECT MIN(exchange_date) AS low, MAX(exchange_date) AS high FROM f_currency_rates) sub"
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("2020-01-02", "2024-05-06", "4")
    asked.clear()
    store.read(RATES, since=day(2023, 1, 1))
    assert (asked[1]["lowerBound"], asked[1]["upperBound"]) == ("2023-01-01", "2024-05-06")
