"""Operator semantics on small tables, hazard by hazard."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from landing import day, rows_of
from tidemark.functions import safe_symbol, whole_number
from tidemark.operators import checks, dedup, incremental, planning, scale, silver
from tidemark.schemas import FINE_PRICE_TYPE
from tidemark.sources import universe


def bars(spark, *rows):
    """(ticker, date, close) rows as vendor bars."""
    return spark.createDataFrame(
        [(t, d, 1.0, 1.0, 1.0, c, 10.0) for t, d, c in rows],
        "symbol string, date string, open double, high double, low double, close double, "
        "volume double",
    )


def facts(spark, *rows):
    return spark.createDataFrame(
        [(k, day(d), v) for k, d, v in rows], "k string, d date, v int"
    )


# Cleaning


def test_h1_price_that_rounds_to_zero_is_dropped_at_scale_two_only(spark):
    rows = bars(spark, ("A", "2025-01-02", 0.001), ("B", "2025-01-02", 0.005))
    assert [r.ticker for r in silver.clean_bars(rows).collect()] == ["B"]
    fine = silver.clean_bars(rows, price=FINE_PRICE_TYPE).orderBy("ticker").collect()
    assert [r.close_price for r in fine] == [Decimal("0.0010"), Decimal("0.0050")]


def test_h4_unreadable_values_are_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = bars(spark, ("A", "Date", 1.0), (None, "2025-01-02", 1.0), ("C", "2025-01-02", 1.0))
    assert [r.ticker for r in silver.clean_bars(rows).collect()] == ["C"]


def test_h13_increment_with_null_zero_or_nan_close_is_dropped(spark):
    rows = bars(
        spark,
        ("A", "2025-01-02", None),
        ("B", "2025-01-02", 0.0),
        ("C", "2025-01-02", float("nan")),
        ("D", "2025-01-02", -1.0),
        ("E", "2025-01-02", 1.0),
    )
    assert [r.ticker for r in silver.clean_bars(rows).collect()] == ["E"]


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("string", "1200", 1200),
        ("string", "1200.0", 1200),
        ("string", "1200.9", 1200),
        ("string", "9007199254740993", 9007199254740993),
        ("string", "x", None),
        ("string", "", None),
        ("string", None, None),
        ("double", 1200.9, 1200),
        ("double", float("nan"), None),
        ("double", 1e300, None),
        ("int", 7, 7),
    ],
)
def test_whole_number(spark, kind, value, expected):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    assert df.select(whole_number(F.col("v"), df.schema["v"].dataType)).first()[0] == expected


def test_date_text_with_a_time_part(spark):
    rows = bars(spark, ("A", "2025-01-02 00:00:00+00:00", 1.0))
    assert silver.clean_bars(rows).first()["trade_date"] == day("2025-01-02")


def test_safe_symbol(spark):
    df = spark.createDataFrame([("^GSPC",), ("GC=F",), ("BRK-B",), ("AAPL",)], "s string")
    names = [r[0] for r in df.select(safe_symbol(F.col("s"))).collect()]
    assert names == ["IDX_GSPC", "GCFUT_F", "BRK_B", "AAPL"]


def test_rename(spark):
    renamed = silver.rename_bars(bars(spark, ("A", "2025-01-02", 1.0)))
    assert renamed.columns == [
        "ticker", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume"
    ]


def test_wide_to_long_drops_empty_cells(spark):
    wide = spark.createDataFrame(
        [("2025-01-02", 1.0, 10, 2.0), ("2025-01-03", None, None, 3.0)],
        "day string, a_close double, a_volume int, b_close double",
    )
    series = {"A": {"close": "a_close", "volume": "a_volume"}, "B": {"close": "b_close"}}
    assert sorted(map(str, (tuple(r) for r in silver.wide_to_long(wide, ["day"], series).collect()))) == [
        "('2025-01-02', 'A', 1.0, 10)",
        "('2025-01-02', 'B', 2.0, None)",
        "('2025-01-03', 'B', 3.0, None)",
    ]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2, True)], "s string, n int, more boolean")
    assert [tuple(r) for r in silver.union_by_name(a, b).orderBy("n").collect()] == [
        (1, "x", None),
        (2, "y", True),
    ]


# Duplicates


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_h9_survivor_does_not_depend_on_partitioning(spark, parts):
    rows = [("A", "2025-01-02", v) for v in (3, 9, 1, 7)] + [("B", "2025-01-02", None)]
    df = facts(spark, *rows).repartition(parts)
    assert rows_of(dedup.one_per_key(df, ["k", "d"])) == [
        ("A", day("2025-01-02"), 9),
        ("B", day("2025-01-02"), None),
    ]
    first = dedup.one_per_key(df.filter("k = 'A'"), ["k", "d"], keep="first")
    assert first.first()["v"] == 1


def test_one_per_key_prefers_before_other_columns(spark):
    df = facts(spark, ("A", "2025-01-02", 9), ("A", "2025-01-05", 1))
    assert dedup.one_per_key(df, ["k"], prefer=["d"]).first()["v"] == 1


def test_one_per_key_of_key_columns_only(spark):
    df = facts(spark, ("A", "2025-01-02", 9), ("A", "2025-01-02", 1)).select("k", "d")
    assert dedup.one_per_key(df, ["k", "d"]).count() == 1


def test_last_n_per_key_matches_brute_force(spark):
    rows = [(f"k{i % 3}", i // 4, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, d int, v int").repartition(7)
    expected = sorted(
        row
        for key in ("k0", "k1", "k2")
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))[-5:]
    )
    assert rows_of(dedup.last_n_per_key(df, "k", ["d", "v"], 5, splits=3)) == expected


# Watermarks


def test_h6_table_and_key_watermarks(spark):
    stored = facts(spark, ("USD", "2025-01-03", 1), ("EUR", "2025-01-01", 1))
    batch = facts(
        spark,
        *((k, d, 2) for k in ("USD", "EUR") for d in ("2025-01-01", "2025-01-02", "2025-01-03")),
        ("NEW", "2019-12-31", 2),
        ("NEW", "2020-01-02", 2),
    )
    mark = incremental.watermark(stored, "d")
    assert incremental.newer_than_table(batch, mark, "d").isEmpty()
    marks = incremental.watermark_per_key(stored, "k", "d")
    newer = incremental.newer_than_per_key(batch, marks, "k", "d", default=date(2020, 1, 1))
    assert [(r.k, str(r.d)) for r in newer.orderBy("k", "d").collect()] == [
        ("EUR", "2025-01-02"),
        ("EUR", "2025-01-03"),
        ("NEW", "2020-01-02"),
    ]


def test_strictly_newer_than_the_watermark(spark):
    stored = facts(spark, ("A", "2025-01-02", 1))
    batch = facts(spark, *(("A", f"2025-01-0{n}", 2) for n in (1, 2, 3)))
    newer = incremental.newer_than_table(batch, incremental.watermark(stored, "d"), "d")
    assert [str(r.d) for r in newer.collect()] == ["2025-01-03"]


def test_watermark_of_nothing_is_the_default(spark):
    empty = facts(spark)
    assert incremental.watermark(empty, "d").first()[0] == date(2020, 1, 1)
    proxy = incremental.proxy_watermark(empty, "k", "AAPL", "d")
    assert proxy.first()[0] == date(2025, 1, 1)
    stored = facts(spark, ("AAPL", "2025-03-01", 1), ("TSLA", "2025-04-01", 1))
    assert incremental.proxy_watermark(stored, "k", "AAPL", "d").first()[0] == day("2025-03-01")
    marks = {"a": incremental.watermark(stored, "d"), "b": incremental.watermark(empty, "d")}
    assert incremental.least_watermark(marks).first()[0] == date(2020, 1, 1)
    newer = incremental.newer_than_per_key(
        stored, incremental.watermark_per_key(empty, "k", "d"), "k", "d"
    )
    assert newer.count() == 2


def test_h8_append_twice_adds_nothing(spark):
    stored = facts(spark, ("A", "2025-01-01", 1))
    batch = facts(spark, ("A", "2025-01-01", 5), ("A", "2025-01-02", 5), ("A", "2025-01-02", 6))
    once = incremental.appended(stored, batch, ["k", "d"])
    assert rows_of(once) == [("A", day("2025-01-01"), 1), ("A", day("2025-01-02"), 6)]
    assert rows_of(incremental.appended(once, batch, ["k", "d"])) == rows_of(once)


def test_two_halves_equal_the_whole(spark):
    stored = facts(spark, ("A", "2025-01-01", 1))
    batch = facts(spark, *((k, f"2025-01-0{n}", n) for k in "AB" for n in range(1, 8)))
    keys = ["k", "d"]
    first = incremental.appended(stored, batch.filter("v % 2 = 0"), keys)
    halves = incremental.appended(first, batch.filter("v % 2 = 1"), keys)
    assert rows_of(halves) == rows_of(incremental.appended(stored, batch, keys))


# Plans


@pytest.mark.parametrize("n", [1, 60, 61])
def test_chunks_are_consecutive_and_full(spark, n):
    keys = spark.createDataFrame([(f"K{i:03d}",) for i in range(n)], "k string").repartition(5)
    chunks = planning.chunk_keys(keys, ["k"]).collect()
    assert sorted((r.k, r.chunk_id) for r in chunks) == [
        (f"K{i:03d}", i // 30) for i in range(n)
    ]


def test_ordinal_over_many_partitions(spark):
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_000).alias("n"))
    # Without this the eight small partitions of the sort would be merged into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = scale.with_ordinal(df, ["n"], "place")
        assert placed.rdd.getNumPartitions() == 8
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert placed.columns == ["n", "place"]
    assert placed.filter("n <> place").isEmpty() and placed.count() == 20_000


def test_fetch_plan(spark):
    keys = spark.createDataFrame([(f"K{i:03d}",) for i in range(61)], "k string")
    marks = spark.createDataFrame(
        [(f"K{i:03d}", day("2025-01-10" if i else "2025-01-02")) for i in range(60)],
        "k string, watermark date",
    )
    plan = planning.fetch_plan(keys, marks, "k", day("2025-01-11")).orderBy("chunk_id").collect()
    # The second chunk would start on the day itself, so it is absent.
    assert [(r.chunk_id, r.n_keys, str(r.start_date), str(r.end_date)) for r in plan] == [
        (0, 30, "2025-01-03", "2025-01-11"),
        (2, 1, "2024-01-02", "2025-01-11"),
    ]
    assert plan[1]["keys"] == ["K060"]


def test_backfill_plan(spark):
    codes = spark.createDataFrame([("A",), ("B",)], "code string")
    landed = spark.createDataFrame([("A", 2020)], "code string, year int")
    plan = planning.backfill_plan(codes, landed, "code", 2020, 2021)
    assert [tuple(map(str, r)) for r in plan.orderBy("code", "year").collect()] == [
        ("A", "2021", "2021-01-01", "2021-12-31"),
        ("B", "2020", "2020-01-01", "2020-12-31"),
        ("B", "2021", "2021-01-01", "2021-12-31"),
    ]


def test_ranges(spark):
    df = facts(spark, *(("A", f"2025-01-0{n}", n) for n in range(1, 6)))
    half_open = planning.in_range(df, "d", day("2025-01-02"), day("2025-01-04"))
    assert sorted(r.v for r in half_open.collect()) == [2, 3]
    closed = planning.in_range(df, "d", day("2025-01-02"), day("2025-01-04"), closed=True)
    assert sorted(r.v for r in closed.collect()) == [2, 3, 4]
    assert [r.v for r in planning.on_date(df, "d", day("2025-01-05")).collect()] == [5]


def test_symbol_subset_by_list_and_by_table(spark):
    df = facts(spark, *((k, "2025-01-01", 1) for k in "ABC"))
    assert [r.k for r in planning.symbol_subset(df, "k", ["B"]).collect()] == ["B"]
    table = spark.createDataFrame([("C",), ("C",)], "k string")
    assert [r.k for r in planning.symbol_subset(df, "k", table).collect()] == ["C"]


# Gates and audits


@pytest.mark.parametrize(
    "moment, status",
    [
        (datetime(2025, 1, 3, 21, 59), "WAIT"),
        (datetime(2025, 1, 3, 22, 0), "RUN"),
        (datetime(2025, 1, 2, 23, 0), "UP_TO_DATE"),
        (datetime(2025, 1, 6, 1, 0), "RUN"),
    ],
)
def test_session_gate(spark, moment, status):
    mark = spark.createDataFrame([(day("2025-01-02"),)], "watermark date")
    assert checks.session_gate(mark, [moment]).first()["status"] == status


@pytest.mark.parametrize("hour, kept", [(15, [1]), (21, [1]), (22, [1, 2])])
def test_closed_sessions(spark, hour, kept):
    df = facts(spark, ("A", "2025-01-02", 1), ("A", "2025-01-03", 2))
    closed = checks.closed_sessions(df, "d", datetime(2025, 1, 3, hour, 0))
    assert sorted(r.v for r in closed.collect()) == kept


def test_load_gate(spark):
    source = spark.createDataFrame([(day("2025-01-03"),)], "latest_date date")
    for mark, needs in (("2025-01-02", True), ("2025-01-03", False)):
        least = spark.createDataFrame([(day(mark),)], "watermark date")
        assert checks.load_gate(source, least).first()["needs_load"] is needs
    nothing = spark.createDataFrame([(None,)], "latest_date date")
    assert checks.load_gate(nothing, least).first()["needs_load"] is False


def test_freshness_and_audit(spark):
    df = facts(spark, ("A", "2025-01-02", 1), ("A", "2025-01-03", 2))
    sources = {"full": (df, "d"), "none": (df.filter("v > 5"), "d")}
    fresh = checks.freshness(sources, day("2025-01-03")).orderBy("dataset").collect()
    assert [(r.dataset, r.status) for r in fresh] == [("full", "AVAILABLE"), ("none", "NOT YET")]
    audit = checks.load_audit(sources).orderBy("dataset").collect()
    assert [(r.n_rows, r.status) for r in audit] == [(2, "LOADED"), (0, "EMPTY")]


def test_top_keys_break_ties_by_key(spark):
    df = facts(spark, *((k, "2025-01-01", 1) for k in "CCBBAD"))
    assert [tuple(r) for r in checks.top_keys(df, "k", 3).collect()] == [
        ("B", 2),
        ("C", 2),
        ("A", 1),
    ]


# Reference lists


def test_universe_sizes(spark):
    assert len(universe.CURRENCIES) == 30
    groups = (universe.HISTORY_GROUPS, universe.INCREMENT_GROUPS)
    assert [sum(map(len, g.values())) for g in groups] == [125, 121]
    assert len(set(universe.SCHEDULED)) == len(universe.SCHEDULED) == 126
    assert universe.instruments(spark, universe.HISTORY_GROUPS).count() == 125
    assert universe.currencies(spark).count() == 30


def test_scheduled_order(spark):
    order = [r.ticker for r in universe.scheduled(spark).orderBy("position").collect()]
    assert order[:3] == ["11B.WA", "AAPL", "ABBV"]
    assert order[order.index("DBC") + 1] == "^DJI"
    assert order[order.index("UNH") + 1 :][:2] == ["UNI7083-USD", "UNI-USD"]
    assert order[-1] == "ZW=F"


# Sizes


def test_lookup_side_is_broadcast_only_within_the_limit(spark):
    big = spark.range(100_000).select(F.col("id").alias("k"))
    side = spark.createDataFrame([(1, "x"), (2, None)], "k long, name string")
    assert scale.measured_bytes(side) == 2 * 32 + 1
    for limit, hinted in ((65, True), (64, False)):
        joined = big.join(scale.lookup_side(side, limit), "k", "left")
        logical = joined._jdf.queryExecution().analyzed().toString()
        assert ("ResolvedHint" in logical) is hinted


@pytest.mark.parametrize("limit", [scale.BROADCAST_BYTES, 0])
def test_lookup_join_matches_a_plain_join(spark, limit):
    """Key 7 holds a third of the rows; some rows have no key, some match nothing."""
    rows = spark.range(0, 9000, 1, 6).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 50 != 1, F.col("id") % 4000)
        .cast("long")
        .alias("k"),
    )
    side = spark.range(0, 3500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = scale.lookup_join(rows, side, "k", limit, most=500)
    assert joined.columns == ["k", "id", "v"]
    plain = rows.join(side, "k", "left").select("k", "id", "v")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_heavy_keys_stay_out_of_the_shuffled_join(spark):
    rows = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in scale.heavy_keys(rows, "k", most=500).collect()] == [-1]
    assert scale.heavy_keys(rows.filter("k < -5"), "k", most=500).isEmpty()
    assert scale.heavy_keys(rows, "k").isEmpty()


def test_measured_bytes_of_nested_values(spark):
    rows = spark.range(10).select(F.array_repeat(F.lit(7), 1000).alias("a"), F.struct(F.repeat(F.lit("x"), 500).alias("t")).alias("s"))
    assert scale.measured_bytes(rows) >= 10 * (8 * 1000 + 500)


@pytest.mark.parametrize("n", [3, 40, 90, 5000])
def test_last_n_beyond_what_is_ranked(spark, monkeypatch, n):
    from tidemark.operators import dedup

    monkeypatch.setattr(dedup, "RANKED", 2)
    rows = [("a", i % 23, i) for i in range(300)] + [("b", 5, i) for i in range(60)] + [("c", None, 1), ("c", 1, 2), (None, 3, 4)]
    df = spark.createDataFrame(rows, "k string, d int, v int").repartition(4)
    dated = df.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")).cast("timestamp"))
    for table, columns in ((df, ["d", "v"]), (dated, ["d", "v"])):
        got = sorted(map(str, dedup.last_n_per_key(table, "k", columns, n).collect()))
        every = {}
        for r in table.collect():
            every.setdefault(r.k, []).append(r)
        low = date(1, 1, 1)
        order = lambda r: (r.d is not None, r.d if r.d is not None else 0, r.v)
        wanted = [r for group in every.values() for r in sorted(group, key=order, reverse=True)[:n]]
        assert got == sorted(map(str, wanted)), low


def test_large_n_sorts_no_whole_series(spark):
    from tidemark.operators import dedup

    df = spark.range(100).selectExpr("'a' AS k", "DATE'2024-01-01' + CAST(id % 50 AS INT) AS d", "id AS v")
    plan = dedup.last_n_per_key(df, "k", ["d", "v"], 5000)._jdf.queryExecution().optimizedPlan().toString()
    windows = plan.count("Window [")
    assert windows == 2 and plan.count("Filter") >= 2  # both over the rows of the last day
