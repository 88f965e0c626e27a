"""Physical plans: what is pushed, what is broadcast, what is combined before a shuffle."""

import re

import pytest

from crosscheck.queries import QUERIES
from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def plan_of(spark):
    plans = {}

    def plan(name):
        if name not in plans:
            df = QUERIES[name](spark, SF_DIR)
            plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plans[name]

    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cartesian_product(plan_of, name):
    plan = plan_of(name)
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert node not in plan, node


@pytest.mark.parametrize(
    "name",
    ["rates_flatten", "rates_float", "gold_normalise", "spread_calc", "clean_bars", "bars_hiprec",
     "bars_rename", "date_text_roundtrip", "safe_name", "drop_all_null", "valid_prices",
     "json_field", "rows_on_date", "date_range", "symbol_subset", "closed_sessions",
     "multi_source_union", "append_new_table"],
)
def test_row_wise_queries_do_not_shuffle(plan_of, name):
    # A scalar subquery ends in the single row of its final aggregate.
    main = plan_of(name).split("Subquery")[0]
    assert "Exchange" not in main


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("rows_on_date", "GreaterThanOrEqual(o_orderdate"),
        ("rows_on_date", "LessThan(o_orderdate"),
        ("date_range", "LessThan(l_shipdate"),
        ("closed_sessions", "LessThan(ts"),
        ("symbol_subset", "In(o_orderpriority"),
        ("watermark_proxy_key", "EqualTo(l_suppkey,7)"),
        ("multi_source_union", "LessThan(o_orderdate"),
    ],
)
def test_filters_reach_the_scan(plan_of, name, pushed):
    assert any(pushed in found for found in re.findall(r"PushedFilters: \[(.*?)\], ", plan_of(name)))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("watermark_table", {"o_orderdate"}),
        ("watermark_per_key", {"l_suppkey", "l_shipdate"}),
        ("rows_per_key", {"o_orderpriority"}),
        ("topk_keys", {"l_suppkey"}),
        ("freshness", {"o_orderdate", "l_shipdate", "ts"}),
        ("json_field", {"event_id", "props"}),
    ],
)
def test_only_needed_columns_are_read(plan_of, name, columns):
    read = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(name))
    assert {c.split(":")[0] for schema in read for c in schema.split(",")} == columns


def test_top_keys_do_not_sort_everything(plan_of):
    assert "TakeOrderedAndProject" in plan_of("topk_keys")
    assert "TakeOrderedAndProject" in plan_of("preview_rows")


def test_small_lookups_are_broadcast(plan_of):
    for name in ("append_new_per_key", "bars_with_group", "instrument_dim"):
        assert "BroadcastHashJoin" in plan_of(name), name


def test_last_rows_are_limited_before_each_shuffle(plan_of):
    plan = plan_of("last_n_per_key")
    assert plan.count("WindowGroupLimit") == 4
    assert plan.count("Partial") == 2


def test_rows_are_combined_before_the_dedup_shuffle(plan_of):
    for name in ("dedup_key", "append_idempotent"):
        assert re.search(r"partial_max", plan_of(name)), name
