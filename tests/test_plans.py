"""Plan shape: pruned scans, date keys without joins, aggregate-before-join."""

import os

import pytest

from strata.catalog import Tables

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables(spark):
    if not os.path.exists(SF):
        pytest.skip("benchmark tables not present")
    return Tables(spark, SF)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(tables):
    plan = _plan(tables.clean("order_items"))
    schema = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    for unused in ("l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert unused not in schema


def test_mean_score_does_not_read_texts(spark):
    from strata.catalog import REGISTRY

    plan = _plan(REGISTRY["mean_score"].run(spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        read = line[line.index("ReadSchema") :]
        assert "text" not in read and "source" not in read


@pytest.mark.parametrize("fact", ["fact_order_items", "fact_orders", "fact_payments", "fact_reviews"])
def test_facts_find_date_keys_without_a_join(tables, fact):
    plan = tables.model[fact]._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
    assert not [line for line in plan.splitlines() if "Join" in line and ("full_date" in line or "as date)" in line)]


def test_fact_orders_aggregates_items_before_join(tables):
    plan = _plan(tables.model["fact_orders"])
    lines = plan.splitlines()
    # the per-order item aggregate (partial then final) feeds a join on order_id
    assert any("partial_count(order_item_id" in line for line in lines)
    assert not any("Join" in line and "order_item_id" in line for line in lines)
