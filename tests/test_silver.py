"""Operator units for the clean layer (dedupe, key filters, look-alikes)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.plans import silver
from tests.fixtures import raw


def test_blank_keys_dropped_and_latest_kept(spark):
    r = raw(spark, "sellers", [
        ("s1", "1", "a", "sp"),
        ("  ", "2", "b", "rj"),
        (None, "3", "c", "mg"),
        ("s1 ", "4", "d", "ba"),   # same key after trim, later row wins
        ("s2", "123456", "x" * 90, "s"),
    ])
    out = {r["seller_id"]: r for r in silver.clean_sellers(r).collect()}
    assert set(out) == {"s1", "s2"}
    assert out["s1"]["seller_zip_code_prefix"] == "00004" and out["s1"]["seller_state"] == "BA"
    assert out["s2"]["seller_zip_code_prefix"] == "12345" and len(out["s2"]["seller_city"]) == 80


def test_dedupe_by_position_across_files_and_partitions(spark):
    a = raw(spark, "products", [("p1", "old"), ("p2", "x")], file_no=0)
    b = raw(spark, "products", [("p1", "new")], file_no=1)
    both = a.unionByName(b)
    for parts in (1, 3, 7):
        got = {r["product_id"]: r["product_category_name"] for r in silver.clean_products(both.repartition(parts)).collect()}
        assert got == {"p1": "new", "p2": "x"}


def test_dedupe_by_value_then_position(spark):
    r = raw(spark, "orders", [
        ("o1", "c1", "delivered", "2018-01-02 00:00:00"),
        ("o1", "c2", "delivered", "2018-01-01 00:00:00"),  # later row, older time: loses
        ("o2", "c1", "SHIPPED", "2018-13-01 00:00:00"),     # invalid time loses to any valid one
        ("o2", "c2", "shipped", "2017-01-01 00:00:00"),
        ("o3", "c1", "x", None),
        ("o3", "c9", "y", None),                             # all invalid: latest row wins
    ])
    got = {r["order_id"]: (r["customer_id"], r["order_status"]) for r in silver.clean_orders(r).collect()}
    assert got == {"o1": ("c1", "delivered"), "o2": ("c2", "shipped"), "o3": ("c9", "y")}


def test_lookalike_keys_survive(spark):
    items = raw(spark, "order_items", [
        ("o1", "1", "p", "s", "2018-01-01 00:00:00", "1.00", "0.5"),
        ("o1", "01", "p", "s", "2018-01-01 00:00:00", "2.00", "0.5"),
        ("o1", "x1", "p", "s", "2018-01-01 00:00:00", "3.00", "0.5"),
    ])
    rows = silver.clean_order_items(items).collect()
    assert sorted((r["order_item_id"], r["price"]) for r in rows if r["order_item_id"] is not None) == [
        (1, Decimal("1.00")), (1, Decimal("2.00"))]
    assert len(rows) == 3  # the unparseable id stays (NULL) in the clean layer

    geo = raw(spark, "geolocation", [
        ("1234", "-1.5", "2.5", "a", "sp"),
        ("01234", "-1.5", "2.5", "a", "SP"),
        ("1234", "-1.5", "2.5", "a", "sp"),     # exact repeat collapses
        ("", "", "", "", ""),                   # blank key kept (no key filter)
    ])
    g = silver.clean_geolocation(geo).collect()
    assert len(g) == 3
    assert sum(1 for r in g if r["geolocation_zip_code_prefix"] == "01234") == 2


def test_reviews_two_timestamp_order(spark):
    r = raw(spark, "order_reviews", [
        ("r1", "o1", "5", "t", "m", "2018-01-01 00:00:00", "2018-01-05 00:00:00"),
        ("r1", "o1", "1", "t", "m", "2018-01-02 00:00:00", "2018-01-05 00:00:00"),  # same answer, newer creation
        ("r1", "o1", "3", "t", "m", "2018-01-09 00:00:00", ""),                     # no answer: loses
    ])
    (row,) = silver.clean_order_reviews(r).collect()
    assert row["review_score"] == 1 and row["review_creation_date"] == dt.datetime(2018, 1, 2)


def test_clean_is_idempotent(spark):
    r = raw(spark, "customers", [("c1", "u1", "1", "x", "sp"), ("c1", "u2", "2", "y", "rj"), ("c2", None, None, None, None)])
    once = silver.clean_customers(r)
    again = silver.clean_customers(once.withColumn("_ingest_pos", F.struct(F.lit(0))))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    got = {x["customer_id"]: x["customer_unique_id"] for x in once.collect()}
    assert got == {"c1": "u2", "c2": None}  # greatest unique id wins
