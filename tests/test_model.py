"""Operator units for dimensions and facts on a hand-worked warehouse."""

import contextlib
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans.model import DIMENSIONS, FACTS, Model
from strata.plans.silver import CLEANERS
from strata.plans import facts
from tests.fixtures import raw

TS = "2018-03-{:02d} 10:00:00"


@pytest.fixture(scope="module")
def model(spark):
    r = {
        "customers": [("c1", "u1", "1", "city1", "sp"), ("c2", "u1", "2", "city2", "rj"), ("c3", "u2", "3", "city3", "mg")],
        "orders": [
            ("o1", "c1", "delivered", TS.format(5), TS.format(6), TS.format(7), TS.format(8), TS.format(10)),
            ("o2", "c2", "canceled", TS.format(4), "", "", "", TS.format(20)),
            ("o3", "c3", "cancelled", TS.format(3), "", "", "", TS.format(20)),
            ("o4", "c3", "unavailable", TS.format(6), "", "", "", TS.format(20)),
        ],
        "order_items": [
            ("o1", "1", "p1", "s1", TS.format(9), "10.00", "1.00"),
            ("o1", "2", "p2", "s1", TS.format(9), "20.01", "1.00"),
            ("o9", "1", "p1", "s2", TS.format(9), "5.00", "0.50"),
            ("o3", "1", "p3", "s2", TS.format(9), "7.00", "0.70"),
        ],
        "order_payments": [
            ("o1", "1", "credit_card", "2", "10.00"),
            ("o1", "2", "voucher", "1", "10.00"),
            ("o3", "1", "boleto", "1", ""),
            ("o3", "2", "debit_card", "1", "3.00"),
            ("o3", "x", "voucher", "1", "99.00"),
        ],
        "order_reviews": [
            ("r1", "o1", "2", "t", "good", TS.format(11), TS.format(12)),
            ("r2", "o1", "3", "t", "  ", TS.format(11), ""),
            ("r3", "o3", "1", "t", None, TS.format(11), TS.format(13)),
            ("r4", "o3", "2", "t", "ok", TS.format(14), TS.format(15)),
        ],
        "products": [("p1", "cat_a"), ("p2", "cat_b"), ("p3", None)],
        "sellers": [("s1", "10", "x", "sp"), ("s2", "20", "y", "rj")],
        "geolocation": [("10", "-1.5", "2", "b", "sp"), ("10", "-1.5", "3", "a", "sp"), ("20", None, "1", "c", "rj")],
        "category_translation": [("cat_a", "A"), ("cat_z", "Z")],
    }
    clean = {e: CLEANERS[e](raw(spark, e, rows)) for e, rows in r.items()}
    return Model(clean)


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_dim_order_status(model):
    got = rows(model["dim_order_status"], "order_status_code")
    assert {k: v["order_status_sk"] for k, v in got.items()} == {"canceled": 1, "cancelled": 2, "delivered": 3, "unavailable": 4}
    assert got["canceled"]["is_cancelled"] and got["cancelled"]["is_cancelled"]
    assert got["unavailable"]["is_closed"] and not got["unavailable"]["is_cancelled"]


def test_dim_date_sequential(model):
    d = model["dim_date"].orderBy("full_date").collect()
    assert [r["date_sk"] for r in d] == list(range(1, len(d) + 1))
    by_day = {r["full_date"].day: r for r in d}
    assert by_day[5]["day_of_week"] == 1 and by_day[4]["day_of_week"] == 7 and by_day[3]["is_weekend"]


def test_dim_customer_person(model):
    got = rows(model["dim_customer"], "customer_unique_id")
    assert set(got) == {"u1", "u2"}
    assert got["u1"]["customer_id_source"] == "c2" and got["u1"]["customer_city"] == "city2"
    assert got["u1"]["total_orders"] == 2 and got["u2"]["total_orders"] == 2
    assert [got["u1"]["customer_sk"], got["u2"]["customer_sk"]] == [1, 2]


def test_dim_seller_counts_items_without_order(model):
    got = rows(model["dim_seller"], "seller_id")
    assert got["s1"]["total_orders"] == 1 and got["s2"]["total_orders"] == 2
    assert got["s2"]["first_order_date_sk"] == got["s2"]["last_order_date_sk"]


def test_dim_product_category(model):
    got = rows(model["dim_product_category"], "product_category_name")
    assert {k: v["product_category_name_en"] for k, v in got.items()} == {"cat_a": "A", "cat_b": None, "cat_z": "Z"}


def test_dim_payment_type(model):
    got = rows(model["dim_payment_type"], "payment_type_code")
    assert got["credit_card"]["is_installment"] and not got["voucher"]["is_installment"]


def test_dim_geolocation(model):
    got = rows(model["dim_geolocation"], "zip_code_prefix")
    assert got["00010"]["geolocation_lng"] == Decimal("3") and got["00010"]["geolocation_city"] == "a"
    assert got["00020"]["geolocation_lat"] is None


def test_main_payment_ties(model):
    mp = facts.main_payment(model.clean["order_payments"], model["dim_payment_type"])
    types = rows(model["dim_payment_type"], "payment_type_sk")
    got = {r["order_id"]: types[r["main_payment_type_sk"]]["payment_type_code"] for r in mp.collect()}
    assert got == {"o1": "credit_card", "o3": "voucher"}  # NULL sequence row still competes on value


def test_fact_orders(model):
    got = rows(model["fact_orders"], "order_id")
    o1, o2 = got["o1"], got["o2"]
    assert o1["total_items"] == 2 and o1["total_gross_revenue"] == Decimal("30.01")
    assert o1["avg_item_price"] == Decimal("15.01") and o1["total_payment_value"] == Decimal("20.00")
    assert o1["days_delivery"] == 3 and o1["days_delay_vs_estimated"] == -2 and o1["review_score"] == 3
    assert o2["total_items"] == 0 and o2["total_gross_revenue"] == Decimal("0.00") and o2["avg_item_price"] is None
    assert o2["total_payment_value"] == Decimal("0.00") and o2["review_score"] is None
    assert got["o3"]["review_score"] == 2
    assert got["o1"]["customer_sk"] == got["o2"]["customer_sk"]


def test_fact_order_items(model):
    f = model["fact_order_items"].collect()
    assert len(f) == 4
    o9 = [r for r in f if r["order_id"] == "o9"][0]
    assert o9["order_date_sk"] is None and o9["customer_sk"] is None and o9["seller_sk"] is not None
    assert sum(r["item_price"] for r in f) == Decimal("42.01")
    assert all(r["item_qty"] == 1 and r["item_gross_revenue"] == r["item_price"] for r in f)


def test_fact_payments_and_reviews(model):
    p = model["fact_payments"].collect()
    assert len(p) == 4  # the NULL-sequence payment is not a fact row
    rv = rows(model["fact_reviews"], "review_id")
    assert rv["r1"]["has_comment"] and not rv["r2"]["has_comment"] and not rv["r3"]["has_comment"]
    assert rv["r2"]["review_answer_date_sk"] is None


def test_fact_grain_and_no_fanout(model):
    items = model.clean["order_items"]
    grain = items.where(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull()).count()
    assert model["fact_order_items"].count() == grain
    assert model["fact_orders"].count() == model.clean["orders"].count()


def test_customer_map_needs_no_dimension(model):
    """Person keys without the dimension are the dimension's keys."""
    from strata.plans import dims

    alone = {r["customer_unique_id"]: r["customer_sk"] for r in dims.customer_keys(model.clean["customers"]).collect()}
    assert alone == {r["customer_unique_id"]: r["customer_sk"] for r in model["dim_customer"].collect()}


def test_ids_that_agree_in_their_declared_length_count_once(spark):
    from strata.plans import dims
    from strata.plans.silver import clean_customers, clean_orders

    start = "o" * 32
    cust = clean_customers(raw(spark, "customers", [("c1", "u1"), ("c2", "u1")]))
    orders = clean_orders(raw(spark, "orders", [(start + "1", "c1", "delivered", TS.format(5)), (start + "2", "c2", "delivered", TS.format(6))]))
    assert orders.count() == 2
    assert [r["total_orders"] for r in dims.customer_orders(cust, orders).collect()] == [1]


def test_item_without_an_order_row_has_its_payment_and_score(spark):
    entities = {
        "customers": [("c1", "u1")],
        "orders": [("o1", "c1", "delivered", TS.format(5))],
        "order_items": [("o1", "1", "p1", "s1", "", "1.00", "1.00"), ("o9", "1", "p1", "s1", "", "2.00", "1.00")],
        "order_payments": [("o9", "1", "voucher", "1", "2.00")],
        "order_reviews": [("r1", "o9", "5")],
        "products": [("p1",)],
        "sellers": [("s1",)],
        "geolocation": [],
        "category_translation": [],
    }
    m = Model({e: CLEANERS[e](raw(spark, e, r)) for e, r in entities.items()})
    got = rows(m["fact_order_items"], "order_id")
    assert len(got) == 2
    assert got["o9"]["main_payment_type_sk"] == 1 and got["o9"]["review_score"] == 5 and got["o9"]["customer_sk"] is None
    assert got["o1"]["main_payment_type_sk"] is None and got["o1"]["customer_sk"] == 1


def test_dim_customer_order_under_two_ids(spark):
    """Appended clean runs: one order id under two customer ids of the same
    person counts once on the exact path."""
    from strata.plans import dims
    from strata.plans.silver import clean_customers, clean_orders

    cust = clean_customers(raw(spark, "customers", [("c1", "u1"), ("c2", "u1"), ("c3", "u2")]))
    run1 = clean_orders(raw(spark, "orders", [("o1", "c1", "delivered", TS.format(5))]))
    run2 = clean_orders(raw(spark, "orders", [("o1", "c2", "delivered", TS.format(6))]))
    orders = run1.unionByName(run2)
    dd = dims.dim_date(orders, clean_orders(raw(spark, "orders", [])).select(
        F.lit(None).cast("timestamp_ntz").alias("review_creation_date"),
        F.lit(None).cast("timestamp_ntz").alias("review_answer_timestamp")))
    got = {r["customer_unique_id"]: r["total_orders"] for r in dims.dim_customer(cust, orders, dd).collect()}
    assert got == {"u1": 1, "u2": 0}


@contextlib.contextmanager
def jobs_started(spark):
    """Counts the jobs started inside the block."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        yield lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_model_that_keeps_nothing_is_lazy(spark, model):
    """Defining every table starts no job; read, they are those of the other model."""
    lazy = Model(model.clean, keep=False)
    with jobs_started(spark) as started:
        for table in DIMENSIONS + FACTS:
            lazy[table].createOrReplaceTempView(f"lazy_{table}")
    assert started() == 0
    for table in ("dim_customer", "dim_order_status", "fact_payments"):
        assert sorted(map(str, spark.table(f"lazy_{table}").collect())) == sorted(map(str, model[table].collect()))
