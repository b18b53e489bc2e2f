"""What the dedupe of the clean layer and the joins of the item fact shuffle: no
raw text beside its typed value, and no row that is wider than its join needs."""

import pytest
from pyspark.sql import functions as F

from strata.plans import facts
from strata.plans.silver import CLEANERS
from strata.sources.schemas import CLEAN_TYPES, INGEST_POS, KEYS, UNKEYED
from tests.fixtures import raw


def _nodes(node, name):
    children = node.children()
    found = [node] if node.nodeName() == name else []
    return found + [n for i in range(children.size()) for n in _nodes(children.apply(i), name)]


def _columns(node):
    out = node.output()
    return [(out.apply(i).name(), out.apply(i).dataType().simpleString()) for i in range(out.size())]


@pytest.mark.parametrize("entity", sorted(CLEANERS))
def test_values_are_typed_before_the_dedupe(spark, entity):
    clean = CLEANERS[entity](raw(spark, entity, []))
    (window,) = _nodes(clean._jdf.queryExecution().optimizedPlan(), "Window")
    sorted_rows = [c for c in _columns(window.child()) if c[0] != INGEST_POS and not c[0].startswith("_newest")]
    types, keys = dict(CLEAN_TYPES[entity]), KEYS[entity] or UNKEYED[entity]
    expected = {n: "string" if n in keys else t.simpleString() for n, t in types.items()}
    assert len(sorted_rows) == len(expected) and dict(sorted_rows) == expected


def test_key_texts_stay_apart_until_the_end(spark):
    rows = [(" o1 ", "1", "p1", "s1", "", "1.005"), ("o1", " 1", "p2", "s1", "", " 2.00 "), ("o1", "01", "p3", "s1", "", "x"), ("o1", "", "p4", "s1", "", "4")]
    clean = CLEANERS["order_items"](raw(spark, "order_items", rows))
    got = {(r["order_id"], r["order_item_id"], r["product_id"], None if r["price"] is None else str(r["price"])) for r in clean.collect()}
    assert got == {("o1", 1, "p2", "2.00"), ("o1", 1, "p3", None), ("o1", None, "p4", "4.00")}


def test_items_look_up_products_while_they_are_narrow(spark):
    """The join on the order comes last, so a product lookup that is too large to
    broadcast shuffles items without the order's columns."""
    item = "order_id string, order_item_id smallint, product_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"
    items = spark.createDataFrame([("o1", 1, "p1", "s1", None, None), ("o2", 2, "p2", "s2", None, None), ("o3", 1, None, None, None, None)], item)
    context = spark.createDataFrame([("o1", 7), ("o1", 8), ("o4", 9)], "order_id string, customer_sk int")
    context = context.withColumns({out: F.lit(1) for _, out in facts.DATE_ROLES} | {"order_status_sk": F.lit(1)})
    context = context.withColumns({ts: F.lit("2018-01-01 00:00:00").cast("timestamp_ntz") for ts, _ in facts.DATE_ROLES})
    payments = spark.createDataFrame([("o2", 1, "x", 1, 2)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value int")
    reviews = spark.createDataFrame([("o1", 4), ("o2", 5)], "order_id string, review_score int")
    lookups = (spark.createDataFrame(rows, schema) for rows, schema in (([("x", 3)], "payment_type_code string, payment_type_sk int"), ([("s1", 1)], "seller_id string, seller_sk int"), ([("p2", 2)], "product_id string, product_sk int")))
    fact = facts.fact_order_items(items, context, payments, reviews, *lookups)
    got = {tuple(r[c] for c in ("order_id", "customer_sk", "seller_sk", "product_sk", "main_payment_type_sk", "review_score")) for r in fact.collect()}
    assert got == {("o1", 7, 1, None, None, 4), ("o1", 8, 1, None, None, 4), ("o2", None, None, 2, 3, 5), ("o3", None, None, None, None, None)}
    last = _nodes(fact._jdf.queryExecution().optimizedPlan(), "Join")[0]
    narrow = {n for n, _ in _columns(last.left())}
    assert "product_sk" in narrow and not narrow & {"product_id", "customer_sk", "review_score"}
