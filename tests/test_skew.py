"""A key holding a third of all rows: results stay whole and exact, and the
plans combine on the map side before the shuffle."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators.dedupe import keep_latest
from strata.plans import facts, silver
from tests.fixtures import raw


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_before_exchange(plan: str, marker: str) -> bool:
    lines = plan.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    return any(marker in line for i in ex for line in lines[i + 1:i + 4])


def test_hot_order_items(spark):
    rows = []
    for i in range(3000):
        order = "hot" if i % 3 == 0 else f"o{i}"
        rows.append((order, str(i), "p", "s", "2018-01-01 00:00:00", "1.00", "0.10"))
    items = silver.clean_order_items(raw(spark, "order_items", rows).repartition(8))
    totals = facts.item_totals_by_order(items)
    hot = totals.where(F.col("order_id") == "hot").first()
    assert hot["_items"] == 1000 and hot["_gross"] == Decimal("1000.00")
    assert totals.count() == 2001
    assert _partial_before_exchange(_plan(totals), "partial_")


def test_hot_dedupe_key(spark):
    rows = [("k", str(i)) for i in range(2000)] + [("x", "1")]
    df = raw(spark, "category_translation", rows).repartition(8)
    kept = keep_latest(df, [F.col("product_category_name")])
    got = {r["product_category_name"]: r["product_category_name_english"] for r in kept.collect()}
    assert got == {"k": "1999", "x": "1"}  # the latest of the hot key's 2000 rows
    assert _partial_before_exchange(_plan(kept), "WindowGroupLimit")


def test_repeated_order_copies(spark):
    """A third of the order rows are copies of one order (repeated loads):
    totals multiply exactly as a join-then-group would, and the copies are
    combined before the shuffle."""
    from strata.plans.model import Model

    order = ("o1", "c1", "delivered", "2018-03-05 10:00:00", "", "", "", "2018-03-10 00:00:00")
    other = [(f"o{i}", "c1", "delivered", "2018-03-05 10:00:00", "", "", "", "2018-03-10 00:00:00") for i in range(2, 201)]
    orders = [order] * 100 + other
    clean = {
        "customers": silver.clean_customers(raw(spark, "customers", [("c1", "u1", "1", "x", "sp")])),
        "orders": silver.clean_orders(raw(spark, "orders", orders)).unionByName(
            silver.clean_orders(raw(spark, "orders", [order]))
        ),
        "order_items": silver.clean_order_items(raw(spark, "order_items", [("o1", "1", "p", "s", "", "2.50", "1.00")])),
        "order_payments": silver.clean_order_payments(raw(spark, "order_payments", [("o1", "1", "x", "1", "2.50")])),
        "order_reviews": silver.clean_order_reviews(raw(spark, "order_reviews", [("r1", "o1", "4")])),
        "products": silver.clean_products(raw(spark, "products", [("p",)])),
        "sellers": silver.clean_sellers(raw(spark, "sellers", [("s",)])),
        "geolocation": silver.clean_geolocation(raw(spark, "geolocation", [("1",)])),
        "category_translation": silver.clean_category_translation(raw(spark, "category_translation", [("a", "b")])),
    }
    # the clean orders hold o1 twice (as an append load would); repeat it more
    copies = clean["orders"].where(F.col("order_id") == "o1")
    for _ in range(5):
        clean["orders"] = clean["orders"].unionByName(copies)
    m = Model(clean)
    f = m["fact_orders"]
    o1 = f.where(F.col("order_id") == "o1").collect()
    assert len(o1) == 1
    n = clean["orders"].where(F.col("order_id") == "o1").count()
    assert o1[0]["total_items"] == n and o1[0]["total_gross_revenue"] == Decimal("2.50") * n
    assert o1[0]["avg_item_price"] == Decimal("2.50") and o1[0]["total_payment_value"] == Decimal("2.50")


def test_hot_order_is_split(spark):
    """A third of the items belong to one order: the one join that brings the
    order's measures to its items is split by adaptive execution."""
    from strata.plans.facts import fact_order_items, order_context

    hot = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in hot}
    n = 60_000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), F.col("id")))
    items = spark.range(0, n, 1, 16).select(
        key.alias("order_id"), (F.col("id") % 30000).cast("smallint").alias("order_item_id"), F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit("1.00").cast("decimal(10,2)").alias("price"), F.lit("0.10").cast("decimal(10,2)").alias("freight_value"),
    )
    stamp = F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit("c").alias("customer_id"), F.lit("delivered").alias("order_status"),
        *[stamp.alias(c) for c, _ in facts.DATE_ROLES],
    )
    small = lambda text, schema: spark.createDataFrame(text, schema)
    dates = spark.sql("SELECT DATE '2018-01-01' AS full_date, 1 AS date_sk")
    try:
        for k, v in hot.items():
            spark.conf.set(k, v)
        context = order_context(orders, small([("c", 1)], "customer_id string, customer_sk int"), F.broadcast(dates), F.broadcast(small([("delivered", 1)], "order_status_code string, order_status_sk int")))
        fact = fact_order_items(
            items,
            context,
            small([("hot", 1, "x", 1, 2)], "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value int"),
            small([("hot", 4)], "order_id string, review_score int"),
            F.broadcast(small([("x", 7)], "payment_type_code string, payment_type_sk int")),
            F.broadcast(small([("s", 1)], "seller_id string, seller_sk int")),
            F.broadcast(small([("p", 1)], "product_id string, product_sk int")),
        )
        got = fact.groupBy((F.col("order_id") == "hot").alias("hot"), "main_payment_type_sk", "review_score").count().collect()
        assert {(r["hot"], r["main_payment_type_sk"], r["review_score"]): r["count"] for r in got} == {(True, 7, 4): n // 3, (False, None, None): n - n // 3}
        fact.collect()
        assert "skew=true" in _plan(fact)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
