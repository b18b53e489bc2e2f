"""Model layer: facts and their reusable sub-operators.

Join layout (all joins are left outer, as the warehouse contract says):

* ``customer_map``  customer_id -> customer_sk, one shuffle on the person id;
* ``order_context`` every order row with its customer, status and five date
  keys, at order grain (fewer rows than items), the date keys by expression
  and the status broadcast after a size check; a model run writes it once for its four facts;
* ``fact_order_items`` first brings the context, the main payment and the mean
  review score together at order grain, then joins items to that once: a
  single join, which adaptive execution splits where one order holds a large
  share of the items (a chain of joins on the same key is never split). Items
  look up seller and product before, while they are narrow, since a large
  product lookup shuffles them;
* ``fact_orders`` aggregates items per order *before* joining (map-side
  combine) instead of joining items and grouping on thirteen columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.clean import has_text
from strata.functions.dates import day, day_diff, exact_money_mean, rounded_mean
from strata.operators.lookup import date_lookups

DATE_ROLES = [
    ("order_purchase_timestamp", "order_date_sk"),
    ("order_approved_at", "approved_date_sk"),
    ("order_delivered_carrier_date", "delivered_carrier_date_sk"),
    ("order_delivered_customer_date", "delivered_customer_date_sk"),
    ("order_estimated_delivery_date", "estimated_delivery_date_sk"),
]


def customer_map(customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``customer_id`` -> ``customer_sk`` through the person id; one row per
    clean customer row (so duplicated customer rows fan out exactly as a
    chained lookup would)."""
    dc = dim_customer.select("customer_unique_id", "customer_sk")
    return (
        customers.select("customer_id", "customer_unique_id")
        .where(F.col("customer_id").isNotNull())
        .join(dc, "customer_unique_id", "left")
        .select("customer_id", "customer_sk")
    )


def order_context(orders: DataFrame, cmap: DataFrame, days: DataFrame, dim_order_status: DataFrame) -> DataFrame:
    """Every order row with an id: its customer, status and date keys, and
    the timestamps that lead times are taken from. ``days`` is the calendar row;
    ``dim_order_status`` should be broadcast already."""
    status = dim_order_status.select(F.col("order_status_code").alias("order_status"), "order_status_sk")
    o = orders.where(F.col("order_id").isNotNull()).join(cmap, "customer_id", "left").join(status, "order_status", "left")
    o = date_lookups(o, days, {out: day(ts) for ts, out in DATE_ROLES})
    return o.select("order_id", *[out for _, out in DATE_ROLES], "customer_sk", "order_status_sk", *[ts for ts, _ in DATE_ROLES])


def main_payment(payments: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """Per order, the type key of its largest payment (lowest sequence on a
    tie; NULL values and sequences lose). A partial top-1 runs before the
    shuffle, so an order with very many payments stays cheap."""
    w = Window.partitionBy("order_id").orderBy(
        F.col("payment_value").desc_nulls_last(),
        F.col("payment_sequential").asc_nulls_last(),
        F.col("payment_type").asc_nulls_last(),
        F.col("payment_installments").asc_nulls_last(),
    )
    best = (
        payments.where(F.col("order_id").isNotNull())
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select("order_id", F.col("payment_type").alias("_ptype"))
    )
    dpt = dim_payment_type.select(F.col("payment_type_code").alias("_ptype"), "payment_type_sk")
    return best.join(dpt, "_ptype", "left").select(
        "order_id", F.col("payment_type_sk").alias("main_payment_type_sk")
    )


def review_score_by_order(reviews: DataFrame) -> DataFrame:
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(rounded_mean("review_score").alias("review_score"))
    )


def payment_total_by_order(payments: DataFrame) -> DataFrame:
    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(F.sum("payment_value").cast("decimal(12,2)").alias("_paid"))
    )


def item_totals_by_order(items: DataFrame) -> DataFrame:
    """Per order: counted item ids, price and freight sums, exact mean price."""
    return items.groupBy("order_id").agg(
        F.count("order_item_id").alias("_items"),
        F.sum("price").alias("_gross"),
        F.sum("freight_value").alias("_freight"),
        exact_money_mean("price").alias("avg_item_price"),
    )


def keyed_items(items: DataFrame) -> DataFrame:
    """Items with both parts of their key."""
    return items.where(F.col("order_id").isNotNull() & F.col("order_item_id").isNotNull())


def _lead_times(with_approval: bool):
    cols = []
    if with_approval:
        cols.append(day_diff("order_approved_at", "order_purchase_timestamp").alias("days_approval"))
    cols += [
        day_diff("order_delivered_customer_date", "order_purchase_timestamp").alias("days_delivery"),
        day_diff("order_delivered_customer_date", "order_estimated_delivery_date").alias(
            "days_delay_vs_estimated"
        ),
    ]
    return cols


def order_grain(context: DataFrame, main: DataFrame, score: DataFrame) -> DataFrame:
    """All that an item looks up by its order id, one row per order row. An
    order id that only has payments or reviews keeps a row of its own, since
    items look those up by their own order id. Repeated order rows stay, so
    items fan out over them. Payments and reviews meet first: a full join's rows
    are shuffled again by the next one, and most orders have neither."""
    return context.join(main.join(score, "order_id", "full"), "order_id", "full")


def fact_order_items(
    items: DataFrame,
    context: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    dim_payment_type: DataFrame,
    seller_lookup: DataFrame,
    product_lookup: DataFrame,
) -> DataFrame:
    """One row per clean item with a key. ``seller_lookup`` (seller_id,
    seller_sk) and ``product_lookup`` (product_id, product_sk) come
    broadcast when their size is proven small (see ``Model``)."""
    keys = context.select(
        "order_id",
        *[out for _, out in DATE_ROLES],
        "customer_sk",
        "order_status_sk",
        *_lead_times(True),
    )
    per_order = order_grain(keys, main_payment(payments, dim_payment_type), review_score_by_order(reviews))
    price = F.col("price").cast("decimal(10,2)")
    f = (
        keyed_items(items)
        .join(seller_lookup, "seller_id", "left")
        .join(product_lookup, "product_id", "left")
        .drop("seller_id", "product_id")
        .join(per_order, "order_id", "left")
    )
    return f.select(
        "order_id",
        "order_item_id",
        *[out for _, out in DATE_ROLES],
        "customer_sk",
        "seller_sk",
        "product_sk",
        "order_status_sk",
        "main_payment_type_sk",
        price.alias("item_price"),
        F.col("freight_value").cast("decimal(10,2)").alias("item_freight_value"),
        price.alias("item_gross_revenue"),
        price.alias("item_net_revenue"),
        F.lit(1).cast("int").alias("item_qty"),
        "days_approval",
        "days_delivery",
        "days_delay_vs_estimated",
        "review_score",
    )


def fact_orders(context: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order (per distinct order version when the clean table
    holds repeated order rows). Item totals are aggregated per order first;
    ``_m`` counts identical order versions so that totals equal those of a
    join-then-group over repeated rows."""
    version = [
        "order_id",
        *[out for _, out in DATE_ROLES],
        "customer_sk",
        "order_status_sk",
        "order_purchase_timestamp",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    # identical copies of an order row (repeated loads) combine on the map
    # side, so a heavily repeated order never lands whole in one task
    versions = context.select(*version).groupBy(*version).agg(F.count(F.lit(1)).alias("_m"))
    f = (
        versions.join(item_totals_by_order(items), "order_id", "left")
        .join(payment_total_by_order(payments), "order_id", "left")
        .join(review_score_by_order(reviews), "order_id", "left")
    )
    m = F.col("_m")
    zero = F.lit(0)
    return f.select(
        "order_id",
        *[out for _, out in DATE_ROLES],
        "customer_sk",
        "order_status_sk",
        F.coalesce(F.col("_items") * m, zero).cast("int").alias("total_items"),
        F.coalesce(F.col("_gross") * m, zero).cast("decimal(12,2)").alias("total_gross_revenue"),
        F.coalesce(F.col("_freight") * m, zero).cast("decimal(12,2)").alias("total_freight_value"),
        F.coalesce(F.col("_paid"), zero).cast("decimal(12,2)").alias("total_payment_value"),
        F.col("avg_item_price").cast("decimal(10,2)").alias("avg_item_price"),
        *_lead_times(False),
        "review_score",
    )


def fact_payments(payments: DataFrame, context: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    ctx = context.select("order_id", "order_date_sk", "customer_sk")
    dpt = dim_payment_type.select(F.col("payment_type_code").alias("payment_type"), "payment_type_sk")
    f = (
        payments.where(F.col("order_id").isNotNull() & F.col("payment_sequential").isNotNull())
        .join(ctx, "order_id", "left")
        .join(dpt, "payment_type", "left")
    )
    return f.select(
        "order_id",
        "payment_sequential",
        "payment_type_sk",
        "payment_installments",
        F.col("payment_value").cast("decimal(10,2)").alias("payment_value"),
        "order_date_sk",
        "customer_sk",
    )


def fact_reviews(reviews: DataFrame, context: DataFrame, days: DataFrame) -> DataFrame:
    ctx = context.select("order_id", "order_date_sk", "customer_sk")
    f = reviews.where(F.col("review_id").isNotNull()).join(ctx, "order_id", "left")
    f = date_lookups(f, days, {"review_creation_date_sk": day("review_creation_date"), "review_answer_date_sk": day("review_answer_timestamp")})
    return f.select(
        "review_id",
        "order_id",
        "customer_sk",
        "order_date_sk",
        "review_creation_date_sk",
        "review_answer_date_sk",
        "review_score",
        has_text("review_comment_message").alias("has_comment"),
    )
