"""Model layer: dimensions.

Inputs are clean-layer DataFrames. Every surrogate key is a dense rank, computed
in parallel and lazily (``key_ranks``); a date's key is its rank in the calendar
bitmap. Small dimensions are broadcast only after a size check; large ones join
by shuffle.

Per-entity statistics are pre-aggregated on the smallest key before any join
so that a customer or seller holding a third of all orders is combined on
the map side instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import calendar_columns, day
from strata.operators.dedupe import representative
from strata.operators.keys import dense_rank_key, key_ranks
from strata.operators.lookup import calendar, date_lookups

ORDER_TIMES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_TIMES = ["review_creation_date", "review_answer_timestamp"]

# Status codes that close an order / that cancel it.
CLOSED_STATUSES = ("delivered", "canceled", "cancelled", "unavailable")
CANCELLED_STATUSES = ("canceled", "cancelled")


def date_values(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """The calendar dates of the seven order and review timestamps, as often as
    they occur. One scan per table: the columns are stacked with ``explode``."""
    o = orders.select(F.explode(F.array(*[day(c) for c in ORDER_TIMES])).alias("full_date"))
    r = reviews.select(F.explode(F.array(*[day(c) for c in REVIEW_TIMES])).alias("full_date"))
    return o.unionByName(r).where(F.col("full_date").isNotNull())


def observed_dates(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Distinct calendar dates of the seven order and review timestamps; no
    calendar fill."""
    return date_values(orders, reviews).distinct()


def dim_date(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    ranked = date_lookups(observed_dates(orders, reviews), calendar(date_values(orders, reviews)), {"date_sk": F.col("full_date")})
    return ranked.select("date_sk", "full_date", *calendar_columns("full_date"))


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Per person: first and last purchase date and the number of distinct
    orders over all of the person's customer ids.

    Distinct (person, order) pairs are counted, because one order id may
    carry several customer ids: ids are cut to their declared length after
    the dedupe, and appended clean runs repeat them."""
    persons = customers.where(F.col("customer_unique_id").isNotNull()).select("customer_unique_id", "customer_id").distinct()
    placed = orders.groupBy("customer_id", "order_id").agg(
        F.min(day("order_purchase_timestamp")).alias("_lo"),
        F.max(day("order_purchase_timestamp")).alias("_hi"),
    )
    pairs = (
        persons.join(placed, "customer_id", "left")
        .groupBy("customer_unique_id", "order_id")
        .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    )
    return pairs.groupBy("customer_unique_id").agg(
        F.min("_lo").alias("first_order_date"),
        F.max("_hi").alias("last_order_date"),
        F.count("order_id").cast("int").alias("total_orders"),
    )


def customer_keys(customers: DataFrame) -> DataFrame:
    """Person -> surrogate key, without the rest of the dimension."""
    return key_ranks(customers.select("customer_unique_id").distinct(), "customer_unique_id", "customer_sk")


def dim_customer(customers: DataFrame, orders: DataFrame, days: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per person (``customer_unique_id``): attributes of the
    person's greatest ``customer_id`` and the person's order statistics.
    ``keys`` are the person's surrogate keys, which the facts look up too."""
    place = ["customer_zip_code_prefix", "customer_city", "customer_state"]
    person = representative(
        customers.where(F.col("customer_unique_id").isNotNull()), "customer_unique_id", ["customer_id", *place]
    ).join(customer_orders(customers, orders), "customer_unique_id", "left")
    ranked = dense_rank_key(person, "customer_unique_id", "customer_sk", ranks=keys if keys is not None else customer_keys(customers))
    ranked = date_lookups(ranked, days, {f"{role}_date_sk": F.col(f"{role}_date") for role in ("first_order", "last_order")})
    return ranked.select(
        "customer_sk",
        "customer_unique_id",
        F.col("customer_id").alias("customer_id_source"),
        *place,
        "first_order_date_sk",
        "last_order_date_sk",
        "total_orders",
    )


def seller_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per seller: first and last purchase date of the orders it sold in and
    their distinct count. Items whose order row is missing still count
    (their dates are NULL)."""
    pairs = items.where(F.col("seller_id").isNotNull()).select("seller_id", "order_id").distinct()
    order_days = orders.groupBy("order_id").agg(
        F.min(day("order_purchase_timestamp")).alias("_lo"),
        F.max(day("order_purchase_timestamp")).alias("_hi"),
    )
    return (
        pairs.join(order_days, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.min("_lo").alias("first_order_date"),
            F.max("_hi").alias("last_order_date"),
            F.count("order_id").cast("int").alias("total_orders"),
        )
    )


def seller_keys(sellers: DataFrame) -> DataFrame:
    """Seller -> surrogate key, without the rest of the dimension."""
    return key_ranks(sellers.select("seller_id").distinct(), "seller_id", "seller_sk")


def dim_seller(sellers: DataFrame, items: DataFrame, orders: DataFrame, days: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per seller with its order statistics."""
    place = ["seller_zip_code_prefix", "seller_city", "seller_state"]
    base = representative(sellers.where(F.col("seller_id").isNotNull()), "seller_id", place)
    sold = base.join(seller_orders(items, orders), "seller_id", "left")
    ranked = dense_rank_key(sold, "seller_id", "seller_sk", ranks=keys if keys is not None else seller_keys(sellers))
    ranked = date_lookups(ranked, days, {f"{role}_date_sk": F.col(f"{role}_date") for role in ("first_order", "last_order")})
    return ranked.select(
        "seller_sk",
        "seller_id",
        *place,
        "first_order_date_sk",
        "last_order_date_sk",
        F.coalesce("total_orders", F.lit(0)).cast("int").alias("total_orders"),
    )


def dim_product_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Categories named by products or by the translation table; English
    name NULL when untranslated."""
    name = "product_category_name"
    cats = (
        products.select(name)
        .unionByName(translation.select(name))
        .where(F.col(name).isNotNull())
        .distinct()
    )
    tr = translation.groupBy(name).agg(
        F.max("product_category_name_english").alias("product_category_name_en")
    )
    ranked = dense_rank_key(cats.join(tr, name, "left"), name, "product_category_sk", ranks=key_ranks(cats, name, "product_category_sk"))
    return ranked.select(
        "product_category_sk",
        name,
        F.substring("product_category_name_en", 1, 80).alias("product_category_name_en"),
    )


def dim_order_status(orders: DataFrame) -> DataFrame:
    codes = orders.select(F.col("order_status").alias("order_status_code")).distinct()
    ranked = key_ranks(codes, "order_status_code", "order_status_sk", "smallint")
    code = F.col("order_status_code")
    return ranked.select(
        "order_status_sk",
        F.substring(code, 1, 20).alias("order_status_code"),
        code.isin(*CLOSED_STATUSES).alias("is_closed"),
        code.isin(*CANCELLED_STATUSES).alias("is_cancelled"),
    )


def payment_type_stats(payments: DataFrame) -> DataFrame:
    """Largest instalment count per payment type (missing counts as 0)."""
    return (
        payments.where(F.col("payment_type").isNotNull())
        .groupBy(F.col("payment_type").alias("payment_type_code"))
        .agg(F.max(F.coalesce(F.col("payment_installments"), F.lit(0))).alias("max_installments"))
    )


def dim_payment_type(payments: DataFrame) -> DataFrame:
    ranked = dense_rank_key(payment_type_stats(payments), "payment_type_code", "payment_type_sk", "smallint")
    return ranked.select(
        "payment_type_sk",
        F.substring("payment_type_code", 1, 20).alias("payment_type_code"),
        (F.col("max_installments") > 1).alias("is_installment"),
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: greatest latitude, then longitude, city and
    state (descending, NULLs last)."""
    rep = representative(
        geolocation.where(F.col("geolocation_zip_code_prefix").isNotNull()),
        "geolocation_zip_code_prefix",
        ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"],
    )
    zips = geolocation.select("geolocation_zip_code_prefix").distinct()
    ranked = dense_rank_key(rep, "geolocation_zip_code_prefix", "geolocation_sk", ranks=key_ranks(zips, "geolocation_zip_code_prefix", "geolocation_sk"))
    return ranked.select(
        "geolocation_sk",
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.col("geolocation_lat").cast("decimal(18,14)").alias("geolocation_lat"),
        F.col("geolocation_lng").cast("decimal(18,14)").alias("geolocation_lng"),
        F.substring("geolocation_city", 1, 80).alias("geolocation_city"),
        F.rtrim(F.substring("geolocation_state", 1, 2)).alias("geolocation_state"),
    )


def product_key_map(products: DataFrame) -> DataFrame:
    return key_ranks(products.select("product_id").distinct(), "product_id", "product_sk")
