"""Clean layer: one function per entity, raw (all text) -> typed, deduplicated.

Every function follows the same shape:
* drop rows whose (first) key is blank -- geolocation has no such filter;
* keep one row per key, where the key is the trimmed *raw* text (so ``1``
  and ``01`` are different keys even though both become 1 later);
* pick the most recent row by the entity's value order, then by ingest
  position, all descending with NULLs last (``keep_latest``);
* trim, pad, fold case, cut to the declared length and guard every cast.

Each is one shuffle on its key, cut to one row a key and task before it (see
``keep_latest``). Values get their types before that sort and shuffle: eight
bytes for an amount or a stamp in place of its text, and a key's text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.operators.dedupe import keep_latest
from strata.sources.schemas import CLEAN_TYPES, INGEST_POS


def _newest(raw: DataFrame, entity: str, key: list[str], exprs: dict) -> DataFrame:
    """The newest row of each ``key``, typed. A key is compared as its trimmed
    raw text and typed in the end, which no ``exprs`` tells from its raw text."""
    early = [C.blank_to_null(n).alias(n) if n in key else exprs[n].cast(t).alias(n) for n, t in CLEAN_TYPES[entity]]
    newest = [c.alias(f"_newest{i}") for i, c in enumerate(newest_first(entity))]
    typed = raw.select(*early, *newest, INGEST_POS)
    kept = keep_latest(typed, [F.col(n) for n in key], [F.col(f"_newest{i}") for i in range(len(newest))])
    return kept.select(*[exprs[n].cast(t).alias(n) if n in key else n for n, t in CLEAN_TYPES[entity]])


def _drop_blank(df: DataFrame, name: str) -> DataFrame:
    return df.where(C.blank_to_null(name).isNotNull())


def newest_first(entity: str) -> list[Column]:
    """What makes a row of a key newer than another, before the ingest position."""
    return {
        "customers": lambda: [C.blank_to_null("customer_unique_id")],
        "orders": lambda: [C.to_timestamp("order_purchase_timestamp")],
        "order_items": lambda: [C.to_timestamp("shipping_limit_date")],
        "order_reviews": lambda: [C.to_timestamp("review_answer_timestamp"), C.to_timestamp("review_creation_date")],
    }.get(entity, list)()


def clean_customers(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "customer_id"),
        "customers",
        ["customer_id"],
        {
            "customer_id": C.clean_text("customer_id", 32),
            "customer_unique_id": C.clean_text("customer_unique_id", 32),
            "customer_zip_code_prefix": C.zip5("customer_zip_code_prefix"),
            "customer_city": C.clean_text("customer_city", 80),
            "customer_state": C.state_code("customer_state"),
        },
    )


def clean_sellers(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "seller_id"),
        "sellers",
        ["seller_id"],
        {
            "seller_id": C.clean_text("seller_id", 32),
            "seller_zip_code_prefix": C.zip5("seller_zip_code_prefix"),
            "seller_city": C.clean_text("seller_city", 80),
            "seller_state": C.state_code("seller_state"),
        },
    )


def clean_geolocation(raw: DataFrame) -> DataFrame:
    key = [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ]
    return _newest(
        raw,
        "geolocation",
        key,
        {
            "geolocation_zip_code_prefix": C.zip5("geolocation_zip_code_prefix"),
            "geolocation_lat": C.to_coordinate("geolocation_lat"),
            "geolocation_lng": C.to_coordinate("geolocation_lng"),
            "geolocation_city": C.clean_text("geolocation_city", 80),
            "geolocation_state": C.state_code("geolocation_state"),
        },
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    exprs = {
        "order_id": C.clean_text("order_id", 32),
        "customer_id": C.clean_text("customer_id", 32),
        "order_status": C.lower_code("order_status", 20),
    }
    for name in (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ):
        exprs[name] = C.to_timestamp(name)
    return _newest(_drop_blank(raw, "order_id"), "orders", ["order_id"], exprs)


def clean_order_items(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "order_id"),
        "order_items",
        ["order_id", "order_item_id"],
        {
            "order_id": C.clean_text("order_id", 32),
            "order_item_id": C.to_smallint("order_item_id"),
            "product_id": C.clean_text("product_id", 32),
            "seller_id": C.clean_text("seller_id", 32),
            "shipping_limit_date": C.to_timestamp("shipping_limit_date"),
            "price": C.to_money("price"),
            "freight_value": C.to_money("freight_value"),
        },
    )


def clean_order_payments(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "order_id"),
        "order_payments",
        ["order_id", "payment_sequential"],
        {
            "order_id": C.clean_text("order_id", 32),
            "payment_sequential": C.to_smallint("payment_sequential"),
            "payment_type": C.lower_code("payment_type", 20),
            "payment_installments": C.to_smallint("payment_installments"),
            "payment_value": C.to_money("payment_value"),
        },
    )


def clean_order_reviews(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "review_id"),
        "order_reviews",
        ["review_id"],
        {
            "review_id": C.clean_text("review_id", 32),
            "order_id": C.clean_text("order_id", 32),
            "review_score": C.to_smallint("review_score"),
            "review_comment_title": C.clean_text("review_comment_title", 80),
            "review_comment_message": C.clean_text("review_comment_message"),
            "review_creation_date": C.to_timestamp("review_creation_date"),
            "review_answer_timestamp": C.to_timestamp("review_answer_timestamp"),
        },
    )


def clean_products(raw: DataFrame) -> DataFrame:
    exprs = {
        "product_id": C.clean_text("product_id", 32),
        "product_category_name": C.clean_text("product_category_name", 80),
        "product_weight_g": C.to_int("product_weight_g"),
    }
    for name in (
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ):
        exprs[name] = C.to_smallint(name)
    return _newest(_drop_blank(raw, "product_id"), "products", ["product_id"], exprs)


def clean_category_translation(raw: DataFrame) -> DataFrame:
    return _newest(
        _drop_blank(raw, "product_category_name"),
        "category_translation",
        ["product_category_name"],
        {
            "product_category_name": C.clean_text("product_category_name", 80),
            "product_category_name_english": C.clean_text("product_category_name_english", 80),
        },
    )


CLEANERS = {
    "customers": clean_customers,
    "sellers": clean_sellers,
    "geolocation": clean_geolocation,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "order_reviews": clean_order_reviews,
    "products": clean_products,
    "category_translation": clean_category_translation,
}

