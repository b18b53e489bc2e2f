"""Declared schemas of the raw and clean layers, and per-entity metadata.

Raw tables are all-text and bind CSV columns by position; clean tables are
typed. Column names (including the legacy ``lenght`` spelling) are part of the
warehouse contract and are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Entity -> raw column names in file order.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "order_reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "sellers": [
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ],
    "category_translation": [
        "product_category_name",
        "product_category_name_english",
    ],
}

# Source file name per entity, load section per entity, and the
# order in which the layer jobs visit the entities.
SOURCE_FILES: dict[str, str] = {
    "customers": "olist_customers_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "order_payments": "olist_order_payments_dataset.csv",
    "order_reviews": "olist_order_reviews_dataset.csv",
    "products": "olist_products_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}
SECTIONS: dict[str, str] = {
    "customers": "CRM",
    "sellers": "CRM",
    "geolocation": "GEO",
    "orders": "ERP",
    "order_items": "ERP",
    "order_payments": "ERP",
    "order_reviews": "ERP",
    "products": "PIM",
    "category_translation": "PIM",
}
ENTITY_ORDER = list(SOURCE_FILES)

# Business key of each clean table (first column is the one that must be
# non-blank); geolocation has none.
KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "geolocation": [],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "products": ["product_id"],
    "category_translation": ["product_category_name"],
}
# Columns that together identify a row where there is no business key.
UNKEYED = {"geolocation": RAW_COLUMNS["geolocation"]}
# Entities whose key is checked before and after the clean load.
KEY_CHECKED = ["customers", "sellers", "orders"]

INGEST_POS = "_ingest_pos"


def raw_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[entity]])


_S = T.StringType()
_I2 = T.ShortType()
_I4 = T.IntegerType()
_TS = T.TimestampNTZType()
_MONEY = T.DecimalType(10, 2)
_GEO = T.DecimalType(18, 14)

CLEAN_TYPES: dict[str, list[tuple[str, T.DataType]]] = {
    "customers": [(c, _S) for c in RAW_COLUMNS["customers"]],
    "geolocation": [
        ("geolocation_zip_code_prefix", _S),
        ("geolocation_lat", _GEO),
        ("geolocation_lng", _GEO),
        ("geolocation_city", _S),
        ("geolocation_state", _S),
    ],
    "order_items": [
        ("order_id", _S),
        ("order_item_id", _I2),
        ("product_id", _S),
        ("seller_id", _S),
        ("shipping_limit_date", _TS),
        ("price", _MONEY),
        ("freight_value", _MONEY),
    ],
    "order_payments": [
        ("order_id", _S),
        ("payment_sequential", _I2),
        ("payment_type", _S),
        ("payment_installments", _I2),
        ("payment_value", _MONEY),
    ],
    "order_reviews": [
        ("review_id", _S),
        ("order_id", _S),
        ("review_score", _I2),
        ("review_comment_title", _S),
        ("review_comment_message", _S),
        ("review_creation_date", _TS),
        ("review_answer_timestamp", _TS),
    ],
    "orders": [("order_id", _S), ("customer_id", _S), ("order_status", _S)]
    + [(c, _TS) for c in RAW_COLUMNS["orders"][3:]],
    "products": [
        ("product_id", _S),
        ("product_category_name", _S),
        ("product_name_lenght", _I2),
        ("product_description_lenght", _I2),
        ("product_photos_qty", _I2),
        ("product_weight_g", _I4),
        ("product_length_cm", _I2),
        ("product_height_cm", _I2),
        ("product_width_cm", _I2),
    ],
    "sellers": [(c, _S) for c in RAW_COLUMNS["sellers"]],
    "category_translation": [(c, _S) for c in RAW_COLUMNS["category_translation"]],
}

