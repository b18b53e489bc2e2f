"""Registered queries: one per warehouse operator, each over whole tables.

Every entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` with the
DuckDB SQL that states the same result (``strata.oracle``). Column names
and types agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions.dates import calendar_columns, day, day_diff
from strata.operators.lookup import date_lookups
from strata.oracle import ORDER_STAMPS, SDEC, UDEC, UINT, date_key, exact_avg, guard, nb, state, ts, txt, with_layers, zip5
from strata.oracle import day as sql_day
from strata.oracle import ddiff as sql_ddiff
from strata.plans import dims, facts, quality, rules
from strata.plans.model import Model
from strata.plans.silver import CLEANERS
from strata.sources.driver_tables import RAW_BUILDERS
from strata.sources.schemas import KEYS, UNKEYED


# Clean columns that no dimension or fact reads.
UNREAD = {
    "order_items": ["shipping_limit_date"],
    "order_reviews": ["review_comment_title"],
    "products": [
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
}


class Tables:
    """Raw, clean and model tables of one benchmark folder, built lazily.

    The model reads clean tables through ``shared``: a clean table feeding
    several dimensions and facts is persisted (memory, spilling to disk) and
    filled by the first job that reads it, instead of being recomputed from
    the raw layer by every job. Clean tables are deterministic, so a lost
    block is simply recomputed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}
        self._clean: dict[str, DataFrame] = {}
        self._shared: dict[str, DataFrame] = {}
        self.model = Model(_SharedClean(self))

    def shared(self, name: str) -> DataFrame:
        """The columns of a clean table that the model reads, persisted."""
        if name not in self._shared:
            unread = [c for c in UNREAD.get(name, []) if c in self.clean(name).columns]
            self._shared[name] = self.clean(name).drop(*unread).persist(StorageLevel.MEMORY_AND_DISK)
        return self._shared[name]

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = RAW_BUILDERS[name](self.spark, self.sf_dir)
        return self._raw[name]

    def clean(self, name: str) -> DataFrame:
        if name not in self._clean:
            self._clean[name] = CLEANERS[name](self.raw(name))
        return self._clean[name]


class _SharedClean(dict):
    def __init__(self, tables: Tables):
        super().__init__()
        self._t = tables

    def __getitem__(self, name):
        return self._t.shared(name)


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, covers: str):
    def wrap(fn):
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn

    return wrap


def _t(spark, sf_dir) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------------------
# scalar rules over whole raw tables
# ---------------------------------------------------------------------------
@register(
    "blank_to_null",
    with_layers(
        f"SELECT customer_id AS raw_customer_id, {nb('customer_id')} AS customer_id, "
        f"{nb('customer_unique_id')} AS customer_unique_id, {nb('customer_city')} AS customer_city FROM r_customers"
    ),
    "SCL-1",
)
def q_blank_to_null(spark, sf_dir):
    r = _t(spark, sf_dir).raw("customers")
    return r.select(
        F.col("customer_id").alias("raw_customer_id"),
        C.blank_to_null("customer_id").alias("customer_id"),
        C.blank_to_null("customer_unique_id").alias("customer_unique_id"),
        C.blank_to_null("customer_city").alias("customer_city"),
    )


@register(
    "zip_pad",
    with_layers(
        f"SELECT customer_zip_code_prefix AS raw_zip, {zip5('customer_zip_code_prefix')} AS zip_code_prefix "
        f"FROM r_customers UNION ALL SELECT seller_zip_code_prefix, {zip5('seller_zip_code_prefix')} FROM r_sellers"
    ),
    "SCL-2",
)
def q_zip_pad(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t.raw("customers").select(
        F.col("customer_zip_code_prefix").alias("raw_zip"), C.zip5("customer_zip_code_prefix").alias("zip_code_prefix")
    )
    b = t.raw("sellers").select(
        F.col("seller_zip_code_prefix").alias("raw_zip"), C.zip5("seller_zip_code_prefix").alias("zip_code_prefix")
    )
    return a.unionByName(b)


@register(
    "state_code",
    with_layers(
        f"SELECT customer_state AS raw_state, {state('customer_state')} AS state_code FROM r_customers "
        f"UNION ALL SELECT geolocation_state, {state('geolocation_state')} FROM r_geolocation"
    ),
    "SCL-3, SCL-5 (char(2))",
)
def q_state_code(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t.raw("customers").select(
        F.col("customer_state").alias("raw_state"), C.state_code("customer_state").alias("state_code")
    )
    b = t.raw("geolocation").select(
        F.col("geolocation_state").alias("raw_state"), C.state_code("geolocation_state").alias("state_code")
    )
    return a.unionByName(b)


@register(
    "case_fold",
    with_layers(
        f"SELECT order_status AS raw_code, left(lower({nb('order_status')}), 20) AS code FROM r_orders "
        f"UNION ALL SELECT payment_type, left(lower({nb('payment_type')}), 20) FROM r_order_payments"
    ),
    "SCL-4",
)
def q_case_fold(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t.raw("orders").select(F.col("order_status").alias("raw_code"), C.lower_code("order_status").alias("code"))
    b = t.raw("order_payments").select(
        F.col("payment_type").alias("raw_code"), C.lower_code("payment_type").alias("code")
    )
    return a.unionByName(b)


@register(
    "bounded_text",
    with_layers(
        f"SELECT review_id AS raw_id, {txt('review_id', 32)} AS id_bounded, "
        f"{txt('review_comment_title', 80)} AS text_bounded, "
        f"length({nb('review_comment_message')}) AS message_length FROM r_order_reviews "
        f"UNION ALL SELECT customer_id, {txt('customer_id', 32)}, {txt('customer_city', 80)}, NULL FROM r_customers"
    ),
    "SCL-5",
)
def q_bounded_text(spark, sf_dir):
    """Declared lengths: ids cut to 32, titles and cities to 80. Review
    messages are unbounded text: only their whole length is reported."""
    t = _t(spark, sf_dir)
    r = t.raw("order_reviews").select(
        F.col("review_id").alias("raw_id"),
        C.clean_text("review_id", 32).alias("id_bounded"),
        C.clean_text("review_comment_title", 80).alias("text_bounded"),
        F.length(C.blank_to_null("review_comment_message")).cast("bigint").alias("message_length"),
    )
    c = t.raw("customers").select(
        F.col("customer_id").alias("raw_id"),
        C.clean_text("customer_id", 32).alias("id_bounded"),
        C.clean_text("customer_city", 80).alias("text_bounded"),
        F.lit(None).cast("bigint").alias("message_length"),
    )
    return r.unionByName(c)


_INT_COLS = [
    ("product_name_lenght", "SMALLINT"),
    ("product_description_lenght", "SMALLINT"),
    ("product_photos_qty", "SMALLINT"),
    ("product_weight_g", "INTEGER"),
    ("product_length_cm", "SMALLINT"),
    ("product_height_cm", "SMALLINT"),
    ("product_width_cm", "SMALLINT"),
]


@register(
    "safe_int",
    with_layers(
        "SELECT product_id AS raw_product_id, "
        + ", ".join(f"{guard(c, UINT, t)} AS {c}" for c, t in _INT_COLS)
        + " FROM r_products"
    ),
    "SCL-6, SCL-10",
)
def q_safe_int(spark, sf_dir):
    r = _t(spark, sf_dir).raw("products")
    cols = [
        (C.to_int(c) if t == "INTEGER" else C.to_smallint(c)).alias(c) for c, t in _INT_COLS
    ]
    return r.select(F.col("product_id").alias("raw_product_id"), *cols)


@register(
    "safe_decimal",
    with_layers(
        f"SELECT price AS raw_price, {guard('price', UDEC, 'DECIMAL(10,2)')} AS price, "
        f"freight_value AS raw_freight_value, {guard('freight_value', UDEC, 'DECIMAL(10,2)')} AS freight_value "
        f"FROM r_order_items UNION ALL SELECT payment_value, {guard('payment_value', UDEC, 'DECIMAL(10,2)')}, "
        f"NULL, NULL FROM r_order_payments"
    ),
    "SCL-7, SCL-10",
)
def q_safe_decimal(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t.raw("order_items").select(
        F.col("price").alias("raw_price"),
        C.to_money("price").alias("price"),
        F.col("freight_value").alias("raw_freight_value"),
        C.to_money("freight_value").alias("freight_value"),
    )
    b = t.raw("order_payments").select(
        F.col("payment_value").alias("raw_price"),
        C.to_money("payment_value").alias("price"),
        F.lit(None).cast("string").alias("raw_freight_value"),
        F.lit(None).cast("decimal(10,2)").alias("freight_value"),
    )
    return a.unionByName(b)


@register(
    "signed_decimal",
    with_layers(
        f"SELECT geolocation_lat AS raw_lat, {guard('geolocation_lat', SDEC, 'DECIMAL(18,14)')} AS lat, "
        f"geolocation_lng AS raw_lng, {guard('geolocation_lng', SDEC, 'DECIMAL(18,14)')} AS lng FROM r_geolocation"
    ),
    "SCL-8, SCL-10",
)
def q_signed_decimal(spark, sf_dir):
    r = _t(spark, sf_dir).raw("geolocation")
    return r.select(
        F.col("geolocation_lat").alias("raw_lat"),
        C.to_coordinate("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("raw_lng"),
        C.to_coordinate("geolocation_lng").alias("lng"),
    )


_TS_COLS = dims.ORDER_TIMES


@register(
    "safe_timestamp",
    with_layers(
        "SELECT order_id AS raw_order_id, "
        + ", ".join(f"{ts(c)} AS {c}" for c in _TS_COLS)
        + f", {ts('order_purchase_timestamp')} IS NULL AND {nb('order_purchase_timestamp')} IS NOT NULL"
        " AS purchase_rejected FROM r_orders"
    ),
    "SCL-9, SCL-10",
)
def q_safe_timestamp(spark, sf_dir):
    r = _t(spark, sf_dir).raw("orders")
    cols = [C.to_timestamp(c).alias(c) for c in _TS_COLS]
    rejected = C.to_timestamp("order_purchase_timestamp").isNull() & C.blank_to_null(
        "order_purchase_timestamp"
    ).isNotNull()
    return r.select(F.col("order_id").alias("raw_order_id"), *cols, rejected.alias("purchase_rejected"))


# ---------------------------------------------------------------------------
# calendar and lead-time rules over whole clean tables
# ---------------------------------------------------------------------------
@register(
    "date_parts",
    with_layers(
        f"SELECT order_id, {sql_day('order_purchase_timestamp')} AS full_date, "
        "CAST(year(order_purchase_timestamp) AS SMALLINT) AS year, CAST(month(order_purchase_timestamp) AS SMALLINT) AS month, "
        "monthname(order_purchase_timestamp) AS month_name, CAST(quarter(order_purchase_timestamp) AS SMALLINT) AS quarter, "
        "CAST(day(order_purchase_timestamp) AS SMALLINT) AS day, CAST(isodow(order_purchase_timestamp) AS SMALLINT) AS day_of_week, "
        "dayname(order_purchase_timestamp) AS day_of_week_name, isodow(order_purchase_timestamp) IN (6, 7) AS is_weekend "
        "FROM s_orders"
    ),
    "SCL-11..15",
)
def q_date_parts(spark, sf_dir):
    o = _t(spark, sf_dir).clean("orders")
    d = day("order_purchase_timestamp")
    return o.select("order_id", d.alias("full_date"), *calendar_columns(d))


@register(
    "day_diff",
    with_layers(
        f"SELECT order_id, {sql_ddiff('order_approved_at', 'order_purchase_timestamp')} AS days_approval, "
        f"{sql_ddiff('order_delivered_customer_date', 'order_purchase_timestamp')} AS days_delivery, "
        f"{sql_ddiff('order_delivered_customer_date', 'order_estimated_delivery_date')} AS days_delay_vs_estimated "
        "FROM s_orders"
    ),
    "SCL-17",
)
def q_day_diff(spark, sf_dir):
    o = _t(spark, sf_dir).clean("orders")
    return o.select(
        "order_id",
        day_diff("order_approved_at", "order_purchase_timestamp").alias("days_approval"),
        day_diff("order_delivered_customer_date", "order_purchase_timestamp").alias("days_delivery"),
        day_diff("order_delivered_customer_date", "order_estimated_delivery_date").alias("days_delay_vs_estimated"),
    )


@register(
    "non_blank_flag",
    with_layers(
        "SELECT review_id, NULLIF(TRIM(coalesce(review_comment_message, ''), ' '), '') IS NOT NULL AS has_comment "
        "FROM s_order_reviews"
    ),
    "SCL-19",
)
def q_non_blank_flag(spark, sf_dir):
    r = _t(spark, sf_dir).clean("order_reviews")
    return r.select("review_id", C.has_text("review_comment_message").alias("has_comment"))


@register("mean_score", with_layers("SELECT order_id, review_score FROM per_order WHERE review_rows > 0"), "SCL-20, AGG-11, JN-14")
def q_mean_score(spark, sf_dir):
    return facts.review_score_by_order(_t(spark, sf_dir).clean("order_reviews"))


# ---------------------------------------------------------------------------
# filters, windows, keys, lookups, aggregates
# ---------------------------------------------------------------------------
@register(
    "key_filter",
    with_layers(
        "SELECT order_id, order_item_id, price FROM s_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL"
    ),
    "FLT-1, FLT-4",
)
def q_key_filter(spark, sf_dir):
    i = _t(spark, sf_dir).clean("order_items")
    return facts.keyed_items(i).select("order_id", "order_item_id", "price")


@register(
    "main_payment",
    with_layers(
        "SELECT order_id, payment_type_sk AS main_payment_type_sk FROM per_order "
        "LEFT JOIN dim_payment_type ON main_method = payment_type_code WHERE payment_rows > 0"
    ),
    "WIN-4, SRT-1, SRT-2, JN-12, JN-13",
)
def q_main_payment(spark, sf_dir):
    t = _t(spark, sf_dir)
    return facts.main_payment(t.clean("order_payments"), t.model["dim_payment_type_b"])


@register(
    "role_playing_dates",
    with_layers(
        "SELECT order_id, " + ", ".join(f"{date_key(c)} AS {sk}" for sk, c in ORDER_STAMPS.items()) + " FROM s_orders"
    ),
    "JN-5, SCL-11",
)
def q_role_playing_dates(spark, sf_dir):
    t = _t(spark, sf_dir)
    o = t.clean("orders")
    o = date_lookups(o, t.model["calendar"], {out: day(c) for c, out in facts.DATE_ROLES})
    return o.select("order_id", *[out for _, out in facts.DATE_ROLES])


@register(
    "customer_lookup",
    with_layers(
        "SELECT order_id, customer_sk FROM s_orders LEFT JOIN person_of USING (customer_id)"
    ),
    "JN-7, JN-8",
)
def q_customer_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.clean("orders").join(t.model["customer_map"], "customer_id", "left").select("order_id", "customer_sk")


@register(
    "customer_order_stats",
    with_layers(
        "SELECT customer_unique_id, first_d AS first_order_date, last_d AS last_order_date, "
        "CAST(n AS INTEGER) AS total_orders FROM cust_orders"
    ),
    "JN-1, JN-2, AGG-4, AGG-5, AGG-14",
)
def q_customer_order_stats(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dims.customer_orders(t.clean("customers"), t.clean("orders"))


# Ids of one person's orders that agree in their first 32 characters, the
# declared length: the dedupe tells them apart, the clean layer no longer does.
_LONG_ID_SQL = "rpad('person-' || CAST(CAST(TRIM(customer_id, ' ') AS BIGINT) // 3 AS VARCHAR) || '-', 32, '.') || '#' || TRIM(order_id, ' ')"


@register(
    "customer_orders_long_ids",
    with_layers(
        "SELECT customer_unique_id, first_d AS first_order_date, last_d AS last_order_date, "
        "CAST(n AS INTEGER) AS total_orders FROM cust_orders",
        {"r_orders": f"SELECT * REPLACE ({_LONG_ID_SQL} AS order_id) FROM r_orders_given"},
    ),
    "AGG-4, DIM-2 (ids longer than declared)",
)
def q_customer_orders_long_ids(spark, sf_dir):
    t = _t(spark, sf_dir)
    person = (F.trim("customer_id").cast("long") / 3).cast("long").cast("string")
    long_id = F.concat(F.rpad(F.concat(F.lit("person-"), person, F.lit("-")), 32, "."), F.lit("#"), F.trim("order_id"))
    orders = CLEANERS["orders"](t.raw("orders").withColumn("order_id", long_id))
    return dims.customer_orders(t.clean("customers"), orders)


@register(
    "seller_order_stats",
    with_layers(
        "SELECT seller_id, first_d AS first_order_date, last_d AS last_order_date, CAST(n AS INTEGER) AS total_orders "
        "FROM seller_orders"
    ),
    "JN-3, JN-4, AGG-4, AGG-5, AGG-14",
)
def q_seller_order_stats(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dims.seller_orders(t.clean("order_items"), t.clean("orders"))


@register("distinct_dates", with_layers("SELECT full_date FROM all_dates"), "SET-1, AGG-13")
def q_distinct_dates(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dims.observed_dates(t.clean("orders"), t.clean("order_reviews"))


@register(
    "category_union",
    with_layers("SELECT product_category_name, product_category_name_en FROM category_names"),
    "SET-2, JN-6, AGG-6, AGG-13",
)
def q_category_union(spark, sf_dir):
    t = _t(spark, sf_dir)
    return dims.dim_product_category(t.clean("products"), t.clean("category_translation")).select(
        "product_category_name", "product_category_name_en"
    )


@register(
    "max_installments",
    with_layers("SELECT payment_type_code, CAST(max_installments AS SMALLINT) AS max_installments, "
                "max_installments > 1 AS is_installment FROM payment_stats"),
    "AGG-7, SCL-16, SCL-18",
)
def q_max_installments(spark, sf_dir):
    s = dims.payment_type_stats(_t(spark, sf_dir).clean("order_payments"))
    return s.select(
        "payment_type_code",
        F.col("max_installments").cast("smallint").alias("max_installments"),
        (F.col("max_installments") > 1).alias("is_installment"),
    )


@register(
    "money_totals",
    with_layers(
        "SELECT order_id, CAST(items AS INTEGER) AS total_items, "
        "CAST(coalesce(gross, 0) AS DECIMAL(12,2)) AS total_gross_revenue, "
        "CAST(coalesce(freight, 0) AS DECIMAL(12,2)) AS total_freight_value, avg_item_price "
        "FROM per_order WHERE item_rows > 0"
    ),
    "AGG-3, AGG-8, AGG-9, AGG-10, AGG-12, JN-15",
)
def q_money_totals(spark, sf_dir):
    agg = facts.item_totals_by_order(_t(spark, sf_dir).clean("order_items"))
    return agg.select(
        "order_id",
        F.col("_items").cast("int").alias("total_items"),
        F.coalesce(F.col("_gross"), F.lit(0)).cast("decimal(12,2)").alias("total_gross_revenue"),
        F.coalesce(F.col("_freight"), F.lit(0)).cast("decimal(12,2)").alias("total_freight_value"),
        "avg_item_price",
    )


@register("payment_totals", with_layers("SELECT order_id, CAST(paid AS DECIMAL(12,2)) AS total_payment_value FROM per_order WHERE payment_rows > 0"), "AGG-8, JN-16")
def q_payment_totals(spark, sf_dir):
    p = facts.payment_total_by_order(_t(spark, sf_dir).clean("order_payments"))
    return p.select("order_id", F.col("_paid").alias("total_payment_value"))


# ---------------------------------------------------------------------------
# quality checks
# ---------------------------------------------------------------------------
def _check_sql(raw: bool) -> str:
    parts = []
    for ent, key in (("customers", "customer_id"), ("sellers", "seller_id"), ("orders", "order_id")):
        if raw:
            k = nb(key)
            src = f"r_{ent}"
        else:
            k = key
            src = f"s_{ent}"
        parts.append(
            f"SELECT '{ent}' AS entity, (SELECT count(*) FROM {src} WHERE {k} IS NULL) AS null_keys, "
            f"(SELECT count(*) FROM (SELECT {k} AS k FROM {src} WHERE {k} IS NOT NULL GROUP BY 1 "
            f"HAVING count(*) > 1) d) AS dup_keys"
        )
    return with_layers(" UNION ALL ".join(parts))


@register("null_dup_check", _check_sql(True), "QLT-1, AGG-1, AGG-2")
def q_null_dup_check(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.key_checks({e: t.raw(e) for e in ("customers", "sellers", "orders")}, raw=True)


@register("post_load_check", _check_sql(False), "QLT-2, AGG-1, AGG-2")
def q_post_load_check(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.key_checks({e: t.clean(e) for e in ("customers", "sellers", "orders")}, raw=False)


_ENTITIES = list(RAW_BUILDERS)


@register(
    "layer_counts",
    with_layers(
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, (SELECT count(*) FROM r_{e}) AS raw_rows, (SELECT count(*) FROM s_{e}) AS clean_rows, "
            f"(SELECT count(*) FROM r_{e}) - (SELECT count(*) FROM s_{e}) AS dropped_rows"
            for e in _ENTITIES
        )
    ),
    "SET-3, QLT-7, SRT-3",
)
def q_layer_counts(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.reconcile({e: t.raw(e) for e in _ENTITIES}, {e: t.clean(e) for e in _ENTITIES})


def _discarded_sql() -> str:
    parts = []
    for entity in _ENTITIES:
        names = KEYS[entity] or UNKEYED[entity]
        blank = f"{nb(names[0])} IS NULL" if KEYS[entity] else "FALSE"
        keys = ", ".join(f"{nb(k)} AS k{i}" for i, k in enumerate(names))
        parts.append(
            f"SELECT '{entity}' AS entity, count(*) AS raw_rows, count(*) FILTER (blank) AS blank_key_rows, "
            f"CAST(count(*) FILTER (NOT blank) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM r_{entity} WHERE NOT ({blank}))) AS BIGINT) "
            f"AS duplicate_rows FROM (SELECT {blank} AS blank FROM r_{entity})"
        )
    return with_layers(" UNION ALL ".join(parts))


@register("discarded_rows", _discarded_sql(), "QLT-7 (rows left out, by reason)")
def q_discarded_rows(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.discarded({e: t.raw(e) for e in _ENTITIES})


# What makes a raw row of a key newer, and how many source columns make its position.
_NEWEST = {
    "customers": [nb("customer_unique_id")],
    "orders": [ts("order_purchase_timestamp")],
    "order_items": [ts("shipping_limit_date")],
    "order_reviews": [ts("review_answer_timestamp"), ts("review_creation_date")],
}
_POSITION = {"geolocation": 2, "order_items": 3}


def _detail_sql() -> str:
    parts = []
    for entity in _ENTITIES:
        names = KEYS[entity] or UNKEYED[entity]
        keys = [nb(k) for k in names]
        text = " || '|' || ".join(f"coalesce({k}, '')" for k in keys)
        places = [f"p{i + 1}" for i in range(_POSITION.get(entity, 1))]
        place = " || '/' || ".join(f"CAST({p} AS VARCHAR)" for p in places)
        order = ", ".join([f"{n} DESC NULLS LAST" for n in _NEWEST.get(entity, [])] + [f"{p} DESC" for p in places])
        of_key = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {order})"
        where = f"WHERE {keys[0]} IS NOT NULL" if KEYS[entity] else ""
        parts.append(
            f"SELECT '{entity}' AS entity, 'newer row' AS reason, k AS key, place AS position, kept AS kept_position FROM "
            f"(SELECT {text} AS k, {place} AS place, first({place}) {of_key} AS kept, row_number() {of_key} AS nth FROM r_{entity} {where}) WHERE nth > 1"
        )
        if KEYS[entity]:
            parts.append(f"SELECT '{entity}', 'blank key', {text}, {place}, NULL FROM r_{entity} WHERE {keys[0]} IS NULL")
    return with_layers(" UNION ALL ".join(parts))


@register("discarded_detail", _detail_sql(), "QLT-7 (each row left out, and the row kept instead)")
def q_discarded_detail(spark, sf_dir):
    t = _t(spark, sf_dir)
    return quality.discarded_detail({e: t.raw(e) for e in _ENTITIES})


def _rules_sql() -> str:
    parts = []
    line = "SELECT '{}' AS entity, '{}' AS rule, {} AS checked, {} AS violations FROM s_{}"
    for entity, declared in rules.RULES.items():
        for name, predicate in declared.rows.items():
            parts.append(line.format(entity, name, f"count({predicate})", f"count(*) FILTER (NOT ({predicate}))", entity))
        if key := KEYS[entity]:
            given = " AND ".join(f"{k} IS NOT NULL" for k in key)
            parts.append(line.format(entity, "key_present", "count(*)", f"count(*) FILTER (NOT ({given}))", entity))
            parts.append(line.format(entity, "key_unique", "count(*)", f"count(*) - count(DISTINCT ({', '.join(key)}))", f"{entity} WHERE {given}"))
        for column, parent in declared.references.items():
            known = f"{column} IN (SELECT {KEYS[parent][0]} FROM s_{parent} WHERE {KEYS[parent][0]} IS NOT NULL)"
            parts.append(line.format(entity, f"{column}_known", "count(*)", f"count(*) FILTER (NOT ({known}))", f"{entity} WHERE {column} IS NOT NULL"))
    return with_layers(" UNION ALL ".join(parts))


@register("rule_report", _rules_sql(), "QLT-1, QLT-2 (declared rules: present, unique, range, order, reference)")
def q_rule_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    return rules.rule_report({e: t.clean(e) for e in _ENTITIES})


# ---------------------------------------------------------------------------
# clean tables, dimensions, facts
# ---------------------------------------------------------------------------
def _reg_clean(entity: str):
    def run(spark, sf_dir):
        return _t(spark, sf_dir).clean(entity)

    covers = {
        "customers": "SLV-1, WIN-2, FLT-1, FLT-2, SCL-1..5",
        "sellers": "SLV-2, WIN-1, FLT-1, FLT-2",
        "geolocation": "SLV-3, WIN-1, FLT-2, SCL-8 (no key filter)",
        "orders": "SLV-4, WIN-2, SCL-9",
        "order_items": "SLV-5, WIN-2, SCL-6, SCL-7",
        "order_payments": "SLV-6, WIN-1, SCL-4, SCL-6, SCL-7",
        "order_reviews": "SLV-7, WIN-2 (two orders)",
        "products": "SLV-8, WIN-1, SCL-6",
        "category_translation": "SLV-9, WIN-1",
    }[entity]
    REGISTRY[f"clean_{entity}"] = Query(f"clean_{entity}", run, with_layers(f"SELECT * FROM s_{entity}"), covers)


for _e in _ENTITIES:
    _reg_clean(_e)

_MODEL_COVERS = {
    "dim_date": "DIM-1, SET-1, WIN-5 (small), SCL-11..15",
    "dim_customer": "DIM-2, WIN-3, WIN-5, JN-1, JN-2, JN-5, AGG-4, AGG-5",
    "dim_seller": "DIM-3, WIN-3, WIN-5, JN-3, JN-4, JN-5",
    "dim_product_category": "DIM-4, SET-2, JN-6, AGG-6, AGG-13",
    "dim_order_status": "DIM-5, SCL-15, AGG-13",
    "dim_payment_type": "DIM-6, SCL-16, AGG-7",
    "dim_geolocation": "DIM-7, WIN-3, WIN-5",
    "product_key_map": "DIM-8, WIN-5",
    "fact_order_items": "FCT-1, JN-3, JN-5, JN-7..14, SCL-17, SCL-21, SCL-22",
    "fact_orders": "FCT-2, JN-7, JN-8, JN-11, JN-14..16, AGG-3, AGG-8..12",
    "fact_payments": "FCT-3, JN-5, JN-13, JN-17",
    "fact_reviews": "FCT-4, JN-5, JN-17, SCL-19",
}


def _reg_model(name: str):
    def run(spark, sf_dir):
        return _t(spark, sf_dir).model[name]

    REGISTRY[name] = Query(name, run, with_layers(f"SELECT * FROM {name}"), _MODEL_COVERS[name])


for _m in _MODEL_COVERS:
    _reg_model(_m)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql}
