"""Raw warehouse entities derived from the benchmark tables.

The benchmark ships TPC-H-style parquet tables, not the retail CSV exports,
so every raw entity is *derived* from them with Spark expressions: whole
tables, no sampling, and the same all-text shape as a CSV ingest. Dirty
values are injected deterministically from the source keys so that every
cleaning rule has work to do: padded keys, blank keys, letters inside
numbers, look-alike keys (``1`` / ``01``), impossible months, date-only
stamps, mixed case, negative and missing amounts, duplicated keys.

Mapping (benchmark table -> entity):
  customer+nation -> customers       orders            -> orders
  lineitem        -> order_items     events            -> order_payments
  documents       -> order_reviews   part              -> products, category_translation
  supplier+nation -> sellers         customer/supplier -> geolocation

The ingest position (the "latest row" tie-break) is a struct of source
columns that is unique per row, stored as ``_ingest_pos``.

The DuckDB twin of this derivation lives in ``strata.oracle`` and must be
kept in step with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.schemas import INGEST_POS, RAW_COLUMNS
from strata.sources.spread import spread

# The period (in source-key units) of each injected defect.
# Shared with the DuckDB twin in strata.oracle.
BLANK_KEY = 17
PAD_KEY = 5
BAD_MONTH = 19
DATE_ONLY = 37
LETTER = 29
LOOKALIKE = 13


def _txt(c: Column) -> Column:
    return c.cast("string")


def _ts_txt(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _days_txt(ts: Column, n: Column) -> Column:
    return _ts_txt(F.timestamp_add("DAY", n.cast("int"), ts))


def _money_txt(c: Column) -> Column:
    return c.cast("decimal(12,2)").cast("string")


def _bad_month(t: Column) -> Column:
    return F.concat(F.substring(t, 1, 5), F.lit("13"), F.substring(t, F.lit(8), F.length(t)))


def _padded(t: Column, k: Column, rem: int = 1) -> Column:
    return F.when(k % PAD_KEY == rem, F.concat(F.lit(" "), t, F.lit("  "))).otherwise(t)


def _dirty_ts(t: Column, k: Column) -> Column:
    return (
        F.when(k % BAD_MONTH == 0, _bad_month(t))
        .when(k % DATE_ONLY == 0, F.substring(t, 1, 10))
        .otherwise(t)
    )


def _shape(df: DataFrame, entity: str, exprs: dict, pos: list[Column]) -> DataFrame:
    cols = [exprs[c].cast("string").alias(c) for c in RAW_COLUMNS[entity]]
    return df.select(*cols, F.struct(*pos).alias(INGEST_POS))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("c_custkey")
    name = F.col("n_name")
    return _shape(
        df,
        "customers",
        {
            "customer_id": F.when(k % BLANK_KEY == 0, F.lit("  ")).otherwise(_padded(_txt(k), k, 2)),
            "customer_unique_id": F.when(k % 41 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("p"), _txt(F.floor(k / 3)))),
            "customer_zip_code_prefix": F.when(k % 43 == 0, F.lit("123456"))
            .otherwise(_txt(F.col("c_nationkey") * 7)),
            "customer_city": F.when(k % 2 == 0, F.lower(name)).otherwise(name),
            "customer_state": F.when(k % 2 == 1, F.lower(F.concat(F.substring(name, 1, 1), F.right(name, F.lit(1)))))
            .otherwise(F.concat(F.substring(name, 1, 1), F.right(name, F.lit(1)))),
        },
        [k],
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = s.join(n, s.s_nationkey == n.n_nationkey, "left")
    k = F.col("s_suppkey")
    name = F.col("n_name")
    return _shape(
        df,
        "sellers",
        {
            "seller_id": _padded(_txt(k), k, 0),
            "seller_zip_code_prefix": _txt(F.col("s_nationkey") * 7 + 1000),
            "seller_city": F.upper(name),
            "seller_state": F.right(name, F.lit(2)),
        },
        [k],
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = _read(spark, sf_dir, "customer").select(
        F.lit(0).alias("src"),
        F.col("c_custkey").alias("k"),
        F.col("c_nationkey").alias("nk"),
        F.col("c_acctbal").alias("bal"),
    )
    s = _read(spark, sf_dir, "supplier").select(
        F.lit(1).alias("src"),
        F.col("s_suppkey").alias("k"),
        F.col("s_nationkey").alias("nk"),
        F.col("s_acctbal").alias("bal"),
    )
    df = c.unionByName(s).join(n, F.col("nk") == F.col("n_nationkey"), "left")
    k = F.col("k")
    name = F.col("n_name")
    return _shape(
        df,
        "geolocation",
        {
            "geolocation_zip_code_prefix": F.when(k % 97 == 0, F.lit(" ")).otherwise(_txt(F.col("nk") * 7)),
            "geolocation_lat": F.concat(_txt(F.floor(F.col("bal") / 1000)), F.lit(".5")),
            "geolocation_lng": F.concat(F.lit("-"), _txt(F.col("nk") + 30), F.lit(".25")),
            "geolocation_city": F.when(k % 3 == 0, F.lower(name))
            .when(k % 3 == 1, F.upper(name))
            .otherwise(name),
            "geolocation_state": F.concat(F.substring(name, 1, 1), F.right(name, F.lit(1))),
        },
        [F.col("src"), k],
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    d = F.col("o_orderdate")
    status = (
        F.when(k % 23 == 0, F.lit("Canceled"))
        .when(k % 29 == 0, F.lit("CANCELLED"))
        .when(k % 31 == 0, F.lit("unavailable"))
        .when(st == "F", F.lit("Delivered"))
        .when(st == "O", F.lit("shipped"))
        .otherwise(F.lit("Processing"))
    )
    return _shape(
        o,
        "orders",
        {
            "order_id": F.when(k % BLANK_KEY == 0, F.lit("   ")).otherwise(_padded(_txt(k), k, 1)),
            "customer_id": _txt(F.col("o_custkey")),
            "order_status": F.when(k % 3 == 0, F.concat(F.lit(" "), status)).otherwise(status),
            "order_purchase_timestamp": _dirty_ts(_ts_txt(d), k),
            "order_approved_at": F.when(k % 41 == 0, F.lit("")).otherwise(_days_txt(d, k % 4)),
            "order_delivered_carrier_date": F.when(st == "P", F.lit("")).otherwise(_days_txt(d, k % 7 + 1)),
            "order_delivered_customer_date": F.when(st != "F", F.lit("")).otherwise(_days_txt(d, k % 45)),
            "order_estimated_delivery_date": _days_txt(d, F.lit(30)),
        },
        [k],
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    pk = F.col("l_partkey")
    mix = ok + pk
    return _shape(
        li,
        "order_items",
        {
            "order_id": F.when((ok + ln) % 7 == 0, F.concat(F.lit("  "), _txt(ok))).otherwise(_txt(ok)),
            "order_item_id": F.when(mix % LOOKALIKE == 0, F.concat(F.lit("0"), _txt(ln)))
            .when(mix % LETTER == 0, F.concat(_txt(ln), F.lit("b")))
            .otherwise(_txt(ln)),
            "product_id": _txt(pk),
            "seller_id": F.when(pk % 53 == 0, F.lit(" ")).otherwise(_txt(F.col("l_suppkey"))),
            "shipping_limit_date": _dirty_ts(_ts_txt(F.col("l_shipdate")), pk),
            "price": _money_txt(F.col("l_extendedprice")),
            "freight_value": _money_txt(F.col("l_quantity")),
        },
        [pk, F.col("l_suppkey"), F.col("l_shipdate")],
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events")
    k = F.col("event_id")
    et = F.col("event_type")
    seq = _txt(F.dayofmonth(F.col("ts")))
    return _shape(
        e,
        "order_payments",
        {
            "order_id": _txt(F.col("user_id")),
            "payment_sequential": F.when(k % LOOKALIKE == 0, F.concat(seq, F.lit("a"))).otherwise(seq),
            "payment_type": F.when(k % 7 == 0, F.upper(et)).otherwise(_padded(et, k, 3)),
            "payment_installments": F.regexp_extract(F.col("props"), "([0-9]+)", 1),
            "payment_value": F.when(k % 31 == 0, F.lit("")).otherwise(_money_txt(F.col("value"))),
        },
        [k],
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "documents")
    k = F.col("doc_id")
    nc = F.col("n_chars")
    clock = F.concat(F.lit(" 08:"), F.lpad(_txt(nc % 60), 2, "0"), F.lit(":00"))
    created = F.date_add(F.lit("2018-01-01").cast("date"), (k % 400).cast("int"))
    answered = F.date_add(created, (nc % 9).cast("int"))
    return _shape(
        d,
        "order_reviews",
        {
            "review_id": _txt(F.floor(k / 2)),
            "order_id": _txt(F.floor(k / 3)),
            "review_score": F.when(k % LOOKALIKE == 0, F.lit("x")).otherwise(_txt(nc % 5 + 1)),
            "review_comment_title": F.concat(F.col("source"), F.lit(" / "), F.col("lang")),
            "review_comment_message": F.when(k % 11 == 0, F.lit("   ")).otherwise(F.col("text")),
            "review_creation_date": F.concat(F.date_format(created, "yyyy-MM-dd"), clock),
            "review_answer_timestamp": F.when(k % 7 == 0, F.lit(""))
            .otherwise(F.concat(F.date_format(answered, "yyyy-MM-dd"), clock)),
        },
        [k],
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    size = F.col("p_size")
    cat = F.concat(F.lower(F.col("p_type")), F.lit("_"), _txt(size % 4))
    return _shape(
        p,
        "products",
        {
            "product_id": F.when(k % 59 == 0, F.lit("")).otherwise(_txt(k)),
            "product_category_name": F.when(k % 11 == 0, F.lit(" "))
            .when(k % 7 == 0, F.upper(cat))
            .otherwise(cat),
            "product_name_lenght": F.when(k % LOOKALIKE == 0, F.concat(_txt(F.length(F.col("p_name"))), F.lit("x")))
            .otherwise(_txt(F.length(F.col("p_name")))),
            "product_description_lenght": _txt(size * 10),
            "product_photos_qty": _txt(size % 5),
            "product_weight_g": _txt(size * 37),
            "product_length_cm": _padded(_txt(size), k, 4),
            "product_height_cm": F.when(k % 101 == 0, F.lit("99999")).otherwise(_txt(size % 13 + 1)),
            "product_width_cm": _txt(k % 50),
        },
        [k],
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    t = F.lower(F.col("p_type"))
    suffix = _txt(F.col("p_size") % 5)
    return _shape(
        p,
        "category_translation",
        {
            "product_category_name": F.concat(t, F.lit("_"), suffix),
            "product_category_name_english": F.when(F.col("p_type").isin("PROMO", "SMALL"), F.lit(""))
            .otherwise(F.concat(t, F.lit(" size "), suffix)),
        },
        [k],
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "products": raw_products,
    "category_translation": raw_category_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    names = names or list(RAW_BUILDERS)
    return {n: RAW_BUILDERS[n](spark, sf_dir) for n in names}
