"""Declared quality rules over the clean tables, and their report.

A rule is a predicate over one row (SQL text), the uniqueness of the table's
key, or a reference to another table's key. All rules of a table are compiled
into one aggregate over one scan: a row gives an entry for its key, carrying
which predicates it breaks, and one for each reference it makes, and entries
are counted by kind and value, combined on the map side. So a key or a
reference that a third of all rows share is one row a task by the time it is
shuffled, and a table's counted keys are what the references to it are looked
up in.

The report has a row for each rule: how many rows it applied to and how many
broke it. A predicate applies where it is not NULL; uniqueness counts the rows
beyond the first of each key; a reference applies where it is not NULL. Rows
with a NULL in their key are counted by the key's ``present`` rule only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.schemas import ENTITY_ORDER, KEYS


@dataclass(frozen=True)
class Rules:
    """Predicates by name, and references: column -> entity with that key."""

    rows: dict[str, str] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)


#: Predicates are standard SQL over the clean columns.
RULES: dict[str, Rules] = {
    "customers": Rules({"person_present": "customer_unique_id IS NOT NULL", "state_length": "length(customer_state) = 2", "zip_length": "length(customer_zip_code_prefix) = 5"}),
    "sellers": Rules({"state_length": "length(seller_state) = 2", "zip_length": "length(seller_zip_code_prefix) = 5"}),
    "geolocation": Rules({"zip_present": "geolocation_zip_code_prefix IS NOT NULL", "lat_range": "geolocation_lat BETWEEN -90 AND 90", "lng_range": "geolocation_lng BETWEEN -180 AND 180"}),
    "orders": Rules(
        {
            "purchase_present": "order_purchase_timestamp IS NOT NULL",
            "approved_after_purchase": "order_approved_at >= order_purchase_timestamp",
            "delivered_after_carrier": "order_delivered_customer_date >= order_delivered_carrier_date",
        },
        {"customer_id": "customers"},
    ),
    "order_items": Rules({"price_positive": "price > 0", "price_present": "price IS NOT NULL", "freight_range": "freight_value BETWEEN 0 AND price"}, {"order_id": "orders", "product_id": "products", "seller_id": "sellers"}),
    "order_payments": Rules({"value_present": "payment_value IS NOT NULL", "installments_range": "payment_installments BETWEEN 0 AND 24"}, {"order_id": "orders"}),
    "order_reviews": Rules({"score_range": "review_score BETWEEN 1 AND 5", "score_present": "review_score IS NOT NULL", "answer_after_creation": "review_answer_timestamp >= review_creation_date"}, {"order_id": "orders"}),
    "products": Rules({"weight_positive": "product_weight_g > 0", "photos_range": "product_photos_qty BETWEEN 1 AND 20"}, {"product_category_name": "category_translation"}),
    "category_translation": Rules({"english_present": "product_category_name_english IS NOT NULL"}),
}


def _key(entity: str) -> list[str]:
    return KEYS[entity]


def counted(table: DataFrame, entity: str) -> DataFrame:
    """(kind, value, n, and for keys the rows that met and broke each predicate)."""
    rules, key = RULES[entity], _key(entity)
    text = lambda c: F.col(c).cast("string")
    whole = F.array(*[text(c) for c in key]) if key else F.array().cast("array<string>")
    complete = F.lit(True)
    for c in key:
        complete &= F.col(c).isNotNull()
    verdicts = [F.expr(p).cast("int") for p in rules.rows.values()]
    none = F.lit(None).cast("int")

    def entry(kind: str, value: Column, flags: list[Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"), *[f.alias(f"r{i}") for i, f in enumerate(flags)])

    entries = [entry("key", F.when(complete, whole), verdicts)]
    entries += [entry(c, F.when(F.col(c).isNotNull(), F.array(text(c))), [none] * len(verdicts)) for c in rules.references]
    sums = [F.count(F.lit(1)).alias("n")]
    for i in range(len(verdicts)):
        sums += [F.count(f"e.r{i}").alias(f"met{i}"), F.count_if(F.col(f"e.r{i}") == 0).alias(f"broke{i}")]
    return table.select(F.explode(F.array(*entries)).alias("e")).groupBy("e.kind", "e.value").agg(*sums)


def rule_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(entity, rule, checked, violations) of every declared rule."""
    counts = {entity: counted(tables[entity], entity) for entity in ENTITY_ORDER}
    out = None
    for entity in ENTITY_ORDER:
        rules, key = RULES[entity], _key(entity)
        is_key, given = F.col("kind") == "key", F.col("value").isNotNull()
        found = counts[entity].withColumn("held", F.lit(True))
        for c, parent in rules.references.items():
            keys = counts[parent].where(is_key & given).select(F.lit(c).alias("kind"), "value", F.lit(True).alias(f"in_{c}"))
            found = found.join(keys, ["kind", "value"], "left").withColumn("held", F.when(F.col("kind") == c, F.col(f"in_{c}").isNotNull()).otherwise(F.col("held"))).drop(f"in_{c}")
        total = lambda n, where: F.coalesce(F.sum(F.when(where, n)), F.lit(0)).cast("bigint")
        n = F.col("n")
        lines = [(name, total(F.col(f"met{i}"), is_key), total(F.col(f"broke{i}"), is_key)) for i, name in enumerate(rules.rows)]
        if key:
            lines.append(("key_present", total(n, is_key), total(n, is_key & ~given)))
            lines.append(("key_unique", total(n, is_key & given), total(n - 1, is_key & given)))
        lines += [(f"{c}_known", total(n, (F.col("kind") == c) & given), total(n, (F.col("kind") == c) & given & ~F.col("held"))) for c in rules.references]
        wide = found.agg(F.array(*[F.struct(F.lit(name).alias("rule"), checked.alias("checked"), broke.alias("violations")) for name, checked, broke in lines]).alias("lines"))
        one = wide.select(F.explode("lines").alias("line")).select(F.lit(entity).alias("entity"), "line.rule", "line.checked", "line.violations")
        out = one if out is None else out.unionByName(one)
    return out
