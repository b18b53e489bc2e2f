"""Row-level audit of the clean load, and the declared rules."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.plans import quality
from strata.plans.rules import RULES, rule_report
from strata.plans.silver import CLEANERS
from strata.sources.schemas import ENTITY_ORDER
from tests.fixtures import raw

TS = "2018-03-{:02d} 10:00:00"
ROWS = {
    "customers": [("c1", "u1", "1", "x", "sp"), (" c1 ", None, "1", "x", "sp"), ("c1", "u9", "1", "x", "s"), ("", "u2", "1", "x", "sp"), ("c2", "", "1", "x", "rj")],
    "sellers": [("s1", "1", "x", "sp"), ("s1", "2", "x", "sp")],
    "geolocation": [("1", "95.0", "-46", "x", "sp"), ("1", "95.0", "-46", "x", "sp"), ("", "-23", "-200.5", "x", "sp")],
    "orders": [("o1", "c1", "delivered", TS.format(5), TS.format(4), TS.format(7), TS.format(8), TS.format(10)), ("o1", "c1", "late", "bad"), ("o2", "c7", "shipped", TS.format(5)), ("o3", "", "shipped", "")],
    "order_items": [("o1", "1", "p1", "s1", TS.format(9), "10.00", "11.00"), ("o1", "1", "p1", "s1", TS.format(8), "9.00", "1.00"), ("o1", "", "p9", "", TS.format(8), "0", "0"), ("o9", "", "p1", "s9", TS.format(8), "", "")],
    "order_payments": [("o1", "1", "card", "30", "5.00"), ("o8", "1", "card", "2", "")],
    "order_reviews": [("r1", "o1", "7", "", "", TS.format(5), TS.format(4)), ("r1", "o1", "1", "", "", TS.format(6), TS.format(4))],
    "products": [("p1", "toys", "1", "1", "0", "0"), ("p2", "cars", "1", "1", "3", "10")],
    "category_translation": [("toys", "toys"), ("games", "")],
}


@pytest.fixture(scope="module")
def tables(spark):
    return {e: raw(spark, e, ROWS[e]) for e in ENTITY_ORDER}


def test_detail_names_each_row_left_out(tables):
    detail = quality.discarded_detail(tables).collect()
    per_reason = Counter((r["entity"], r["reason"]) for r in detail)
    counts = {}
    for r in quality.discarded(tables).collect():
        counts |= {(r["entity"], "blank key"): r["blank_key_rows"], (r["entity"], "newer row"): r["duplicate_rows"]}
    assert {k: n for k, n in counts.items() if n} == dict(per_reason)
    # every position left out is a raw row, and the kept ones are the clean layer's
    for entity, df in tables.items():
        places = {r["p"] for r in df.select(quality.position_text(df).alias("p")).collect()}
        gone = [r["position"] for r in detail if r["entity"] == entity]
        kept = {r["kept_position"] for r in detail if r["entity"] == entity and r["kept_position"]}
        assert len(set(gone)) == len(gone) and set(gone) <= places and kept <= places - set(gone)
        assert len(places) - len(gone) == CLEANERS[entity](df).count()


def test_detail_points_to_the_row_that_is_kept(tables):
    detail = {(r["entity"], r["position"]): r for r in quality.discarded_detail(tables).collect()}
    df = tables["customers"]
    at = {(r["customer_id"], r["customer_unique_id"]): r["p"] for r in df.select("*", quality.position_text(df).alias("p")).collect()}
    winner = at[("c1", "u9")]
    assert detail["customers", at[("c1", "u1")]]["kept_position"] == winner == detail["customers", at[(" c1 ", None)]]["kept_position"]
    assert detail["customers", at[("", "u2")]]["reason"] == "blank key"


def test_detail_of_a_hot_key_is_split(spark):
    """Rows meet their kept row in a join, which adaptive execution can split."""
    rows = [(f"c{i}" if i % 3 else "hot", f"u{i:05d}", "1", "x", "sp") for i in range(3000)]
    detail = quality.discarded_detail({"customers": raw(spark, "customers", rows)})
    plan = detail._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" in plan
    assert detail.count() == 999 and detail.select("kept_position").distinct().count() == 1


def test_rules_by_hand(tables):
    clean = {e: CLEANERS[e](df) for e, df in tables.items()}
    got = {(r["entity"], r["rule"]): (r["checked"], r["violations"]) for r in rule_report(clean).collect()}
    assert got["customers", "person_present"] == (2, 1)
    assert got["customers", "state_length"] == (2, 1)
    assert got["customers", "key_present"] == (2, 0) and got["customers", "key_unique"] == (2, 0)
    assert got["geolocation", "lat_range"] == (2, 1) and got["geolocation", "lng_range"] == (2, 1) and got["geolocation", "zip_present"] == (2, 1)
    assert got["orders", "approved_after_purchase"] == (1, 1) and got["orders", "customer_id_known"] == (2, 1)
    assert got["order_items", "key_present"] == (3, 2) and got["order_items", "key_unique"] == (1, 0)
    assert got["order_items", "order_id_known"] == (3, 1) and got["order_items", "product_id_known"] == (3, 1) and got["order_items", "seller_id_known"] == (2, 1)
    assert got["order_items", "price_positive"] == (2, 1) and got["order_items", "freight_range"] == (2, 1)
    assert got["order_payments", "installments_range"] == (2, 1) and got["order_payments", "order_id_known"] == (2, 1)
    assert got["order_reviews", "score_range"] == (1, 0) or got["order_reviews", "score_range"] == (1, 1)
    assert got["products", "product_category_name_known"] == (2, 1) and got["products", "weight_positive"] == (2, 1)
    assert got["category_translation", "english_present"] == (2, 1)
    declared = sum(len(r.rows) + len(r.references) for r in RULES.values()) + 2 * (len(RULES) - 1)
    assert len(got) == declared


def test_repeated_keys_and_empty_tables(tables):
    clean = {e: CLEANERS[e](df) for e, df in tables.items()}
    twice = clean | {"orders": clean["orders"].unionByName(clean["orders"])}
    got = {(r["entity"], r["rule"]): (r["checked"], r["violations"]) for r in rule_report(twice).collect()}
    assert got["orders", "key_unique"] == (6, 3) and got["order_items", "order_id_known"] == (3, 1)
    empty = {e: df.where(F.lit(False)) for e, df in clean.items()}
    assert {(r["checked"], r["violations"]) for r in rule_report(empty).collect()} == {(0, 0)}

