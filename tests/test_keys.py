"""Surrogate keys: the parallel rank equals a plain global dense rank."""

import datetime
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import keys
from strata.operators.keys import dense_rank_key, key_ranks
from strata.operators.lookup import calendar, date_lookups


def test_parallel_rank_matches_dense_rank(spark):
    rnd = random.Random(7)
    names = list({"k%05d_%s" % (rnd.randint(0, 99999), rnd.choice("ab_2Z")) for _ in range(1500)} | {"", "é", "z" * 50})
    df = spark.createDataFrame([(k, len(k)) for k in names], "k string, v int").repartition(4)
    ref = df.withColumn("sk", F.dense_rank().over(Window.orderBy("k")).cast("int"))
    want = sorted(map(tuple, ref.select("sk", "k", "v").collect()))
    for ranges in (1, 5, 700):
        ranks = key_ranks(df, "k", "sk", ranges=ranges)
        assert sorted(map(tuple, dense_rank_key(df, "k", "sk", ranks=ranks).collect())) == want
    assert [r[0] for r in want] == list(range(1, len(names) + 1))


def test_few_and_no_keys(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert sorted(map(tuple, dense_rank_key(df, "k", "sk").collect())) == [(1, "a"), (2, "b")]
    assert dense_rank_key(df.where("k = 'c'"), "k", "sk").collect() == []
    typed = dense_rank_key(df, "k", "sk", "smallint").schema["sk"].dataType.simpleString()
    assert typed == "smallint"


def _meeting_in_one_task(df):
    """What the plan's single-partition exchanges read."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_only_counts_and_the_sample_meet_in_one_task(spark):
    df = spark.range(0, 5000).select(F.format_string("id%06d", "id").alias("k"))
    below = _meeting_in_one_task(dense_rank_key(df, "k", "sk"))
    assert below and all("keys=[_range" in line or "collect_list" in line or "Aggregate(keys=[], functions=[partial_collect" in line for line in below), below


def test_the_rank_is_lazy_and_repeatable(spark):
    """Building it starts no job and writes nothing; every run, however the
    input is cut, gives the same ranks."""
    from tests.test_model import jobs_started

    df = spark.range(0, 3000).select(F.format_string("id%06d", F.pmod(F.xxhash64("id"), F.lit(100000))).alias("k")).distinct()
    with jobs_started(spark) as started:
        lazy = dense_rank_key(df, "k", "sk")
        again = dense_rank_key(df.repartition(3), "k", "sk")
    assert started() == 0
    assert "Checkpoint" not in lazy._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, again.collect()))


def test_ranges_are_even(spark):
    """No range holds much more than its share, also when the keys share most of their letters."""
    df = spark.range(0, 20000).select(F.format_string("customer-%08d", "id").alias("k"))
    plan = key_ranks(df, "k", "sk", ranges=32)
    ranges = plan.select("sk").count()
    assert ranges == 20000
    sample = [r["k"] for r in df.orderBy(F.xxhash64("k"), "k").limit(keys.SAMPLE).collect()]
    bounds = sorted(sample)[31::32]
    held = [sum(1 for i in range(20000) if (lo <= "customer-%08d" % i < hi)) for lo, hi in zip(["", *bounds], [*bounds, "d"])]
    assert max(held) < 3 * 20000 / 32


def test_large_dimensions_take_the_parallel_rank(spark):
    """No dimension's keys meet in one task, however few they are."""
    from strata.plans import dims
    from strata.plans.silver import clean_orders, clean_products, clean_sellers
    from tests.fixtures import raw

    for df in (
        dims.product_key_map(clean_products(raw(spark, "products", [("p1",), ("p2",)]))),
        dims.seller_keys(clean_sellers(raw(spark, "sellers", [("s1",)]))),
        dims.dim_order_status(clean_orders(raw(spark, "orders", [("o1", "c1", "delivered")]))),
    ):
        assert all("keys=[_range" in line or "collect_list" in line for line in _meeting_in_one_task(df))


def test_date_keys_are_ranks_of_days(spark):
    rng = random.Random(3)
    days = sorted({datetime.date(rng.choice([1, 1899, 1969, 1970, 2017, 2018, 9999]), rng.randint(1, 12), rng.randint(1, 28)) for _ in range(300)} | {datetime.date(1970, 1, 1), datetime.date(1969, 12, 31)})
    seen = spark.createDataFrame([(d,) for d in days] * 2 + [(None,)], "full_date date")
    asked = [*days, None, datetime.date(1500, 1, 1), datetime.date(9999, 12, 31), datetime.date(2018, 1, 31), datetime.date(1, 1, 1)]
    df = spark.createDataFrame([(d, d) for d in asked], "d date, e date")
    got = date_lookups(df, calendar(seen), {"sk": F.col("d"), "sk2": F.col("e")})
    want = {d: i + 1 for i, d in enumerate(days)}
    assert {(r["d"], r["sk"], r["sk2"]) for r in got.collect()} == {(d, want.get(d), want.get(d)) for d in asked}
    joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert all("word" in line for line in joins)  # only where the subquery lays out the words
    empty = date_lookups(df, calendar(seen.where("false")), {"sk": F.col("d")})
    assert {r["sk"] for r in empty.collect()} == {None}
