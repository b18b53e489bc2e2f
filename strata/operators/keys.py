"""Surrogate keys: the dense rank of a natural key, 1..n in key order.

``DENSE_RANK() OVER (ORDER BY k)`` with no partition makes Spark move every
row into one task. ``key_ranks`` computes the rank in parallel and lazily, the
same way at every size, and the same again whenever any part of it is redone:

1. bounds: the ``SAMPLE`` keys of least hash, a uniform sample that depends on
   the keys alone, sorted, every so many of them taken as a bound. They are one
   row (a scalar subquery), however many keys there are;
2. a key's range is the number of bounds up to it, an expression that searches
   the bounds;
3. a position inside its range from ``row_number`` (one shuffle of the keys),
   plus the keys of the ranges before it, summed over one row a range and sent
   to every task.

Nothing is sampled at run time, so nothing has to be written or fixed: a lost
task, or a second run, gives every key the same rank. Balanced ranges only
spread the work; the rank is exact whatever the bounds are.

Input must hold each key once, which every caller guarantees by building it
with ``groupBy``/``distinct``; equal keys would otherwise get distinct ranks.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, WAYS = 512, 8  # keys of the sample, a power of the parts that a step of the search tells apart


def key_ranks(keys: DataFrame, key: str, out: str, type_name: str = "int", ranges: int | None = None) -> DataFrame:
    """(key, out) of every key that is not NULL, in binary order."""
    keys = keys.select(key).where(F.col(key).isNotNull())
    ranges = min(ranges or 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), SAMPLE)
    sample = keys.orderBy(F.xxhash64(key), key).limit(SAMPLE).agg(F.sort_array(F.collect_list(key)).alias("_keys"))
    every = F.lit(max(1, SAMPLE // ranges))
    bounds = sample.select(F.filter("_keys", lambda _, i: (i + 1) % every == 0)).scalar()
    ranged, step, found = keys.select(key, bounds.alias("_bounds")), SAMPLE // WAYS, F.lit(0)
    while step:  # the search for the last bound up to the key; past the end ``get`` is NULL
        passed = [F.when(F.get("_bounds", found + (way * step - 1)) <= F.col(key), step).otherwise(0) for way in range(1, WAYS)]
        ranged = ranged.select(key, "_bounds", functools.reduce(operator.add, passed, found).alias("_range"))
        step, found = step // WAYS, F.col("_range")
    ranged = ranged.drop("_bounds")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    placed = ranged.withColumn("_pos", F.row_number().over(Window.partitionBy("_range").orderBy(key)))
    return placed.join(F.broadcast(before), "_range").select(key, (F.col("_before") + F.col("_pos")).cast(type_name).alias(out))


def dense_rank_key(df: DataFrame, key: str, out: str, type_name: str = "int", ranks: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = dense rank of ``key`` as the first column. Rows with a
    NULL key are dropped. Only the key column is ranked; the rows, which are
    grouped by the key already, meet it again in a join on the key. ``ranks``
    gives the ranks if they are known, or cheaper to get than from ``df``."""
    if ranks is None:
        ranks = key_ranks(df, key, out, type_name)
    return df.join(ranks, key).select(out, *df.columns)
