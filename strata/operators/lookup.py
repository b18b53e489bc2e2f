"""Left lookups against dimensions, with a checked broadcast; date keys from a
bitmap of days.

A dimension is broadcast only after its row count is measured to be under a
bound; above the bound the join stays a shuffle join and adaptive execution
may still switch it once the real shuffle size is known.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Broadcast bound for dimensions whose size is bounded by nature
# (statuses, payment types).
SMALL_DIM_ROWS = 100_000
# Broadcast bound for key -> surrogate-key lookups whose size grows with the
# data (sellers, products): one million (id, sk) pairs is a few tens of MB.
LOOKUP_ROWS = 1_000_000


def sized_broadcast(df: DataFrame, max_rows: int = SMALL_DIM_ROWS, kept: list | None = None) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows, else leave the
    join to a shuffle. The dimension is persisted first, so the counting
    job fills the cache that the broadcast then reads; ``kept`` collects what
    stays persisted, for the caller to release."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if df.count() <= max_rows:
        if kept is not None:
            kept.append(df)
        return F.broadcast(df)
    return df.unpersist()


def calendar(dates: DataFrame) -> DataFrame:
    """The dates of ``full_date``, repeated or not, as one row: a bitmap of days
    in words of 64, from the first word on, and how many days there are before
    each. Dates become words before the only shuffle, and the row's size follows
    their span (456 KB for ten thousand years)."""
    word, bit = F.shiftright(F.unix_date("full_date"), 6).alias("word"), F.expr("1L << (unix_date(full_date) & 63)")
    words = dates.where(F.col("full_date").isNotNull()).groupBy(word).agg(F.bit_or(bit).alias("bits"))
    in_order = Window.orderBy("word")
    days = F.bit_count("bits")
    before = (F.sum(days).over(in_order) - days).cast("int").alias("before")
    gap = (F.lead("word").over(in_order) - F.col("word") - 1).alias("gap")  # words without a day up to the next one
    listed = words.select("word", "bits", before, gap).agg(F.sort_array(F.collect_list(F.struct("word", "bits", "before", "gap"))).alias("words"))

    def dense(name: str, none: Column) -> Column:
        return F.flatten(F.transform("words", lambda w: F.concat(F.array(w[name]), F.array_repeat(none, F.coalesce(w["gap"], F.lit(0)))))).alias(name)

    return listed.select(F.get("words", F.lit(0))["word"].alias("first"), dense("bits", F.lit(0).cast("bigint")), dense("before", F.lit(0)))


def _date_rank(on: Column) -> Column:
    """The dense rank of the calendar date ``on`` by the calendar row ``_days``."""
    day = F.unix_date(on)
    word = F.shiftright(day, 6) - F.col("_days.first")
    bits, bit = F.get("_days.bits", word), day.bitwiseAND(F.lit(63))
    held = F.call_function("shiftright", bits, bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bit))
    return F.when((word >= 0) & held, F.get("_days.before", word) + F.bit_count(bits.bitwiseAND(lower)) + 1)


def date_lookups(df: DataFrame, days: DataFrame, roles: dict[str, Column]) -> DataFrame:
    """Add each name of ``roles`` = ``date_sk`` of its calendar date, NULL when
    the date is NULL or not one of ``days``: the row of ``calendar``, or a table
    of dates to make it from. It is one scalar subquery for all roles, and no
    role needs a join."""
    days = calendar(days) if "full_date" in days.columns else days
    row = days.select(F.struct("first", "bits", "before")).scalar()
    return df.withColumn("_days", row).withColumns({out: _date_rank(on) for out, on in roles.items()}).drop("_days")
