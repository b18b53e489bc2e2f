"""Quality checks: key checks, layer reconciliation, row counts during writes.

All checks are distributed aggregates; the driver only receives the handful
of numbers they produce.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.clean import blank_to_null
from strata.plans.silver import newest_first
from strata.sources.schemas import INGEST_POS, KEYS, UNKEYED


def key_check(df: DataFrame, key: str, entity: str, raw: bool) -> DataFrame:
    """One row ``(entity, null_keys, dup_keys)``: rows whose key is blank
    (raw) or NULL (clean), and keys held by more than one row. A single
    shuffle: group by the key, then count groups."""
    k = blank_to_null(key) if raw else F.col(key)
    per_key = df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).cast("bigint").alias("dup_keys"),
    ).select(F.lit(entity).alias("entity"), "null_keys", "dup_keys")


def key_checks(tables: dict[str, DataFrame], raw: bool) -> DataFrame:
    out = None
    for entity, df in tables.items():
        one = key_check(df, KEYS[entity][0], entity, raw)
        out = one if out is None else out.unionByName(one)
    return out


def reconcile(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Rows per entity in both layers and the difference (rows dropped by
    the blank-key filter and the dedupe)."""
    parts = []
    for entity in raw:
        parts.append(raw[entity].agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), F.lit("raw").alias("layer"), "n"))
        parts.append(clean[entity].agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), F.lit("clean").alias("layer"), "n"))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    counts = stacked.groupBy("entity").agg(
        F.sum(F.when(F.col("layer") == "raw", F.col("n"))).cast("bigint").alias("raw_rows"),
        F.sum(F.when(F.col("layer") == "clean", F.col("n"))).cast("bigint").alias("clean_rows"),
    )
    out = counts.select("entity", "raw_rows", "clean_rows", (F.col("raw_rows") - F.col("clean_rows")).alias("dropped_rows"))
    return out.orderBy("entity")


def discarded(raw: dict[str, DataFrame]) -> DataFrame:
    """Raw rows that the clean load leaves out, by entity and reason: the
    (first) key is blank, or a newer row has the same key. One shuffle per
    entity, of key counts combined on the map side."""
    out = None
    for entity, df in raw.items():
        names = KEYS[entity] or UNKEYED[entity]
        keys = [blank_to_null(k).alias(f"_k{i}") for i, k in enumerate(names)]
        blank = F.col("_k0").isNull() if KEYS[entity] else F.lit(False)
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        one = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("raw_rows"),
            F.coalesce(F.sum(F.when(blank, F.col("_n"))), F.lit(0)).alias("blank_key_rows"),
            F.coalesce(F.sum(F.when(~blank, F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"),
        ).select(F.lit(entity).alias("entity"), "raw_rows", "blank_key_rows", "duplicate_rows")
        out = one if out is None else out.unionByName(one)
    return out


def position_text(df: DataFrame) -> Column:
    """A row's ingest position as text, its parts between slashes."""
    parts = df.schema[INGEST_POS].dataType.names
    return F.concat_ws("/", *[F.coalesce(F.col(INGEST_POS)[p].cast("string"), F.lit("")) for p in parts])


def discarded_detail(raw: dict[str, DataFrame]) -> DataFrame:
    """The raw rows that the clean load leaves out, one by one: entity, reason
    (``blank key``, or ``newer row`` if another row of the key is kept), key,
    position, and the position of the row that is kept.

    The kept row of a key is an aggregate, combined on the map side, and the
    rows are joined to it. That join has one kept row a key, so adaptive
    execution can split a key that a third of all rows have; a window over the
    key would sort them all in one task."""
    out = None
    for entity, df in raw.items():
        names = KEYS[entity] or UNKEYED[entity]
        keys = [blank_to_null(k).alias(f"_k{i}") for i, k in enumerate(names)]
        newest = F.struct(*[c.alias(f"_n{i}") for i, c in enumerate(newest_first(entity))], F.col(INGEST_POS).alias("_pos"))
        rows = df.select(*keys, newest.alias("_newest"), position_text(df).alias("position"))
        key = F.concat_ws("|", *[F.coalesce(F.col(f"_k{i}"), F.lit("")) for i in range(len(names))])
        blank = F.col("_k0").isNull() if KEYS[entity] else F.lit(False)
        keyed = rows.where(~blank)
        # the greatest struct: descending, NULLs last, then the position
        kept = keyed.groupBy(*[f"_k{i}" for i in range(len(names))]).agg(F.max(F.struct("_newest", "position")).alias("_kept"))
        kept = kept.select(*[F.col(f"_k{i}").alias(f"_j{i}") for i in range(len(names))], F.col("_kept.position").alias("kept_position"))
        same = F.lit(True)
        for i in range(len(names)):
            same &= F.col(f"_k{i}").eqNullSafe(F.col(f"_j{i}"))
        older = keyed.join(kept, same).where("position <> kept_position")
        one = older.select(F.lit(entity).alias("entity"), F.lit("newer row").alias("reason"), key.alias("key"), "position", "kept_position")
        if KEYS[entity]:
            empty = rows.where(blank).select(F.lit(entity).alias("entity"), F.lit("blank key").alias("reason"), key.alias("key"), "position", F.lit(None).cast("string").alias("kept_position"))
            one = one.unionByName(empty)
        out = one if out is None else out.unionByName(one)
    return out


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled while ``df`` is written, so the
    write reports its row count without a second scan."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
