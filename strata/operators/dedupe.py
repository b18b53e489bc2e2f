"""Keep one row per key.

``keep_latest`` is the clean layer's dedupe: per key, the row that is newest
by the entity's recency columns (descending, NULLs last) and then by the
stored ingest position. It is ``row_number() = 1``: Spark keeps each task's
own first row of a key before the hash exchange (a partial
``WindowGroupLimit``), so a key holding a third of all rows ships at most one
row per map task, and columns that nobody reads later are pruned at the scan.
The unique ingest position leaves no ties.

``representative`` picks the row with the greatest ordering columns per key
by an aggregate; it is used where the key is a plain column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.schemas import INGEST_POS


def keep_latest(
    df: DataFrame,
    keys: Sequence[Column],
    newest_first: Sequence[Column] = (),
    position: str = INGEST_POS,
) -> DataFrame:
    """One row per value of the ``keys`` expressions: the greatest by
    ``newest_first`` (each descending, NULLs last), then by ``position``.
    Returns the input's columns unchanged."""
    latest = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in newest_first], F.col(position).desc())
    return df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def representative(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the row whose ``order`` columns are greatest,
    compared left to right with NULL lowest (descending, nulls last). Output
    columns: key, then order columns."""
    keys = [key] if isinstance(key, str) else list(key)
    best = F.max(F.struct(*[F.col(c) for c in order])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order])
