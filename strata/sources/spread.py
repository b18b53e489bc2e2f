"""Spread a coarse input over the cluster.

A source that arrives in fewer partitions than the cluster has cores (one
parquet row group, one multi-line CSV file, which cannot be split) would run
all of its per-row work -- parsing, trimming, casting, the map side of the
first shuffle -- in that many tasks. ``spread`` round-robins such an input
over ``defaultParallelism`` partitions right after the scan. An input that
is already split finely enough (any large table) is returned unchanged, so
the extra exchange only ever moves small data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
