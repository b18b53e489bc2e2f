"""Hand-made raw tables: all text, in load order, with an ingest position."""

from pyspark.sql import functions as F

from strata.sources.schemas import INGEST_POS, RAW_COLUMNS, raw_schema


def raw(spark, entity, rows, file_no=0):
    """``rows`` in load order (later = more recent). Missing trailing values
    are NULL."""
    width = len(RAW_COLUMNS[entity])
    data = [tuple(list(r) + [None] * (width - len(r))) for r in rows]
    df = spark.createDataFrame(data, raw_schema(entity)) if data else spark.createDataFrame([], raw_schema(entity))
    idx = F.monotonically_increasing_id()
    df = df.coalesce(1).withColumn(
        INGEST_POS,
        F.struct(F.lit(1).cast("long").alias("load_seq"), F.lit(f"file{file_no}").alias("file"),
                 F.lit(0).cast("long").alias("block"), idx.alias("row")),
    )
    return df


def empty_raw(spark, entity):
    return raw(spark, entity, [])
