"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept, and returns the documents that stay, with all their columns; the last
returns the packed pieces. ``run`` writes each stage's rows as Parquet into the
shared checkpoint folder and reads them again for the next.

Stages decide by doc_id. A row without doc_id cannot be told from another, so
only the classifier, which judges rows, can remove it; the other stages keep
it. Rows that share a doc_id but not their text are told apart by the exact
stage only; later they stay or go together. Null and empty texts pass through
the operators with the results that their modules define. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import best_two_fit, decontaminate, exact_dedup, jaccard_join, quality_cnn
from strata.llm.common import ascii_lower, id_filter, materialise, read_table, ship_code, without

SEQUENCE = 1024
QUALITY_AT_LEAST = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from their labels."""
    ship_code(spark)
    network = quality_cnn.Network().fit(*quality_cnn.training_sample(docs, read_table(spark, sf_dir, "labels")))
    return quality_cnn.keep_good(docs, network, QUALITY_AT_LEAST)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, once."""
    ship_code(spark)
    judged = materialise(exact_dedup.exact_dedup(docs, keep="largest"), "exact")
    by_id = judged.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("any_kept"), F.min("kept").alias("all_kept"))
    left = without(docs, by_id.filter("NOT any_kept").select("doc_id"))
    both = materialise(by_id.filter("any_kept AND NOT all_kept").select("doc_id"), "repeated-ids")
    if both.isEmpty():
        return left
    # rows that repeat an id: decided by their text as well, and kept once
    repeated = id_filter(both)(left["doc_id"])
    digest, nth = ("_" * (1 + max(map(len, docs.columns))) + name for name in ("sha256", "nth"))  # no column's name
    rows = left.filter(repeated).withColumn(digest, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))).cast("binary"), 256))
    stay = judged.filter("kept").select(F.col("doc_id").alias(f"{digest}_id"), F.col("text_sha256").alias(f"{digest}_kept"))
    same = (rows["doc_id"].cast("long") == stay[f"{digest}_id"]) & (rows[digest] == stay[f"{digest}_kept"])
    # of rows that are equal but for their letters' case, or for other columns, the first in a fixed order
    first = Window.partitionBy("doc_id", digest).orderBy("text", F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    once = rows.filter("doc_id IS NOT NULL").join(stay, same, "left_semi").withColumn(nth, F.row_number().over(first)).filter(F.col(nth) == 1)
    return left.filter(~repeated).unionByName(once.drop(digest, nth)).unionByName(rows.filter("doc_id IS NULL").drop(digest))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles the smallest doc_id stays."""
    ship_code(spark)
    linked = materialise(jaccard_join.jaccard_components(docs), "near")
    return without(docs, linked.filter("doc_id <> component_id").select("doc_id"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    ship_code(spark)
    judged = materialise(decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark")), "contaminated")
    return without(docs, judged.filter("contaminated").select("doc_id"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as pieces in sequences of at most 1,024 tokens."""
    ship_code(spark)
    return best_two_fit.pack(docs, capacity=SEQUENCE, added=True)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]

#: The classifier has no SQL form; tests check run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "after-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
