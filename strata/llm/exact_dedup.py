"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition turns its rows into sorted runs: one entry for each
digest, with the row to keep so far, the count and the rows behind it. Runs
then meet in binomial rounds: in each round the run groups whose numbers agree
but for their lowest bits exchange entries, digest range by digest range, and
a merging task folds equal digests into one. A digest that a third of all rows
carry is thus one entry per run from the start, and one entry per group after
every round. Digest ranges keep the last rounds spread over the cluster.

Entries are merged only if SHA-256, byte length and a second, independent
64-bit checksum agree, at every level.

Defined results: a null text counts as the empty text; all empty texts are
equal. Repeated rows (same id, same text) are copies of which exactly one is
kept. A null id counts as smaller than every id. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_column

RUN_ENTRIES = 200_000  # rows a task holds before it ends a run
RUN_SCHEMA = "run long, digest binary, size long, check long, rows array<struct<id:long,place:long>>"
IDENTITY = ["digest", "size", "check"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = TaskContext.get().partitionId()
    row_type = pa.list_(pa.struct([("id", pa.int64()), ("place", pa.int64())]))
    entries: dict[tuple, list] = {}
    held = place = 0

    def ended() -> pa.RecordBatch:
        keys = sorted(entries)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([run] * len(keys), pa.int64()),
                pa.array([k[0] for k in keys], pa.binary()),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([k[2] for k in keys], pa.int64()),
                pa.array([[{"id": i, "place": p} for i, p in entries[k]] for k in keys], row_type),
            ],
            names=["run", "digest", "size", "check", "rows"],
        )

    for batch in batches:
        texts = pc.ascii_lower(text_column(batch))
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1].tolist()
        view = memoryview(data if data is not None else b"")
        for i, doc_id in enumerate(ids):
            text = view[at[i] : at[i + 1]]
            check = xxhash.xxh64_intdigest(text) - (1 << 63)
            entries.setdefault((hashlib.sha256(text).digest(), len(text), check), []).append((doc_id, place))
            place += 1
            held += 1
            if held >= RUN_ENTRIES:
                yield ended()
                entries.clear()
                held = 0
    if entries:
        yield ended()


def digest_runs(docs: DataFrame) -> DataFrame:
    """Sorted runs of (digest, size, check) with the rows behind each entry."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_runs, RUN_SCHEMA)


def merge_rounds(entries: DataFrame, runs: int, pick, fan_in: int = 8) -> DataFrame:
    """Fold runs in rounds of ``fan_in`` (a power of two: log2 binomial steps).

    ``entries`` has run, the identity columns, keep and group_size. In a round,
    runs whose number div fan_in agrees meet, range by range; after the last
    there is one entry for each identity.
    """
    if fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("fan_in must be a power of two")
    spark = entries.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leading = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    merged = entries.withColumn("lane", F.floor(leading * ranges / F.lit(1 << 32)).cast("int"))
    while True:
        merged = (
            merged.withColumn("run", F.floor(F.col("run") / fan_in))
            .repartition("lane", "run")
            .sortWithinPartitions("lane", "run", *IDENTITY)
            .groupBy("lane", "run", *IDENTITY)
            .agg(pick("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        )
        runs = -(-runs // fan_in)
        if runs <= 1:
            return merged.select(*IDENTITY, "keep", "group_size")


def exact_dedup(docs: DataFrame, keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. ``keep`` names which
    id of equal texts stays: "smallest" or "largest".
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    best, pick = (F.array_min, F.min) if keep == "smallest" else (F.array_max, F.max)
    runs = materialise(digest_runs(docs), "digest-runs")
    last = runs.agg(F.max("run").alias("last")).first()["last"]
    row = lambda r: F.struct(r["id"].alias("id"), F.col("run").alias("run"), r["place"].alias("place"))
    entries = runs.select("run", *IDENTITY, best(F.transform("rows", row)).alias("keep"), F.size("rows").cast("long").alias("group_size"))
    winners = merge_rounds(entries, (last or 0) + 1, pick, fan_in)
    # a run holds one entry for a digest, so a hot digest meets its winner once per run
    rows = runs.join(winners, IDENTITY).select("run", "digest", "keep", "group_size", F.explode("rows").alias("row"))
    same_row = (F.col("keep.run") == F.col("run")) & (F.col("keep.place") == F.col("row.place"))
    return rows.select(
        F.col("row.id").alias("doc_id"),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        same_row.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
