"""Incremental raw load with Structured Streaming.

The append mode of the raw load, for a landing folder that keeps receiving
CSV exports: a file-source stream picks up only files it has not seen (the
stream's checkpoint remembers them), and every micro-batch becomes one
raw-layer run that is appended to the layer's published runs.

A run is named after the stream, the stream's checkpoint (by an id stored in
it) and the batch, so streams never write into each other's runs, nor does a
stream that starts over with a new checkpoint. A batch that is replayed
before it was published is written again with the load sequence that its
first attempt stored; one that was published is left alone. A restarted
stream or a lost executor thus neither duplicates nor loses a file.

The load sequence is the time in nanoseconds, as in the batch load, so
streamed and batch-loaded rows rank by when they were loaded.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans import quality
from strata.plans.pipeline import Warehouse
from strata.sources.csv_source import CSV_OPTIONS, ingest_position
from strata.sources.schemas import INGEST_POS, RAW_COLUMNS, SECTIONS, raw_schema


def _kept(warehouse: Warehouse, path: str, text: str) -> str:
    """The text stored at ``path``; the first to ask stores its own."""
    warehouse._mkdirs(path.rsplit("/", 1)[0])
    warehouse._create_text(path, text)
    return warehouse._read_text(path)


def start_raw_stream(
    spark: SparkSession,
    warehouse: Warehouse,
    entity: str,
    landing_dir: str,
    checkpoint_location: str,
    stream_name: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Stream the CSV files of ``landing_dir`` into the raw ``entity`` table.
    ``available_now`` processes what is there and stops; otherwise the query
    runs with ``processing_time`` triggers."""
    reader = spark.readStream.schema(raw_schema(entity))
    for k, v in CSV_OPTIONS.items():
        reader = reader.option(k, v)
    stream = reader.csv(landing_dir).select(
        *RAW_COLUMNS[entity],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    warehouse.create_layers()
    origin = _kept(warehouse, f"{checkpoint_location.rstrip('/')}/strata/stream-id", uuid.uuid4().hex).strip()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{stream_name}-{origin}-{entity}-{batch_id:012d}"
        if run_id in warehouse.runs("raw"):
            return
        t0 = time.perf_counter()
        row = {"run_id": run_id, "layer": "raw", "section": SECTIONS[entity], "table": entity}
        try:
            run = f"{warehouse.root}/raw/{run_id}"
            load_seq = int(_kept(warehouse, f"{run}/_load_seq/value", str(time.time_ns())))
            position = ingest_position(load_seq, "_file", "_block").alias(INGEST_POS)
            out, counted = quality.observed(batch.select(*RAW_COLUMNS[entity], position), run_id)
            out.write.mode("overwrite").parquet(f"{run}/{entity}")
            row["rows"] = int(counted.get["rows"])
            warehouse.publish_run("raw", run_id, [entity])
            row["status"] = "ok"
        except Exception as exc:  # audited, then raised: the stream stops and replays the batch
            row["status"], row["error"] = "failed", f"{type(exc).__name__}: {exc}"
            raise
        finally:
            row["seconds"] = round(time.perf_counter() - t0, 3)
            warehouse._write_audit([row])

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
