"""Training-order token shards.

Documents are tokenised and laid end to end, task by task, in sequences of
exactly ``seq_len`` ids; only a task's last sequence is filled up with zeros.
Sequences are numbered in input order (the count of the tasks before, plus the
place inside the task), and a keyed Feistel permutation with cycle-walking
sends each number to a global slot. Slots are dealt to shards by range, and a
task writes a shard as records of one fixed stride in slot order, so slot s is
record ``s % shard_rows`` of shard ``s // shard_rows``: a reader resumes
anywhere by seeking, and reads the training order from front to back. Until a
task has them, the records of a batch that go to one shard are one compressed
bundle.

A record is seq_len ids as little-endian unsigned 16-bit and a line feed.
Shards (``shards/shard=N``) are written by Spark's own committer, so a lost
executor leaves no half shard. An index (``index``, Parquet) names the piece
of a document behind every stretch of a slot.

Defined results: a null text counts as empty; an empty text is the end token
alone. Repeated rows are written each on its own. A null doc_id stays null. An
empty table writes nothing. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.best_two_fit import END_TOKEN, encoder, text_encoder
from strata.llm.common import Feistel, materialise, text_column

MOST_IDS = 1 << 16  # ids must fit the two bytes of a record's cell
SHARDS_A_TASK = 8  # 128 MB of records to sort at the default sizes

PIECE = "struct<doc_id:long,piece:int,start:long,at:int,n_tokens:int,ids_crc32:long>"
SEQUENCE = f"run long, place long, record binary, crc long, pieces array<{PIECE}>"
_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("at", pa.int32()), ("n_tokens", pa.int32()), ("ids_crc32", pa.int64())]))


def stride(seq_len: int) -> int:
    return 2 * seq_len + 1


def _sequences(batches: Iterator[pa.RecordBatch], seq_len: int, vocabulary: str | None, added: bool) -> Iterator[pa.RecordBatch]:
    encode = text_encoder(vocabulary, added)
    if encoder(vocabulary).n_vocab > MOST_IDS:
        raise ValueError("the vocabulary does not fit two-byte ids")
    run, place = TaskContext.get().partitionId(), 0
    cells, filled, held = np.zeros(seq_len, "<u2"), 0, []
    records, pieces = [], []

    def flush() -> pa.RecordBatch:
        nonlocal place
        n = len(records)
        columns = [pa.array([run] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), pa.array(records, pa.binary())]
        columns += [pa.array([zlib.crc32(r) for r in records], pa.int64()), pa.array(pieces, _PIECES)]
        place += n
        records.clear()
        pieces.clear()
        return pa.RecordBatch.from_arrays(columns, names=["run", "place", "record", "crc", "pieces"])

    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        for doc_id, text in zip(ids, text_column(batch)):
            tokens = encode(text.as_py())
            tokens.append(END_TOKEN)
            wide = np.array(tokens, "<u4")
            start = piece = 0
            while start < len(wide):
                part = wide[start : start + seq_len - filled]
                cells[filled : filled + len(part)] = part
                held.append({"doc_id": doc_id, "piece": piece, "start": start, "at": filled, "n_tokens": len(part), "ids_crc32": zlib.crc32(part)})
                filled += len(part)
                start += len(part)
                piece += 1
                if filled == seq_len:
                    records.append(cells.tobytes())
                    pieces.append(held)
                    filled, held = 0, []
        if records:
            yield flush()
    if filled:
        cells[filled:] = 0
        records.append(cells.tobytes())
        pieces.append(held)
        yield flush()


def _bundle(records: list[bytes]) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(b"".join(records), asbytes=True)


def _unbundle(bundle: bytes, n: int, seq_len: int) -> list[bytes]:
    width = 2 * seq_len
    cells = pa.decompress(bundle, n * width, "zstd", asbytes=True)
    return [cells[at : at + width] for at in range(0, n * width, width)]


def _bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, slots, bundle) of the records (shard, slot, record) of each batch."""
    for batch in batches:
        shard, slot = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        records = batch.column(2).to_pylist()
        order = np.argsort(shard, kind="stable")
        shards, starts = np.unique(shard[order], return_index=True)
        groups = np.split(order, starts[1:]) if len(order) else []
        columns = [pa.array(shards, pa.int64()), pa.array([slot[g].tolist() for g in groups], pa.list_(pa.int64()))]
        columns.append(pa.array([_bundle([records[i] for i in g.tolist()]) for g in groups], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "slots", "bundle"])


def _unbundled(batches: Iterator[pa.RecordBatch], seq_len: int) -> Iterator[pa.RecordBatch]:
    """(shard, slot, record) again, a bundle at a time."""
    for batch in batches:
        for shard, slots, bundle in zip(*(c.to_pylist() for c in batch.columns)):
            columns = [pa.array([shard] * len(slots), pa.int64()), pa.array(slots, pa.int64()), pa.array(_unbundle(bundle, len(slots), seq_len), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "slot", "record"])


def write_shards(docs: DataFrame, path: str, key: int, seq_len: int = 1024, shard_rows: int = 8192, vocabulary: str | None = None, added: bool = False) -> int:
    """Write ``shards`` and ``index`` below ``path``; returns the number of sequences.

    added: an added token that stands in a text is one id, not ordinary text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = materialise(rows.mapInArrow(lambda batches: _sequences(batches, seq_len, vocabulary, added), SEQUENCE), "sequences")
    counts = made.groupBy("run").agg(F.count(F.lit(1)).alias("n"))  # one row per input task
    bases = counts.select("run", F.coalesce(F.sum("n").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0

    def slots(batches: Iterator[pa.RecordBatch], payload: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
        order = Feistel(total, key)
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            slot = order(column("base").to_numpy() + column("place").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(slot // shard_rows), pa.array(slot), *map(column, payload)], names=["shard", "slot", *payload])

    if not total:
        return 0
    numbered = made.join(F.broadcast(bases), "run")  # one short row per input task: the records stay where they are
    slotted = numbered.select("base", "place", "record").mapInArrow(lambda b: _bundled(slots(b, ("record",))), "shard long, slots array<long>, bundle binary")
    shards = -(-total // shard_rows)
    tasks = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // SHARDS_A_TASK)))
    (
        slotted.repartitionById(tasks, F.expr(f"int(shard * {tasks} div {shards})"))  # neighbouring shards, as many each
        .mapInArrow(lambda b: _unbundled(b, seq_len), "shard long, slot long, record binary")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("value"))
        .write.partitionBy("shard").option("lineSep", "\n").text(f"{path}/shards")
    )
    listed = numbered.select("base", "place", "crc", "pieces").mapInArrow(lambda b: slots(b, ("crc", "pieces")), f"shard long, slot long, crc long, pieces array<{PIECE}>")
    listed.write.parquet(f"{path}/index")
    return total


def read_records(spark: SparkSession, path: str, seq_len: int = 1024, shard_rows: int = 8192) -> DataFrame:
    """(slot, crc) of every record in the shards, read from the files."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, width = memoryview(content.as_buffer()), stride(seq_len)
                checks = [zlib.crc32(data[at : at + width - 1]) for at in range(0, len(data), width)]
                yield pa.RecordBatch.from_arrays([pa.array(shard * shard_rows + np.arange(len(checks))), pa.array(checks, pa.int64())], names=["slot", "crc"])

    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary, shard long").format("binaryFile").load(f"{path}/shards")
    return files.select("shard", "content").mapInArrow(parse, "slot long, crc long")


def read_index(spark: SparkSession, path: str, seq_len: int = 1024, shard_rows: int = 8192) -> DataFrame:
    """Every piece: doc_id, piece, start, slot, shard, at, n_tokens, ids_crc32, and
    whether the slot's record is in its shard as it was made (intact)."""
    listed = spark.read.parquet(f"{path}/index")
    found = read_records(spark, path, seq_len, shard_rows).select("slot", F.col("crc").alias("found"))
    whole = listed.join(found, "slot", "left").withColumn("intact", F.coalesce(F.col("crc") == F.col("found"), F.lit(False)))
    return whole.select("slot", "shard", "intact", F.explode("pieces").alias("p")).select("p.doc_id", "p.piece", "p.start", "slot", "shard", "p.at", "p.n_tokens", "p.ids_crc32", "intact")


def read_slot(shard: bytes, slot: int, seq_len: int = 1024, shard_rows: int = 8192) -> np.ndarray:
    """The ids of a slot, from the bytes of its shard."""
    return np.frombuffer(shard, "<u2", seq_len, slot % shard_rows * stride(seq_len))
