"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20  # text bytes worked on at once inside a task


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(sc._temp_dir, f"strata-{uuid.uuid4().hex}.zip")  # the driver's own; Spark serves it
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/strata-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation, and
    every later reader sees the same rows.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def named_rows(docs: DataFrame, *columns) -> DataFrame:
    """``columns`` with a name for each row, ``row``, that every later scan repeats.

    Scans of a file table are cut anew each time, by the cores there are then,
    so a row's place in a task names nothing. Rows of files are named by a
    64-bit hash of their file's path and their place in it; other tables are
    numbered once and written. Equal names of two rows have the odds of equal
    64-bit hashes.
    """
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):  # keep a row's file and place, each once
        node = node.children().head()
    if node.children().isEmpty():
        try:
            return docs.select(F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"), *columns)
        except AnalysisException:  # not a table of files
            pass
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), *columns), "rows")


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._scratch)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The named column as large_string, null replaced by the empty text."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offsets of each (rows + 1)."""
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into row ranges of at most ``most`` text bytes.

    A longer text makes a slice of its own; texts are never cut. Yields the
    rows, their bytes and the offsets of each text.
    """
    for batch in batches:
        data, at = text_bytes(text_column(batch, text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def lower_ascii_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int) -> np.ndarray:
    """A random 64-bit code of each byte value."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.full(max(n, 1024), base, np.uint64)
            have[0] = 1
            have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def words_of(data: np.ndarray, at: np.ndarray, is_word: np.ndarray, codes: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of word bytes) of the texts: start, end, row, 64-bit hash.

    ``is_word`` marks word bytes and ``codes`` gives a byte's code, so a code
    table that repeats the small letters' codes for capitals folds case. No
    word crosses a text's end. Long input is worked on in parts of
    ``SLICE_BYTES``; a word that two parts share is put together again, so the
    working memory beside the words themselves is that of one part.
    """
    found = []
    for begun in range(0, max(len(data), 1), SLICE_BYTES):
        stop = min(begun + SLICE_BYTES, len(data))
        low, high = np.searchsorted(at, [begun, stop], "left")
        cuts = np.unique(np.concatenate([[begun], at[low:high], [stop]]))
        starts, ends, sums = _word_sums(data[begun:stop], cuts - begun, is_word, codes, base)
        starts, ends = starts + begun, ends + begun
        if found and len(starts) and len(found[-1][0]) and starts[0] == begun == found[-1][1][-1] and not (low < len(at) and at[low] == begun):
            before, after, parts = found[-1]
            shift = pow(base, int(after[-1] - before[-1]), 1 << 64)
            parts[-1] += sums[0] * np.uint64(shift)
            after[-1] = ends[0]
            starts, ends, sums = starts[1:], ends[1:], sums[1:]
        if len(starts):
            found.append((starts, ends, sums))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    starts, ends, sums = (np.concatenate(part) if len(found) > 1 else part[0] for part in zip(*found))
    return starts, ends, np.searchsorted(at, starts, "right") - 1, mix64(sums + (ends - starts).astype(np.uint64))


def _word_sums(data: np.ndarray, at: np.ndarray, is_word: np.ndarray, codes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and unmixed hash of the words of texts that begin at ``at``."""
    n = len(data)
    flags = np.zeros(n + 1, np.int8)
    if n:
        flags[:n] = is_word[data]
    edge = np.empty(n + 1, np.bool_)
    edge[0] = flags[0] == 1
    np.not_equal(flags[1:], flags[:-1], out=edge[1:])
    starts_flag = edge & (flags == 1)
    cuts = at[1:-1]
    cuts = cuts[cuts < n]
    starts_flag[cuts] |= flags[cuts] == 1  # a text that begins right after a word byte
    starts = np.flatnonzero(starts_flag)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    # an end: the next non-word byte or the next text's start
    stop_flag = edge & (flags == 0)
    stop_flag[cuts] |= flags[np.maximum(cuts - 1, 0)] == 1
    ends = np.flatnonzero(stop_flag)
    if len(ends) and ends[0] == 0:
        ends = ends[1:]
    ends = ends[: len(starts)]
    lengths = ends - starts
    inside = np.repeat(starts, lengths)
    where = np.flatnonzero(flags[:n])
    values = codes[data[where]] * powers(base, int(lengths.max()))[where - inside]
    return starts, ends, np.add.reduceat(values, np.cumsum(lengths) - lengths)


def word_slices(batches: Iterator[pa.RecordBatch], is_word: np.ndarray, text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, bool]]:
    """As ``slices``, but a longer text comes in parts, cut where no word is.

    The last value tells whether the rows end here: a part of a longer text is
    followed by the next one until it does. A word longer than ``most`` is
    never cut.
    """
    for rows, data, at in slices(batches, text, most):
        if len(data) <= most:
            yield rows, data, at, True
            continue
        begun = 0
        while begun < len(data):
            stop = min(begun + most, len(data))
            if stop < len(data):
                gaps = np.flatnonzero(is_word[data[begun:stop]] == 0)
                if len(gaps):
                    stop = begun + int(gaps[-1]) + 1
                else:
                    while stop < len(data) and not len(gaps := np.flatnonzero(is_word[data[stop : stop + most]] == 0)):
                        stop += most
                    stop = min(stop + int(gaps[0]) + 1, len(data)) if len(gaps) else len(data)
            yield rows, data[begun:stop], np.array([0, stop - begun]), stop == len(data)
            begun = stop


def shingle_hashes(words: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every k consecutive words (order counts); len(words) - k + 1 of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= np.uint64(base)
        out += words[i : i + n]
    return mix64(out)


class Feistel:
    """Keyed permutation of 0..size-1: a balanced network with cycle-walking.

    The network permutes the smallest even-bit domain that holds ``size``;
    values that land outside are permuted again until they fall inside, which
    keeps the map a bijection of the range itself.
    """

    def __init__(self, size: int, key: int, rounds: int = 6):
        if not 1 <= size <= 1 << 62:
            raise ValueError("size must be between 1 and 2**62")
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        seeds = np.random.default_rng(key).integers(0, 1 << 63, rounds, dtype=np.uint64)
        self.keys = seeds * np.uint64(2) + np.uint64(1)

    def _once(self, x: np.ndarray) -> np.ndarray:
        shift, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> shift, x & mask
        for key in self.keys:
            left, right = right, left ^ (mix64(right * np.uint64(0x9E3779B97F4A7C15) + key) & mask)
        return left << shift | right

    def __call__(self, values) -> np.ndarray:
        x = self._once(np.atleast_1d(np.asarray(values, np.uint64)))
        while (out := x >= np.uint64(self.size)).any():
            x[out] = self._once(x[out])
        return x.astype(np.int64)


def ascii_lower(column) -> F.Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


BITMAP_BITS = 26  # 2**26 bits: 8 MB however many values go in


def bitmap_of(values: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bitmap of fixed size with the bit of every value's top ``bits`` set.

    A filter without false negatives. Its size is fixed, so it may be sent to
    every task; with more values it merely lets more through. Partial bitmaps
    are or-ed before the shuffle.
    """
    at = F.shiftrightunsigned(F.col(column), 64 - bits)
    parts = values.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in parts.collect():  # at most 2**(bits - 15) rows of 4 KB
        out[row["part"] << 12 : (row["part"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    return out


class SentBitmap:
    """A bitmap sent to the tasks compressed, and unpacked once a process."""

    def __init__(self, spark: SparkSession, bitmap: np.ndarray):
        self.token = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(zlib.compress(bitmap.tobytes(), 1))

    @property
    def value(self) -> np.ndarray:
        if self.token not in _UNPACKED:
            while len(_UNPACKED) > 3:
                _UNPACKED.pop(next(iter(_UNPACKED)))
            _UNPACKED[self.token] = np.frombuffer(zlib.decompress(self.packed.value), np.uint8)
        return _UNPACKED[self.token]

    def destroy(self) -> None:
        """Drop the copies on the executors, once nothing reads them again."""
        self.packed.destroy()


_UNPACKED: dict[str, np.ndarray] = {}


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    bits = int(len(bitmap)).bit_length() + 2
    at = values >> np.uint64(64 - bits)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return values.view(np.int64)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases.

    Spark drops them once the driver has collected the plans that refer to
    them, which would otherwise happen at its periodic collection only.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _id_hash(ids: np.ndarray) -> np.ndarray:
    return mix64(ids.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


def id_filter(ids: DataFrame, column: str = "doc_id"):
    """A condition on an id that holds for all of ``ids`` and for few others."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(signed(_id_hash(batch.column(0).to_numpy())))], names=["key"])

    longs = ids.select(F.col(column).cast("long").alias(column)).filter(F.col(column).isNotNull())
    shared = SentBitmap(ids.sparkSession, bitmap_of(longs.mapInArrow(keys, "key long"), "key"))

    @F.pandas_udf("boolean")
    def listed(values: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, _id_hash(values.to_numpy(np.int64))))

    return lambda docs_column: listed(F.coalesce(docs_column.cast("long"), F.lit(0)))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``dropped`` (a null never is).

    Only rows that the ids' bitmap lets through are shuffled to be joined; the
    texts of all others stay where they are.
    """
    dropped = dropped.select(F.col("doc_id").alias("dropped_id")).filter("dropped_id IS NOT NULL").distinct()
    listed = id_filter(dropped, "dropped_id")(docs["doc_id"])
    suspects = docs.filter(listed).join(dropped, docs["doc_id"].cast("long") == dropped["dropped_id"], "left_anti")
    return docs.filter(~listed).unionByName(suspects)
