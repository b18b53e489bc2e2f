"""Removal of repeated byte strings by bucket-pointer refinement.

Every ``length``-byte string that also starts earlier (smaller doc_id, or the
same document at an earlier place) is removed. Positions are kept in buckets
of equal content, as a suffix sorter keeps them, and buckets are refined by
the identifiers of longer content until every string is decided:

1. q-gram buckets. A string's pointer is its least q-gram (the rightmost of
   equals), so equal strings have pointers at the same place in the same
   bucket, and the strings of one pointer stand side by side. Buckets with one
   pointer are settled: nothing there repeats.
2. Hull buckets. A pointer is refined by the identifier of the whole stretch
   that its strings cover. Of equal hulls the earliest stays; all strings of
   the others repeat. A q-gram bucket that holds only one kind of hull is
   settled.
3. The earliest hulls of the other buckets are refined in recursion: a block
   of neighbouring strings of a pointer has a core (the bytes that all of its
   strings have) and a hull. Equal hulls settle a block, a core found once
   settles it too; what is left is cut into smaller blocks, down to a string.

Identifiers are 64-bit hashes and are compared only inside one q-gram bucket,
so two contents are mistaken for each other only if they share their q-gram's
identifier and their own. Buckets are aggregated before they are shuffled, and
no task needs all members of a bucket. Bitmaps pass the surviving identifiers
to the next scan; what slips through one is only work. They grow with the
identifiers, up to a fixed size.

Defined results: a null text counts as empty; texts of fewer than ``length``
bytes lose nothing. A null doc_id comes before every other. Rows with the same
doc_id are ordered by their names, which no scan changes (see ``named_rows``);
a table that is not one of files keeps its order. An empty table gives an empty
result. Other columns are not read. A text of more than ``PIECE`` bytes is worked on in pieces that
overlap by ``length`` - 1 bytes, so each string lies inside exactly one of them.
A pointer whose strings two pieces share has a hull in each, as if its strings
were cut by a text's end; which strings repeat stays the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SentBitmap, bitmap_of, byte_codes, discard, in_bitmap, materialise, mix64, named_rows, powers, signed, slices

LENGTH, Q = 100, 32
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
PLACE_BITS = 28
LEVELS = (16, 4, 1)  # strings in a block, level by level
SLICE = PIECE = 1 << 20
BITS, MOST_BITS = 27, 29  # of the bitmaps: 16 MB each, at most 64 MB

FOUND = "bucket long, hull long, doc_id long, row long, first int, strings int"


class Prefix:
    """Hashes of any substring of a byte string, from its prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.back = powers(UNBASE, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(byte_codes(4)[data] * powers(BASE, n + 1)[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix64((self.sums[stop] - self.sums[start]) * self.back[start])


@dataclass
class Pointers:
    """Pointers of a slice: text, place, bucket, and the first and last string of each."""

    row: np.ndarray
    at: np.ndarray
    bucket: np.ndarray
    first: np.ndarray
    last: np.ndarray
    prefix: Prefix


def pointers(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, q: int = Q) -> Pointers | None:
    """The pointers of all strings that lie inside one text; places are in the slice."""
    if len(data) < length:
        return None
    if len(data) > 1 << PLACE_BITS:
        raise ValueError("a text of more than 2**28 bytes")
    prefix = Prefix(data)
    every = np.arange(len(data) - q + 1)
    grams = prefix(every, every + q)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = grams & ~low | low - every.astype(np.uint64)  # of equal grams the rightmost is least
    window, width = length - q + 1, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if rest := window - width:
        least = np.minimum(least[:-rest], least[rest:])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    string = np.flatnonzero(np.arange(len(least)) + length <= offsets[row + 1])
    if not len(string):
        return None
    row, at = row[string], (low - (least[string] & low)).astype(np.int64)
    new = np.ones(len(at), np.bool_)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    bucket = mix64(grams[at[begin]])  # a least gram's own hash is a small number, which would crowd the bitmaps
    return Pointers(row[begin], at[begin], bucket, string[begin], string[end], prefix)


def _rows(batches: Iterator[pa.RecordBatch], most: int = SLICE) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Slices with the name of each row."""
    for batch, data, offsets in slices(batches, most=most):
        yield batch.column(1).to_numpy(), batch.column(0), data, offsets


def _pointers(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, Pointers]]:
    """Slices and their pointers; a longer text comes in pieces. Offsets are those
    of the texts' starts, so they are negative for a later piece."""
    for rows, ids, data, offsets in _rows(batches, min(SLICE, piece)):
        for begun in range(0, max(len(data) - LENGTH + 1, 1), piece - LENGTH + 1) if len(data) > piece else (0,):
            part = data[begun : begun + piece]
            if (p := pointers(part, np.array([0, len(part)]) if len(data) > piece else offsets)) is not None:
                yield rows, ids, part, offsets - begun, p


def place_key(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix64(row.astype(np.uint64) * np.uint64(BASE) + at.astype(np.uint64))


def _buckets(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    for *_, p in _pointers(batches, piece):
        bucket, counts = np.unique(p.bucket, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(bucket)), pa.array(counts)], names=["bucket", "n"])


def _hulls(batches: Iterator[pa.RecordBatch], shared: np.ndarray, piece: int) -> Iterator[pa.RecordBatch]:
    for rows, ids, _, offsets, p in _pointers(batches, piece):
        kept = np.flatnonzero(in_bitmap(shared, p.bucket))
        hull = hull_id(p, kept)
        row, first = p.row[kept], p.first[kept]
        columns = [pa.array(signed(p.bucket[kept])), pa.array(signed(hull)), ids.take(pa.array(row)), pa.array(rows[row])]
        columns += [pa.array((first - offsets[row]).astype(np.int32)), pa.array((p.last[kept] - first + 1).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "hull", "doc_id", "row", "first", "strings"])


def hull_id(p: Pointers, kept: np.ndarray) -> np.ndarray:
    """Identifies the content of a pointer's strings and where the pointer is in them."""
    first, last = p.first[kept], p.last[kept]
    shape = ((p.at[kept] - first) << 16 | last - first).astype(np.uint64)
    return mix64(p.prefix(first, last + LENGTH) + shape * np.uint64(UNBASE))


def _stretches(batches: Iterator[pa.RecordBatch], mixed: np.ndarray, earliest: np.ndarray, piece: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the earliest hulls in buckets of several kinds of hull."""
    for rows, ids, data, offsets, p in _pointers(batches, piece):
        kept = np.flatnonzero(in_bitmap(mixed, p.bucket))
        first = p.first[kept] - offsets[p.row[kept]]
        kept = kept[in_bitmap(earliest, place_key(rows[p.row[kept]], first))]
        row, first, last = p.row[kept], p.first[kept], p.last[kept]
        raw = data.tobytes()
        pieces = [raw[a : b + LENGTH] for a, b in zip(first.tolist(), last.tolist())]
        columns = [pa.array(signed(p.bucket[kept])), ids.take(pa.array(row)), pa.array(rows[row]), pa.array((first - offsets[row]).astype(np.int32))]
        columns += [pa.array((p.at[kept] - first).astype(np.int32)), pa.array(pieces, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "doc_id", "row", "first", "before", "bytes"])


STRETCH = "bucket long, doc_id long, row long, first int, before int, bytes binary"
BLOCK = "bucket long, core long, hull long, doc_id long, row long, first int, strings int, pointer int"


def block_key(row: np.ndarray, pointer: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Names a block: the text's row, the pointer's place, the block's number at its level."""
    return mix64(place_key(row, pointer) + block.astype(np.uint64) * np.uint64(UNBASE))


def _blocks(batches: Iterator[pa.RecordBatch], width: int, wider: int, active: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Blocks of ``width`` strings inside the active blocks of ``wider`` strings.

    A string is numbered by the pointer's distance from its start, so equal
    strings of a bucket have the same number and fall into the same block.
    """
    for batch in batches:
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        stretch = column("bytes")
        ends = np.cumsum([len(b) for b in stretch.to_pylist()])
        base = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        data = np.frombuffer(b"".join(stretch.to_pylist()), np.uint8)
        if not len(data):
            continue
        prefix = Prefix(data)
        before, row, first = column("before").to_numpy().astype(np.int64), column("row").to_numpy(), column("first").to_numpy().astype(np.int64)
        strings = ends - base - LENGTH + 1
        near = before - strings + 1  # the last string's number; the first one's is ``before``
        low, high = near // width, before // width
        counts = high - low + 1
        source = np.repeat(np.arange(len(base)), counts)
        block = np.repeat(low, counts) + np.arange(len(source)) - np.repeat(np.cumsum(counts) - counts, counts)
        if active is not None:
            kept = in_bitmap(active, block_key(row[source], first[source] + before[source], block * width // wider))
            source, block = source[kept], block[kept]
        top = np.minimum(before[source], block * width + width - 1)
        bottom = np.maximum(near[source], block * width)
        pointer = base[source] + before[source]
        # the core of a whole block, also of one that the text's end cuts
        core = prefix(pointer - block * width, pointer - block * width - width + 1 + LENGTH)
        number = block.astype(np.uint64) * np.uint64(BASE)
        hull = prefix(pointer - top, pointer - bottom + LENGTH)
        shape = (top << 16 | bottom).astype(np.uint64) * np.uint64(UNBASE)
        columns = [column("bucket").take(pa.array(source)), pa.array(signed(mix64(core + number))), pa.array(signed(mix64(hull + shape)))]
        columns += [column("doc_id").take(pa.array(source)), pa.array(row[source])]
        columns += [pa.array((first[source] + before[source] - top).astype(np.int32)), pa.array((top - bottom + 1).astype(np.int32)), pa.array((first[source] + before[source]).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "core", "hull", "doc_id", "row", "first", "strings", "pointer"])


def _keys(frame: DataFrame, make, *bitmaps: SentBitmap) -> DataFrame:
    """A column ``key`` of 64-bit names made from a batch's columns by numpy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays([pa.array(signed(make(columns, *(b.value for b in bitmaps))))], names=["key"])

    return frame.mapInArrow(run, "key long")


def _listed(frame: DataFrame, make, names: list[str], bitmap: SentBitmap) -> DataFrame:
    """The rows whose key, made from the named columns, is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False) for name in names}
            yield batch.filter(pa.array(in_bitmap(bitmap.value, make(columns))))

    return frame.mapInArrow(run, frame.schema)


def bits_for(values: int) -> int:
    """Eight bits a value and more, between the least and the most."""
    return max(BITS, min(MOST_BITS, (8 * values).bit_length()))


def classes(found: DataFrame, kind: list[str], *more: str) -> DataFrame:
    """The earliest member of each class of equal hulls, and how many there are."""
    earliest = F.min(F.struct("doc_id", "row", "first", *more)).alias("e")
    place = [F.col("e.row").alias("first_row"), F.col("e.first").alias("first_at"), *(f"e.{name}" for name in more)]
    return found.groupBy("bucket", *kind).agg(earliest, F.count("*").alias("members")).select("bucket", *kind, *place, "members")


def repeats(found: DataFrame, earliest: DataFrame, kind: list[str]) -> DataFrame:
    """The spans (row, start, stop) of members that aren't their class's earliest."""
    met = found.join(earliest.filter("members > 1"), ["bucket", *kind])
    later = (F.col("row") != F.col("first_row")) | (F.col("first") != F.col("first_at"))
    return met.filter(later).select("row", F.col("first").alias("start"), (F.col("first") + F.col("strings") - 1 + LENGTH).alias("stop"))


def several(earliest: DataFrame, groups: list[str], kind: str) -> DataFrame:
    """Groups with more than one kind."""
    return earliest.groupBy(*groups).agg(F.min(kind).alias("low"), F.max(kind).alias("high")).filter("low != high")


def repeated_spans(docs: DataFrame, piece: int = PIECE) -> list[DataFrame]:
    """Tables of removed spans, by the rows' names; they may overlap."""
    spark = docs.sparkSession
    send = lambda bitmap: SentBitmap(spark, bitmap)
    counted = docs.mapInArrow(lambda b: _buckets(b, piece), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    several_pointers = materialise(counted.filter("n > 1").select("bucket"), "shared-buckets")
    shared = send(bitmap_of(several_pointers, "bucket", bits_for(several_pointers.count())))
    discard(several_pointers)

    found = materialise(docs.mapInArrow(lambda b: _hulls(b, shared.value, piece), FOUND), "hulls")
    earliest = materialise(classes(found, ["hull"]), "earliest-hulls")
    spans = [materialise(repeats(found, earliest, ["hull"]), "hull-spans")]
    shared.destroy()
    bits = bits_for(earliest.count())
    mixed = send(bitmap_of(several(earliest, ["bucket"], "hull"), "bucket", bits))
    firsts = _keys(
        earliest.select("bucket", "first_row", "first_at"),
        lambda c, mixed: place_key(c["first_row"], c["first_at"])[in_bitmap(mixed, c["bucket"].view(np.uint64))],
        mixed,
    )
    chosen = send(bitmap_of(firsts, "key", bits))
    discard(found, earliest)

    stretches = materialise(docs.mapInArrow(lambda b: _stretches(b, mixed.value, chosen.value, piece), STRETCH), "stretches")
    for bitmap in (mixed, chosen):
        bitmap.destroy()
    wider, active = LENGTH, None
    for width in LEVELS:
        blocks = materialise(stretches.mapInArrow(lambda b, w=width, o=wider, a=active: _blocks(b, w, o, a.value if a else None), BLOCK), f"blocks-{width}")
        kind = ["core", "hull"]
        # the class's earliest member also tells its pointer, which names it at the next level
        earliest = materialise(classes(blocks, kind, "pointer"), f"earliest-{width}")
        bits = bits_for(earliest.count())
        # most classes have one member, so only the others' go to the join
        repeated = send(bitmap_of(_keys(earliest.filter("members > 1").select("bucket", *kind), class_key), "key", bits))
        again = _listed(blocks.drop("doc_id", "pointer"), class_key, ["bucket", *kind], repeated)
        spans.append(materialise(repeats(again, earliest.drop("pointer"), kind), f"spans-{width}"))
        repeated.destroy()
        if active:
            active.destroy()
        if width > 1:
            cores = _keys(several(earliest, ["bucket", "core"], "hull").select("bucket", "core"), lambda c: core_key(c["bucket"], c["core"]))
            open_cores = send(bitmap_of(cores, "key", bits))

            def open_blocks(c: dict, cores: np.ndarray, width: int = width) -> np.ndarray:
                kept = in_bitmap(cores, core_key(c["bucket"], c["core"]))
                return block_key(c["first_row"], c["pointer"], (c["pointer"].astype(np.int64) - c["first_at"]) // width)[kept]

            active = send(bitmap_of(_keys(earliest.select("bucket", "core", "first_row", "first_at", "pointer"), open_blocks, open_cores), "key", bits))
            open_cores.destroy()
        discard(blocks, earliest)
        wider = width
    discard(stretches)
    return spans


def core_key(bucket: np.ndarray, core: np.ndarray) -> np.ndarray:
    return mix64(bucket.view(np.uint64) * np.uint64(BASE) + core.view(np.uint64))


def class_key(c: dict) -> np.ndarray:
    """Names a class of blocks with equal cores and hulls."""
    return mix64(core_key(c["bucket"], c["core"]) + c["hull"].view(np.uint64) * np.uint64(UNBASE))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _result(ids: list, sizes: list[int], removed: list[int], runs: list[int], digests: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in ((ids, pa.int64()), (sizes, pa.int64()), (removed, pa.int64()), (runs, pa.int64()), (digests, pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted, disjoint, not touching."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    begin = np.flatnonzero(new)
    return np.stack([spans[begin, 0], reach[np.append(begin[1:], len(spans)) - 1]], 1)


def _merged_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's list of spans, merged."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [merged(np.stack([listed.values.field(n).to_numpy() for n in ("start", "stop")], 1)) for listed in batch.column(1)]
        offsets = np.cumsum([0, *(len(c) for c in cuts)])
        flat = np.concatenate(cuts).astype(np.int32)
        spans = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["start", "stop"])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)], names=["row", "spans"])


def remove_repeats(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    texts = named_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "row", "text")
    spans = repeated_spans(texts, piece)
    union = spans[0]
    for more in spans[1:]:
        union = union.unionByName(more)
    lists = union.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    by_row = materialise(lists.mapInArrow(_merged_lists, "row long, spans array<struct<start:int,stop:int>>"), "row-spans")
    discard(*spans)
    touched = SentBitmap(spark, bitmap_of(_keys(by_row.select("row"), lambda c: place_key(c["row"], np.zeros(len(c["row"]), np.int64))), "key", bits_for(by_row.count())))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that lose something keep their bytes, the others only their digest."""
        for rows, ids, data, offsets in _rows(batches):
            loses = in_bitmap(touched.value, place_key(rows, np.zeros(len(rows), np.int64))).tolist()
            raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            kept = pa.array([r if cut else None for r, cut in zip(raw, loses)], pa.binary())
            digests = pa.array([None if cut else hashlib.sha256(r).hexdigest() for r, cut in zip(raw, loses)], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(rows), ids, pa.array(np.diff(offsets)), kept, digests], names=["row", "doc_id", "n_bytes", "bytes", "digest"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raws, lists = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "bytes", "spans"))
            sizes, removed, runs, digests = [], [], [], []
            for raw, listed in zip(raws.to_pylist(), lists):
                keep = np.ones(len(raw), np.bool_)
                runs.append(0)
                if listed.is_valid and len(listed.values):
                    for a, b in zip(listed.values.field("start").to_pylist(), listed.values.field("stop").to_pylist()):
                        keep[a:b] = False
                    runs[-1] = len(listed.values)
                sizes.append(len(raw))
                removed.append(len(raw) - int(keep.sum()))
                digests.append(hashlib.sha256(np.frombuffer(raw, np.uint8)[keep].tobytes()).hexdigest())
            yield _result(ids.to_pylist(), sizes, removed, runs, digests)

    scanned = materialise(texts.mapInArrow(scan, "row long, doc_id long, n_bytes long, bytes binary, digest string"), "scanned")
    touched.destroy()
    whole = scanned.filter("bytes IS NULL").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("digest").alias("kept_sha256"))
    losing = scanned.filter("bytes IS NOT NULL").select("row", "doc_id", "bytes").join(by_row, "row", "left")
    return whole.unionByName(losing.mapInArrow(cut, RESULT))
