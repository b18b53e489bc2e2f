"""Best-two-fit packing of tokenised documents into fixed-size sequences.

Bins are planned on the histogram of piece lengths, which has at most one
entry for each length up to the capacity however many documents there are.
Equal lengths are interchangeable, so a planned bin (a pattern of lengths) is
repeated for as long as every length in it lasts. Pieces then take the slots
of their length by their rank among the pieces of that length: the rank inside
a task, plus the counts of the tasks before it.

Defined results: a null text counts as empty; an empty text is one piece (the
end token alone). Repeated rows are packed each on its own. A null id stays
null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import functools
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise, text_column

END_TOKEN = 2
PIECE_SCHEMA = "run long, doc_id long, piece int, start long, length long, ids_crc32 long, place long"


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """The 50k byte-level vocabulary; ``encode_ordinary`` takes added tokens as text.

    ``path`` is the vocabulary as ranks; the ids are those of the same
    vocabulary's ``byte_bpe_50k.json`` (checked in the tests), whose added
    tokens are its special ones.
    """
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


#: White space of the pattern's \\s, in runs too long for the encoder's matcher.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % (1 << 16))


def space_cuts(text: str) -> list[tuple[str, bool]]:
    """The text in parts that the pattern would part as well, and whether each
    is a long run of white space.

    Before a character of another kind the pattern takes such a run but for its
    last character (``\\s+(?!\\S)``), at the end all of it.
    """
    parts, done = [], 0
    for run in LONG_SPACE.finditer(text):
        stop = run.end() - (run.end() < len(text))
        parts += [(text[done : run.start()], False), (text[run.start() : stop], True)]
        done = stop
    return [part for part in (*parts, (text[done:], False)) if part[0]]


def text_encoder(path: str | None = None, added: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text. added: also the ids of the added tokens that stand in it,
    as ``tokenizers`` gives them with add_special_tokens=False."""
    encoding = encoder(path)
    names = sorted(encoding.special_tokens_set) if added else []

    def encode(text: str) -> list[int]:
        if any(name in text for name in names):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    def whole(text: str) -> list[int]:
        if not LONG_SPACE.search(text):
            return encode(text)
        ids: list[int] = []
        for part, space in space_cuts(text):
            ids += encoding._encode_single_piece(part) if space else encode(part)  # the matcher fails on the run
        return ids

    return whole


def cuts(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; a first, shorter one takes the rest."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    first = n_ids % capacity
    return ([(0, first)] if first else []) + [(at, capacity) for at in range(first, n_ids, capacity)]


def _pieces(batches: Iterator[pa.RecordBatch], capacity: int, vocabulary: str | None, added: bool) -> Iterator[pa.RecordBatch]:
    encode, run, seen = text_encoder(vocabulary, added), TaskContext.get().partitionId(), Counter()
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
        rows = []
        for doc_id, text in zip(ids, text_column(batch)):
            tokens = encode(text.as_py())
            tokens.append(END_TOKEN)
            raw = np.array(tokens, "<u4")
            for piece, (start, length) in enumerate(cuts(len(raw), capacity)):
                rows.append((run, doc_id, piece, start, length, zlib.crc32(raw[start : start + length]), seen[length]))
                seen[length] += 1
        names = ("run", "doc_id", "piece", "start", "length", "ids_crc32", "place")
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def token_pieces(docs: DataFrame, capacity: int, vocabulary: str | None = None, added: bool = False) -> DataFrame:
    """Pieces of every document; ``place`` counts the task's earlier pieces of that length."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda batches: _pieces(batches, capacity, vocabulary, added), PIECE_SCHEMA)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-two-fit over a histogram of lengths: (times, lengths of one bin).

    A bin is filled with the longest unpacked lengths that fit. If room is
    left, its smallest document gives way to the two unpacked documents that
    together fill the widened gap most, if they fill it better.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    present = sorted(left)
    bins: list[tuple[int, list[int]]] = []
    while present:
        used: Counter = Counter()
        lengths: list[int] = []
        gap = capacity
        while gap:
            i = bisect.bisect_right(present, gap) - 1
            while i >= 0 and left[present[i]] == used[present[i]]:
                i -= 1
            if i < 0:
                break
            lengths.append(present[i])
            used[present[i]] += 1
            gap -= present[i]
        if gap and len(lengths) > 1:
            smallest = lengths[-1]
            two = best_two(present, left, used, gap + smallest)
            if two and sum(two) > smallest:
                used[smallest] -= 1
                used.update(two)
                lengths[-1:] = two
        times = min(left[length] // n for length, n in used.items() if n)
        bins.append((times, lengths))
        for length, n in used.items():
            if n:
                left[length] -= n * times
                if not left[length]:
                    present.remove(length)
    return bins


def best_two(present: list[int], left: dict[int, int], used: Counter, room: int) -> list[int] | None:
    """The two unpacked lengths of the largest sum that is at most ``room``."""
    free = [length for length in present if length < room and left[length] > used[length]]
    low, high, best = 0, len(free) - 1, None
    while low <= high:
        total = free[low] + free[high]
        if total > room:
            high -= 1
            continue
        enough = low != high or left[free[low]] - used[free[low]] > 1
        if enough and (best is None or total > sum(best)):
            best = [free[high], free[low]]
        low += 1
    return best


def slot_table(bins: list[tuple[int, list[int]]], width: int) -> tuple[np.ndarray, ...]:
    """For every length, the ranges of ranks that a pattern's slots take.

    Sorted by (length, first rank). Columns: key = length * 2**40 + first rank,
    slots of that length in one bin, first sequence, index of the first offset;
    and all offsets.
    """
    rows, offsets, taken, sequence = [], [], Counter(), 0
    for times, lengths in bins:
        at, places = 0, {}
        for length in lengths:
            places.setdefault(length, []).append(at)
            at += length
        for length, spots in places.items():
            rows.append(((length << 40) + taken[length], len(spots), sequence, len(offsets)))
            offsets += spots
            taken[length] += times * len(spots)
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), table[:, 3].copy(), np.array(offsets, np.int64)


def pack(docs: DataFrame, capacity: int = 1024, vocabulary: str | None = None, added: bool = False) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    added: an added token that stands in a text is one id, not ordinary text.

    The plan sent to the tasks is bounded by the capacity: every planned bin
    uses up at least one of its lengths, and holds at most capacity documents.
    """
    spark = docs.sparkSession
    pieces = materialise(token_pieces(docs, capacity, vocabulary, added), "pieces")
    by_run = pieces.groupBy("run", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_run.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    slots = spark.sparkContext.broadcast(slot_table(plan_bins(counts, capacity), capacity))
    before = Window.partitionBy("length").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_run.select("run", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["run", "length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, per_bin, sequence, first, offsets = slots.value
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            length = column("length").to_numpy()
            rank = column("place").to_numpy() + column("base").to_numpy()
            at = np.searchsorted(key, (length << 40) + rank, "right") - 1
            turn = rank - (key[at] - (length << 40))
            out = [column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(sequence[at] + turn // per_bin[at]), pa.array(offsets[first[at] + turn % per_bin[at]])]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
