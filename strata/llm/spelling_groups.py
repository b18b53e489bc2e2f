"""Spelling variants by dynamic programming over sorted word lists.

Words are near if one inserted, deleted or replaced code point turns one into
the other. The vocabulary is laid out in sorted lists, and each list is scanned
for all of its words at once: the edit matrix of a query word and a list word
needs only the band of three cells around its diagonal, adjacent words share
the rows of their longest common prefix, so a row is computed once for the run
of words that share it, and a run whose shared prefix already costs more than
one edit in every cell is skipped with all its words.

Lists are groups that a near pair has in common, so no list holds the whole
vocabulary. A pair belongs to the length of its shorter word, and its edit, at
the first place where the words differ, falls into one region of that length;
the pair agrees before and behind the region. A group is a length, a region and
what lies around it: at first the regions are the two halves. A group of more
than ``GROUP`` words is never formed: its region is halved again, down to a
single place, where a group cannot be large. Groups are counted by aggregation
before any word is moved, and what is split is carried by a bitmap of fixed
size (a false positive splits a group that need not be, no more).

A word's form is its near word of most occurrences (the smallest of equals) if
that has at least ``RATIO`` times as many; roots follow forms by doubling.

Defined results: null texts have no words; a null doc_id reads as empty in the
planted edit's key. Repeated rows count each. An empty table gives an empty
result. Other columns are not read. Long texts are worked on in parts, cut
where no word is.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SentBitmap, bitmap_of, discard, in_bitmap, lower_ascii_table, materialise, signed, word_slices

LEAST, TIMES = 7, 2  # code points of a word, occurrences
RATIO = 10
PLANT = 31
GROUP = 1 << 16  # words of a list; a region of one place leaves fewer
ENTRIES, CELLS = 1 << 18, 1 << 23  # distinct words a task counts, cells of the lists it scans, at once
BITS = 24


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) after the planted edits, counted within the task as far as they fit."""
    is_word = np.zeros(256, np.int8)
    is_word[65:91] = is_word[97:123] = is_word[128:] = 1
    lower = lower_ascii_table().tobytes()
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST)  # the whole run: it begins where no letter stands before
    counts: Counter[str] = Counter()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()
        return batch

    for batch, data, at, _ in word_slices(batches, is_word):
        raw = data.tobytes().translate(lower)
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            begun = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            for run, n in Counter(runs.findall(raw[a:b].decode())).items():
                h = zlib.crc32(run.encode(), begun)
                if not h % PLANT:
                    place = h % len(run)
                    run = run[:place] + run[place + 1 :]
                    if len(run) < LEAST:
                        continue
                counts[run] += n
        if len(counts) >= ENTRIES:
            yield flush()
    if counts:
        yield flush()


def regions(word: str, split) -> Iterator[tuple[int, int, int, int]]:
    """(key, length, low, high) of the groups of a word; ``split(key)`` tells which are halved."""
    for length in (len(word), len(word) - 1):
        if length < LEAST:
            continue
        middle = length // 2
        stack = [(0, middle), (middle, length)]
        while stack:
            low, high = stack.pop()
            key = xxhash.xxh64_intdigest(f"{length}:{low}:{high}:{word[:low]}:{word[len(word) - length + high :]}")
            if high - low > 1 and split(key):
                middle = (low + high) // 2
                stack += [(low, middle), (middle, high)]
            else:
                yield key, length, low, high


ENTRY = "key long, length int, low int, high int, word string, n long"


def _entries(batches: Iterator[pa.RecordBatch], hot: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    bits = None if hot is None else len(hot).bit_length() + 2
    split = (lambda key: False) if hot is None else lambda key: hot[key >> 64 - bits + 3] >> (key >> 64 - bits & 7) & 1
    for batch in batches:
        words, ns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [(*spec, i) for i, word in enumerate(words) for spec in regions(word, split)]
        if not rows:
            continue
        key, length, low, high, which = zip(*rows)
        which = np.array(which)
        columns = [pa.array(signed(np.array(key, np.uint64))), *(pa.array(np.array(c, np.int32)) for c in (length, low, high))]
        yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(pa.array(which)), pa.array(np.array(ns, np.int64)[which])], names=["key", "length", "low", "high", "word", "n"])


def scan(letters: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs (query, word), by place, at one edit inside a group.

    ``letters`` holds the words as zero-padded rows, sorted by group and word.
    """
    rows, width = letters.shape
    same = group[1:] == group[:-1]
    differ = letters[1:] != letters[:-1]
    shared = np.full(rows, -1, np.int32)  # longest common prefix with the word before; -1 begins a group
    shared[1:][same] = np.argmax(differ[same], 1)
    padded = np.concatenate([letters, np.full((rows, 3), 255, np.uint16)], 1).astype(np.uint16)
    padded[:, :width][letters == 0] = 65535  # behind a query's end nothing is equal
    padded[:, width:] = 65535
    starts = np.flatnonzero(shared < 0)
    query = np.arange(rows)
    run = np.searchsorted(starts, query, "right") - 1
    band = np.tile(np.array([2, 0, 1], np.int8), (rows, 1))  # cells d-1, d, d+1 of row d
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for depth in range(width):
        finer = np.flatnonzero(shared <= depth)
        first = np.searchsorted(finer, np.append(starts, rows), "left")
        low, high = first[run], first[run + 1]
        fan = high - low
        query, band = np.repeat(query, fan), np.repeat(band, fan, 0)
        run = np.repeat(low - np.cumsum(fan) + fan, fan) + np.arange(int(fan.sum()))
        starts = finer
        letter = letters[starts[run], depth]
        ended = np.flatnonzero(letter == 0)
        if len(ended):
            cell = sizes[query[ended]] - depth + 1
            inside = (cell >= 0) & (cell <= 2)
            ended, cell = ended[inside], cell[inside]
            near = ended[band[ended, cell] == 1]
            hits.append((query[near], starts[run[near]]))
        before = padded[query, depth - 1] if depth else np.full(len(query), 65535, np.uint16)
        left = np.minimum(band[:, 0] + (before != letter), band[:, 1] + 1)
        here = np.minimum(np.minimum(band[:, 1] + (padded[query, depth] != letter), band[:, 2] + 1), left + 1)
        right = np.minimum(band[:, 2] + (padded[query, depth + 1] != letter), here + 1)
        kept = np.flatnonzero((letter != 0) & (np.minimum(np.minimum(left, here), right) <= 1))
        query, run = query[kept], run[kept]
        band = np.minimum(np.stack([left[kept], here[kept], right[kept]], 1), 2).astype(np.int8)
        if not len(query):
            break
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def near_words(words: list[str], ns: np.ndarray, group: np.ndarray, length: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """For words with near words in their groups: place, their number, the best one's n and place."""
    sizes = np.array([len(w) for w in words])
    width = int(sizes.max()) + 1
    letters = np.frombuffer(b"".join(w.encode("latin-1").ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    query, word = scan(letters, sizes, group)
    # a pair counts where its shorter word's length and its first difference belong
    place = np.argmax(letters[query] != letters[word], 1)
    shorter = np.minimum(sizes[query], sizes[word])
    end = high[query] + (high[query] == length[query])
    own = (shorter == length[query]) & (place >= low[query]) & (place < end)
    query, word = query[own], word[own]
    order = np.lexsort((word, -ns[word], query))
    query, word = query[order], word[order]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
    return query[first], np.diff(np.append(first, len(query))), ns[word[first]], word[first]


def _near(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Scans the sorted groups, which may run over batches; a group is never cut."""

    def found(table: pa.Table) -> pa.RecordBatch:
        key, length, low, high, ns = (table.column(c).to_numpy() for c in ("key", "length", "low", "high", "n"))
        new = np.append(True, (key[1:] != key[:-1]) | (length[1:] != length[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1]))
        group = np.cumsum(new)
        several = np.bincount(group)[group] > 1
        words = table.column("word").filter(pa.array(several)).to_pylist()
        if not words:
            return pa.RecordBatch.from_pylist([], schema=out)
        query, near, n, best = near_words(words, *(c[several] for c in (ns, group, length, low, high)))
        named = pa.array(words, pa.string())
        return pa.RecordBatch.from_arrays([named.take(pa.array(query)), pa.array(near), pa.array(n), named.take(pa.array(best))], schema=out)

    out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    held: list[pa.RecordBatch] = []
    cells = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows * (int(np.max(batch.column(1).to_numpy())) + 2)
        if cells < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        # all but the last group, which the next batch may go on with
        ends = [table.column(c).to_numpy() for c in ("key", "length", "low", "high")]
        last = np.flatnonzero(np.any([e != e[-1] for e in ends], 0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield found(table.slice(0, cut))
        rest = table.slice(cut)
        held = rest.to_batches()
        cells = rest.num_rows * (int(ends[1][-1]) + 2)
    if held:
        yield found(pa.Table.from_batches(held).combine_chunks())


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words that occur often enough."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(word_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= TIMES)


def near_table(words: DataFrame, most: int, cells: int) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words."""
    hot, bitmap = None, None
    while True:
        entries = words.mapInArrow(lambda b, h=hot: _entries(b, h.value if h else None), ENTRY)
        large = entries.filter("high - low > 1").groupBy("key", "length", "low", "high").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
        large = materialise(large.select("key"), "large-groups")
        if large.isEmpty():
            break
        more = bitmap_of(large, "key", BITS)
        bitmap = more if bitmap is None else bitmap | more
        hot = SentBitmap(words.sparkSession, bitmap)
        discard(large)
    spec = ["key", "length", "low", "high"]
    found = entries.repartition("key").sortWithinPartitions(*spec, "word").mapInArrow(lambda b: _near(b, cells), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms are followed to the last, by doubling."""
    paths = materialise(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        step = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = paths.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = materialise(longer, "paths")
        discard(paths)
        paths = longer
        if paths.filter("moved").isEmpty():
            return paths.select("word", "root")
        paths = paths.drop("moved")
        paths._scratch = longer._scratch


def spelling_groups(docs: DataFrame, group: int = GROUP, cells: int = CELLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialise(vocabulary(docs), "words")
    near = words.join(near_table(words, group, cells), "word", "left")
    chosen = F.col("best_n") >= RATIO * F.col("n")
    judged = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best")).alias("form"), F.when(chosen, F.col("best_n")).alias("form_n"))
    judged = materialise(judged, "judged")
    ends = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    out = judged.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
