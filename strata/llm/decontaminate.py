"""Benchmark decontamination by winnowing.

A text's words give k-word grams; of every ``span - k + 1`` consecutive grams
the one with the least hash (the rightmost of equals) is a fingerprint. Two
texts that share ``span`` words share the fingerprint chosen inside them, so
joining the fingerprints of documents and benchmark items finds every shared
span. Each joined fingerprint carries the words around it; the hit is extended
word by word to both sides, and counts if at least ``span`` words agree. An
item of fewer than ``span`` words is one gram of its own length; documents are
scanned for grams of each such length, every one of them a fingerprint.

Documents are scanned once. A bitmap of fixed size over the items' grams drops
the fingerprints that no item has before anything is shuffled.

Defined results: null and empty texts have no words and are never hit; an item
without words is in no document. Repeated rows are judged each on its own;
repeated items count once. A null doc_id stays null; an item with a null id
marks words but is not listed. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SentBitmap, bitmap_of, byte_codes, in_bitmap, lower_ascii_table, materialise, shingle_hashes, signed, slices, words_of

HIT = "struct<lane:int,gram:long,at:int,lead:int,context:binary>"
_HIT_TYPE = pa.list_(pa.struct([("lane", pa.int32()), ("gram", pa.int64()), ("at", pa.int32()), ("lead", pa.int32()), ("context", pa.binary())]))


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = lower_ascii_table()
    is_word = np.zeros(256, np.int8)
    is_word[48:58] = is_word[97:123] = is_word[65:91] = is_word[128:] = 1
    return lower, is_word, byte_codes(2)[lower]


def winnow(grams: np.ndarray, valid: np.ndarray, window: int) -> np.ndarray:
    """Which grams are the rightmost least of some ``window`` consecutive grams.

    ``valid`` marks the starts of windows that lie inside one text.
    """
    n = len(grams) - window + 1
    chosen = np.zeros(len(grams), np.bool_)
    if n <= 0:
        return chosen
    least, place = grams[:n].copy(), np.zeros(n, np.int64)
    for i in range(1, window):
        here = grams[i : i + n]
        better = here <= least
        least[better] = here[better]
        place[better] = i
    starts = np.flatnonzero(valid[:n])
    chosen[starts + place[starts]] = True
    return chosen


def _scan(batches: Iterator[pa.RecordBatch], span: int, k: int, short: tuple[int, ...], bitmap: np.ndarray | None, items: bool) -> Iterator[pa.RecordBatch]:
    """A row for each text: key, id, n_words and its fingerprints.

    items: a short text is one gram of its own length, and nothing is filtered.
    """
    lower, is_word, codes = _tables()
    run, place = TaskContext.get().partitionId() << 40, 0
    for batch, data, at in slices(batches, most=2 << 20):
        starts, ends, rows, hashes = words_of(data, at, is_word, codes)
        n_words = np.bincount(rows, minlength=batch.num_rows)
        first = np.cumsum(n_words) - n_words
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        text = lower[data]
        for lane in (span, *range(1, span)) if items else (span, *short):
            size = k if lane == span else lane
            grams = shingle_hashes(hashes, size)
            if not len(grams):
                continue
            if lane == span:
                valid = np.zeros(len(grams), np.bool_)
                n = max(0, len(rows) - span + 1)
                valid[:n] = rows[:n] == rows[span - 1 :]
                chosen = winnow(grams, valid, span - k + 1)
            else:
                chosen = rows[: len(grams)] == rows[size - 1 :]
                if items:
                    chosen &= n_words[rows[: len(grams)]] == lane
            picked = np.flatnonzero(chosen)
            if bitmap is not None:
                picked = picked[in_bitmap(bitmap, grams[picked])]
            reach = span - k if lane == span else 0
            for p, gram in zip(picked.tolist(), signed(grams[picked]).tolist()):
                row = int(rows[p])
                low = max(p - reach, int(first[row]))
                high = min(p + size + reach, int(first[row] + n_words[row]))
                context = b" ".join(text[s:e].tobytes() for s, e in zip(starts[low:high].tolist(), ends[low:high].tolist()))
                found[row].append({"lane": lane, "gram": gram, "at": p - int(first[row]), "lead": p - low, "context": context})
        ids = batch.column(0)
        keys = pa.array(run + np.arange(place, place + batch.num_rows))
        place += batch.num_rows
        yield pa.RecordBatch.from_arrays([keys, ids, pa.array(n_words.astype(np.int64)), pa.array(found, _HIT_TYPE)], names=["key", "id", "n_words", "hits"])


def scan(texts: DataFrame, id_column: str, span: int, k: int, short: tuple[int, ...] = (), bitmap: np.ndarray | None = None, items: bool = False) -> DataFrame:
    shared = None if bitmap is None else SentBitmap(texts.sparkSession, bitmap)
    rows = texts.select(F.col(id_column).cast("long").alias("id"), "text")
    return rows.mapInArrow(lambda batches: _scan(batches, span, k, short, shared.value if shared else None, items), f"key long, id long, n_words long, hits array<{HIT}>")


def extent(lane: int, span: int, k: int, lead: int, context: bytes, other_lead: int, other: bytes) -> tuple[int, int] | None:
    """Words before and behind the gram's start that both contexts share, if enough."""
    if lane < span:
        return (0, lane) if context == other else None
    mine, theirs = context.split(b" "), other.split(b" ")
    left = 0
    while left < min(lead, other_lead) and mine[lead - left - 1] == theirs[other_lead - left - 1]:
        left += 1
    right = 0
    while right < min(len(mine) - lead, len(theirs) - other_lead) and mine[lead + right] == theirs[other_lead + right]:
        right += 1
    return (left, right) if right >= k and left + right >= span else None


def shared_spans(docs: DataFrame, items: DataFrame, span: int, k: int) -> tuple[DataFrame, DataFrame]:
    """The scanned documents (key, id, n_words, hits), and their hit spans.

    A span row: key, start and stop (word numbers), items (an array of ids).
    """
    marked = materialise(scan(items, "item_id", span, k, items=True).select("id", F.explode("hits").alias("hit")).select("id", "hit.*"), "benchmark-grams")
    short = tuple(sorted(r["lane"] for r in marked.filter(F.col("lane") < span).select("lane").distinct().collect()))  # at most span - 1
    bitmap = bitmap_of(marked, "gram")
    scanned = materialise(scan(docs, "doc_id", span, k, short, bitmap), "document-grams")
    contexts = marked.groupBy("lane", "gram", F.col("lead").alias("item_lead"), F.col("context").alias("item_context")).agg(F.collect_set("id").alias("items"))
    met = scanned.select("key", F.explode("hits").alias("hit")).select("key", "hit.*").join(contexts, ["lane", "gram"])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("key", "lane", "at", "lead", "context", "item_lead", "item_context")
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            kept, bounds = [], []
            for i, (_, lane, at, lead, context, item_lead, item_context) in enumerate(zip(*columns)):
                if (found := extent(lane, span, k, lead, context, item_lead, item_context)) is not None:
                    kept.append(i)
                    bounds.append((at - found[0], at + found[1]))
            rows = batch.take(pa.array(kept, pa.int64()))
            ends = np.array(bounds, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.get_field_index("key")), pa.array(ends[:, 0]), pa.array(ends[:, 1]), rows.column(rows.schema.get_field_index("items"))], names=["key", "start", "stop", "items"])

    return scanned, met.mapInArrow(extend, "key long, start long, stop long, items array<long>")


def decontaminate(docs: DataFrame, items: DataFrame, span: int = 10, k: int = 5) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit counts the words inside any shared span, n_items the items that share
    one, items_sha256 is over their ids, sorted as strings, comma-joined.
    """
    if not 1 <= k <= span:
        raise ValueError("k must be between 1 and span")
    scanned, spans = shared_spans(docs, items, span, k)
    spans = materialise(spans, "shared-spans")
    earlier = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("start", F.coalesce(F.max("stop").over(earlier), F.lit(0)))
    n_hit = (
        spans.select("key", "start", "stop").distinct()
        .select("key", F.greatest(F.lit(0), F.col("stop") - reached).alias("new"))
        .groupBy("key").agg(F.sum("new").alias("n_hit"))
    )
    named = (
        spans.select("key", F.explode("items").alias("item")).distinct()
        .groupBy("key").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("names"))
    )
    names = F.coalesce("names", F.array().cast("array<string>"))
    return (
        scanned.drop("hits").join(n_hit, "key", "left").join(named, "key", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(names).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", names).cast("binary"), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
