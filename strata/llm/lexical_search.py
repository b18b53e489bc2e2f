"""Ranked lexical search over norm buckets of impact vectors (LEMP).

A document is the vector of its impacts ``b = (10**9 tf) div (1000 tf + 12 m)``
on the terms that the query items use, an item the vector of its term counts;
both are scaled by the root of the term's weight, so that their inner product
is the score. Every task keeps the best ``k`` documents of each item:

* A block of document vectors is ordered by length and cut into buckets. By
  Cauchy-Schwarz no document of a bucket scores more than the item's length
  times the bucket's greatest, so the item is done with the block at the first
  bucket for which that is below its k-th score so far.
* Inside a bucket the lists of the item's ``FOCUS`` heaviest coordinates give a
  partial product and the part of a document's length that it uses up; the rest
  is bounded by the lengths left on both sides.
* Survivors are scored again in 64-bit integers, which alone decide.

The bounds are widened by a relative 1e-9, far beyond what rounding can
change, so they only save work. The tasks' best documents, ``k`` an item and
task, meet in one ranking by item.

Counts cover all documents: a first scan counts documents, terms and, for the
items' terms, the documents that hold them. The items are a stated query set:
they are sent to the tasks in blocks of about ``BLOCK_TERMS`` distinct terms,
each block with two scans of its own. Terms are compared by 64-bit hashes.

Defined results: a null text, or one without terms, of a document or an item
takes no part. Repeated item rows are ranked each on its own, repeated
document rows are documents of their own; a null doc_id comes last among equal
scores. An empty table on either side gives an empty result. Other columns are
not read. A long document is worked on in parts; one item must fit a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import byte_codes, lower_ascii_table, materialise, signed, word_slices, words_of

BLOCK_TERMS = 1 << 20  # distinct terms of the items sent at once
POSTINGS = 1 << 21  # impacts of the documents that a task orders at once
BUCKET, FOCUS = 256, 8
SLACK = 1 + 1e-9


def tables() -> tuple[np.ndarray, np.ndarray]:
    is_word = np.zeros(256, np.int8)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        is_word[low : high + 1] = 1
    return is_word, byte_codes(11)[lower_ascii_table()]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, item_id, terms, counts) of the items that have terms."""
    run, place, parts = TaskContext.get().partitionId() << 40, 0, []
    for batch, data, at, last in word_slices(batches, tables()[0]):
        _, _, rows, hashes = words_of(data, at, *tables())
        if batch.num_rows == 1:
            parts.append(hashes)
            if not last:
                continue
            hashes, parts = np.concatenate(parts), []
            rows = np.zeros(len(hashes), np.int64)
        bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        listed = [np.unique(hashes[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
        has = np.flatnonzero(np.diff(bounds))
        columns = [pa.array(run + place + has), batch.column(0).take(pa.array(has))]
        columns += [pa.array([signed(listed[i][0]) for i in has], pa.list_(pa.int64())), pa.array([listed[i][1] for i in has], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "item_id", "terms", "counts"])
        place += batch.num_rows


def _term_counts(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc_ids, all terms of each, and (row, term number, tf) of the vocabulary's."""
    width = np.int64(len(vocabulary))
    parts: list[tuple[int, np.ndarray, np.ndarray]] = []
    for batch, data, at, last in word_slices(batches, tables()[0]):
        _, _, rows, hashes = words_of(data, at, *tables())
        n = np.bincount(rows, minlength=batch.num_rows)
        place = np.minimum(np.searchsorted(vocabulary, hashes), width - 1)
        known = vocabulary[place] == hashes
        key, tf = np.unique(rows[known] * width + place[known], return_counts=True)
        if parts or not last:  # parts of one long text
            parts.append((int(n[0]), key, tf))
            if not last:
                continue
            n = np.array([sum(p[0] for p in parts)])
            key, inverse = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
            tf = np.bincount(inverse, weights=np.concatenate([p[2] for p in parts]), minlength=len(key)).astype(np.int64)
            parts = []
        yield batch.column(0), n, key // width, key % width, tf


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's documents that hold each term; -1 are its documents, -2 its terms."""
    held, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
    for _, n, _, term, _ in _term_counts(batches, vocabulary):
        held += np.bincount(term, minlength=len(held))
        docs, total = docs + int((n > 0).sum()), total + int(n.sum())
    term = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(term, [-1, -2])), pa.array(np.append(held[term], [docs, total]))], names=["term", "n"])


@dataclass
class Items:
    """A block of items: vocabulary, weights, and each item's terms."""

    item: np.ndarray
    vocabulary: np.ndarray
    terms: list[np.ndarray]  # numbers in the vocabulary
    counts: list[np.ndarray]
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    docs: int = 0
    total: int = 0

    @classmethod
    def of(cls, rows: list) -> Items:
        terms = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(terms))
        return cls(np.array([r["item"] for r in rows], np.int64), vocabulary, [np.searchsorted(vocabulary, t) for t in terms], [np.array(r["counts"], np.int64) for r in rows])

    def weigh(self, counted: dict[int, int]) -> None:
        self.docs, self.total = counted.pop(-1, 0), counted.pop(-2, 0)
        held = np.zeros(len(self.vocabulary), np.int64)
        held[list(counted)] = list(counted.values())
        self.weight = np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


class Best:
    """The best documents so far of one item: score down, doc_id up, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.void = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.bool_)

    @property
    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, void: np.ndarray) -> None:
        score, doc, void = np.append(self.score, score), np.append(self.doc, doc), np.append(self.void, void)
        order = np.lexsort((doc, void, -score))[: self.k]
        self.score, self.doc, self.void = score[order], doc[order], void[order]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All of low[i]..high[i]-1, one after the other."""
    sizes = high - low
    return np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class Search:
    """Searches blocks of document vectors for the best documents of every item."""

    def __init__(self, items: Items, k: int, bucket: int = BUCKET):
        self.bucket = bucket
        self.items, self.root = items, np.sqrt(items.weight.astype(np.float64))
        self.best = [Best(k) for _ in items.terms]
        self.vectors = []  # of each item: coordinates by weight down, values, rest of the length after the focus
        for terms, counts in zip(items.terms, items.counts):
            value = counts * self.root[terms]
            order = np.argsort(-value, kind="stable")
            left = math.sqrt(float((value[order[FOCUS:]] ** 2).sum()))
            self.vectors.append((terms[order[:FOCUS]], value[order[:FOCUS]], left, math.sqrt(float((value**2).sum()))))
        self.dense = np.zeros(len(items.vocabulary), np.int64)
        self.visited = 0  # pairs scored in full

    def block(self, doc: np.ndarray, void: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        square = np.bincount(row, weights=self.items.weight[term] * impact.astype(np.float64) ** 2, minlength=len(doc))
        sizes, starts = np.bincount(row, minlength=len(doc)), np.searchsorted(row, np.arange(len(doc)))
        order = np.argsort(-square, kind="stable")
        order = order[square[order] > 0]
        buckets: dict[int, tuple] = {}

        def bucket(first: int) -> tuple:
            if first not in buckets:
                docs = order[first : first + self.bucket]
                at = _ranges(starts[docs], starts[docs] + sizes[docs])
                local, terms = np.repeat(np.arange(len(docs)), sizes[docs]), term[at]
                by_term = np.argsort(terms, kind="stable")
                scaled = self.root[terms] * impact[at]
                buckets[first] = docs, terms[by_term], local[by_term], scaled[by_term]
            return buckets[first]

        for i, (focus, value, left, length) in enumerate(self.vectors):
            best, terms = self.best[i], self.items.terms[i]
            self.dense[terms] = self.items.weight[terms] * self.items.counts[i]
            for first in range(0, len(order), self.bucket):
                if length * math.sqrt(square[order[first]]) * SLACK < best.least:
                    break  # nor can any shorter vector reach it
                docs, listed, local, scaled = bucket(first)
                low, high = np.searchsorted(listed, focus, "left"), np.searchsorted(listed, focus, "right")
                at = _ranges(low, high)
                met, used = local[at], scaled[at]
                product = np.bincount(met, weights=np.repeat(value, high - low) * used, minlength=len(docs))
                rest = np.maximum(square[docs] * SLACK - np.bincount(met, weights=used**2, minlength=len(docs)), 0)
                chosen = docs[(product + left * np.sqrt(rest)) * SLACK >= best.least]
                if not len(chosen):
                    continue
                at = _ranges(starts[chosen], starts[chosen] + sizes[chosen])
                score = np.add.reduceat(self.dense[term[at]] * impact[at], np.cumsum(sizes[chosen]) - sizes[chosen])
                self.visited += len(chosen)
                if (good := score >= best.least).any():
                    best.add(score[good], doc[chosen[good]], void[chosen[good]])
            self.dense[terms] = 0


def _search(batches: Iterator[pa.RecordBatch], items: Items, k: int, bucket: int, most: int) -> Iterator[pa.RecordBatch]:
    search, held, postings = Search(items, k, bucket), [], 0

    def flush() -> None:
        rows = np.cumsum([0] + [len(h[0]) for h in held])
        parts = [(d, v, r + base, t, b) for (d, v, r, t, b), base in zip(held, rows)]
        search.block(*(np.concatenate(p) for p in zip(*parts)))

    for ids, n, row, term, tf in _term_counts(batches, items.vocabulary):
        m = 100 - 25 + (25 * n * items.docs) // max(items.total, 1)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), row, term, impact))
        postings += len(row)
        if postings >= most:
            flush()
            held, postings = [], 0
    if held:
        flush()
    sizes = [len(b.score) for b in search.best]
    join = lambda name: np.concatenate([getattr(b, name) for b in search.best])
    columns = [pa.array(np.repeat(items.item, sizes)), pa.array(join("doc"), mask=join("void").astype(bool)), pa.array(join("score"))]
    yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])


def rank_documents(docs: DataFrame, benchmark: DataFrame, k: int = 20, bucket: int = BUCKET, postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    item_id = benchmark.schema["item_id"].dataType.simpleString()
    items = materialise(benchmark.select("item_id", "text").mapInArrow(_items, f"item long, item_id {item_id}, terms array<long>, counts array<long>"), "items")
    blocks = max(1, math.ceil((items.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK_TERMS))
    found = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms", "counts").collect()  # BLOCK_TERMS terms or about
        if not rows:
            continue
        query = Items.of(rows)
        sent = spark.sparkContext.broadcast(query.vocabulary)
        counted = texts.mapInArrow(lambda b, v=sent: _counts(b, v.value), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        query.weigh({r["term"]: r["n"] for r in counted.collect()})  # a row for each of the block's terms
        sent.destroy()
        sent = spark.sparkContext.broadcast(query)
        found.append(materialise(texts.mapInArrow(lambda b, q=sent: _search(b, q.value, k, bucket, postings), "item long, doc_id long, score long"), "found"))
        sent.destroy()
    if not found:
        return items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("false")
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = union.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
