"""SimHash near duplicates by covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of its three-word shingles'
XXH64 values. Fingerprints that differ in at most ``RADIUS`` bits link.

Tables come from a covering code: every bit position gets a vector of RADIUS +
1 bits, and there is a table for each non-zero vector v, whose mask keeps the
positions with an odd product with v. Any RADIUS differing positions have a
common orthogonal v, so the pair agrees on all that this table's mask keeps:
every pair within the radius meets in some table, not just most pairs.

A bucket of more than ``BUCKET`` distinct fingerprints is never compared as a
whole: its members agree on the kept bits, so the same construction over the
remaining ones splits it again, with the same guarantee. A mask keeps half of
what is left or more, so three levels leave at most 2**8 values. Buckets are
counted by aggregation before any member is moved. A small bucket gives the
links of a spanning forest of its links, not its pairs.

Defined results: a text of one or two words has its whole sequence as its one
shingle. A null text, or one without words, has fingerprint zero, which links
like any other. Repeated rows have the same fingerprint and get a row each. A
null doc_id is never a component's smallest id; a component of null ids only
has a null one. An empty table gives an empty result. Other columns are not
read. A long text is worked on in parts that carry two words over.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii_table, materialise, signed, word_slices
from strata.llm.components import components

WORDS, SEED, RADIUS = 3, 42, 3
BUCKET = 1 << 8  # what three levels leave at most; less would not end
PART = 1 << 20


def covering(kept: int = 0) -> list[int]:
    """Masks that keep ``kept`` and, of the other bits, a covering code's choice each."""
    free = [i for i in range(64) if not kept >> i & 1]
    vectors = (1 << RADIUS + 1) - 1
    return [kept | sum(1 << bit for place, bit in enumerate(free) if ((1 + place % vectors) & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _votes(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """How many of the shingles' hashes have each bit set, and the number of shingles."""
    n = len(words) - width + 1
    shingles = words if width == 1 else map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    return np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0, dtype=np.int64), n


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, fingerprint) of every row."""
    is_word = np.ones(256, np.int8)
    is_word[[32, 9, 10, 11, 12, 13]] = 0
    lower = lower_ascii_table().tobytes()
    carried: list[bytes] = []
    votes, total = np.zeros(64, np.int64), 0
    for batch, data, at, last in word_slices(batches, is_word, most=PART):
        out = np.zeros(batch.num_rows, np.uint64)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            words = carried + data[a:b].tobytes().translate(lower).split()
            if len(words) >= WORDS:
                more, n = _votes(words, WORDS)
                votes, total = votes + more, total + n
            if not last:
                carried = words[-WORDS + 1 :]
                continue
            if not total and words:
                votes, total = _votes([b" ".join(words)], 1)
            if total:
                out[i] = np.packbits(2 * votes > total, bitorder="little").view(np.uint64)[0]
            carried, votes, total = [], np.zeros(64, np.int64), 0
        if last:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed(out))], names=["doc_id", "print"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) that connect what links inside each bounded list of fingerprints."""
    for batch in batches:
        lists, edges = batch.column(0), []
        for listed in lists:
            values = listed.values.to_numpy().view(np.uint64)
            left = np.ones(len(values), np.bool_)
            while left.any():
                queue = [int(np.argmax(left))]
                left[queue[0]] = False
                while queue:
                    one = queue.pop()
                    near = np.flatnonzero(left & (np.bitwise_count(values ^ values[one]) <= RADIUS))
                    left[near] = False
                    queue += near.tolist()
                    edges += [(values[one], values[two]) for two in near]
        ends = np.array(edges, np.uint64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(signed(np.ascontiguousarray(ends[:, i]))) for i in range(2)], names=["a", "b"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(mask, print) of the next level for those of a level."""
    for batch in batches:
        mask, prints = (batch.column(i).to_numpy().view(np.uint64) for i in range(2))
        kinds, which = np.unique(mask, return_inverse=True)
        finer = np.array([covering(int(kind)) for kind in kinds], np.uint64).reshape(len(kinds), -1)[which]
        columns = [pa.array(signed(finer.reshape(-1))), pa.array(signed(np.repeat(prints, finer.shape[1])))]
        yield pa.RecordBatch.from_arrays(columns, names=["mask", "print"])


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all links of the distinct ``print`` values."""
    masks = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in covering()))
    entries = prints.select(F.explode(masks).alias("mask"), "print")
    found = None
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    while True:
        keyed = entries.withColumn("key", F.col("print").bitwiseAND(F.col("mask")))
        ends = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b"))
        buckets = materialise(ends.filter("n > 1"), "buckets")
        small = keyed.join(buckets.filter((F.col("n") > 2) & (F.col("n") <= BUCKET)).select("mask", "key"), ["mask", "key"])
        small = small.groupBy("mask", "key").agg(F.collect_list("print").alias("prints"))  # BUCKET at most
        edges = buckets.filter((F.col("n") == 2) & near).select("a", "b").unionByName(small.select("prints").mapInArrow(_forest, "a long, b long"))
        found = edges if found is None else found.unionByName(edges)
        hot = buckets.filter(F.col("n") > BUCKET)
        if hot.isEmpty():
            return found
        split = keyed.join(hot.select("mask", "key"), ["mask", "key"]).select("mask", "print")
        entries = materialise(split.mapInArrow(_refined, "mask long, print long").distinct(), "refined")


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, fingerprint (hex), component_id (the smallest doc_id reachable)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialise(texts.mapInArrow(fingerprints, "doc_id long, print long"), "fingerprints")
    prints = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("least_doc")), "prints")
    found = components(links(prints.select("print")))
    parted = prints.join(found.select(F.col("node").alias("print"), "component"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    parted = materialise(parted, "parted")
    smallest = parted.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    answers = parted.join(smallest, "component").select("print", "component_id")
    out = rows.join(answers, "print")
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
