"""Exact N-gram Jaccard self-join with set-relation skipping.

A text's set is its distinct five-word shingles. Two sets link at a Jaccard
similarity of at least 3/4; the join gives every text its component of links
without listing the pairs inside one.

Relations between sets save most of the work, and all of the result stays:

* Equal sets are one set.
* Shingles have one global order, rare ones first: by the frequency class that
  a counting sketch of all texts gives them, then by hash. A set's prefix are
  its first ``n - ceil(3n/4) + 1`` shingles. The sketch leaves out those counted
  once, which are in no other text; a set whose prefix holds no others links
  with nothing.
* A shingle's list names the sets that have it in their prefix, with their size
  n and the shingles left from that position on, which bound what they can
  still share. Every set first tries one set of its lists, the one with most
  left (near copies have most in common with the text that they were made of).
  The overlap is computed exactly. A set that links with it joins its cluster,
  and that overlap is the answer from which answers for the set are derived.
* Then clusters stand for their members in the lists. Lists are cut into blocks
  by size; the larger set of a pair visits the blocks of the sizes that its
  position still allows, the smaller one is in a block only if its own position
  allows its size at all. So pairs whose positions leave too little never meet,
  nor do clusters already known to be connected.
* For two clusters that meet, the leaders' overlap is computed exactly. If the
  leaders link, the clusters are connected. If not, the overlap of members x
  and y is at most the leaders' overlap plus what x and y have beyond their
  leaders and not alone; only members for whom that would suffice are compared.

Every linked pair of sets shares its first common shingle within both
prefixes, with enough left behind it on both sides, so its clusters meet; none
is lost. What is counted once is found by a shuffle of ``PRINT_BITS``-bit
fingerprints, sorted and stored as differences, so only shingles of several
texts fill the sketch. It has a fixed size: the more of those there are, the
fewer it tells from rare ones, which makes lists longer and changes no result.
Hot shingles are aggregated before they are shuffled. Shingles are 64-bit hashes.

Defined results: a text with fewer than five words, but not none, has its whole
sequence as its one shingle; a null text or one without words has the empty
set, links with nothing and is its own component. Repeated rows are equal sets
and get a row each. A null doc_id is never a component's smallest id; a
component of null ids only has a null one. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SentBitmap, bitmap_of, byte_codes, discard, in_bitmap, lower_ascii_table, materialise, mix64, named_rows, shingle_hashes, signed, slices, words_of
from strata.llm.components import components

WORDS = 5
ROW_BITS, TOKEN_BITS = 26, 27
CELL_BITS, PART_BITS = 26, 16  # cells of the sketch, of four bits in the end; cells a row of it
PRINT_BITS, FINE_BITS = 38, 26  # a shingle's fingerprint, the top bits of its hash; those of one row have the others in common
CHUNK = 1 << 22  # shingles that a task counts before it hands them on
BLOCK = 1.1  # sizes in a block of a list differ by this factor at most
SLICE = 2 << 20


def enough(overlap: Column, n: Column, m: Column) -> Column:
    """100 * overlap >= 75 * union, in whole numbers."""
    return 7 * overlap >= 3 * (n + m)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    is_word = np.ones(256, np.int8)
    is_word[[32, 9, 10, 11, 12, 13]] = 0
    return is_word, byte_codes(5)[lower_ascii_table()]


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' distinct shingles, ascending in each text, and each text's number."""
    _, _, rows, hashes = words_of(data, at, *_tables())
    n_words = np.bincount(rows, minlength=len(at) - 1)
    grams = shingle_hashes(hashes, WORDS)
    first = np.cumsum(n_words) - n_words
    sets, sizes = [], np.zeros(len(n_words), np.int64)
    for i, (start, n) in enumerate(zip(first.tolist(), n_words.tolist())):
        if n >= WORDS:
            sets.append(np.unique(grams[start : start + n - WORDS + 1]))
        elif n:
            sets.append(shingle_hashes(hashes[start : start + n], n) ^ np.uint64(n))
        else:
            continue
        sizes[i] = len(sets[-1])
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def row_hash(rows: np.ndarray) -> np.ndarray:
    return mix64(rows.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def cell_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


SKETCH = "row long, doc_id long, n long, low long, high long, part int, prints binary"
_SKETCH = pa.schema([(n, pa.int64()) for n in ("row", "doc_id", "n", "low", "high")] + [("part", pa.int32()), ("prints", pa.binary())])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text, and between them rows of the shingles' fingerprints, by part."""
    held, n_held = [], 0
    for batch, data, at in slices(batches, most=SLICE):
        tokens, sizes = shingle_sets(data, at)
        has = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[has]
        low, high = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
        if len(has):
            low[has] = np.add.reduceat(mix64(tokens + np.uint64(1)), starts)
            high[has] = np.bitwise_xor.reduceat(mix64(tokens + np.uint64(2)), starts)
            # equal sets of a slice count once
            _, first, which = np.unique(low ^ mix64(high), return_index=True, return_inverse=True)
            once = np.repeat(first[which] == np.arange(len(sizes)), sizes)
            held.append(tokens[once] >> np.uint64(64 - PRINT_BITS))
            n_held += len(held[-1])
        columns = [batch.column(0), batch.column(1), pa.array(sizes), pa.array(signed(low)), pa.array(signed(high)), pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=_SKETCH)
        if n_held >= CHUNK:
            yield from _counted(held)
            held, n_held = [], 0
    if held:
        yield from _counted(held)


def _counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's fingerprints, ascending, with their counts."""
    prints, n = np.unique(np.concatenate(held), return_counts=True)
    n = np.minimum(n, 255).astype(np.uint8)
    parts, starts = np.unique(prints >> np.uint64(FINE_BITS), return_index=True)
    ends = np.append(starts[1:], len(prints))
    within = (prints & np.uint64((1 << FINE_BITS) - 1)).astype(np.uint32)
    for some in range(0, len(parts), 256):
        bounds = list(zip(starts[some : some + 256].tolist(), ends[some : some + 256].tolist()))
        listed = parts[some : some + 256]
        columns = [*(pa.nulls(len(listed), pa.int64()) for _ in range(5)), pa.array(listed.astype(np.int32))]
        columns[2] = pa.array([b - a for a, b in bounds], pa.int64())
        columns.append(pa.array([_pack(within[a:b], n[a:b]) for a, b in bounds], pa.binary()))
        yield pa.RecordBatch.from_arrays(columns, schema=_SKETCH)


def _pack(within: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte, and their counts."""
    steps = np.diff(within, prepend=np.uint32(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes() + n.tobytes(), "zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, 5 * n, "zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(raw[: 4 * n].reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32), raw[4 * n :]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, cells, counts) of the fingerprints that are counted more than once.

    Takes rows (part, n, prints) of all tasks, sorted by part. A part's memory
    is that of its fingerprints, one in 2**(PRINT_BITS - FINE_BITS) of all.
    """
    part, held = None, []

    def cells() -> pa.RecordBatch:
        within, n = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(within, kind="stable")
        within, n = within[order], n[order].astype(np.int64)
        starts = np.flatnonzero(np.append(True, within[1:] != within[:-1]))
        totals = np.add.reduceat(n, starts)
        several = totals > 1
        found = (part << FINE_BITS | within[starts[several]].astype(np.int64)) >> PRINT_BITS - CELL_BITS
        cell, at = np.unique(found, return_index=True)
        counts = np.add.reduceat(totals[several], at) if len(at) else at
        columns = [pa.array([part << FINE_BITS + CELL_BITS - PRINT_BITS >> PART_BITS], pa.int32())]
        columns += [pa.array([(cell & (1 << PART_BITS) - 1).astype(np.uint16).tobytes()], pa.binary()), pa.array([counts.astype(np.uint64).tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["part", "cells", "counts"])

    for batch in batches:
        for number, n, packed in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if number != part:
                if held:
                    yield cells()
                part, held = number, []
            held.append(_unpack(packed, n))
    if held:
        yield cells()


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, classes): each part's counts, of one to eight bytes each, summed as bit lengths, two cells a byte."""
    part, total = None, np.zeros(1 << PART_BITS, np.int64)

    def packed() -> pa.RecordBatch:
        kinds = np.ceil(np.log2(total + 1)).astype(np.uint8)  # bit lengths, 0 for none, 1 for a single one
        kinds = np.minimum(kinds, 15)
        cells = zlib.compress((kinds[::2] | kinds[1::2] << 4).tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([cells], pa.binary())], names=["part", "classes"])

    for batch in batches:
        for number, cells, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if number != part:
                if part is not None:
                    yield packed()
                part = number
                total[:] = 0
            if cells:
                total[np.frombuffer(cells, np.uint16)] += np.frombuffer(counts, f"u{2 * len(counts) // len(cells)}").astype(np.int64)
    if part is not None:
        yield packed()


def frequency_classes(rows: DataFrame) -> np.ndarray:
    """The sketch's classes, two cells a byte: 32 MB however many texts there are."""
    whole = F.shiftright("part", PART_BITS - (FINE_BITS + CELL_BITS - PRINT_BITS))  # of the sketch's rows
    parts = rows.filter("part IS NOT NULL").select("part", "n", "prints").repartition(whole).sortWithinPartitions("part")
    out = np.zeros(1 << CELL_BITS - 1, np.uint8)
    width = 1 << PART_BITS - 1
    for row in parts.mapInArrow(lambda b: _classes(_repeated(b)), "part int, classes binary").collect():  # 2**10 rows at most
        out[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(zlib.decompress(row["classes"]), np.uint8)
    return out


def class_of(classes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    cells = cell_of(tokens)
    return classes[cells >> 1] >> (cells & 1).astype(np.uint8) * np.uint8(4) & np.uint8(15)


def _chosen_texts(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names, bytes and offsets of the rows that a bitmap lets through; the others cost nothing."""
    for batch, data, at in slices(batches, most=SLICE):
        rows = batch.column(0).to_numpy()
        kept = in_bitmap(chosen, row_hash(rows))
        if kept.any():
            sizes = np.diff(at)
            yield rows[kept], data[np.repeat(kept, sizes)] if not kept.all() else data, np.append(0, np.cumsum(sizes[kept]))


def _chosen_sets(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(id, shingles) of the rows that a bitmap lets through."""
    for rows, data, at in _chosen_texts(batches, chosen):
        tokens, counts = shingle_sets(data, at)
        ends = np.cumsum(counts)
        shingles = [tokens[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(shingles, pa.binary())], names=["id", "shingles"])


def _prefixes(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, classes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Slices of the prefixes' shingles that other texts may have: token, id, n,
    shingles left, and the shingles of the set that no other text has."""
    for rows, data, at in _chosen_texts(batches, chosen):
        tokens, sizes = shingle_sets(data, at)
        owner = np.repeat(np.arange(len(rows)), sizes)
        kind = class_of(classes, tokens)
        order = np.argsort(owner << 4 | kind, kind="stable")  # ascending within each part already
        tokens, owner, kind = tokens[order], owner[order], kind[order]
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        n, lone = sizes[owner], np.bincount(owner[kind <= 1], minlength=len(rows))
        kept = (kind > 1) & (place < n - (3 * n + 3) // 4 + 1)
        yield tokens[kept], rows[owner[kept]], n[kept], (n - place)[kept], lone[owner[kept]]


def _tokens(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for tokens, *_ in _prefixes(batches, chosen, classes):
        token, n = np.unique(tokens, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(signed(token)), pa.array(n)], names=["token", "n"])


ENTRY = "token long, id long, n long, rest long, lone long"


def _entries(batches: Iterator[pa.RecordBatch], chosen: np.ndarray, classes: np.ndarray, shared: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The index: the prefix shingles that other prefixes have."""
    for tokens, *rest in _prefixes(batches, chosen, classes):
        kept = in_bitmap(shared, tokens)
        columns = [pa.array(x) for x in (signed(tokens[kept]), *(r[kept] for r in rest))]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "id", "n", "rest", "lone"])


def row_bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of the column ``id`` for scans to test their rows with."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(signed(row_hash(batch.column(0).to_numpy())))], names=["key"])

    return bitmap_of(ids.select("id").mapInArrow(keys, "key long"), "key", ROW_BITS)


def overlaps(sets: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """pairs (a, b) with n, m (the sizes) and overlap, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(batch.schema.get_field_index(c)) for c in ("left", "right"))
            sizes = np.zeros((batch.num_rows, 3), np.int64)
            for i, (x, y) in enumerate(zip(left, right)):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                sizes[i] = len(one), len(two), len(np.intersect1d(one, two, assume_unique=True))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("a", "b")]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(sizes[:, i]) for i in range(3))], names=["a", "b", "n", "m", "overlap"])

    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    return materialise(both.mapInArrow(count, "a long, b long, n long, m long, overlap long"), f"{name}-overlaps")


def most_left(rest: Column, n: Column) -> Column:
    """The size of the largest set that a set of size n with ``rest`` shingles left can link with."""
    return F.floor(7 * rest / 3).cast("long") - n


def block(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(BLOCK)) + 1e-9).cast("int")


def lead(sets: DataFrame, ids: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clusters (id, root, n, beyond) of all ids, and the links found on the way (a, b).

    ``beyond`` counts the shingles of a set that its root lacks but that another
    set may have.
    """
    sized = index.withColumn("block", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))))
    most = F.max(F.struct((F.col("rest") / F.col("n")).alias("share"), (-F.col("n")).alias("fewest"), "id", "n", "rest")).alias("leader")
    leaders = sized.groupBy("token", "block").agg(most).select("token", "block", "leader.id", "leader.n", "leader.rest").toDF("token", "block", "leader", "m", "left")
    votes = sized.join(leaders, ["token", "block"]).filter((F.col("id") != F.col("leader")) & enough(F.least("rest", "left"), F.col("n"), F.col("m")))
    votes = votes.groupBy("id", "leader").agg(F.count(F.lit(1)).alias("votes"))
    # one leader a set is tried at a time, the one that most of its lists name
    ranked = votes.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "leader"))).alias("ranked"))  # one a list of the set at most
    ranked = materialise(ranked.select(F.col("id").alias("a"), F.expr("ranked[0].leader").alias("b"), F.expr("try_element_at(ranked, 2).leader").alias("other")), "leaders")
    linking = lambda pairs: pairs.filter(enough(F.col("overlap"), F.col("n"), F.col("m")))
    first = overlaps(sets, ranked.select("a", "b"), "leaders")
    linked = linking(first)
    # of two sets that name each other the larger id leads, so that none is led by one that it leads
    mutual = linked.select(F.col("b").alias("a"), F.col("a").alias("b")).filter("a > b")
    linked = linked.join(mutual, ["a", "b"], "left_anti")
    led = linked.select(F.col("a").alias("id"))
    rooted = linked.join(led.select(F.col("id").alias("b")), "b", "left_anti")  # the leader leads itself
    nearest = lambda pairs: pairs.groupBy(F.col("a").alias("id")).agg(F.min(F.struct("b", "n", "overlap")).alias("best")).select("id", F.col("best.b").alias("root"), "best.n", (F.col("best.n") - F.col("best.overlap")).alias("beyond"))
    settled = materialise(nearest(rooted), "clusters-1")
    # a set whose leader is led itself tries the leader's root; one that does not
    # link with its leader the next leader, or that one's root
    roots = settled.select(F.col("id").alias("b"), "root")
    second = linked.join(settled.select(F.col("id").alias("a")), "a", "left_anti").select("a", "b")
    second = second.unionByName(ranked.join(led.select(F.col("id").alias("a")), "a", "left_anti").filter("other IS NOT NULL").select("a", F.col("other").alias("b")))
    second = second.join(roots, "b", "left").select("a", F.coalesce("root", "b").alias("b"))
    leading = settled.select(F.col("root").alias("a")).distinct()
    second = materialise(second.filter("a <> b").join(leading, "a", "left_anti").join(linked.select("a", "b"), ["a", "b"], "left_anti"), "proposed-2")
    again = overlaps(sets, second, "roots")
    # a root of the second round must not be led itself
    relinked = linking(again).join(again.select(F.col("a").alias("b")).distinct(), "b", "left_anti")
    members = settled.unionByName(nearest(relinked))
    members = members.join(ids.select("id", "lone"), "id").withColumn("beyond", F.col("beyond") - F.col("lone")).drop("lone")
    alone = ids.select("id", "n").join(members.select("id"), "id", "left_anti").select("id", F.col("id").alias("root"), "n", F.lit(0).cast("long").alias("beyond"))
    clusters = materialise(members.unionByName(alone), "clusters")
    links = materialise(linking(first).select("a", "b").unionByName(linking(again).select("a", "b")), "links")
    discard(ranked, first, settled, second, again)
    return clusters, links


def meetings(index: DataFrame, clusters: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of roots (a < b), not connected yet, whose members may link."""
    entries = index.join(clusters.select("id", "root"), "id").join(known.select(F.col("node").alias("root"), "component"), "root", "left")
    entries = materialise(entries.withColumn("component", F.coalesce("component", "root")), "entries")
    several = entries.groupBy("token").agg(F.min("component").alias("one"), F.max("component").alias("other")).filter("one <> other").select("token")
    entries_left = entries.join(several, "token", "left_semi").withColumn("top", most_left(F.col("rest"), F.col("n")))
    listed = F.struct("root", "component", "least", "most", "top")
    ranges = [F.min("n").alias("least"), F.max("n").alias("most"), F.max("top").alias("top")]
    keys = ["token", "block", "root", "component"]
    smaller = entries_left.filter("top >= n").withColumn("block", block(F.col("n"))).groupBy(*keys).agg(*ranges)
    reach = F.sequence(block(F.ceil(3 * F.col("n") / 4)), block(F.least("n", "top")))
    larger = entries_left.withColumn("block", F.explode(reach)).groupBy(*keys).agg(*ranges)
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    near = (4 * x("most") >= 3 * y("least")) & (4 * y("most") >= 3 * x("least")) & (y("top") >= x("least")) & (x("top") >= y("least"))
    met = larger.select("token", "block", listed.alias("x")).join(smaller.select("token", "block", listed.alias("y")), ["token", "block"])
    met = met.filter((x("component") != y("component")) & near)
    pairs = met.select(F.least(x("root"), y("root")).alias("a"), F.greatest(x("root"), y("root")).alias("b")).distinct()
    pairs = materialise(pairs, "meetings")
    discard(entries)
    return pairs


def derive(sets: DataFrame, clusters: DataFrame, links: DataFrame, met: DataFrame) -> DataFrame:
    """The links between clusters that meet, at least one for each connection."""
    roots = overlaps(sets, met, "meetings")
    direct = enough(F.col("overlap"), F.col("n"), F.col("m"))
    links = links.unionByName(roots.filter(direct).select("a", "b"))
    reach = clusters.groupBy("root").agg(F.min("n").alias("least"), F.max("beyond").alias("beyond"))
    bound = lambda side: reach.select(F.col("root").alias(side), F.col("least").alias(f"least_{side}"), F.col("beyond").alias(f"beyond_{side}"))
    open_pairs = roots.filter(~direct).join(bound("a"), "a").join(bound("b"), "b")
    open_pairs = open_pairs.filter(enough(F.col("overlap") + F.col("beyond_a") + F.col("beyond_b"), F.col("least_a"), F.col("least_b")))
    # what a member of either side must have beyond its leader at least
    least = F.ceil(3 * (F.col("least_a") + F.col("least_b")) / 7) - F.col("overlap")
    open_pairs = open_pairs.select("a", "b", "overlap", (least - F.col("beyond_b")).alias("need_a"), (least - F.col("beyond_a")).alias("need_b"))
    open_pairs = materialise(open_pairs, "open")
    if open_pairs.isEmpty():
        return links
    # what the direct links have connected needs no members
    known = components(links)
    part = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"part_{side}"))
    apart = open_pairs.join(part("a"), "a", "left").join(part("b"), "b", "left").filter(F.coalesce("part_a", "a") != F.coalesce("part_b", "b"))
    member = lambda side: clusters.select(F.col("root").alias(side), F.col("id").alias(f"id_{side}"), F.col("n").alias(f"n_{side}"), F.col("beyond").alias(f"beyond_{side}"))
    apart = apart.select("a", "b", "overlap", "need_a", "need_b")
    pairs = apart.join(member("a"), "a").filter("beyond_a >= need_a").join(member("b"), "b").filter("beyond_b >= need_b")
    pairs = pairs.filter(((F.col("id_a") != F.col("a")) | (F.col("id_b") != F.col("b"))) & enough(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b")) & enough(F.col("overlap") + F.col("beyond_a") + F.col("beyond_b"), F.col("n_a"), F.col("n_b")))
    compared = overlaps(sets, pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")), "members")
    return links.unionByName(compared.filter(direct).select("a", "b"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest doc_id reachable)."""
    spark = docs.sparkSession
    send = lambda bitmap: SentBitmap(spark, bitmap)
    texts = named_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = materialise(texts.mapInArrow(_sketches, SKETCH), "sketches")
    classes = send(frequency_classes(sketches))
    rows = materialise(sketches.filter("part IS NULL").select("row", "doc_id", "n", "low", "high"), "rows")
    discard(sketches)
    same = rows.filter("n > 0").groupBy("low", "high", "n").agg(F.min("row").alias("id"), F.min("doc_id").alias("least_doc"))
    sets = materialise(same, "sets")

    # the index, and the whole sets of those that are in a list with another
    chosen = send(row_bitmap(sets))
    counted = texts.mapInArrow(lambda b: _tokens(b, chosen.value, classes.value), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    listed = send(bitmap_of(counted.filter("n > 1"), "token", TOKEN_BITS))
    entries = materialise(texts.mapInArrow(lambda b: _entries(b, chosen.value, classes.value, listed.value), ENTRY), "prefixes")
    exact = entries.join(sets.select("id"), "id", "left_semi")  # the bitmaps let a few others through
    shared = exact.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1").select("token")
    index = materialise(exact.join(shared, "token", "left_semi"), "index")
    discard(entries)
    ids = materialise(index.select("id", "n", "lone").distinct(), "ids")
    wanted = send(row_bitmap(ids))
    shingles = materialise(texts.mapInArrow(lambda b: _chosen_sets(b, wanted.value), "id long, shingles binary"), "shingles")
    for bitmap in (classes, chosen, listed, wanted):
        bitmap.destroy()

    clusters, links = lead(shingles, ids, index)
    # a set and its root are linked by construction, so clusters are connected
    known = materialise(components(links), "known")
    met = meetings(index, clusters, known)
    discard(index, ids, known)
    found = components(derive(shingles, clusters, links, met))
    discard(shingles, clusters, links, met)
    parted = sets.join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    parted = materialise(parted.select("low", "high", "n", "component", "least_doc"), "parted")
    discard(sets)
    smallest = parted.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    answers = parted.join(smallest, "component").select("low", "high", "n", "component_id")
    out = rows.join(answers, ["low", "high", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
