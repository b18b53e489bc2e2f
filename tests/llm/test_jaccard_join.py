import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import jaccard_join
from strata.llm.common import ship_code
from strata.llm.components import components

SCHEMA = "doc_id long, text string, n_shingles string, component_id string"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                part[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if sets[i] and ids else doc_id if not sets[i] else None))
    return sorted(out, key=str)


def run(spark, rows):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], SCHEMA).coalesce(3)
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(docs).collect()), key=str)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(40))
    near = " ".join(f"w{i}" for i in range(37))
    rows = [(9, text), (4, text.upper()), (7, near), (1, None), (2, ""), (3, " \t\n"), (5, "one two"), (6, "One\ntwo"), (8, "two one"), (None, text), (9, text), (10, "é è é è é"), (11, "É è é è é"), (None, "lonely row of words here it is")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def drift(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        choice = rng.random()
        if choice < 0.5:
            words[at] = f"x{rng.randrange(10**6)}"
        elif choice < 0.75:
            del words[at]
        else:
            words.insert(at, f"x{rng.randrange(10**6)}")
    return words


@pytest.mark.parametrize("seed", range(2))
def test_families_near_the_threshold(spark, seed):
    """Chains of edits, so that many pairs lie close to 3/4 on both sides."""
    rng = random.Random(seed)
    line = [f"common{i}" for i in range(30)]
    rows = []
    for family in range(6):
        text = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.randint(20, 120))]
        for _ in range(25):
            text = drift(rng, text, rng.randint(0, 3)) if rng.random() < 0.7 else text
            shown = line + text if rng.random() < 0.3 else text
            rows.append((len(rows) * 7 % 1009, " ".join(shown)))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_passage_with_tails_of_many_lengths(spark):
    """Sets of different sizes, whose prefixes end at different places."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join(passage[rng.randint(0, 6) :] + [f"t{i}x{j}" for j in range(rng.randint(0, 26))])) for i in range(150)]
    assert run(spark, rows) == brute(rows)


def test_links_only_between_members(spark):
    """Two clusters whose leaders don't link are joined through members."""
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for step in range(1, 9):  # each a bit further; neighbours link, the ends do not
        rows.append((step, " ".join(base[3 * step :] + [f"n{i}" for i in range(3 * step)])))
    assert run(spark, rows) == brute(rows)


def test_frequency_classes():
    """Tasks' sketches add up, and tell what is counted once from what is not."""
    rng = np.random.default_rng(8)
    tokens = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    total, rows = {}, []
    for _ in range(3):
        cells, n = np.unique(jaccard_join.cell_of(rng.choice(tokens, 2000)), return_counts=True)
        for cell, k in zip(cells.tolist(), n.tolist()):
            total[cell] = total.get(cell, 0) + k
        for part in np.unique(cells >> jaccard_join.PART_BITS).tolist():
            own = cells >> jaccard_join.PART_BITS == part
            rows.append({"part": part, "cells": (cells[own] & 0xFFFF).astype(np.uint16).tobytes(), "counts": n[own].astype(np.uint8).tobytes()})
    rows.sort(key=lambda r: r["part"])
    packed = np.zeros(1 << jaccard_join.CELL_BITS - 1, np.uint8)
    for batch in jaccard_join._classes(iter([pa.RecordBatch.from_pylist(rows[:100]), pa.RecordBatch.from_pylist(rows[100:])])):
        part, classes = batch.column(0)[0].as_py(), np.frombuffer(zlib.decompress(batch.column(1)[0].as_py()), np.uint8)
        packed[part * len(classes) : (part + 1) * len(classes)] = classes
    want = [total.get(cell, 0).bit_length() for cell in jaccard_join.cell_of(tokens).tolist()]
    assert jaccard_join.class_of(packed, tokens).tolist() == want


def test_rows_keep_their_names(spark, monkeypatch, scratch):
    """A scan that is cut otherwise than the one before it gives the same rows."""
    ship_code(spark)
    rng = random.Random(4)
    base = [[f"f{k}w{rng.randrange(300)}" for _ in range(40)] for k in range(8)]
    rows = [(i, " ".join(drift(rng, rng.choice(base), rng.randint(0, 4)))) for i in range(240)]
    for part in range(4):
        spark.createDataFrame(rows[part::4], "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 2048).mode("append").parquet(scratch)
    settings = {"spark.sql.files.openCostInBytes": "1024", "spark.sql.files.maxPartitionBytes": "4096"}
    before = jaccard_join.materialise

    def rescaled(*args):
        table = before(*args)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        return table

    monkeypatch.setattr(jaccard_join, "materialise", rescaled)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        cut = spark.read.parquet(scratch).rdd.getNumPartitions()
        got = sorted((tuple(r) for r in jaccard_join.jaccard_components(spark.read.parquet(scratch)).collect()), key=str)
        assert cut > spark.read.parquet(scratch).rdd.getNumPartitions()
    finally:
        for name in (*settings, "spark.sql.leafNodeDefaultParallelism"):
            spark.conf.unset(name)
    assert got == brute(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 70), (71, 70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 50 for i in (50, 70, 71, 100)}}


def test_sketch_of_repeated_shingles(monkeypatch):
    """The sketch holds the shingles that several texts have, and no others, however many there are."""
    monkeypatch.setattr(jaccard_join, "CHUNK", 5000)  # several chunks a task
    words = [[f"d{i}w{j}" for j in range(2000)] for i in range(40)]
    words[7][100:160] = words[31][500:560] = [f"s{j}" for j in range(60)]  # 56 shingles that two texts have
    data = [" ".join(w).encode() for w in words]
    grams = [jaccard_join.shingle_sets(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[0] for d in data]
    batches = [pa.RecordBatch.from_pydict({"row": [i], "doc_id": [i], "text": [d.decode()]}) for i, d in enumerate(data)]
    made = [b.select(["part", "n", "prints"]).filter(b.column("part").is_valid()) for task in (batches[:20], batches[20:]) for b in jaccard_join._sketches(iter(task))]
    rows = pa.Table.from_batches([b for b in made if b.num_rows])
    assert sum(rows.column("n").to_pylist()) > 79000
    found = np.zeros(1 << jaccard_join.CELL_BITS, np.int64)
    for batch in jaccard_join._repeated(iter(rows.sort_by("part").to_batches())):
        cells, counts = (np.frombuffer(batch.column(i)[0].as_py(), t) for i, t in ((1, np.uint16), (2, np.uint64)))
        found[(batch.column(0)[0].as_py() << jaccard_join.PART_BITS) + cells.astype(np.int64)] += counts.astype(np.int64)
    shared = np.intersect1d(grams[7], grams[31])
    assert len(shared) == 56
    want = np.zeros_like(found)
    np.add.at(want, jaccard_join.cell_of(shared), 2)
    assert (found == want).all()
