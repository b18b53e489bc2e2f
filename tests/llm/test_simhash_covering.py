import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from strata.llm import simhash_covering
from strata.llm.common import read_table, ship_code
from tests.llm.test_jaccard_join import FOLD

SCHEMA = "doc_id long, text string, fingerprint int, component_id string"


def fingerprint(text):
    words = (text or "").translate(FOLD).encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_parts(prints):
    values, part = np.array(prints, np.uint64), np.full(len(prints), -1)
    for i in range(len(prints)):
        if part[i] < 0:
            part[i], queue = i, [i]
            while queue:
                near = np.flatnonzero((np.bitwise_count(values ^ values[queue.pop()]) <= 3) & (part < 0))
                part[near] = i
                queue += near.tolist()
    return part.tolist()


def brute(rows):
    prints = [fingerprint(t) for _, t in rows]
    parts = brute_parts(prints)
    least = {}
    for (doc_id, _), p in zip(rows, parts):
        if doc_id is not None:
            least[p] = min(doc_id, least.get(p, doc_id))
    return sorted(((i, f"{f:016x}", least.get(p)) for (i, _), f, p in zip(rows, prints, parts)), key=str)


def run(spark, rows):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], SCHEMA).coalesce(3)
    return sorted((tuple(r) for r in simhash_covering.simhash_components(docs).collect()), key=str)


@pytest.mark.parametrize("kept", [0, 0xFFFF0F0F0F0F, (1 << 60) - 1])
def test_masks_cover_the_radius(kept):
    """Any three positions outside the kept ones are left out by some mask."""
    masks = simhash_covering.covering(kept)
    assert len(masks) == 15 and all(m & kept == kept for m in masks)
    free = [i for i in range(64) if not kept >> i & 1]
    for three in itertools.combinations(free, 3):
        assert any(not any(m >> i & 1 for i in three) for m in masks)


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(9, text), (4, text.upper()), (7, text + " more"), (1, None), (2, ""), (3, " \t\n"), (5, "one two"), (6, "One\ntwo"), (8, "two one"), (None, text), (9, text), (10, "é É é"), (None, "quite alone here"), (11, "word")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("varying, members", [(12, 900), (40, 1200)])
def test_families_of_fingerprints(spark, varying, members):
    """Dense families, whose buckets are refined, and scattered fingerprints."""
    ship_code(spark)
    rng = random.Random(varying)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for centre in list(prints)[:2]:
        bits = rng.sample(range(64), varying)
        for _ in range(members):
            value = centre
            for bit in rng.sample(bits, rng.randint(1, 7)):
                value ^= 1 << bit
            prints.add(value)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")
    found = simhash_covering.components(simhash_covering.links(frame)).collect()
    part = {r["node"] % (1 << 64): r["component"] for r in found}
    got, want = {}, {}
    for p, root in zip(prints, brute_parts(prints)):
        got.setdefault(part.get(p, ("alone", p)), set()).add(p)
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(simhash_covering, "PART", 300)
    rng = random.Random(2)
    texts = [" ".join(f"a{rng.randrange(50)}" for _ in range(n)) for n in (1, 3, 900, 2, 500)] + ["x" * 2000, " " * 4000 + "A b", "Lone" + " " * 999, None, "y" * 700 + " z " + "k" * 900 + " q"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    got = {i: p for b in simhash_covering.fingerprints(iter([batch])) for i, p in zip(b.column(0).to_pylist(), b.column(1).to_numpy().view(np.uint64).tolist())}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


def test_whole_documents_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in simhash_covering.simhash_components(docs).collect()), key=str) == brute(rows)
