import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import suffix_dedup
from strata.llm.common import read_table, ship_code

SCHEMA = "doc_id long, text string, lang string, n_bytes long"


def brute(rows, length=100):
    """rows: (doc_id, text) in input order."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        raw = (rows[i][1] or "").encode()
        keep = np.ones(len(raw), bool)
        for at in range(len(raw) - length + 1):
            piece = raw[at : at + length]
            if piece in seen:
                keep[at : at + length] = False
            seen.add(piece)
        gone = np.flatnonzero(~keep)
        runs = int((np.diff(gone) > 1).sum()) + 1 if len(gone) else 0
        out[i] = (rows[i][0], len(raw), len(gone), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[keep].tobytes()).hexdigest())
    return sorted(out.values(), key=str)


def run(spark, rows):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA).coalesce(2)
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("piece", [100, 500])
def test_long_texts_in_pieces(spark, piece):
    ship_code(spark)
    rng = random.Random(piece)
    passage = words(rng, 90)
    rows = [(1, passage + words(rng, 100)), (2, words(rng, 70) + passage * 2), (3, passage[30:]), (4, "x" * 1300), (5, None), (6, "x" * 99), (7, passage[:250] + "y" * 300 + passage[120:]), (None, passage[50:200])]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], SCHEMA).coalesce(2)
    got = suffix_dedup.remove_repeats(docs, piece=piece).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_no_text_is_too_long(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", 21)
    text = np.random.default_rng(0).integers(97, 123, (1 << 21) + 5000, dtype=np.uint8).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([0], pa.int64()), pa.array([text.decode()])], names=["doc_id", "row", "text"])
    strings = np.zeros(len(text), np.int64)
    for found in suffix_dedup._hulls(iter([batch]), np.full(1 << 24, 255, np.uint8), suffix_dedup.PIECE):
        for first, n in zip(found.column(4).to_pylist(), found.column(5).to_pylist()):
            strings[first : first + n] += 1
    assert (strings[:-99] == 1).all() and not strings[-99:].any()


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_edges(spark):
    passage = words(random.Random(0), 60)
    rows = [
        (1, passage),
        (2, passage),
        (3, None),
        (4, ""),
        (5, "x" * 400),
        (6, "y" * 99),
        (7, "y" * 100),
        (8, "y" * 101),
        (9, "ab" * 300 + passage[:120]),
        (10, passage[17:] + passage[:150]),
        (None, passage + " tail"),
        (11, passage),
        (11, passage),
        (12, "x" * 250 + passage[50:170] + "x" * 250),
    ]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_edited_copies(spark, seed):
    rng = random.Random(seed)
    bases = [words(rng, rng.randint(30, 160)) for _ in range(6)]
    line = words(rng, 22)
    rows = []
    for i in range(70):
        text = list(rng.choice(bases).split(" "))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = words(rng, 1)
        text = " ".join(text)
        if rng.random() < 0.4:
            at = rng.randrange(len(text))
            text = text[:at] + line + text[at:]
        rows.append((i * 3, text))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_whole_documents_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_buckets_are_spread_over_the_bitmap():
    data = np.random.default_rng(3).integers(97, 123, 200_000, dtype=np.uint8)
    p = suffix_dedup.pointers(data, np.array([0, len(data)]))
    shares = np.bincount((p.bucket >> np.uint64(60)).astype(np.int64), minlength=16) / len(p.bucket)
    assert shares.min() > 0.04 and shares.max() < 0.09  # all in the lowest sixteenth, if named by the least gram's hash


def test_spans_travel_merged(spark, monkeypatch):
    ship_code(spark)
    lists, keep = [], suffix_dedup.materialise

    def seen(frame, name):
        table = keep(frame, name)
        if name == "row-spans":
            lists.extend(len(r["spans"]) for r in table.collect())
        return table

    monkeypatch.setattr(suffix_dedup, "materialise", seen)
    passage = words(random.Random(5), 300)
    rows = [(1, passage), (2, passage), (3, passage[40:] + words(random.Random(6), 20) + passage[:400])]
    assert run(spark, rows) == brute(rows)
    assert sorted(lists) == [1, 2]


@pytest.mark.parametrize("values, bits", [(0, 27), (1 << 23, 27), (1 << 25, 29), (1 << 40, 29)])
def test_bitmaps_grow_with_their_values(values, bits):
    assert suffix_dedup.bits_for(values) == bits
