import random
import re

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import common


@pytest.mark.parametrize("seed", range(5))
def test_words_of(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab é\n.Z") for _ in range(rng.choice([0, 0, 1, 3, 30]))) for _ in range(40)]
    raw = [t.encode() for t in texts]
    data, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    is_word = np.ones(256, np.int8)
    is_word[[32, 10]] = 0
    starts, ends, rows, hashes = common.words_of(data, at, is_word, common.byte_codes(5)[common.lower_ascii_table()])
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^ \n]+", t)]
    assert [(int(r), data[s:e].tobytes().decode()) for r, s, e in zip(rows, starts, ends)] == want
    by_hash = {}
    fold = str.maketrans("Z", "z")
    for (_, word), h in zip(want, hashes.tolist()):
        assert by_hash.setdefault(word.translate(fold), h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_slices_cover_all_rows_whole():
    texts = ["a" * n for n in (0, 5, 900, 3, 0, 2000, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(common.slices(iter([batch]), most=1000))
    assert [i for rows, _, _ in parts for i in rows.column(0).to_pylist()] == list(range(8))
    assert [data[a:b].tobytes().decode() for _, data, at in parts for a, b in zip(at[:-1], at[1:])] == [t or "" for t in texts]


def test_bitmap(spark):
    common.ship_code(spark)
    values = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    frame = spark.createDataFrame([(int(v),) for v in common.signed(values)], "h long")
    bitmap = common.bitmap_of(frame, "h")
    assert common.in_bitmap(bitmap, values).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert common.in_bitmap(bitmap, others).mean() < 0.01


def test_without(spark):
    common.ship_code(spark)
    docs = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "c", 3), (-5, "d", 4), (2, "e", 5)], "doc_id long, text string, dropped_id int")
    dropped = spark.createDataFrame([(2,), (-5,), (None,), (99,), (2,)], "doc_id long")
    assert sorted(r["text"] for r in common.without(docs, dropped).collect()) == ["a", "c"]
    assert common.without(docs, dropped.limit(0)).count() == 5
