import glob
import os

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import best_two_fit, token_output
from strata.llm.common import Feistel, ship_code


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4096, 4097])
def test_feistel_is_a_permutation(size):
    for key in (0, 99):
        assert sorted(Feistel(size, key)(np.arange(size))) == list(range(size))
    if size > 900:
        assert (Feistel(size, 1)(np.arange(size)) != Feistel(size, 2)(np.arange(size))).mean() > 0.9


def test_round_trip(spark, scratch):
    ship_code(spark)
    texts = [(i, "some words " * (i % 40)) for i in range(120)] + [(200, None), (201, ""), (None, "no id"), (5, "twice"), (5, "twice"), (202, "naïve 漢字 " * 900)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, slot int").repartition(4)
    total = token_output.write_shards(docs, scratch, key=7, seq_len=64, shard_rows=16)
    files = {int(f.split("shard=")[1].split("/")[0]): open(f, "rb").read() for f in glob.glob(f"{scratch}/shards/shard=*/part-*")}
    assert sorted(files) == list(range(-(-total // 16)))
    width = token_output.stride(64)
    assert sum(map(len, files.values())) == total * width
    assert all(len(files[s]) == 16 * width for s in list(files)[:-1] if s != max(files))
    index = token_output.read_index(spark, scratch, 64, 16).collect()
    assert all(r["intact"] for r in index) and {r["slot"] for r in index} == set(range(total))
    # every document comes back whole from the files
    encode = best_two_fit.encoder().encode_ordinary
    pieces = {}
    for r in index:
        ids = token_output.read_slot(files[r["shard"]], r["slot"], 64, 16)[r["at"] : r["at"] + r["n_tokens"]]
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], ids.tolist()))
    for doc_id, text in texts:
        want = encode(text or "") + [2]
        if doc_id != 5:
            parts = sorted(pieces[doc_id])
            assert [i for _, _, ids in parts for i in ids] == want and [p for p, _, _ in parts] == list(range(len(parts)))
    assert sum(len(ids) for _, _, ids in pieces[5]) == len(encode("some words " * 5)) + 1 + 2 * (len(encode("twice")) + 1)


def test_damage_shows(spark, scratch):
    ship_code(spark)
    docs = spark.createDataFrame([(i, "words and words " * 9) for i in range(20)], "doc_id long, text string").coalesce(1)
    token_output.write_shards(docs, scratch, key=7, seq_len=32, shard_rows=8)
    path = sorted(glob.glob(f"{scratch}/shards/shard=0/part-*"))[0]
    data = bytearray(open(path, "rb").read())
    data[3 * token_output.stride(32)] ^= 1
    open(path, "wb").write(bytes(data))
    checksum = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    os.remove(checksum)
    assert {r["slot"] for r in token_output.read_index(spark, scratch, 32, 8).collect() if not r["intact"]} == {3}


def test_empty_table(spark, scratch):
    ship_code(spark)
    assert token_output.write_shards(spark.createDataFrame([], "doc_id long, text string"), scratch, key=1) == 0


def test_records_travel_bundled():
    """The records of a batch for one shard are a bundle, smaller than they are, that gives them back."""
    rng = np.random.default_rng(4)
    phrases = rng.integers(0, 50000, (400, 16))
    records = [phrases[rng.integers(0, 400, 64)].astype("<u2").tobytes() for _ in range(300)]
    shard = np.arange(300) * 7 % 5
    slot = shard * 8192 + np.arange(300)
    batch = pa.RecordBatch.from_arrays([pa.array(shard), pa.array(slot), pa.array(records, pa.binary())], names=["shard", "slot", "record"])
    bundled = list(token_output._bundled(iter([batch, batch.slice(0, 0)])))
    assert sum(b.num_rows for b in bundled) == 5
    assert sum(b.column(2).nbytes for b in bundled) < 0.7 * batch.column(2).nbytes
    back = {s: (n, r) for b in token_output._unbundled(iter(bundled), 1024) for n, s, r in zip(*(c.to_pylist() for c in b.columns))}
    assert back == dict(zip(slot.tolist(), zip(shard.tolist(), records)))
