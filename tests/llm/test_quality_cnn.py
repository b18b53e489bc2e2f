import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm import quality_cnn
from strata.llm.common import read_table, ship_code


def test_chunks_cover_every_byte():
    for n in (0, 1, 63, 448, 512, 513, 960, 961, 5000):
        data = np.arange(n, dtype=np.int64).astype(np.uint8)
        symbols, rows, held = quality_cnn.chunked(data, np.array([0, n]))
        seen = np.zeros(max(n, 1), bool)
        for i, h in enumerate(held):
            start = i * quality_cnn.HOP
            seen[start : start + h] = True
            assert (symbols[i, :h] == data[start : start + h]).all() and (symbols[i, h:] == 256).all()
        assert seen.all() or n == 0
        assert len(rows) == max(1, -(-max(n - 64, 1) // 448))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (5, 700, 1500)]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    target = np.array([1, 0, 1], np.float32)
    net = quality_cnn.Network()
    net._train = True
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    symbols, rows, _ = quality_cnn.chunked(data, at)
    loss = lambda: -float(np.mean(np.log(np.where(target == 1, p := net.forward(symbols, rows, 3)["p"], 1 - p))))
    grads = net.gradients(symbols, rows, target)
    for name in ("out", "hidden", "filters", "embed"):
        w = net.weights[name]
        for _ in range(4):
            spot = tuple(rng.integers(0, s) for s in w.shape)
            if name == "embed":
                spot = (256, spot[1])
            w[spot] += 1e-4
            up = loss()
            w[spot] -= 2e-4
            down = loss()
            w[spot] += 1e-4
            assert abs((up - down) / 2e-4 - grads[name][spot]) < 2e-3


def test_scores_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(32, 120, n, dtype=np.uint8)) for n in (0, 3, 511, 4000)]
    net = quality_cnn.Network()
    together = net.score(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    alone = [net.score(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6)


def test_edges_and_accuracy(spark, monkeypatch):
    ship_code(spark)
    good, bad = "plain words in a row that differ from each other ", "!! ?? ## $$ %% && "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 30)) for i in range(400)] + [(None, good), (9001, None), (9002, ""), (1, good)]
    docs = spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], "doc_id long, text string, score double, quality int").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(400)] + [(None, 1, 1), (5, None, 0), (70000, 1, 1), (7, 1, 1)], "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in quality_cnn.train_and_score(docs, labels).collect()]
    assert len(got) == len(rows)
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 5 == 0) for r in got if r[0] is not None)
    assert all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.3) for r in got)
    held = [r for r in got if r[1] and r[0] is not None and r[0] < 400]
    assert held and all(r[3] == r[0] % 2 for r in held)
    # learning never sees a held-out row, and is bounded
    texts, _ = quality_cnn.training_sample(docs, labels, rows=50)
    assert len(texts) <= 50


def test_sample_takes_one_row_an_id(spark, monkeypatch):
    ship_code(spark)
    rows = [(i, f"text {i}") for i in range(60)] + [(7, f"again {i:04d}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    sizes, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    samples = [quality_cnn.training_sample(d, labels) for d in (docs, docs.coalesce(1).orderBy("text"), docs.coalesce(1).orderBy(docs["text"].desc()))]
    assert sizes and max(sizes) <= 60
    assert all(s[0] == samples[0][0] and (s[1] == samples[0][1]).all() for s in samples)
    assert zlib.crc32(b"7") % 5 and b"again 0000" in samples[0][0]


def test_no_labels(spark):
    ship_code(spark)
    docs = spark.createDataFrame([(1, "x"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality_cnn.train_and_score(docs, none).collect()] == [0.5, 0.5]
    assert quality_cnn.train_and_score(docs.limit(0), none).collect() == []


def test_keep_good_keeps_all_columns(spark):
    ship_code(spark)
    docs = spark.createDataFrame([(1, "x", 3), (None, None, 4)], "doc_id long, text string, score int")
    assert sorted(map(tuple, quality_cnn.keep_good(docs, quality_cnn.Network(prior=0.4)).collect()), key=str) == [(1, "x", 3), (None, None, 4)]
    assert quality_cnn.keep_good(docs, quality_cnn.Network(prior=0.2)).count() == 0


@pytest.mark.parametrize("sf, bad_rejected", [("sf0.01", 0.7), ("sf0.1", 0.9)])
def test_held_out_documents(sf, bad_rejected):
    """Few labels or many: rejected documents go and the others stay."""
    folder = f"/root/testdata/{sf}"
    labels = pq.read_table(f"{folder}/labels.parquet", columns=["doc_id", "quality"]).to_pydict()
    quality = {i: q for i, q in zip(labels["doc_id"], labels["quality"]) if q is not None}
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    rows = [(zlib.crc32(str(i).encode()) % 5 == 0, (t or "").encode(), quality[i]) for i, t in zip(docs["doc_id"], docs["text"]) if i in quality]
    learnt = [(t, q) for held, t, q in rows if not held and len(t) <= quality_cnn.TRAIN_BYTES]
    net = quality_cnn.Network().fit([t for t, _ in learnt], np.array([q for _, q in learnt], np.float32))

    def kept(label, held):
        texts = [t for h, t, q in rows if q == label and h == held]
        parts = [texts[i : i + 200] for i in range(0, len(texts), 200)]
        return np.concatenate([net.score(np.frombuffer(b"".join(p), np.uint8), np.cumsum([0, *map(len, p)])) for p in parts]) >= 0.3

    assert 1 - kept(0, True).mean() >= bad_rejected and kept(1, True).mean() >= 0.97
    assert 1 - kept(0, False).mean() >= 0.95 and kept(1, False).mean() >= 0.97


def test_held_out_query(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_cnn.train_and_score(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))
    held = got.filter("held_out").join(read_table(spark, sf, "labels"), "doc_id").collect()
    clean = [r for r in held if r["quality"] == 1]
    assert len(clean) > 40 and sum(r["predicted"] for r in clean) / len(clean) > 0.97
