import re

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import quality_cnn
from strata.llm.common import ship_code

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
GOOD = "plain text number {0} that says something of its own about topic {0} and goes on with item {1} and item {2} until it ends at {3} or so"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, kept string"


def rows():
    good = [GOOD.format(i, i * 7, i * 13, i * 31) for i in range(300)]
    out = [(i, t) for i, t in enumerate(good)]
    out += [(1000 + i, "!! ?? ## $$ " * (5 + i % 20)) for i in range(300)]  # junk
    out += [(2000 + i, good[i].upper() if i % 2 else good[i]) for i in range(40)]  # exact copies
    out += [(3000 + i, good[60 + i] + " tail") for i in range(40)]  # near copies
    item = "the benchmark asks which of these ten words come right after one another here"
    out += [(4000 + i, f"{good[100 + i]} new {i} words {i + 1} in {i + 2} front {item} and {i} others {i * 3} behind") for i in range(10)]
    out += [(5000, None), (5001, ""), (None, good[5]), (5002, good[299]), (5002, good[299]), (5003, "long " * 4000)]
    return out, [(1, item), (2, None), (3, "")]


def words(pattern, text):
    return re.findall(pattern, (text or "").translate(FOLD))


def shingles(text):
    w = words(r"[^\x20\x09-\x0d]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    ship_code(spark)
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs, items = rows()
    spark.createDataFrame([(i, t, "en", "s", 1, "c", "k") for i, t in docs], SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i < 1000), 0) for i, _ in docs if i is not None and i < 1300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def stage_rows(spark, corpus):
    """Each stage's input and output, as run() makes them."""
    docs, seen = spark.read.parquet(f"{corpus}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, corpus), "test")
        assert out.dtypes == docs.dtypes
        seen.append(([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["doc_id"], r["text"]) for r in out.collect()]))
        docs = out
    return seen, docs


def test_stages_against_brute_force(spark, corpus):
    (quality, exact, near, bench), last = stage_rows(spark, corpus)
    key = lambda r: (str(r[0]), str(r[1]))

    given, kept = quality
    network = quality_cnn.Network().fit(*quality_cnn.training_sample(spark.read.parquet(f"{corpus}/documents.parquet"), spark.read.parquet(f"{corpus}/labels.parquet")))
    score = lambda t: network.score(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0]
    assert sorted(kept, key=key) == sorted((r for r in given if score(r[1]) >= 0.3), key=key)
    ids = {i for i, _ in kept}
    assert not any(1000 <= (i or 0) < 1300 for i in ids) and len([i for i in ids if i is not None and i < 300]) >= 297

    given, kept = exact
    groups = {}
    for i, t in given:
        if i is not None:
            groups.setdefault((t or "").translate(FOLD), []).append(i)
    want = [(max(ids), text) for text, ids in groups.items()]
    nulls = [(i, t) for i, t in given if i is None]
    # a null id can be a group's only row or its loser; it stays either way
    assert sorted(((i, (t or "").translate(FOLD)) for i, t in kept if i is not None), key=key) == sorted(want, key=key)
    assert [r for r in kept if r[0] is None] == nulls

    given, kept = near
    sets = {i: shingles(t) for i, t in given if i is not None}
    order, root = sorted(sets), {}
    for i in order:
        linked = {root[j] for j in root if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
        root[i] = min(linked | {i})
        for j in root:
            if root[j] in linked:
                root[j] = root[i]
    assert sorted(i for i, _ in kept if i is not None) == [i for i in order if root[i] == i]

    given, kept = bench
    item = words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", rows()[1][0][1])
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    dirty = lambda t: any(tuple(w[i : i + 10]) in windows for w in [words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)] for i in range(len(w) - 9))
    assert sorted(kept, key=key) == sorted((r for r in given if not dirty(r[1])), key=key)
    assert len(given) - len(kept) >= 9

    packed = corpus_pipeline.run(spark, corpus).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in last.collect()}
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stage_order():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.STAGES[2][1] is corpus_pipeline.near


def test_exact_with_clashing_columns_and_ties(spark, tmp_path):
    """Repeated ids, rows equal but for letters' case, and columns named like the stage's own."""
    rows = [(1, "Same text", "a", 1), (1, "same TEXT", "b", 2), (1, "same TEXT", "b", 2), (1, "other", "c", 3), (2, "SAME text", "d", 4), (2, "SAME text", "d", 5), (3, None, "e", 6), (3, "", "e", 7), (None, "other", "f", 8)]
    schema = "doc_id long, text string, _text_sha256 string, _kept_id int"
    expected = None
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, schema).repartition(parts)
        kept = corpus_pipeline.exact(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        got = sorted(map(tuple, kept.collect()), key=str)
        assert expected in (None, got)
        expected = got
    assert [r for r in expected if r[0] == 2] == [(2, "SAME text", "d", 4)]
    assert sorted(r[0] for r in expected if r[0] is not None) == [1, 2, 3]
