import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import lexical_search
from strata.llm.common import ship_code

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, rank string, score long"


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=20):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for *_, n in counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, tfs, n in counted:
            m = 75 + (25 * n * n_docs) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tfs[t]) // (1000 * tfs[t] + 12 * m)) for t in terms(text) if t in tfs)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k=20, **sizes):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA).coalesce(3)
    items = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical_search.rank_documents(docs, items, k, **sizes).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(rng, n, words=400):
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 30, 200])))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 25)))) for i in range(12)]
    return docs, items


def test_edges(spark):
    docs = [(5, "Red fox, RED hen"), (2, "red fox red hen"), (9, "red-fox_red.hen"), (None, "red fox red hen"), (2, "red fox red hen"), (1, None), (3, ""), (4, " .,;"), (7, "été fox"), (8, "Été x9")]
    items = [(1, "fox"), (1, "fox"), (2, "red red fox"), (3, None), (4, "..."), (5, "absent"), (None, "hen"), (6, "été É X9")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, k=2) == brute(docs, items, 2)


def test_empty_tables(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert run(spark, [], items) == [] == run(spark, docs, []) == run(spark, docs, [(1, None)])


@pytest.mark.parametrize("bucket, postings, block", [(4, 50, 1 << 20), (256, 1 << 21, 30)])
def test_buckets_and_blocks(spark, monkeypatch, bucket, postings, block):
    """Small buckets, blocks of documents and blocks of items give the same."""
    docs, items = corpus(random.Random(bucket), 300)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    assert run(spark, docs, items, bucket=bucket, postings=postings) == brute(docs, items)


def test_bounds_skip_documents():
    """Buckets and coordinates leave most of the pairs unscored, and the best as they are."""
    rng = np.random.default_rng(3)
    docs, words = 4000, 500
    row = np.repeat(np.arange(docs), 12)
    term = np.concatenate([rng.choice(words, 12, replace=False) for _ in range(docs)])
    impact = rng.integers(1, 900_000, len(row)) // rng.integers(1, 40, len(row))
    items = lexical_search.Items(np.arange(5), np.arange(words, dtype=np.uint64), [rng.choice(words, 9, replace=False) for _ in range(5)], [np.ones(9, np.int64)] * 5, rng.integers(0, 9000, words))
    search = lexical_search.Search(items, 20)
    search.block(np.arange(docs), np.zeros(docs, bool), row, term, impact)
    assert search.visited < 0.6 * docs * 5
    for i, best in enumerate(search.best):
        dense = np.zeros(words, np.int64)
        dense[items.terms[i]] = items.weight[items.terms[i]]
        score = np.bincount(row, weights=(dense[term] * impact).astype(float), minlength=docs).astype(np.int64)
        want = np.lexsort((np.arange(docs), -score))[:20]
        assert best.doc.tolist() == want.tolist() and best.score.tolist() == score[want].tolist()


def test_long_document_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lexical_search.word_slices, "__defaults__", ("text", 500))
    docs, items = corpus(random.Random(1), 40)
    docs += [(1000, " ".join(t for _, t in docs) + " " + "z" * 3000), (1001, " " * 5000)]
    batches = lambda rows: iter([__import__("pyarrow").RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})])
    vocabulary = np.unique(np.concatenate([lexical_search.words_of(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), *lexical_search.tables())[3] for _, t in items]))
    whole = [(n.tolist(), len(tf), int(tf.sum())) for _, n, _, _, tf in lexical_search._term_counts(batches(docs[-2:]), vocabulary)]
    assert [w[0] for w in whole] == [[len(terms(docs[-2][1]))], [0]]
    asked = {t for _, text in items for t in terms(text)}
    counted = Counter(t for t in terms(docs[-2][1]) if t in asked)
    assert whole[0][1:] == (len(counted), sum(counted.values()))
