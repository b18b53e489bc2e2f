import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import spelling_groups
from strata.llm.common import read_table, ship_code
from tests.llm.test_jaccard_join import FOLD

SCHEMA = "doc_id long, text string, word int, n string"


def counts(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def run(spark, rows, **sizes):
    ship_code(spark)
    docs = spark.createDataFrame([(i, t, 1, "b") for i, t in rows], SCHEMA).coalesce(3)
    return sorted((tuple(r) for r in spelling_groups.spelling_groups(docs, **sizes).collect()), key=str)


def variants(rng, word, n, letters="abé"):
    out = [word]
    for _ in range(n):
        base, at = rng.choice(out), rng.randrange(len(word) + 1)
        out.append(rng.choice([base[:at] + rng.choice(letters) + base[at:], base[:at] + base[at + 1 :], base[:at] + rng.choice(letters) + base[at + 1 :]]))
    return out


def test_edges(spark):
    words = "colouring " * 120 + "colourings " * 11 + "coluoring colourin colourin colouring1colouring " + "ÉTÉÉTÉÉ étéété été×÷ÿÿÿ " * 3
    rows = [(1, words), (1, words), (2, None), (3, ""), (None, words), (4, "colouringx colouringx COLOURINGX " * 2), (5, "short words only here"), (6, "aaaaaaa aaaaaaaa aaaaaaaaa " * 2), (7, "xcolouring " * 2)]
    assert run(spark, rows) == brute(counts(rows))


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("most", [1 << 16, 3])
def test_dense_vocabulary(spark, most):
    """Many near words, groups split down to one place, chains of forms."""
    rng = random.Random(most)
    words = [w for base in ("abababab", "bbbbbbbaaaaaa", "éabaéabaéaba", "aaaaaaa") for w in variants(rng, base, 60)]
    text = " ".join(w for w in words for _ in range(rng.choice([1, 2, 3, 30, 400])))
    rows = [(i, text) for i in range(3)] + [(None, text)]
    want = brute(counts(rows))
    assert any(w[1] != w[2] and w[1] for w in want)  # a form that has a form
    assert run(spark, rows, group=most, cells=300) == want


@pytest.mark.parametrize("seed", range(3))
def test_scan(seed):
    rng = random.Random(seed)
    words = sorted({w for base in ("abcabcab", "cabcabca") for w in variants(rng, base, 80, "abc")} | {"a", "ab", "b"})
    split = len(words) // 3
    sizes, group = np.array([len(w) for w in words]), np.repeat([0, 1], [split, len(words) - split])
    letters = np.array([list(w.encode("latin-1").ljust(sizes.max() + 1, b"\0")) for w in words], np.uint8)
    query, word = spelling_groups.scan(letters, sizes, group)
    want = [(i, j) for i in range(len(words)) for j in range(len(words)) if group[i] == group[j] and one_edit(words[i], words[j])]
    assert sorted(zip(query.tolist(), word.tolist())) == want


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(spelling_groups.word_slices, "__defaults__", ("text", 100))
    rows = [(1, "Evenings mornings. " * 200 + "q" * 500 + " " + "q" * 500), (2, " " * 2000 + "evenings")]
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    got = Counter()
    for b in spelling_groups.word_counts(iter([batch])):
        got.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    assert {w: n for w, n in got.items() if n >= 2} == counts(rows)


def test_whole_documents_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in spelling_groups.spelling_groups(docs).collect()), key=str) == brute(counts(rows))
